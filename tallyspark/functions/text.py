"""String cleaning, extraction and word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean(value: Column | str) -> Column:
    """Trimmed, inner white space squeezed to one blank, lower case."""
    value = F.col(value) if isinstance(value, str) else value
    return F.lower(F.trim(F.regexp_replace(value, r"\s+", " ")))


def title(value: Column | str) -> Column:
    """Cleaned, each word with a capital."""
    return F.initcap(clean(value))


def host(url: Column | str) -> Column:
    """Host of a URL without user and port; empty string if there is none.

    What Spark's parser refuses (a blank in the path, say) is read by pattern.
    """
    url = F.col(url) if isinstance(url, str) else url
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:@\[]+)"
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.regexp_extract(url, pattern, 1)))


def url_parameter(url: Column | str, name: str) -> Column:
    """Value of a query parameter; empty string if there is none."""
    url = F.col(url) if isinstance(url, str) else url
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return F.regexp_extract(query, rf"(?:^|&)\Q{name}\E=([^&]*)", 1)


def words(value: Column | str) -> Column:
    """Lower-case pieces of a whole text between white space; the first and
    the last may be empty."""
    value = F.col(value) if isinstance(value, str) else value
    return F.split(F.lower(value), r"\s+")


def word_count(df: DataFrame, column: str) -> DataFrame:
    """(word, n) over all rows; counted before the shuffle.

    Empty pieces go after the explode, where the test is compiled code.
    """
    single = df.select(F.explode(words(column)).alias("word")).where(F.col("word") != "")
    return single.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
