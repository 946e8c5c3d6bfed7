"""Format-preserving pseudonyms for personal data.

A value that is found and validated (a card number by its check digit, an
address by its octets, a date by the calendar ...) is turned into its rank
among the values of its format, the rank is permuted by a keyed Feistel network
that walks until it is back in the format's range, and the rank's value takes
its place in the text. The same value becomes the same pseudonym in every
document, separators and lengths stay, check digits are made right, and who has
the key can turn pseudonyms back. The key is a setting of the session, never
part of this code.

Kinds: e-mail addresses, card numbers, IBANs, telephone numbers, US social
security numbers, IPv4 addresses, dates, and the values of passwords, tokens
and keys. What fails its validation is left alone, and so is the rest of the
text.

Telephone numbers are any ten digits after +1, parted by a blank, dot or dash or
not at all, with or without brackets about the first three; the same without +1
where brackets or dots and dashes part them, as blanks alone or nothing would
take any number; and 8 to 15 digits after another country's code. Numbers whose
area code and exchange begin with 2 to 9 are a format of their own.

Not found: dates with one digit for the day or month, or with its name, IPv6
addresses, and ten digits without a mark of a telephone number.

Nulls: a null text stays null and has nothing replaced. Empty texts stay. Rows
are independent of each other, so repeated rows get the same answer. An empty
table gives an empty result. Time grows in proportion to a text's length.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import math
import re
import secrets
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tallyspark.llm.common import slices

_ROUNDS = 10

# The setting that names the key, and the keys of sessions without it.
KEY_SETTING = "spark.tallyspark.pseudonym.key"
_SESSION_KEYS: dict[str, str] = {}


def session_key(spark: SparkSession) -> str:
    """The key that the session is given in ``KEY_SETTING``.

    Without one, a random key that lasts as long as the application: values stay
    linked across its documents, and nobody can turn the pseudonyms back.
    """
    given = spark.conf.get(KEY_SETTING, None)
    return given or _SESSION_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


class Feistel:
    """A keyed permutation of 0..n-1 for any n, and its inverse."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _mix(self, kind: str, n: int, turn: int, half: int) -> int:
        text = f"{kind}|{n}|{turn}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=64).digest(), "big")

    def permute(self, kind: str, n: int, x: int, back: bool = False) -> int:
        if n < 2:
            return x
        a = math.isqrt(n - 1) + 1
        turns = range(_ROUNDS)
        while True:
            left, right = divmod(x, a)
            for turn in reversed(turns) if back else turns:
                sign = -1 if back else 1
                if turn % 2:
                    right = (right + sign * self._mix(kind, n, turn, left)) % a
                else:
                    left = (left + sign * self._mix(kind, n, turn, right)) % a
            x = left * a + right
            if x < n:
                return x


# ---- formats: a value's rank among the values of its format, and back ----

_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_HEX = "0123456789abcdef"


def _alphabets(text: str) -> list[str]:
    """For each character, the characters that may take its place; itself alone for a separator."""
    if re.fullmatch(r"[0-9a-f]+", text):
        return [_HEX] * len(text)
    return [_DIGITS if c in _DIGITS else _LOWER if c in _LOWER else _LOWER.upper() if c in _LOWER.upper() else c for c in text]


def _rank(text: str, alphabets: list[str]) -> tuple[int, int]:
    x, n = 0, 1
    for c, alphabet in zip(text, alphabets):
        x = x * len(alphabet) + alphabet.index(c)
        n *= len(alphabet)
    return x, n


def _unrank(x: int, alphabets: list[str]) -> str:
    out = []
    for alphabet in reversed(alphabets):
        x, i = divmod(x, len(alphabet))
        out.append(alphabet[i])
    return "".join(reversed(out))


Permute = Callable[[str, int, int], int]


def _characters(kind: str, text: str, permute: Permute) -> str:
    """Every letter and digit within its own class."""
    alphabets = _alphabets(text)
    x, n = _rank(text, alphabets)
    return _unrank(permute(f"{kind}:{''.join(a[0] for a in alphabets)}", n, x), alphabets)


def _into(shape: str, digits: str) -> str:
    """The digits in the places of the shape's digits."""
    it = iter(digits)
    return "".join(next(it) if c in _DIGITS else c for c in shape)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _card(text: str, permute: Permute) -> str | None:
    digits = _only_digits(text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or digits[0] == "0":
        return None
    # The first digit names the network and is part of the format.
    inner = digits[1:-1]
    body = digits[0] + str(permute(f"card:{digits[0]}", 10 ** len(inner), int(inner))).zfill(len(inner))
    return _into(text, body + luhn_digit(body))


def _iban(text: str, permute: Permute) -> str | None:
    plain = text.replace(" ", "")
    number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
    if not 15 <= len(plain) <= 34 or int(number) % 97 != 1:
        return None
    body = _characters(f"iban:{plain[:2]}", plain[4:], permute) if not re.fullmatch("[0-9]+", plain[4:]) else (
        str(permute(f"iban:{plain[:2]}", 10 ** len(plain[4:]), int(plain[4:]))).zfill(len(plain[4:]))
    )
    check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2]) + "00") % 97
    it = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(it) for c in text)


def _ranked_national(digits: str) -> tuple[str, int, int]:
    """(kind, how many, rank) of ten digits: area code and exchange both begin with 2 to 9, or they don't."""
    area, office, line = int(digits[:3]), int(digits[3:6]), int(digits[6:])
    if area >= 200 and office >= 200:
        return "phone", 800 * 800 * 10_000, ((area - 200) * 800 + office - 200) * 10_000 + line
    # First those of the area codes below 200, with any exchange, then the exchanges below 200.
    place = area * 1000 + office if area < 200 else 200 * 1000 + (area - 200) * 200 + office
    return "phone/01", (200 * 1000 + 800 * 200) * 10_000, place * 10_000 + line


def _unranked_national(kind: str, n: int, x: int, permute: Permute) -> str:
    place, line = divmod(permute(kind, n, x), 10_000)
    if kind == "phone":
        area, office = place // 800 + 200, place % 800 + 200
    elif place < 200 * 1000:
        area, office = divmod(place, 1000)
    else:
        area, office = (place - 200 * 1000) // 200 + 200, (place - 200 * 1000) % 200
    return f"{area:03d}{office:03d}{line:04d}"


def _phone(text: str, permute: Permute) -> str | None:
    digits = _only_digits(text)
    national = digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
    if not text.startswith("+") or digits[0] == "1":
        if len(national) != 10:
            return None
        new = _unranked_national(*_ranked_national(national), permute)
        return _into(text, digits[: len(digits) - 10] + new)
    if not 8 <= len(digits) <= 15:
        return None
    country = digits[:2]
    rest = digits[2:]
    return _into(text, country + str(permute(f"phone:{country}", 10 ** len(rest), int(rest))).zfill(len(rest)))


def _ssn(text: str, permute: Permute) -> str | None:
    area, group, serial = (int(p) for p in text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = area - 1 - (area > 666)
    x = permute("ssn", 898 * 99 * 9_999, (areas * 99 + group - 1) * 9_999 + serial - 1)
    areas, group, serial = x // (99 * 9_999), x // 9_999 % 99 + 1, x % 9_999 + 1
    return f"{areas + 1 + (areas >= 665):03d}-{group:02d}-{serial:04d}"


def _ip(text: str, permute: Permute) -> str | None:
    octets = [int(p) for p in text.split(".")]
    if max(octets) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    x = permute("ip", 1 << 32, int.from_bytes(bytes(octets), "big"))
    return ".".join(map(str, x.to_bytes(4, "big")))


_FIRST = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST


def _date(text: str, permute: Permute) -> str | None:
    a, mark, b, _, c = re.split(r"([-/.])", text)
    if len(a) == 4:
        order = "ymd"
    elif mark == "/" and int(a) <= 12:
        order = "mdy"
    else:
        order = "dmy"
    try:
        day = datetime.date(**{{"y": "year", "m": "month", "d": "day"}[o]: int(p) for o, p in zip(order, (a, b, c))})
    except ValueError:
        return None
    x = day.toordinal() - _FIRST
    if not 0 <= x < _DAYS:
        return None
    # Days of 12 and less read as either order where slashes part them, so they stay in one class.
    if order != "ymd" and mark == "/":
        if day.day <= 12:
            x = permute("date/12", 200 * 12 * 12, ((day.year - 1900) * 12 + day.month - 1) * 12 + day.day - 1)
            new = datetime.date(x // 144 + 1900, x // 12 % 12 + 1, x % 12 + 1)
        else:
            late = _late_days()
            new = late[permute(f"date/{order}", len(late), _late_place()[day])]
    else:
        new = datetime.date.fromordinal(permute("date", _DAYS, x) + _FIRST)
    parts = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
    return mark.join(parts[o] for o in order)


_LATE: list[datetime.date] = []
_PLACE: dict[datetime.date, int] = {}


def _late_days() -> list[datetime.date]:
    """The days after the 12th of their month."""
    if not _LATE:
        days = (datetime.date.fromordinal(_FIRST + i) for i in range(_DAYS))
        _LATE.extend(d for d in days if d.day > 12)
        _PLACE.update({d: i for i, d in enumerate(_LATE)})
    return _LATE


def _late_place() -> dict[datetime.date, int]:
    _late_days()
    return _PLACE


def _email(text: str, permute: Permute) -> str | None:
    local, domain = text.rsplit("@", 1)
    labels, top = domain.rsplit(".", 1)
    return f"{_characters('local', local, permute)}@{_characters('domain', labels, permute)}.{top}"


def _secret(text: str, permute: Permute) -> str | None:
    return _characters("secret", text, permute)


# In the order in which they are looked for: what is found first keeps its place.
_EDGE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
_FINDERS: list[tuple[str, str, re.Pattern, Callable[[str, Permute], str | None]]] = [
    ("secret", "=:", re.compile(r"(?i)\b(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?(?P<v>[A-Za-z0-9_\-]{6,})"), _secret),
    ("email", "@", re.compile(r"(?<![A-Za-z0-9._%+\-])(?P<v>[A-Za-z0-9](?:[A-Za-z0-9._%+\-]{0,62}[A-Za-z0-9_%+\-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24})" + _END), _email),
    ("iban", "", re.compile(_EDGE + r"(?P<v>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)" + _END), _iban),
    ("ip", ".", re.compile(r"(?<![0-9A-Za-z.])(?P<v>[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})(?![0-9A-Za-z]|\.[0-9])"), _ip),
    ("date", "-/.", re.compile(r"(?<![0-9A-Za-z./\-])(?P<v>[0-9]{4}([-/.])[0-9]{2}\2[0-9]{2}|[0-9]{2}([/.])[0-9]{2}\3[0-9]{4})(?=T[0-9]{2}:|(?![0-9A-Za-z]|[./\-][0-9]))"), _date),
    ("ssn", "-", re.compile(r"(?<![0-9A-Za-z\-])(?P<v>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9A-Za-z]|-[0-9])"), _ssn),
    ("phone", "+()-.", re.compile(r"(?<![0-9A-Za-z+])(?P<v>\+1[ .\-]?(?:\([0-9]{3}\)|[0-9]{3})[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}|(?:1[ .\-]?)?(?:\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-]?|[0-9]{3}[.\-][0-9]{3}[.\-])[0-9]{4})" + _END), _phone),
    ("phone", "+", re.compile(r"(?<![0-9A-Za-z+])(?P<v>\+[2-9][0-9](?:[ .\-]?\(?[0-9]{2,4}\)?){2,5})" + _END), _phone),
    ("card", "", re.compile(_EDGE + r"(?P<v>[0-9]{13,19}|[0-9]{4}([ \-])[0-9]{4}\2[0-9]{4}\2[0-9]{1,7}|[0-9]{4}([ \-])[0-9]{6}\3[0-9]{5})" + _END), _card),
]
_HINT = re.compile(r"[0-9@]|(?i:password|passwd|pwd|token|secret|key)")


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the values that hold their validation, in order, not overlapping."""
    return [(s, e, k) for s, e, k, _ in _found(text, lambda kind, n, x: x)]


def _found(text: str, permute: Permute) -> list[tuple[int, int, str, str]]:
    if not text or not _HINT.search(text):
        return []
    taken: list[tuple[int, int, str, str]] = []
    for kind, needs, pattern, turn in _FINDERS:
        if needs and not any(c in text for c in needs):
            continue
        found = []  # those of one pattern don't overlap
        for m in pattern.finditer(text):
            s, e = m.span("v")
            # What is taken is in order and doesn't overlap: only the last one before the end can be in the way.
            at = bisect.bisect_left(taken, (e,))
            if at and taken[at - 1][1] > s:
                continue
            new = turn(m["v"], permute)
            if new is not None:
                found.append((s, e, kind, new))
        if found:
            taken = sorted(taken + found)
    return taken


def pseudonymised(text: str, feistel: Feistel, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and their (start, end, kind) in it. ``back`` turns pseudonyms into values."""
    out, spans, at, length = [], [], 0, 0
    for s, e, kind, new in _found(text, lambda k, n, x: feistel.permute(k, n, x, back)):
        out += [text[at:s], new]
        length += s - at
        spans.append((length, length + len(new), kind))
        length += len(new)
        at = e
    return "".join([*out, text[at:]]), spans


SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("kind", StringType())]))


def _replacer(key: bytes, back: bool, spans_name: str | None):
    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for batch in slices(batches):
            at = batch.schema.names.index("text")
            texts, spans = [], []
            for text in batch.column(at).to_pylist():
                new, found = pseudonymised(text, feistel, back) if text else (text, [])
                texts.append(new)
                if spans_name:
                    spans.append([dict(zip(("start", "end", "kind"), f)) for f in found])
            columns, names = list(batch.columns), list(batch.schema.names)
            columns[at] = pa.array(texts, pa.string())
            if spans_name:
                columns, names = [*columns, pa.array(spans, spans_type)], [*names, spans_name]
            yield pa.RecordBatch.from_arrays(columns, names)

    return replace


def pseudonyms(docs: DataFrame, key: str, back: bool = False, spans: str | None = "spans") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and where they stand and of what kind they are in a column named ``spans``.

    A column of ``docs`` of that name gives way to it, so name another to keep
    both; with None there are the columns of ``docs`` alone, all of them.
    """
    rows = docs.drop(spans) if spans in docs.columns else docs
    added = [StructField(spans, SPANS)] if spans else []
    return rows.mapInArrow(_replacer(key.encode(), back, spans), StructType([*rows.schema.fields, *added]))


def replaced_count(spans: str = "spans") -> Column:
    return F.size(spans).cast("long")
