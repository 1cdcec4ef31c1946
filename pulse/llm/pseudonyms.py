"""Format-preserving pseudonyms for personal data in text.

Numbers and dates that are valid (a card number by its Luhn digit, an account number by
its remainder, an address by its octets, a date by the calendar, ...) are replaced by another valid value of
the same format. The value is read as a number below the size of its format, and a keyed
Feistel network permutes these numbers (sizes that are no product of equal halves by cycle walking), so
equal values get equal pseudonyms in every document, different values different ones, and
the key's owner can go back. No value is its own pseudonym: E^-1(E(x) + 1) is taken, a keyed
permutation without fixed points.

Addresses of mail may have a name and a domain of any length. Keys and tokens behind their name may have any
length from 16 characters on, and parts with dots between. What has above 128 characters is changed block by block.
Days and months may have one digit, and keep it.

What stays: secrets under 16 characters; behind a colon also those that are one word of letters in one case ("key:
responsibilities"), with a capital or without; dates before 1900 or after 2099; numbers that their own check refuses.

Rows are treated one by one, in one pass without a shuffle. Null text stays null, an empty
text stays empty; all other columns stay as they are, but one named as the spans, which is replaced. Repeated rows
get equal texts, an empty table gives none.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.llm.common import bounded_batches, plain

ROUNDS = 8


class Feistel:
    """A keyed permutation of the numbers below `size`."""

    def __init__(self, key: bytes, kind: str, size: int) -> None:
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.width = self.half // 8 + 1
        self.key = hmac.new(key, f"{kind}:{size}".encode(), hashlib.sha256).digest()

    def _round(self, number: int, value: int) -> int:
        data = bytes([number]) + value.to_bytes(self.width, "little")
        digest = hashlib.blake2b(data, key=self.key, digest_size=min(64, self.width)).digest()
        return int.from_bytes(digest, "little") & self.mask

    def _once(self, x: int, back: bool) -> int:
        left, right = x >> self.half, x & self.mask
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ self._round(i, left), left
            else:
                left, right = right, left ^ self._round(i, right)
        return left << self.half | right

    def _walk(self, x: int, back: bool) -> int:
        x = self._once(x, back)
        while x >= self.size:
            x = self._once(x, back)
        return x

    def swap(self, x: int, back: bool = False) -> int:
        """The pseudonym of x, or what it stands for. Only a size of 1 leaves x as it is."""
        step = -1 if back else 1
        return self._walk((self._walk(x, False) + step) % self.size, True)


@lru_cache(maxsize=4096)
def _network(key: bytes, kind: str, size: int) -> Feistel:
    return Feistel(key, kind, size)


def luhn_digit(digits: str) -> str:
    """The check digit that belongs behind the digits."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _into(template: str, characters: str) -> str:
    """The template with its letters and digits replaced in order; marks and spaces stay."""
    new = iter(characters)
    return "".join(next(new) if c.isalnum() else c for c in template)


def _alphabet(c: str) -> str | None:
    if "0" <= c <= "9":
        return "0123456789"
    if "a" <= c <= "z":
        return "abcdefghijklmnopqrstuvwxyz"
    if "A" <= c <= "Z":
        return "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return None


def _characters(text: str, key: bytes, kind: str, back: bool) -> str:
    """Letters to letters of their case, digits to digits, the rest unchanged."""
    sets = [_alphabet(c) for c in text]
    size, value = 1, 0
    for c, s in zip(text, sets, strict=True):
        if s:
            size, value = size * len(s), value * len(s) + s.index(c)
    if size == 1:
        return text
    shape = "".join(s[0] if s else c for c, s in zip(text, sets, strict=True))
    value = _network(key, f"{kind}:{shape}", size).swap(value, back)
    out = []
    for c, s in zip(reversed(text), reversed(sets), strict=True):
        if s:
            value, at = divmod(value, len(s))
            c = s[at]
        out.append(c)
    return "".join(reversed(out))


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _card(m: re.Match, key: bytes, back: bool) -> str | None:
    digits = _digits(m[0])
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = len(digits) - 1
    new = str(_network(key, "card", 10**body).swap(int(digits[:-1]), back)).zfill(body)
    if len(set(new + luhn_digit(new))) == 1:  # a run of one digit isn't read as a number, so it is stepped over
        new = str(_network(key, "card", 10**body).swap(int(new), back)).zfill(body)
    return _into(m[0], new + luhn_digit(new))


def _phone(m: re.Match, key: bytes, back: bool) -> str | None:
    prefix, rest = m["country"] or "", m[0][len(m["country"] or "") :]
    digits = _digits(rest)
    new = str(_network(key, "phone", 10 ** len(digits)).swap(int(digits), back)).zfill(len(digits))
    return prefix + _into(rest, new)


def _social(m: re.Match, key: bytes, back: bool) -> str | None:
    area, group, serial = int(m["area"]), int(m["group"]), int(m["serial"])
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    rank = area - 1 - (area > 666)
    value = (rank * 99 + group - 1) * 9999 + serial - 1
    value = _network(key, "social", 898 * 99 * 9999).swap(value, back)
    value, serial = divmod(value, 9999)
    rank, group = divmod(value, 99)
    area = rank + 1 + (rank >= 665)
    return f"{area:03}{m['mark']}{group + 1:02}{m['mark']}{serial + 1:04}"


def _remainder(country: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(m: re.Match, key: bytes, back: bool) -> str | None:
    plain = m[0].replace(" ", "")
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(body) <= 30 or int(check) != 98 - _remainder(country, body):
        return None
    body = _characters(body, key, f"iban:{country}", back)
    return _into(m[0], f"{country}{98 - _remainder(country, body):02}{body}")


def _address(m: re.Match, key: bytes, back: bool) -> str | None:
    octets = m[0].split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    value = int.from_bytes(bytes(map(int, octets)), "big")
    return ".".join(map(str, _network(key, "address", 1 << 32).swap(value, back).to_bytes(4, "big")))


_MONTHS = "January February March April May June July August September October November December".split()
_NAMED = "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in _MONTHS)
_DAY_ONE = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _DAY_ONE


def _date(m: re.Match, key: bytes, back: bool) -> str | None:
    year_first = m["y1"] is not None
    year = m["y1"] or m["y2"]
    month, day = (m["m1"], m["d1"]) if year_first else (m["a2"], m["b2"])
    mark = m["s1"] if year_first else m["s2"]
    fields = month, day
    day_first = not year_first and (mark == "." or int(month) > 12)
    if day_first:
        month, day = day, month
    try:
        at = datetime.date(int(year), int(month), int(day)).toordinal() - _DAY_ONE
    except ValueError:
        return None
    if not 0 <= at < _DAYS:
        return None
    # A format's days: those that are read back in the same order of day and month, and written as wide.
    narrow = min(map(len, fields)) == 1
    network = _network(key, "date", _DAYS)
    while True:
        at = network.swap(at, back)
        new = datetime.date.fromordinal(at + _DAY_ONE)
        if day_first and mark != "." and new.day <= 12:
            continue
        pair = (new.day, new.month) if day_first else (new.month, new.day)
        # Beside a field of one digit, one of two digits keeps its leading zero or that it has none.
        if narrow and any((n < 10) != (len(f) == 1 or f[0] == "0") for n, f in zip(pair, fields, strict=True)):
            continue
        one, two = (f"{n:0{len(f)}}" for n, f in zip(pair, fields, strict=True))
        return f"{new.year:04}{mark}{one}{mark}{two}" if year_first else f"{one}{mark}{two}{mark}{new.year:04}"


def _written_date(m: re.Match, key: bytes, back: bool) -> str | None:
    """5 March 1984, March 5, 1984, 5 Mar 1984: the style and the length of the month's name stay."""
    name = m["n1"] or m["n2"]
    month = next(i for i, n in enumerate(_MONTHS) if n[:3].lower() == name[:3].lower())
    short = len(name) == 3
    try:
        at = datetime.date(int(m["y1"] or m["y2"]), month + 1, int(m["d1"] or m["d2"])).toordinal() - _DAY_ONE
    except ValueError:
        return None
    if not 0 <= at < _DAYS:
        return None
    network = _network(key, "date", _DAYS)
    while True:
        at = network.swap(at, back)
        new = datetime.date.fromordinal(at + _DAY_ONE)
        # May is its own short form, so it counts among the short ones: what is written is read back.
        if new.month != 5 or short:
            break
    word = _MONTHS[new.month - 1]
    word = word[:3] if short else word
    word = word.upper() if name.isupper() else word.lower() if name.islower() else word
    return f"{new.day} {word} {new.year}" if m["n1"] else f"{word} {new.day}{m['comma']} {new.year}"


_BLOCK = 128


def _in_blocks(value: str, key: bytes, name: str, back: bool, change: Callable[[str, bytes], str]) -> str:
    """A long value in blocks, each under a key made of the plain blocks before: its numbers stay within what a
    round changes."""
    if len(value) <= _BLOCK:
        return change(value, key)
    parts, chain = [], hmac.new(key, f"{name}:{len(value)}".encode(), hashlib.sha256)
    for at in range(0, len(value), _BLOCK):
        given = value[at : at + _BLOCK]
        parts.append(change(given, chain.digest()))
        chain.update((parts[-1] if back else given).encode())
    return "".join(parts)


def _email(m: re.Match, key: bytes, back: bool) -> str | None:
    kind = "email:" + m["domain"].lower()
    new = _in_blocks(m["local"], key, "long " + kind, back, lambda value, k: _characters(value, k, kind, back))
    return f"{m[0][: m.start('local') - m.start()]}{new}@{m['domain']}"



def _secret_block(value: str, key: bytes, hexadecimal: bool, upper: bool, back: bool) -> str:
    if not hexadecimal:
        return _characters(value, key, "secret", back)
    number = _network(key, f"hex{len(value)}", 16 ** len(value)).swap(int(value, 16), back)
    new = f"{number:0{len(value)}x}"
    return new.upper() if upper else new


_PLAIN_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


def _secret(m: re.Match, key: bytes, back: bool) -> str | None:
    value = m["value"]
    if value is None or (m["mark"] == ":" and _PLAIN_WORD.fullmatch(value)):
        return None
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) is not None
    upper = hexadecimal and value != value.lower()
    new = _in_blocks(value, key, "long secret", back, lambda part, k: _secret_block(part, k, hexadecimal, upper, back))
    return m[0][: m.start("value") - m.start()] + new + m[0][m.end("value") - m.start() :]


# A secret has a part of 16 characters at least; short parts with dots are stepped over, so that none is read twice.
# In order of precedence: what an earlier kind has taken, a later one doesn't see.
KINDS: dict[str, tuple[str, Callable[[re.Match, bytes, bool], str | None]]] = {
    "email": (r"(?<![\w.%+-])[._%+-]*+(?P<local>[A-Za-z0-9][A-Za-z0-9._%+-]*+)@(?P<domain>(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24})(?![\w-])", _email),
    "secret": (r"(?i:\b(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|key)\b[\"']?\s{0,3}(?P<mark>[:=])\s{0,3}[\"']?)(?:(?P<value>(?:[A-Za-z0-9_+/=-]{1,15}+\.)*+[A-Za-z0-9_+/=-]{16,}+(?:\.[A-Za-z0-9_+/=-]++)*+)|(?:[A-Za-z0-9_+/=-]{1,15}+\.)++)", _secret),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])", _iban),
    "card": (r"(?<![\w.+-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-]|\.\d)", _card),
    "address": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", _address),
    "date": (r"(?<![\w./-])(?:(?P<y1>(?:19|20)\d\d)(?P<s1>[-/.])(?P<m1>\d{1,2})(?P=s1)(?P<d1>\d{1,2})|(?P<a2>\d{1,2})(?P<s2>[-/.])(?P<b2>\d{1,2})(?P=s2)(?P<y2>(?:19|20)\d\d))(?![\w/-]|\.\d)", _date),
    "written date": (rf"(?i:(?<![\w.-])(?:(?P<d1>[1-9]|[12]\d|3[01]) (?P<n1>{_NAMED}) (?P<y1>(?:19|20)\d\d)|(?P<n2>{_NAMED}) (?P<d2>[1-9]|[12]\d|3[01])(?P<comma>,?) (?P<y2>(?:19|20)\d\d)))(?![\w-])", _written_date),
    "social": (r"(?<![\w-])(?P<area>\d{3})(?P<mark>[- ])(?P<group>\d{2})(?P=mark)(?P<serial>\d{4})(?![\w-])", _social),
    "phone": (r"(?<![\w+])(?:(?P<country>\+\d{1,3})[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[-. ]\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?![\w-])", _phone),
}
# Words in capitals with marks put between them are still read: "TOKEN = \"9F..\"!!".
_PATTERNS = {kind: (re.compile(pattern, re.ASCII), change) for kind, (pattern, change) in KINDS.items()}


def replace(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of each in the new text."""
    found: list[tuple[int, int, str, str]] = []
    for kind, (pattern, change) in _PATTERNS.items():
        if kind == "email" and "@" not in text:
            continue
        for m in pattern.finditer(text):
            if any(m.start() < e and s < m.end() for s, e, *_ in found):
                continue
            new = change(m, key, back)
            if new is not None:
                found.append((m.start(), m.end(), kind, new))
    out, spans, at, size = [], [], 0, 0
    for start, end, kind, new in sorted(found):
        out += [text[at:start], new]
        size += start - at
        spans.append((size, size + len(new), kind))
        size += len(new)
        at = end
    return "".join(out) + text[at:], spans


_SPANS = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (("start", T.IntegerType()), ("end", T.IntegerType()), ("kind", T.StringType()))]))


def pseudonymise(
    docs: DataFrame, key: str, text_col: str = "text", spans: str | None = "pii_spans", back: bool = False
) -> DataFrame:
    """The rows with pseudonyms in the text and, if named, a column of their spans (start, end, kind).

    `back` turns pseudonyms into the values again. A column of the spans' name is replaced.
    """
    secret = key.encode()
    result = T.StructType([T.StructField("text", T.StringType()), T.StructField("spans", _SPANS)])
    risky = re.compile(r"[\d@:=]")

    @F.pandas_udf(result)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            rows = [
                (t, []) if not isinstance(t, str) or not risky.search(t) else replace(t, secret, back) for t in part
            ]
            yield pd.DataFrame(rows, columns=["text", "spans"])

    changed = run(F.col(text_col).cast("string"))
    bounded_batches(docs.sparkSession)
    columns = [plain(c) for c in docs.columns if c != spans]
    marked = docs.select(F.struct(*columns).alias("row"), changed.alias("new"))
    kept = [F.col("new.text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c != spans]
    return marked.select(*kept, *([F.col("new.spans").alias(spans)] if spans else []))
