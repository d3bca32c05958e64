"""Replace personal data by keyed pseudonyms of the same format.

Found are e-mail addresses, account numbers (IBAN), payment cards, telephone
numbers, social security numbers, network addresses and dates, each validated
(check digits, ranges, calendar). A value's format stays: separators, length,
country codes and check digits that fit; the rest is a number below some N, which a
keyed permutation of 0..N-1 maps. The permutation is a Feistel network over two
residues, walked until it falls below N, and conjugates a shift: equal values get
equal pseudonyms in all documents, different values of a format different ones, and
no value keeps its own.

A null text stays null, an empty one empty; texts are searched whole. Repeated rows
are treated alike.
"""

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

ROUNDS = 8


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of 0..size-1 without fixed points (from size 2 on).

    A Feistel network maps pairs of residues modulo ``rows`` and ``columns``; results
    of ``size`` or more are mapped again until one falls below it.
    """

    key: bytes
    name: str
    size: int

    @property
    def columns(self) -> int:
        return math.isqrt(self.size - 1) + 1

    @property
    def rows(self) -> int:
        return -(-self.size // self.columns)

    def _mix(self, turn: int, value: int) -> int:
        data = f"{self.name}|{self.size}|{turn}|{value}".encode()
        return int.from_bytes(blake2b(data, key=self.key, digest_size=16).digest(), "big")

    def forth(self, x: int) -> int:
        while True:
            a, b = divmod(x, self.columns)
            for turn in range(0, ROUNDS, 2):
                a = (a + self._mix(turn, b)) % self.rows
                b = (b + self._mix(turn + 1, a)) % self.columns
            x = a * self.columns + b
            if x < self.size:
                return x

    def back(self, x: int) -> int:
        while True:
            a, b = divmod(x, self.columns)
            for turn in range(ROUNDS - 2, -1, -2):
                b = (b - self._mix(turn + 1, a)) % self.columns
                a = (a - self._mix(turn, b)) % self.rows
            x = a * self.columns + b
            if x < self.size:
                return x

    def __call__(self, x: int) -> int:
        if self.size < 2:
            return x
        shift = 1 + self._mix(ROUNDS, 0) % (self.size - 1)
        return self.back((self.forth(x) + shift) % self.size)


# --- numbers in mixed radix --------------------------------------------------------

def _pack(digits: list[int], radices: list[int]) -> int:
    x = 0
    for d, r in zip(digits, radices):
        x = x * r + d
    return x


def _unpack(x: int, radices: list[int]) -> list[int]:
    out = []
    for r in reversed(radices):
        x, d = divmod(x, r)
        out.append(d)
    return out[::-1]


def _permuted(key: bytes, name: str, digits: list[int], radices: list[int]) -> list[int]:
    return _unpack(Permutation(key, name, math.prod(radices))(_pack(digits, radices)), radices)


def _refill(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced, in order."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in pattern)


# --- kinds: a shape, and a pseudonym of a match, or None if it isn't valid ----------

def luhn_digit(digits: str) -> str:
    """The check digit that ``digits`` want."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _card(key: bytes, found: str) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 13 <= len(digits) <= 19 or digits[0] not in "23456" or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    radices = [10] * (len(digits) - 2)  # the first digit tells the network and stays
    body = digits[0] + "".join(map(str, _permuted(key, "card", [int(c) for c in digits[1:-1]], radices)))
    return _refill(found, body + luhn_digit(body))


def _iban_check(country: str, account: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


def _iban(key: bytes, found: str) -> str | None:
    plain = found.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(account) <= 30 or _iban_check(country, account) != check:
        return None
    radices = [10 if c.isdigit() else 26 for c in account]
    shape = "".join("0" if c.isdigit() else "A" for c in account)
    drawn = _permuted(key, f"iban {country} {shape}", [int(c) if c.isdigit() else ord(c) - 65 for c in account], radices)
    new = "".join(str(d) if r == 10 else chr(65 + d) for d, r in zip(drawn, radices))
    left = iter(country + _iban_check(country, new) + new)
    return "".join(c if c == " " else next(left) for c in found)


def _phone(key: bytes, found: str) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 8 <= len(digits) <= 15:
        return None
    if found.lstrip("(").startswith("+"):
        kept = len(re.match(r"\+(\d{1,3})", found.lstrip("("))[1])
        own = [int(c) for c in digits[kept:]]
        lows, radices = [0] * len(own), [10] * len(own)
    else:  # of the North American plan: area and exchange begin with 2 to 9
        kept, own = 0, [int(c) for c in digits]
        if len(own) != 10 or own[0] < 2 or own[3] < 2:
            return None
        lows, radices = [2, 0, 0, 2] + [0] * 6, [8, 10, 10, 8] + [10] * 6
    drawn = _permuted(key, f"phone {digits[:kept]}", [d - low for d, low in zip(own, lows)], radices)
    return _refill(found, digits[:kept] + "".join(str(d + low) for d, low in zip(drawn, lows)))


def _social(key: bytes, found: str) -> str | None:
    area, group, serial = (int(p) for p in found.split(found[3]))
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    a, g, s = _permuted(key, "social", [area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999])
    return f"{a + 1 + (a >= 665):03d}{found[3]}{g + 1:02d}{found[3]}{s + 1:04d}"


def _address(key: bytes, found: str) -> str | None:
    parts = found.split(".")
    octets = [int(p) for p in parts]
    # Not this host and the loopback range: they name no one.
    if any(o > 255 or str(o) != p for o, p in zip(octets, parts)) or octets[0] in (0, 127):
        return None
    a, *rest = _permuted(key, "address", [octets[0] - 1 - (octets[0] > 127), *octets[1:]], [254, 256, 256, 256])
    return ".".join(map(str, [a + 1 + (a >= 126), *rest]))


FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
DAYS = (LAST_DAY - FIRST_DAY).days + 1


def _date(key: bytes, found: str) -> str | None:
    parts = re.findall(r"\d+|\D+", found)
    numbers = [int(p) for p in parts[::2]]
    if len(parts[0]) == 4:
        orders = ((0, 1, 2),)
    else:  # day first, unless only the other reading is a date
        orders = ((2, 1, 0), (2, 0, 1))
    for order in orders:
        try:
            day = date(*(numbers[i] for i in order))
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            continue
        new = FIRST_DAY + timedelta(Permutation(key, "date", DAYS)((day - FIRST_DAY).days))
        padded = all(len(p) >= 2 for p in parts[::2])
        for place, value in zip(order, (new.year, new.month, new.day)):
            parts[2 * place] = f"{value:02d}" if padded else str(value)
        return "".join(parts)
    return None


def _mail(key: bytes, found: str) -> str | None:
    local, domain = found.rsplit("@", 1)
    if ".." in found or len(local) > 64 or local[0] == "." or local[-1] == "." or domain[0] in ".-":
        return None
    places = [i for i, c in enumerate(local) if c.isascii() and c.isalnum()]
    if not places:
        return None
    lowered = local.lower()
    radices = [10 if lowered[i].isdigit() else 26 for i in places]
    drawn = _permuted(key, "mail " + re.sub(r"[a-z]", "a", re.sub(r"\d", "0", lowered)) + "@" + domain.lower(),
                      [int(lowered[i]) if lowered[i].isdigit() else ord(lowered[i]) - 97 for i in places], radices)
    out = list(local)
    for i, d, r in zip(places, drawn, radices):
        c = str(d) if r == 10 else chr(97 + d)
        out[i] = c.upper() if local[i].isupper() else c
    return "".join(out) + "@" + domain


# In the order in which equal starts are tried.
KINDS: tuple[tuple[str, re.Pattern[str], Callable[[bytes, str], str | None]], ...] = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?![A-Za-z0-9-])"), _mail),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"), _iban),
    ("card", re.compile(
        r"(?<![A-Za-z0-9+-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![A-Za-z0-9]|-\d)"), _card),
    ("phone", re.compile(
        r"(?<![\w.+-])(?:\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|"
        r"\d{3}([ .-])\d{3}\1\d{4})(?![\w-])"), _phone),
    ("social", re.compile(r"(?<![\w-])\d{3}([- ])\d{2}\1\d{4}(?![\w-])"), _social),
    ("address", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"), _address),
    ("date", re.compile(r"(?<![\w./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?!\w|[/-]|\.\d)"), _date),
)
# A text with neither a digit nor an at sign holds none of the kinds.
ANY = re.compile(r"[0-9@]")

Found = tuple[str, int, int, str]  # kind, start, end, pseudonym


@lru_cache(maxsize=100_000)
def _pseudonym(kind: int, key: bytes, found: str) -> str | None:
    return KINDS[kind][2](key, found)


def find_personal(text: str | None, key: bytes) -> list[Found]:
    """Valid finds by start, none overlapping: earlier kinds go before later ones."""
    if not text or not ANY.search(text):
        return []
    found: list[Found] = []  # by start
    for number, (kind, pattern, _) in enumerate(KINDS):
        own, at = [], 0  # matches of a kind come in order: one walk along the finds of earlier kinds
        for match in pattern.finditer(text):
            start, end = match.span()
            while at < len(found) and found[at][2] <= start:
                at += 1
            if at < len(found) and found[at][1] < end:
                continue
            value = match[0]
            new = _pseudonym(number, key, value)
            while new is None and kind == "iban" and " " in value:  # the last groups may be words
                value = value.rsplit(" ", 1)[0]
                new = _pseudonym(number, key, value)
            if new is not None:
                own.append((kind, start, start + len(value), new))
        found = sorted(found + own, key=lambda f: f[1])
    return found


def replace_personal(text: str, found: list[Found]) -> str:
    pieces, at = [], 0
    for _, start, end, new in found:
        pieces += [text[at:start], new]
        at = end
    return "".join([*pieces, text[at:]])


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())]))
_OUT = pa.struct([("text", pa.string()), ("found", _FOUND)])


def pseudonymise(docs: DataFrame, key: str, *, text: str = "text", found: str = "personal") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and what was found in ``found``.

    ``found`` is array<struct<kind, start, end, pseudonym>>, in code points of the old
    text, and replaces a column so named. The same ``key`` gives the same pseudonyms.
    """
    secret = blake2b(key.encode(), digest_size=32).digest()

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            old = t.as_py()
            own = find_personal(old, secret)
            out.append({"text": replace_personal(old, own) if own else old, "found": [
                {"kind": k, "start": s, "end": e, "pseudonym": n} for k, s, e, n in own]})
        return pa.array(out, _OUT)

    kept = [c for c in docs.columns if c != found]
    done = F.arrow_udf(run, "struct<text:string,found:array<struct<kind:string,start:int,end:int,pseudonym:string>>>")
    return (docs.select(*kept).withColumn("__done", done(F.col(text)))
            .select(*(F.col("__done.text").alias(c) if c == text else F.col(c) for c in kept),
                    F.col("__done.found").alias(found)))
