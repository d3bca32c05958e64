"""Find secrets in texts: known shapes, and strings of high entropy.

Per text three known shapes are searched (a value assigned to a telling name, a
cloud access id, a long hexadecimal run). Beside them every long string of
token characters is a candidate: a window slides over it, its Shannon entropy
is kept up by incremental counts, and stretches whose windows reach the
threshold of their character class become spans. Stretches that the allow-list
explains are cut out of a candidate and the rest is measured; a digest announced by
the word before it clears its whole candidate. What is reported is what is masked.

Spans count code points, end exclusive. A null or empty text has none; texts
are searched whole; repeated rows are searched each for itself.
"""

import math
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Shapes of the known kinds, each with the part that must be long
# enough and that length; in the order in which equal starts are listed.
KNOWN = (
    ("assign", re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}"), 0, 32),
)
# One of these is part of every name that "assign" looks for.
NAME_HINTS = ("passw", "secret", "token", "api")


@dataclass(frozen=True)
class TokenClass:
    """A character class whose runs are measured, and what makes a window hot."""

    kind: str
    runs: re.Pattern[str]
    window: int
    bits: float


# A window of 20 random hexadecimal digits has about 3.4 bits a character, one
# of 20 random base-64 characters about 4.1; words of a language stay below 3.2.
CLASSES = (
    TokenClass("entropy_hex", re.compile(r"[0-9A-Fa-f]+"), 20, 2.9),
    TokenClass("entropy_base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 20, 3.75),
)
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")

# Strings that look random and are none: identifiers in UUID form, running
# alphabets, placeholders, and digests announced by the word before them.
ALLOWED = (
    re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"),
    re.compile(r"0123456789|123456789[0a]|abcdefghij|qwertyuiop", re.IGNORECASE),
    re.compile(r"example|sample|placeholder|changeme|dummy|xxxx", re.IGNORECASE),
)
DIGEST_BEFORE = re.compile(
    r"(md5|sha-?1|sha-?256|sha-?512|commit|checksum|digest|integrity|etag)[\"']?\s*[:= -]\s*[\"']?$",
    re.IGNORECASE)
CONTEXT = 24

Span = tuple[str, int, int]
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
REDACTED = "[secret]"


def known_spans(text: str) -> list[Span]:
    """Matches of the known shapes, leftmost and non-overlapping per kind."""
    found = []
    lowered = text.lower()
    for kind, pattern, part, least in KNOWN:
        if kind == "assign" and not any(hint in lowered for hint in NAME_HINTS):
            continue
        for match in pattern.finditer(text):
            if match.end(part) - match.start(part) >= least:
                found.append((kind, match.start(), match.end()))
    return found


def hot_stretches(run: str, window: int, bits: float) -> Iterator[tuple[int, int]]:
    """Merged windows of ``run`` whose entropy is at least ``bits`` a character.

    H = log2 w - (1/w) * sum c log2 c; moving on by one character changes two counts.
    """
    if len(run) < window:
        return
    weigh = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    most = (math.log2(window) - bits) * window + 1e-9
    counts: dict[str, int] = {}
    total = 0.0
    begin = end = -1
    for i, char in enumerate(run):
        if i >= window:
            old = run[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += weigh[c - 1] - weigh[c]
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += weigh[c + 1] - weigh[c]
        if i >= window - 1 and total <= most:
            first = i - window + 1
            if begin >= 0 and first > end:
                yield begin, end
                begin = first
            elif begin < 0:
                begin = first
            end = i + 1
    if begin >= 0:
        yield begin, end


def _mixed(piece: str) -> bool:
    return any(c.isdigit() for c in piece) and any(c.isalpha() for c in piece)


def _pieces(text: str, start: int, end: int, allow: Sequence[re.Pattern[str]]) -> Iterator[tuple[int, int]]:
    """What is left of a candidate when the stretches that the allow-list explains are cut out."""
    if DIGEST_BEFORE.search(text[max(0, start - CONTEXT):start]):
        return
    for begin, stop in [*sorted(m.span() for p in allow for m in p.finditer(text, start, end)), (end, end)]:
        if begin > start:
            yield start, begin
        start = max(start, stop)


def entropy_spans(text: str, classes: Sequence[TokenClass] = CLASSES,
                  allow: Sequence[re.Pattern[str]] = ALLOWED) -> list[Span]:
    """Stretches of high entropy in long token strings, letters and digits mixed, of each class for itself."""
    found: list[Span] = []
    for candidate in CANDIDATE.finditer(text):
        if not _mixed(candidate[0]):
            continue
        for start, end in _pieces(text, *candidate.span(), allow):
            for c in classes:
                for run in c.runs.finditer(text, start, end):
                    for begin, stop in hot_stretches(run[0], c.window, c.bits):
                        begin, stop = run.start() + begin, run.start() + stop
                        if _mixed(text[begin:stop]):
                            found.append((c.kind, begin, stop))
    return found


ORDER = {kind: i for i, kind in enumerate([k[0] for k in KNOWN] + [c.kind for c in CLASSES])}


def secret_spans(text: str | None, classes: Sequence[TokenClass] = CLASSES,
                 allow: Sequence[re.Pattern[str]] = ALLOWED) -> list[Span]:
    """All spans by start, then kind. Spans of different kinds may overlap; a hot stretch
    within one span of a known shape adds nothing and is left out."""
    if not text:
        return []
    found = sorted(known_spans(text), key=lambda s: s[1])
    starts = [s[1] for s in found]
    reach = list(accumulate((s[2] for s in found), max))  # how far the spans up to here go
    for span in entropy_spans(text, classes, allow):
        i = bisect_right(starts, span[1])
        if not i or reach[i - 1] < span[2]:
            found.append(span)
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]]))


def redacted(text: str | None) -> str | None:
    """The text with every stretch covered by spans replaced by one mark."""
    if not text:
        return text
    pieces, at = [], 0
    for _, start, end in secret_spans(text):
        if start >= at:
            pieces += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def _spans_of(texts: pa.Array) -> pa.Array:
    return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in secret_spans(t.as_py())]
                     for t in texts], SPANS)


def _redacted_of(texts: pa.Array) -> pa.Array:
    return pa.array([redacted(t.as_py()) for t in texts], pa.string())


def find_secrets(text: Column) -> Column:
    """array<struct<kind, start, end>> of a text column; empty for null."""
    run = F.arrow_udf(_spans_of, "array<struct<kind:string,start:int,end:int>>")
    return run(text)


def scan_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with the spans of each text in ``out``, which replaces a column so named."""
    return docs.withColumn(out, find_secrets(F.col(text)))


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark; other rows as they are."""
    return docs.withColumn(text, F.arrow_udf(_redacted_of, "string")(F.col(text)))
