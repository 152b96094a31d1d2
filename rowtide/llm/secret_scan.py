"""Secrets in texts: fixed patterns, and windows of high Shannon entropy in candidate strings.

A window slides over each candidate; its entropy follows from counts that change by one
character in and one out. The limit depends on the window's class of characters.
Windows at or above the limit are merged to spans. What the allow-list knows is passed over.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_VALUE = 8
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 16
HEX_LENGTH = 32
# The runs of hex digits that are long enough; shorter ones would be dropped.
HEX = re.compile(rf"[0-9a-f]{{{HEX_LENGTH},}}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
# Bits per character a window needs, by the smallest class that holds it. Twenty random
# characters come to about 3.4 bits for 16 symbols and 4.1 for 64. Digits alone and words
# of a single case are never secret.
HEX_LIMIT, LOWER_LIMIT, LETTERS_LIMIT, MIXED_LIMIT = 3.0, 3.6, 4.1, 3.8
# Groups of characters: digits, a-f, g-z, A-F, G-Z, the plus sign, and what joins the parts of
# paths and names. A window with two joints is made of several short parts and no secret.
_GROUPS = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+", "/_=-")
GROUP = {c: i for i, group in enumerate(_GROUPS) for c in group}
MOST_JOINTS = 1
WORD_OR_NUMBER = re.compile(r"[0-9]+|[G-Z]+|[g-z]+")  # told apart at once
# What looks random in a candidate and is not secret: segments with a placeholder or a
# keyboard or alphabet run (as much of it as stands close), UUIDs, dates with or without a time. It is cut out, and the
# rest of the candidate is looked at. The words come first to skip candidates quickly.
PLAIN_WORDS = re.compile(
    r"example|placeholder|changeme|dummy|sample|your[_-]|0123456789|abcdefghij|qwertyuiop", re.IGNORECASE
)
PLAIN_REACH = 40  # characters to either side of the word
PLAIN_FORMS = re.compile(
    r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T_-]?[0-9]{2})*Z?)(?![0-9A-Za-z])"
)
# Spans that are no secret: repetitions, and paths of words of a single case and numbers.
_WORD = "(?:[a-z]+|[A-Z][a-z]+|[A-Z]+)"
ALLOW = tuple(
    re.compile(p)
    for p in (
        r"[=_-]+|(.{1,4})\1+.?.?.?",
        rf"{_WORD}?(?:[/_=+-]+(?:{_WORD}|[0-9]+))*[/_=+-]*",
    )
)

_TERM = [0.0, *(n * math.log2(n) for n in range(1, WINDOW + 1))]


def limit_of(groups: list[int], first: str) -> float:
    """The limit of a window with so many characters of each group that begins with `first`."""
    digits, low_hex, low, up_hex, up, plus, joints = groups
    lower, upper = low_hex + low, up_hex + up
    if joints > MOST_JOINTS:
        return math.inf
    if plus or (digits and lower and upper):
        return MIXED_LIMIT
    if not (lower or upper):
        return math.inf
    if not (low or upper) or not (up or lower):
        return HEX_LIMIT
    if digits:
        return LOWER_LIMIT
    if lower and upper and not (upper == 1 and "A" <= first <= "Z"):
        return LETTERS_LIMIT
    return math.inf


def entropy_windows(candidate: str, limit: float | None = None, size: int = WINDOW) -> list[tuple[int, int]]:
    """Merged [start, end) of the windows whose entropy is at least `limit` bits, or that of their class."""
    if len(candidate) < size:
        return []
    counts: dict[str, int] = {}
    groups = [0] * len(_GROUPS)
    total, spans = 0.0, []  # total: sum of c * log2(c)
    for i, c in enumerate(candidate):
        if i >= size:
            old = candidate[i - size]
            n = counts[old]
            counts[old] = n - 1
            groups[GROUP[old]] -= 1
            total += _TERM[n - 1] - _TERM[n]
        n = counts.get(c, 0)
        counts[c] = n + 1
        groups[GROUP[c]] += 1
        total += _TERM[n + 1] - _TERM[n]
        bits = math.log2(size) - total / size
        start = i - size + 1
        least = HEX_LIMIT if limit is None else limit  # no class has a lower one
        if start >= 0 and bits >= least and (limit is not None or bits >= limit_of(groups, candidate[start])):
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points; kinds by number."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def without(begin: int, end: int, cut: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What is left of [begin, end) without the spans `cut`, where long enough for a window."""
    left, at = [], begin
    for low, high in [*sorted(cut), (end, end)]:
        if low - at >= WINDOW:
            left.append((at, low))
        at = max(at, high)
    return left


def plain_segments(candidate: str, low: int, high: int) -> list[tuple[int, int]]:
    """The segments between `/` and `=` with a plain word, as far as they reach beside it."""
    out, at = [], low
    while m := PLAIN_WORDS.search(candidate, at, high):
        least, most = max(at, m.start() - PLAIN_REACH), min(high, m.end() + PLAIN_REACH)
        begin = max(candidate.rfind(c, least, m.start()) + 1 for c in "/=") or least
        at = min((e for c in "/=" if (e := candidate.find(c, m.end(), most)) >= 0), default=most)
        out.append((begin, at))
    return out


def pieces(candidate: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """[start, end) of what is left of a candidate without those taken, and of that without the plain parts."""
    left = []
    for low, high in without(0, len(candidate), taken):
        plain = plain_segments(candidate, low, high) + [m.span() for m in PLAIN_FORMS.finditer(candidate, low, high)]
        left += without(low, high, plain)
    return left


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """All spans by start, then kind. The fixed ones are cut out before entropy is looked at."""
    if not text:
        return []
    found = base_spans(text)
    fixed = sorted((s, e) for s, _, e in found)
    last = 0  # the first fixed span that may reach into this candidate or a later one
    for m in CANDIDATE.finditer(text):
        while last < len(fixed) and fixed[last][1] <= m.start():
            last += 1
        taken = []
        for s, e in itertools.islice(fixed, last, None):
            if s >= m.end():
                break
            taken.append((s - m.start(), e - m.start()))
        for low, high in pieces(m[0], taken):
            piece, at = m[0][low:high], m.start() + low
            if WORD_OR_NUMBER.fullmatch(piece):
                continue
            for start, end in entropy_windows(piece):
                if not any(a.fullmatch(piece, start, end) for a in ALLOW):
                    found.append((start + at, 3, end + at))
    return sorted(found)


def scan_column(text: Column) -> Column:
    """array<struct<kind, start, end>> of a text, offsets in code points, end exclusive.

    Null and empty texts give an empty array. Long texts are read whole.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    @F.arrow_udf("array<struct<kind: string, start: bigint, end: bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans(t.as_py())] for t in batch]
            yield pa.array(rows, pa.list_(kind))

    return run(text.cast("string"))
