"""Personal data in texts: fixed patterns, and bootstrapped contextual extraction.

The fixed patterns find emails, addresses, cards and phones; these are the seeds. Where a
seed stands, the one and the two words before it are its lexical patterns. Strings that
look like an identifier of a kind without fitting its fixed pattern are candidates; they
stand in patterns too. Spark counts how often the words of each pattern occur in the whole
corpus and scores the graph of patterns and instances in rounds: a pattern is as good as
the share of its occurrences that are followed by trusted instances, a candidate as good as
the best pattern it stands in. Good patterns make their candidates trusted, these count for
further patterns, and so on. Trusted candidates are returned as spans of kind `context`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import broadcast_if, stored

KINDS = ("email", "ip", "card", "phone", "context")
BASE_KINDS = KINDS[:4]
EMAIL, IP, CARD, PHONE, CONTEXT = range(5)

# What an email's local part consists of; its domain has a dot.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Groups of digits that stand close together hold all addresses and cards.
NUMBERS = re.compile(r"[0-9]++(?:[\x20()./-]{1,2}[0-9]++)*+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD_RUN = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
PHONE_RUN = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
CARD_DIGITS, PHONE_DIGITS, LIKE_PHONE_DIGITS = (12, 19), (9, 15), (7, 15)
QUAD = 4
SHORTEST = 7  # characters of an address or number

# What looks like an email: `at` and `dot` written out or in brackets, or a host without a dot.
AT = re.compile(r"@|[\[({<\x20]at[\])}>\x20]", re.IGNORECASE)
_AT = r"(?:\x20?[\[({<]\x20?at\x20?[\])}>]\x20?|\x20at\x20|\x20?@\x20?)"
_DOT = r"(?:\x20?[\[({<]\x20?dot\x20?[\])}>]\x20?|\x20dot\x20|\.)"
LIKE_EMAIL = re.compile(rf"{_AT}(?P<host>(?:[A-Za-z0-9-]++{_DOT}){{0,4}}[A-Za-z0-9-]++)(?![\w@])", re.IGNORECASE)
LOCAL_LENGTH = 64

# The words of contexts. Between the last of them and the instance there are no digits, line
# ends or further words, and at most so many characters.
WORD = re.compile(r"[A-Za-z\x80-\U0010ffff]+")
GAP = 8
# A pattern is trusted with so many distinct trusted instances and such a share of its
# occurrences; one occurrence more than seen is taken to fail.
LEAST_INSTANCES = 3
LEAST_SHARE = 0.5
ROUNDS = 4
# Patterns counted in one pass over the texts (8 bytes each in a task); more take more passes.
PASS_PATTERNS = 1 << 20
BROADCAST_INSTANCES = 200_000
# Characters taken apart, and words held, at a time; words whose keys a task remembers.
PART, REMEMBERED = 1 << 20, 1 << 18

_PAIR = np.uint64(0x9E3779B97F4A7C15)


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _local(text: str, at: int, least: int) -> int:
    """Where the run of a local part's characters that ends before `at` begins."""
    while at > least and text[at - 1] in LOCAL:
        at -= 1
    return at


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """For each @ the run before it, as far as no earlier email took it, and a dotted domain."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = _local(text, at, last)
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _numbers(text: str) -> tuple[list, list]:
    """Fixed spans and look-alikes among the numbers of a text."""
    fixed, like = [], []
    for m in NUMBERS.finditer(text):
        low, high = m.span()
        if high - low < SHORTEST:
            continue
        free = not _word_at(text, low - 1) and not _word_at(text, high)
        for d in DOTTED.finditer(text, low, high):
            parts, at = d[0].split("."), d.start()
            for i in range(0, len(parts) - QUAD + 1, QUAD):
                four = parts[i : i + QUAD]
                end = at + sum(map(len, four)) + QUAD - 1
                if all(map(_small, four)):
                    fixed.append((at, IP, end))
                at = end + 1
            if free and d.span() == (low, high) and QUAD <= len(parts) <= QUAD + 2 and max(map(len, parts)) <= QUAD:
                like.append((low, IP, high))
        for c in CARD_RUN.finditer(text, low, high):
            if c.end() - c.start() >= CARD_DIGITS[0]:
                digits = c[0].replace(" ", "").replace("-", "")
                if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                    fixed.append((c.start(), CARD, c.end()))
        if free:
            digits = len(DIGIT.findall(m[0]))
            low -= low > 0 and text[low - 1] in "+("
            for kind, (least, most) in ((CARD, CARD_DIGITS), (PHONE, LIKE_PHONE_DIGITS)):
                if least <= digits <= most:
                    like.append((low, kind, high))
    return fixed, like


def _word_at(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] in "_@")


def _like_emails(text: str) -> Iterator[tuple[int, int, int]]:
    if not AT.search(text):
        return
    for m in LIKE_EMAIL.finditer(text):
        if "@" not in m[0] and m["host"].isalnum():
            continue  # a plain `at` needs a dotted host
        start = _local(text, m.start(), max(0, m.start() - LOCAL_LENGTH - 1))
        if 0 < m.start() - start <= LOCAL_LENGTH:
            yield start, EMAIL, m.end()


def found_in(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind, end), in code points, of the fixed patterns and of the look-alikes.

    Look-alikes stand free of words and touch no fixed span. A string may look like several
    kinds; the patterns around it decide. The time is linear in the text.
    """
    fixed, like = _numbers(text)
    fixed += [(s, EMAIL, e) for s, e in _emails(text)]
    if "+" in text:
        for m in PHONE_RUN.finditer(text):
            if PHONE_DIGITS[0] <= len(DIGIT.findall(m[0])) <= PHONE_DIGITS[1]:
                fixed.append((m.start(), PHONE, m.end()))
    fixed.sort()
    out, at = [], 0
    for start, kind, end in sorted([*like, *_like_emails(text)]):
        while at < len(fixed) and fixed[at][2] <= start:
            at += 1
        if not any(s < end and start < e for s, _, e in _near(fixed, at, end)):
            out.append((start, kind, end))
    return fixed, out


def _near(spans: list, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """The spans from number `at` on that begin before `end`."""
    for i in range(at, len(spans)):
        if spans[i][0] >= end:
            return
        yield spans[i]


def context(text: str, start: int) -> list[str]:
    """The last two words before `start`, none if the last does not stand close to it."""
    reach = 64
    while True:
        begin = max(0, start - reach)
        words = [(m.start() + begin, m[0]) for m in WORD.finditer(text[begin:start])]
        # A word cut off by the window, or too few words, ask for a wider one.
        if begin == 0 or sum(at > begin for at, _ in words) >= 2 or not WORD.search(text[max(begin, start - GAP - 1) : start]):
            break
        reach *= 4
    words = words[-2:]
    if not words:
        return []
    at, last = words[-1]
    gap = text[at + len(last) : start]
    if len(gap) > GAP or DIGIT.search(gap) or "\n" in gap:
        return []
    return [w for _, w in words]


class Keys(dict):
    """Keys of words in lower case, made once each; forgotten when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = key = xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass"), 11)
        return key


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (first * _PAIR + second) * _PAIR ^ (first >> np.uint64(31))


def pattern_keys(words: list[str], keys: Keys) -> list[int]:
    """Keys of the patterns one gives: the last word, and both."""
    if not words:
        return []
    own = np.array([keys[w] for w in words], np.uint64)
    out = np.concatenate([own[-1:], _joined(own[:-1], own[1:])])
    return out.view(np.int64).tolist()


def _words(texts: Iterator[str]) -> Iterator[list[str]]:
    """The words of all texts in order, some at a time; an empty word stands after each text."""
    held = []
    for text in texts:
        at = 0
        while at < len(text):
            end = at + PART
            while end < len(text) and WORD.match(text[end]):
                end += 1
            held += WORD.findall(text[at:end])
            at = end
            if len(held) > PART:
                yield held
                held = held[-1:]  # may begin a pair
                held.insert(0, "")  # and was counted
        held.append("")
    yield held


def count_patterns(texts: Iterator[str], wanted: np.ndarray) -> np.ndarray:
    """How often each of the (sorted) wanted patterns occurs in the texts."""
    out, keys, first = np.zeros(len(wanted), np.int64), Keys(), True
    for words in _words(texts):
        own = np.fromiter((keys[w] for w in words), np.uint64, len(words))
        alone = own if first else own[2:]  # the word carried over was counted
        for found in (alone, _joined(own[:-1], own[1:])):
            place = np.searchsorted(wanted, found)
            place[place == len(wanted)] = 0
            np.add.at(out, place[wanted[place] == found], 1)
        first = False
    return out


_SPAN = pa.struct([("kind", pa.int8()), ("start", pa.int64()), ("end", pa.int64())])
_MENTION = pa.struct(
    [
        ("kind", pa.int8()),
        ("seed", pa.bool_()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("instance", pa.int64()),
        ("patterns", pa.list_(pa.int64())),
    ]
)
_FOUND = (
    "struct<base: array<struct<kind: tinyint, start: bigint, end: bigint>>, mentions: array<struct<kind: tinyint,"
    " seed: boolean, start: bigint, end: bigint, instance: bigint, patterns: array<bigint>>>>"
)


def _instance(kind: int, mention: str) -> int:
    """What makes two mentions the same: the digits of a number, an email's letters."""
    same = mention.lower() if kind in (EMAIL, IP) else "".join(DIGIT.findall(mention))
    digest = xxhash.xxh64_intdigest(same.encode("utf-8", "surrogatepass"), kind)
    return digest - (1 << 64) if digest >> 63 else digest


def read_text(text: str | None, keys: Keys) -> dict:
    """The fixed spans of a text, and all seeds and candidates with their contexts' patterns."""
    fixed, like = found_in(text) if text else ([], [])
    mentions = []
    for seed, spans in ((True, fixed), (False, like)):
        for start, kind, end in spans:
            patterns = pattern_keys(context(text, start), keys)
            own = {"kind": kind, "seed": seed, "start": start, "end": end}
            mentions.append(own | {"instance": _instance(kind, text[start:end]), "patterns": patterns})
    return {"base": [{"kind": k, "start": s, "end": e} for s, k, e in fixed], "mentions": mentions}


def _found_column(text: Column) -> Column:
    kind = pa.struct([("base", pa.list_(_SPAN)), ("mentions", pa.list_(_MENTION))])

    @F.arrow_udf(_FOUND)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keys = Keys()
        for batch in batches:
            yield pa.array([read_text(t.as_py(), keys) for t in batch], kind)

    return run(text.cast("string"))


def _occurrences(docs: DataFrame, text: Column, patterns: DataFrame) -> DataFrame:
    """(pattern, occurrences): how often the words of each pattern occur in all texts.

    Every pass takes the patterns of one remainder, so that what a task holds is bounded.
    """
    spark = docs.sparkSession
    passes = -(-patterns.count() // PASS_PATTERNS)
    out = spark.createDataFrame([], "pattern long, occurrences long")
    for number in range(passes):
        mine = patterns.where(F.pmod("pattern", F.lit(passes)) == number)
        keys = np.array([r.pattern for r in mine.collect()], np.int64).view(np.uint64)
        shared = spark.sparkContext.broadcast(np.sort(keys))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            wanted = shared.value
            n = count_patterns((t.as_py() or "" for batch in batches for t in batch.column(0)), wanted)
            some = np.flatnonzero(n)
            columns = [pa.array(wanted[some].view(np.int64)), pa.array(n[some])]
            yield pa.RecordBatch.from_arrays(columns, names=["pattern", "occurrences"])

        if len(keys):
            out = out.unionByName(docs.select(text.alias("t")).mapInArrow(run, "pattern long, occurrences long"))
    return out.groupBy("pattern").agg(F.sum("occurrences").alias("occurrences"))


def trusted_instances(docs: DataFrame, text: Column, mentions: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, instance) of the candidates that are seeds elsewhere or stand in good patterns.

    `mentions` has kind, seed, instance and patterns. An edge joins a pattern of a kind and an
    instance in it and has their number of mentions. In each round a pattern's share is the
    weight of its mentions over its occurrences in all texts and one more; it is good with a
    share of 0.5 and three distinct instances by weight. A candidate weighs the share of its
    best good pattern, a seed always 1. The rounds end early when no weight changes.
    """
    instances = mentions.groupBy("kind", "instance").agg(
        F.bool_or("seed").alias("seed"), F.bool_or(~F.col("seed")).alias("open")
    )
    instances = stored(instances)
    edges = mentions.select("kind", "instance", F.explode("patterns").alias("pattern"))
    edges = stored(edges.groupBy("kind", "pattern", "instance").agg(F.count("*").alias("n")))
    # Patterns with too few instances can never be good: their occurrences need no count.
    able = edges.groupBy("kind", "pattern").agg(F.count("*").alias("instances"))
    able = stored(able.where(F.col("instances") >= LEAST_INSTANCES).select("kind", "pattern"))
    total = _occurrences(docs, text, stored(able.select("pattern").distinct()))
    edges = edges.join(able.join(total, "pattern"), ["kind", "pattern"])
    edges = stored(edges.join(instances.select("kind", "instance", "seed"), ["kind", "instance"]))
    weight = edges.select("kind", "instance").limit(0).withColumn("weight", F.lit(0.0))
    for _ in range(rounds):
        found = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("weight", F.lit(0.0)))
        known = edges.join(weight, ["kind", "instance"], "left").withColumn("r", found)
        scored = known.groupBy("kind", "pattern").agg(
            (F.sum(F.col("r") * F.col("n")) / (F.max("occurrences") + 1)).alias("share"), F.sum("r").alias("support")
        )
        good = scored.where((F.col("share") >= LEAST_SHARE) & (F.col("support") >= LEAST_INSTANCES))
        held = edges.where("NOT seed").join(good, ["kind", "pattern"])
        before = weight
        weight = stored(held.groupBy("kind", "instance").agg(F.max("share").alias("weight")))
        if _mark(before) == _mark(weight):
            break
    known = instances.where("open AND seed").select("kind", "instance")
    return known.unionByName(weight.select("kind", "instance")).distinct()


def _mark(weights: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("kind", "instance", F.round("weight", 9)).cast("decimal(38,0)"))
    return tuple(weights.agg(F.count("*"), digest).first())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of `docs`: id and spans, array<struct<kind, start, end>> by start, then kind.

    Offsets are code points, ends exclusive. Kinds are `email`, `ip`, `card`, `phone` and, for
    what the patterns discover, `context`; such spans overlap no fixed ones and, of several
    that overlap each other, the longest (then first) stays. Null and empty texts have none.
    Repeated rows are judged alike; null ids stay. Very long texts are read whole, at a
    time in proportion to their length. Other columns are not read; no rows give no rows.
    """
    text = F.col(text_col).cast("string")
    read = docs.select(F.col(id_col).alias("id"), _found_column(text).alias("f"))
    # Row numbers hold because they are given to rows that are already stored.
    read = stored(read.select("id", "f.base", "f.mentions"))
    read = read.withColumn("row", F.monotonically_increasing_id())
    mentions = stored(read.select("row", F.explode("mentions").alias("m")).select("row", "m.*"))
    good = trusted_instances(docs, text, mentions, rounds)
    good = broadcast_if(stored(good), BROADCAST_INSTANCES)
    found = mentions.where("NOT seed").join(good, ["kind", "instance"]).groupBy("row")
    found = found.agg(F.collect_set(F.struct("start", "end")).alias("found"))
    wide = F.array_sort(
        F.transform("found", lambda s: F.struct((s["start"] - s["end"]).alias("n"), s["start"].alias("start"), s["end"].alias("end")))
    )
    kept = F.aggregate(
        wide,
        F.array().cast("array<struct<start: bigint, end: bigint>>"),
        lambda held, s: F.when(
            F.exists(held, lambda h: (h["start"] < s["end"]) & (s["start"] < h["end"])), held
        ).otherwise(F.array_append(held, F.struct(s["start"].alias("start"), s["end"].alias("end")))),
    )
    more = F.transform(
        F.coalesce(kept, F.array()), lambda s: F.struct(s["start"], F.lit(CONTEXT).cast("byte").alias("kind"), s["end"])
    )
    base = F.transform("base", lambda s: F.struct(s["start"], s["kind"], s["end"]))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(
        F.array_sort(F.concat(base, more)),
        lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return read.join(found, "row", "left").select(F.col("id").alias(id_col), spans.alias("spans"))
