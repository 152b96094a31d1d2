"""Near-duplicates by SimHash, searched through an inverted index on byte positions.

Two 64-bit fingerprints that differ in at most four bits agree in at least four of their
eight bytes, each at the same position. A posting list therefore stands for four positions
and their byte values: the intersection of four positional byte lists, and the least tally
a linked pair can have. Within a list the shared bytes of each pair are tallied; a pair is
verified only in the list of its first four shared positions, so it is looked at once.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import broadcast_if, stored, text_parts
from rowtide.llm.graph import components

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
# Longest posting list compared in one piece; longer ones are split by half-bytes.
LIST_LIMIT = 512
# Shingles hashed, and pairs held, at a time: memory does not grow with a text or a list.
BLOCK = 1 << 16
PAIR_BLOCK = 1 << 20
# Dropped ids up to this number (8 bytes each) are broadcast, more are joined by shuffle.
BROADCAST_IDS = 1_000_000

_BYTE_SETS = list(itertools.combinations(range(8), 4))


def _mask(positions, width: int) -> int:
    return sum(((1 << width) - 1) << (width * p) for p in positions)


_BYTE_MASKS = [_mask(s, 8) for s in _BYTE_SETS]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(data: bytes | None, size: int = SHINGLE_WORDS) -> int:
    """The SimHash of one text in UTF-8: null, empty and blank texts give zero."""
    ones, total, words = np.zeros(64, np.int64), 0, []
    for part in text_parts(data or b""):
        # Both are ASCII-only for bytes. The last words of a part go on into the next.
        words = words[len(words) - size + 1 :] if len(words) >= size else words
        words += part.lower().split()
        if len(words) >= size:
            total += _count_bits(words, size, ones)
    if words and not total:
        total = _count_bits(words, len(words), ones)
    return sum(1 << i for i in np.flatnonzero(ones * 2 > total).tolist())


def _count_bits(words: list[bytes], size: int, ones: np.ndarray) -> int:
    """Add the set bits of all shingles' hashes to `ones`; the number of shingles."""
    digest, last = xxhash.xxh64_intdigest, len(words) - size + 1
    for begin in range(0, last, BLOCK):
        part = words[begin : min(begin + BLOCK, last) + size - 1]
        joined = b" ".join(part)
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths).tolist()
        hashes = [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends[size - 1 :].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return last


def fingerprint_column(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column, as a signed long."""

    @F.arrow_udf("long")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([_signed(fingerprint(x.as_py(), size)) for x in batch], pa.int64())

    return run(text.cast("binary"))


def _shared(x: np.ndarray, width: int) -> np.ndarray:
    """For each xor of a pair, which of its bytes (or half-bytes) are zero: one bit each."""
    slots = 64 // width
    low = np.uint64((1 << width) - 1)
    out = np.zeros(len(x), np.uint32)
    for p in range(slots):
        out |= (((x >> np.uint64(p * width)) & low) == 0).astype(np.uint32) << np.uint32(p)
    return out


def _first_four(bits: np.ndarray) -> np.ndarray:
    """The lowest four set bits of each."""
    rest, out = bits.copy(), np.zeros_like(bits)
    for _ in range(4):
        low = rest & (~rest + np.uint32(1))
        out |= low
        rest ^= low
    return out


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the label trees of the pairs (a, b); afterwards every label is a root."""
    while True:
        ra, rb = labels[a], labels[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if (differ := low != high).any():
            np.minimum.at(labels, high[differ], low[differ])
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]
        if not differ.any():
            return


def _linked(runs, values, wanted_bytes, max_bits, free=None, wanted_halves=None) -> np.ndarray:
    """Labels after joining all verified pairs within runs of equal number.

    A pair counts in the run whose slots are the first four it shares. Pairs are taken at
    growing distance, and only rows whose run reaches so far stay in play.
    """
    labels = np.arange(len(values))
    last = np.searchsorted(runs, runs, side="right") - 1
    rows, held, count = np.arange(len(values)), [], 0
    for distance in itertools.count(1):
        rows = rows[rows + distance <= last[rows]]
        if not len(rows):
            break
        x = values[rows] ^ values[rows + distance]
        tally = _shared(x, 8)
        keep = (np.bitwise_count(tally) >= 4) & (np.bitwise_count(x) <= max_bits)
        keep &= _first_four(tally) == wanted_bytes[rows]
        if free is not None:
            keep &= _first_four(_shared(x, 4) & free[rows]) == wanted_halves[rows]
        held.append((rows[keep], rows[keep] + distance))
        count += int(keep.sum())
        if count > PAIR_BLOCK:
            _merge(labels, *map(np.concatenate, zip(*held)))
            held, count = [], 0
    if held:
        _merge(labels, *map(np.concatenate, zip(*held)))
    return labels


_SET_BITS = np.array([sum(1 << p for p in s) for s in _BYTE_SETS], np.uint32)
# For each byte set, the half-bytes outside it, and their 70 choices of four.
_FREE = [[h for p in range(8) if p not in s for h in (2 * p, 2 * p + 1)] for s in _BYTE_SETS]
_FREE_BITS = np.array([sum(1 << h for h in f) for f in _FREE], np.uint32)
_HALF_SETS = [list(itertools.combinations(f, 4)) for f in _FREE]
_HALF_BITS = np.array([[sum(1 << h for h in c) for c in sets] for sets in _HALF_SETS], np.uint32)
_SPLIT_MASKS = np.array([[m | _mask(c, 4) for c in sets] for m, sets in zip(_BYTE_MASKS, _HALF_SETS)], np.uint64)


def _runs(columns: list[np.ndarray]) -> np.ndarray:
    """The number of each row's run of equal values in the (sorted) columns."""
    change = np.zeros(len(columns[0]), bool)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.cumsum(change)


def _pieces(batches: Iterator[pa.RecordBatch], keys: int, limit: int) -> Iterator[tuple[bool, list[np.ndarray]]]:
    """Sorted postings as whole lists (False), and rows of lists above the limit (True).

    At most `limit` rows of one list are held back between batches.
    """
    rest, long_key = None, None
    for batch in batches:
        now = [np.asarray(c) for c in batch.columns]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now)]
        rest = None
        if long_key is not None:
            same = np.logical_and.reduce([c == k for c, k in zip(now, long_key)])
            head = len(same) if same.all() else int(np.argmin(same))
            yield True, [c[:head] for c in now]
            now = [c[head:] for c in now]
        if not len(now[0]):
            continue
        long_key = None
        runs = _runs(now[:keys])
        cut = int(np.searchsorted(runs, runs[-1]))
        yield False, [c[:cut] for c in now]
        rest = [c[cut:] for c in now]
        if len(rest[0]) > limit:
            yield True, rest
            long_key, rest = [c[0] for c in rest[:keys]], None
    if rest is not None:
        yield False, rest


def _row(kind: int, which, a, b) -> pa.RecordBatch:
    n = len(a)
    kinds, which = np.full(n, kind, np.int8), np.asarray(which, np.int8)
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds), pa.array(which), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
        names=["kind", "which", "u", "v"],
    )


def _compare_lists(max_bits: int, limit: int):
    """Links (kind 0: a fingerprint and the least of its class in the list), and rows of
    lists above the limit (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for is_long, (which, part, fp) in _pieces(batches, 2, limit):
            values = fp.view(np.uint64)
            if is_long:
                yield _row(1, which, values, values)
                continue
            if not len(values):
                continue
            runs = _runs([which, part])
            size = np.bincount(runs)[runs]
            if (over := size > limit).any():
                yield _row(1, which[over], values[over], values[over])
            some = (size > 1) & ~over
            runs, which, values = runs[some], which[some], values[some]
            labels = _linked(runs, values, _SET_BITS[which], max_bits)
            if (moved := labels != np.arange(len(labels))).any():
                yield _row(0, which[moved], values[moved], values[labels[moved]])

    return run


def _split_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a long list, once for each four of the eight half-bytes outside its bytes."""
    names = ["which", "half", "part", "fp"]
    for batch in batches:
        which, fp = np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64)
        n = _SPLIT_MASKS.shape[1]
        part = (fp[:, None] & _SPLIT_MASKS[which]).ravel()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(which, n)),
                pa.array(np.tile(np.arange(n, dtype=np.int8), len(fp))),
                pa.array(part.view(np.int64)),
                pa.array(np.repeat(fp, n).view(np.int64)),
            ],
            names=names,
        )


def _compare_split_lists(max_bits: int):
    """Links from the split lists; none can hold more than 2^16 fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (which, half, part, fp) in _pieces(batches, 3, 1 << 16):
            values = fp.view(np.uint64)
            if not len(values):
                continue
            runs = _runs([which, half, part])
            some = np.bincount(runs)[runs] > 1
            runs, which, half, values = runs[some], which[some], half[some], values[some]
            labels = _linked(
                runs, values, _SET_BITS[which], max_bits, _FREE_BITS[which], _HALF_BITS[which, half]
            )
            if (moved := labels != np.arange(len(labels))).any():
                yield _row(0, which[moved], values[moved], values[labels[moved]])

    return run


_FOUND = "kind byte, which byte, u long, v long"


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, limit: int = LIST_LIMIT) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints which chains of links connect.

    `fingerprints` has distinct, non-null longs in column fp. Within a posting list only a
    spanning star of each linked class is returned, never all its pairs. A list above the
    limit is dealt out again by four half-bytes more: the remaining 32 bits differ in at
    most `max_bits` too, so four of their eight half-bytes agree.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("four shared bytes are only guaranteed for up to four differing bits")
    keys = [
        F.struct(F.lit(i).cast("byte").alias("which"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
        for i, m in enumerate(_BYTE_MASKS)
    ]
    postings = fingerprints.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.which", "k.part", "fp")
    lists = postings.repartition("which", "part").sortWithinPartitions("which", "part", "fp")
    found = stored(lists.mapInArrow(_compare_lists(max_bits, limit), _FOUND))
    split = (
        found.where("kind = 1")
        .select("which", F.col("u").alias("fp"))
        .mapInArrow(_split_lists, "which byte, half byte, part long, fp long")
    )
    again = split.repartition("which", "half", "part").sortWithinPartitions("which", "half", "part", "fp")
    more = again.mapInArrow(_compare_split_lists(max_bits), _FOUND)
    return found.where("kind = 0").unionByName(more).select("u", "v").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: id, fp (signed long) and component_id.

    component_id is the smallest id reachable over fingerprints that differ in at most
    `max_bits` bits. Null, empty and blank texts share fingerprint zero and are linked like
    any others. Repeated rows stay repeated; a null id counts as no candidate for the
    smallest. Other columns of `docs` are not read. An empty table gives no rows.
    """
    ids = docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), size).alias("fp"))
    ids = stored(ids)
    values = stored(ids.groupBy("fp").agg(F.min("id").alias("least")))
    edges = links(values.select("fp"), max_bits)
    # Nodes are ordered by their smallest id, those without any last: the root of a component
    # then names it, and no component is ever gathered.
    node = F.struct(F.col("least").isNull().alias("none"), "least", "fp").alias("node")
    named = values.select("fp", node)
    ends = edges.join(named.withColumnsRenamed({"fp": "u", "node": "nu"}), "u").join(
        named.withColumnsRenamed({"fp": "v", "node": "nv"}), "v"
    )
    roots = components(ends.select(F.col("nu").alias("u"), F.col("nv").alias("v")))
    rooted = named.join(roots, "node", "left")
    classes = rooted.select("fp", F.coalesce("root", "node")["least"].alias("component_id"))
    return ids.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, all columns kept, without those whose component has a smaller id.

    Rows without an id stay. Rows that share an id are judged alike.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    name = "_dropped_id"
    while name in docs.columns:
        name += "_"
    dropped = found.where(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias(name)).distinct()
    dropped = broadcast_if(stored(dropped), BROADCAST_IDS)
    return docs.join(dropped, docs[id_col] == dropped[name], "left_anti")
