"""Hard negatives by segment summaries.

Every vector is cut into 1, 4 and 16 segments, and the mean and the deviation (the length of
what is left after the mean) of each are stored beside it. For a segment of m entries

    m * mean_a * mean_b - dev_a * dev_b  <=  a . b  <=  m * mean_a * mean_b + dev_a * dev_b,

so the sums over a level's segments bound the inner product from both sides. An anchor's
rows are judged by the coarsest level first; those that cannot be among its best leave, the
others go on to the next level, and what remains is scored exactly in integers.

The rows are dealt into shards of bounded size by a hash of their id, the anchors are sent
to every shard, and a shard returns its own best few for each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import shuffle_partitions, stored

POSITIVES, NEGATIVES = 5, 3
# A negative's score, in percent of the positive's.
BAND = (50, 95)
SEGMENTS = (1, 4, 16)
# Rows of a shard, which one task holds; pairs it looks at in one step.
SHARD_ROWS = 1 << 17
PAIRS = 1 << 19
# Gathered pairs scored at a time.
GATHER = 1 << 16
EXACT_IN_DOUBLE = 2.0**53
LONG = np.iinfo(np.int64)

_VECTOR = "vec_id long, label long, x array<long>, is_anchor boolean, mean array<double>, dev array<double>"


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * component) of each component, as longs."""
    return F.transform(vector, lambda c: F.floor(F.lit(scale) * c.cast("double")))


def is_finite(vector: Column) -> Column:
    """Whether a vector is there and has no null, NaN or infinite component."""

    def good(c: Column) -> Column:
        d = c.cast("double")
        return d.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf"))

    return vector.isNotNull() & F.forall(vector, good)


def edges(dims: int) -> list[np.ndarray]:
    """The segment borders of every level; each level refines the one before."""
    return [np.unique(np.arange(k + 1) * dims // k) for k in SEGMENTS]


def summary(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of all segments of all levels, side by side, one line per vector."""
    means, devs = [], []
    values = x.astype(np.float64)
    for border in edges(x.shape[1]):
        if len(border) < 2:
            continue
        lengths = np.diff(border)
        mean = np.add.reduceat(values, border[:-1], axis=1) / lengths
        rest = values - np.repeat(mean, lengths, axis=1)
        means.append(mean)
        devs.append(np.sqrt(np.add.reduceat(rest * rest, border[:-1], axis=1)))
    none = np.zeros((len(x), 0))
    return np.concatenate([none, *means], axis=1), np.concatenate([none, *devs], axis=1)


def bounds(a: tuple, r: tuple, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lower, upper) of all inner products of two sets of summaries, level by level.

    The second set may shrink between levels: the caller sends back which of it stay.
    """
    (mean_a, dev_a), (mean_r, dev_r) = a, r
    begin, stay = 0, np.arange(len(mean_r))
    for border in edges(dims):
        end = begin + len(border) - 1
        middle = (mean_a[:, begin:end] * np.diff(border)) @ mean_r[stay, begin:end].T
        around = dev_a[:, begin:end] @ dev_r[stay, begin:end].T
        # Far above the rounding of the sums; scores are whole numbers.
        around += 1e-3 + 1e-10 * (np.abs(middle).max(initial=0) + around.max(initial=0))
        begin = end
        sent = yield middle - around, middle + around
        if sent is not None:
            stay = stay[sent]


def _kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k]


def best_in_band(anchors: dict, rows: dict, open_: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """(anchor, band, row, score): an anchor's first k rows in each of its bands of scores.

    `open_` says which rows an anchor may take. A row leaves a level if its bounds miss all
    bands, or in each k rows that surely lie in the band are surely better.
    """
    dims = rows["x"].shape[1]
    at = np.arange(len(rows["id"]))
    levels = bounds((anchors["mean"], anchors["dev"]), (rows["mean"], rows["dev"]), dims)
    lower, upper = next(levels)
    while True:
        keep = np.zeros_like(open_)
        for b in range(low.shape[1]):
            least, most = low[:, b, None], high[:, b, None]
            maybe = open_ & (upper >= least) & (lower <= most)
            surely = maybe & (lower >= least) & (upper <= most)
            keep |= maybe & (upper >= _kth_largest(np.where(surely, lower, -np.inf), k)[:, None])
        needed = keep.any(axis=0)
        open_, at = keep[:, needed], at[needed]
        if not len(at):
            break
        try:
            lower, upper = levels.send(needed)
        except StopIteration:
            break
    who, which, score = _scores(anchors["x"], rows["x"], open_, at)
    ids, out = rows["id"][which], []
    for b in range(low.shape[1]):
        inside = np.flatnonzero((score >= low[who, b]) & (score <= high[who, b]))
        order = inside[np.lexsort((ids[inside], -score[inside], who[inside]))]
        group = who[order]
        rank = np.arange(len(order)) - np.searchsorted(group, group)
        first = order[rank < k]
        out.append((who[first], np.full(len(first), b), ids[first], score[first]))
    return [np.concatenate(c) for c in zip(*out)]


def _scores(a: np.ndarray, r: np.ndarray, open_: np.ndarray, at: np.ndarray):
    """Exact integer inner products of the open pairs (anchor, row)."""
    who, column = np.nonzero(open_)
    which = at[column]
    if not len(who):
        return who, which, np.zeros(0, np.int64)
    fa, fr = a.astype(np.float64), r[at].astype(np.float64)
    largest = np.sqrt((fa * fa).sum(1).max() * (fr * fr).sum(1).max())
    # Doubles hold every partial sum exactly up to that size.
    if largest < EXACT_IN_DOUBLE and len(who) * 16 > open_.size:
        return who, which, (fa @ fr.T)[who, column].astype(np.int64)
    score = np.empty(len(who), np.int64)
    for s in range(0, len(who), GATHER):
        part = slice(s, s + GATHER)
        score[part] = (a[who[part]] * r[which[part]]).sum(axis=1)
    return who, which, score


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), width)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the summaries to the rows; vectors of one length are taken together."""
    for batch in batches:
        sizes = np.asarray(batch.column("x").value_lengths())
        for dims in np.unique(sizes):
            part = batch.filter(pa.array(sizes == dims))
            both = summary(_lists(part.column("x"), int(dims)))
            lists = [pa.array(list(m), pa.list_(pa.float64())) for m in both]
            yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=[*part.schema.names, "mean", "dev"])


def _vectors(part: pa.RecordBatch, dims: int) -> dict:
    segments = sum(len(b) - 1 for b in edges(dims))
    return {
        "id": np.asarray(part.column("vec_id")),
        "label": np.asarray(part.column("label")),
        "x": _lists(part.column("x"), dims),
        "mean": _lists(part.column("mean"), segments),
        "dev": _lists(part.column("dev"), segments),
    }


def _of(vectors: dict, which) -> dict:
    return {k: v[which] for k, v in vectors.items()}


def _by_label(anchors: dict, rows: dict) -> Iterator[tuple[dict, dict]]:
    for label in np.unique(anchors["label"]):
        yield _of(anchors, anchors["label"] == label), _of(rows, rows["label"] == label)


def _blocks(anchors: dict, rows: dict, pairs: int) -> Iterator[dict]:
    step = max(1, pairs // max(1, len(rows["id"])))
    for s in range(0, len(anchors["id"]), step):
        yield _of(anchors, slice(s, s + step))


def _positives(anchors: dict, rows: dict, k: int) -> Iterator[pa.RecordBatch]:
    for own, same in _by_label(anchors, rows):
        for block in _blocks(own, same, PAIRS):
            n = len(block["id"])
            others = block["id"][:, None] != same["id"][None, :]
            low, high = np.full((n, 1), LONG.min), np.full((n, 1), LONG.max)
            who, _, ids, score = best_in_band(block, same, others, low, high, k)
            yield pa.RecordBatch.from_arrays([pa.array(block["id"][who]), pa.array(ids), pa.array(score)], names=["anchor_id", "positive_id", "positive_score"])


def _percent(score: np.ndarray, percent: int) -> np.ndarray:
    """So much of each score, rounded down; products stay within longs."""
    return score // 100 * percent + score % 100 * percent // 100


def _negatives(anchors: dict, rows: dict, k: int, band: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(anchors, rows, PAIRS):
        score = block["scores"]
        none = block["positives"] < 0
        low = np.where(none, LONG.max, -_percent(-score, band[0]))
        high = np.where(none, LONG.min, _percent(score, band[1]))
        others = block["label"][:, None] != rows["label"][None, :]
        who, b, ids, found = best_in_band(block, rows, others, low, high, k)
        columns = [block["id"][who], block["positive_ids"][who, b], score[who, b], ids, found]
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _goals(part: pa.RecordBatch) -> dict:
    """The anchors' positives as matrices; where `positives` is negative there is none."""
    column = part.column("positives")
    sizes = np.asarray(column.value_lengths())
    width = int(sizes.max(initial=0))
    there = np.arange(width)[None, :] < sizes[:, None]
    out = {"positives": np.where(there, 0, -1)}
    flat = column.flatten()
    for name, field in (("positive_ids", "positive_id"), ("scores", "positive_score")):
        out[name] = np.zeros(there.shape, np.int64)
        out[name][there] = np.asarray(flat.field(field))
    return out


def _on_shards(search, with_goals: bool):
    """Runs `search(anchors, rows)` on each shard: its rows come first, then the anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, rows = None, [], None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("dims", "shard", "kind")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                dims, shard, kind = keys[:, s].tolist()
                part = batch.slice(s, e - s)
                if kind == 0:
                    if key != (dims, shard):
                        key, held, rows = (dims, shard), [], None
                    held.append(_vectors(part, dims))
                    continue
                if key != (dims, shard):
                    continue  # no rows here
                if rows is None:
                    rows, held = {k: np.concatenate([h[k] for h in held]) for k in held[0]}, []
                anchors = _vectors(part, dims)
                if with_goals:
                    anchors |= _goals(part)
                yield from search(anchors, rows)

    return run


def _searched(rows: DataFrame, anchors: DataFrame, shards: int, search, schema: str, with_goals: bool) -> DataFrame:
    """The shards' own results: rows by a hash of their id, anchors sent to each shard."""
    dims = F.size("x").alias("dims")
    of_row = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    goals = "array<struct<positive_id: bigint, positive_score: bigint>>"
    held = rows.select(dims, of_row, F.lit(0).cast("byte").alias("kind"), "*")
    sent = anchors.select(dims, everywhere, F.lit(1).cast("byte").alias("kind"), "*")
    if with_goals:
        held = held.withColumn("positives", F.array().cast(goals))
    both = held.unionByName(sent).repartitionById(shards, "shard").sortWithinPartitions("dims", "shard", "kind")
    return both.mapInArrow(_on_shards(search, with_goals), schema)


def mine(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "vector",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `vectors` has integer vectors (array<long>); `anchors` is a condition over its columns.
    Scores are inner products, which must fit a long; higher ones come first, then smaller
    ids. For each anchor and each of its first `positives` other rows of the same label come
    the first `negatives` rows of other labels whose score is within `band` percent of the
    positive's (none if the positive's is negative).

    Rows with a null id, label or vector take no part. Of rows that share an id the one with
    the smallest label, then vector, counts. Vectors are compared with those of their own
    length; empty ones have score zero. Other columns are not read. No rows give no rows.
    """
    named = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<long>").alias("x"),
        anchors.alias("is_anchor"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    single = named.groupBy("vec_id").agg(F.min(F.struct("label", "x", "is_anchor")).alias("v"))
    single = single.select("vec_id", "v.label", "v.x", "v.is_anchor")
    summed = stored(single.mapInArrow(_summarise, _VECTOR))
    chosen, summed = summed.where("is_anchor").drop("is_anchor"), summed.drop("is_anchor")
    shards = max(shuffle_partitions(vectors), -(-summed.count() // SHARD_ROWS), 1)

    offered = _searched(
        summed, chosen, shards, lambda a, r: _positives(a, r, positives),
        "anchor_id long, positive_id long, positive_score long", False,
    )
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    first = stored(offered.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives).drop("n"))
    goals = first.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    aimed = chosen.join(goals, chosen.vec_id == goals.anchor_id).drop("anchor_id")

    found = _searched(
        summed, aimed, shards, lambda a, r: _negatives(a, r, negatives, band),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", True,
    )
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
