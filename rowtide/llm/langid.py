"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all documents one may learn from. The weights are
fitted by follow-the-regularised-leader with L1 and L2 penalties on a bounded sample of
labelled rows, and one temperature is fitted on rows the weights never saw. Prediction
reads whole texts in blocks.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import stored

UNDETERMINED = "und"
BITS = 16  # n-grams share 2^16 slots
ORDERS = (1, 2, 3)
# Labelled rows fitted on, about; a quarter of as many more set the temperature. Of a rare
# language LABEL_ROWS (and a quarter of as many) are drawn, or all where there are fewer.
TRAIN_ROWS = 3000
LABEL_ROWS = 100
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
# Features are relative frequencies, times this, times the inverse document frequency.
SCALE = 16.0
# Characters worked on at a time.
BLOCK = 1 << 20


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """For each code point its lower-case letter, or 32 where it is no letter."""
    table = np.full(sys.maxunicode + 1, 32, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _slots(text: str | None) -> Iterator[np.ndarray]:
    """The slots of a text's n-grams, block by block; nothing for a text without letters."""
    table = _folding()
    tail = np.array([32], np.uint32)
    if not text:
        return
    for begin in range(0, len(text), BLOCK):
        raw = np.frombuffer(text[begin : begin + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        now = np.concatenate([tail, table[raw]])
        if begin + BLOCK >= len(text):
            now = np.append(now, np.uint32(32))
        blank = now == 32
        keep = ~(blank & np.concatenate([[False], blank[:-1]]))
        keep[: len(tail)] = True  # they were kept already
        now = now[keep]
        found = []
        for n in ORDERS:
            # n-grams that end in this block: those within the tail were given before.
            skip = max(len(tail) - n + 1, 0)
            codes = now[skip:]
            if len(codes) < n:
                continue
            h = np.full(len(codes) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for k in range(n):
                h = (h ^ codes[k : len(codes) - n + 1 + k]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            if n == 1:
                h = h[codes != 32]
            found.append(h >> np.uint32(32 - BITS))
        tail = now[-(max(ORDERS) - 1) :]
        if found:
            yield np.concatenate(found)


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass
class Model:
    """Languages in order, weights times frequency weights by slot, biases, temperature."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not _has_letter(text):
            return UNDETERMINED, 0.0
        total, count = np.zeros(len(self.languages)), 0
        for slots in _slots(text):
            total += self.table[slots].sum(axis=0, dtype=np.float64)
            count += len(slots)
        logits = (total / count + self.bias) / self.temperature
        odds = np.exp(logits - logits.max())
        best = int(np.argmax(odds))
        return self.languages[best], float(odds[best] / odds.sum())


def _learn_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slot counts of the sampled rows, and the task's document frequencies."""
    frequency, docs = np.zeros(1 << BITS, np.int64), 0
    names = ["lang", "part", "slots", "counts", "key", "slot", "n"]
    kinds = [pa.string(), pa.int8(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
    for batch in batches:
        out = []
        for text, lang, part, key in zip(*batch.columns):
            text, lang, part, key = text.as_py(), lang.as_py(), part.as_py(), key.as_py()
            counts = np.zeros(1 << BITS, np.int32)
            for slots in _slots(text):
                counts += np.bincount(slots, minlength=1 << BITS).astype(np.int32)
            some = np.flatnonzero(counts)
            frequency[some] += 1
            docs += 1
            if part >= 0 and len(some):
                out.append((lang, part, some.astype(np.int32).tobytes(), counts[some].tobytes(), key, None, None))
        columns = zip(*out) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
    some = np.flatnonzero(frequency)
    # Slot -1 stands for the number of documents.
    slots, counts = np.append(some, -1), np.append(frequency[some], docs)
    last = [pa.nulls(len(slots), k) for k in kinds[:5]] + [pa.array(slots, kinds[5]), pa.array(counts, kinds[6])]
    yield pa.RecordBatch.from_arrays(last, names=names)


def train(
    docs: DataFrame,
    text: Column,
    lang: Column,
    calibrate: Column,
    key: Column,
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """A model from all rows of `docs` that have a label and a text.

    `key` (a long, well spread) draws the sample of about `train_rows` rows; of the rows
    where `calibrate` holds, a quarter as many set the temperature. A language of which this
    would draw fewer than LABEL_ROWS is drawn more densely, so that every one is learnt, and
    its bias and its weight in the temperature are put right by the rate. The bounds concern the
    fit only. Without labelled rows the model knows no language and predicts `und`.
    """
    rows = docs.select(text.alias("text"), lang.alias("lang"), calibrate.alias("late"), key.alias("key"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    # One row for each language and half, of which a model holds weights anyway.
    sizes = {(bool(r["late"]), r["lang"]): r["n"] for r in rows.groupBy("late", "lang").agg(F.count("*").alias("n")).collect()}
    totals = [sum(n for (late, _), n in sizes.items() if late == half) for half in (False, True)]
    share = [min(1.0, train_rows / max(1, totals[0])), min(1.0, train_rows / 4 / max(1, totals[1]))]
    rates = {
        (late, name): max(share[late], min(1.0, LABEL_ROWS / (4 if late else 1) / n)) for (late, name), n in sizes.items()
    }
    part = F.when(F.col("late"), F.lit(1)).otherwise(F.lit(0)).cast("byte")
    bound = F.lit(0.0)
    for late in (False, True):
        entries = [F.lit(x) for (half, name), rate in rates.items() if half == late for x in (name, rate)]
        if entries:
            bound = F.when(F.col("late") == late, F.try_element_at(F.create_map(*entries), F.col("lang"))).otherwise(bound)
    drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < bound * (1 << 30)
    part = F.when(drawn, part).otherwise(F.lit(-1).cast("byte"))
    found = stored(
        rows.select("text", "lang", part.alias("part"), "key").mapInArrow(
            _learn_batches, "lang string, part byte, slots binary, counts binary, key long, slot int, n long"
        )
    )
    frequency = found.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    by_slot = np.zeros(1 << BITS)
    total = 0
    for r in frequency:  # at most 2^16 + 1 rows
        if r["slot"] < 0:
            total = r["n"]
        else:
            by_slot[r["slot"]] = r["n"]
    weight = np.log((1 + total) / (1 + by_slot)) + 1
    sample = found.where("slot IS NULL").select("lang", "part", "slots", "counts", "key").collect()
    sample.sort(key=lambda r: (r["key"], r["lang"], r["slots"], r["counts"]))
    languages = sorted({r["lang"] for r in sample})
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0)
    number = {name: i for i, name in enumerate(languages)}
    examples: list[list] = [[], []]
    for r in sample:
        slots, counts = np.frombuffer(r["slots"], np.int32), np.frombuffer(r["counts"], np.int32)
        x = SCALE * weight[slots] * counts / counts.sum()
        examples[r["part"]].append((slots, x, number[r["lang"]]))
    fit, late = examples
    # How much each language's rows stand for: one, or less where it was drawn more densely.
    stands = [np.array([share[h] / rates.get((bool(h), name), share[h]) for name in languages]) for h in (0, 1)]
    weights, bias = fit_ftrl(fit or late, len(languages))
    bias = bias + np.log(stands[0 if fit else 1])
    temperature = fit_temperature(late or fit, weights, bias, stands[1 if late else 0])
    return Model(languages, (SCALE * weight[:, None] * weights).astype(np.float32), bias, temperature)


def fit_ftrl(examples: list, classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (slot, class) and biases by follow-the-regularised-leader, rows in given order."""
    z, n = np.zeros(((1 << BITS) + 1, classes)), np.zeros(((1 << BITS) + 1, classes))

    def solve(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    last = 1 << BITS
    # A fixed shuffle of the epochs: neighbouring ids may be alike.
    draw = np.random.default_rng(17)
    for row in itertools.chain(*(draw.permutation(len(examples)) for _ in range(epochs))):
        slots, x, y = examples[row]
        w, b = solve(z[slots], n[slots], L1), solve(z[last], n[last], 0.0)
        logits = x @ w + b
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[y] -= 1.0
        for at, g, now in ((slots, x[:, None] * p, w), (last, p, b)):
            before = n[at]
            after = before + g * g
            z[at] += g - (np.sqrt(after) - np.sqrt(before)) / ALPHA * now
            n[at] = after
    w = solve(z, n, L1)
    return w[:last], solve(z[last], n[last], 0.0)


def fit_temperature(examples: list, weights: np.ndarray, bias: np.ndarray, stands: np.ndarray | None = None) -> float:
    """The temperature of least log loss, by golden section on its logarithm.

    `stands` is how much an example of each class counts for.
    """
    logits = np.array([x @ weights[slots] + bias for slots, x, _ in examples])
    truth = np.array([y for _, _, y in examples])

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1)
        each = top + np.log(np.exp(scaled - top[:, None]).sum(axis=1)) - scaled[np.arange(len(truth)), truth]
        return float(np.average(each, weights=None if stands is None else stands[truth]))

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def predict_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """struct<lang: string, score: double> of a text; `und` and 0 for null or letterless ones.

    The model has a fixed number of slots times the number of languages.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def run(batch: pa.Array) -> pa.Array:
        found = [shared.value.predict(t.as_py()) for t in batch]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=["lang", "score"],
        )

    return run(text.cast("string"))


def fold(id_col: Column, count: int) -> Column:
    """crc32 of the id as text, modulo `count`; a null id counts as empty."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(count))


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 5,
    train_rows: int = TRAIN_ROWS,
) -> tuple[Column, Column]:
    """(prediction, held_out) columns for `docs`, from a model of its own labelled rows.

    Fold 0 is never learnt from; of the others, fold 1 sets the temperature. Null labels
    are passed over; repeated rows count as often as they occur.
    """
    part = fold(F.col(id_col), folds)
    usable = docs.where(part != 0)
    key = F.xxhash64(F.col(id_col).cast("string"))
    model = train(usable, F.col(text_col).cast("string"), F.col(lang_col), part == 1, key, train_rows)
    return predict_column(docs.sparkSession, model, F.col(text_col)), part == 0
