"""Benchmark passages in documents, found through a positional inverted index.

Only DataFrame operations. The documents are read once: a posting (term, document, position)
is stored for every token that is a word of the benchmark, and one row for each document's
length. A posting's position less the term's offset in a window is a start of that window.
The lists of a window's rarest terms are intersected on the start first; what they have in
common is held against the lists of all its other terms. A window occurs exactly where all
lists say so, and nearly where its rarest terms stand a few words from their places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import ascii_lower, broadcast_if, stored
from rowtide.session import written

# Runs of 0-9, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
# Terms of a window whose lists are intersected first, the rarest.
RARE_TERMS = 2
# How far a window's rare terms may have moved for a proximity match.
SLOP = 5
# Benchmark words and window terms up to this number are broadcast, more join by shuffle.
BROADCAST_TERMS = 200_000
# Documents (16 bytes each) with candidates or matches up to this number are broadcast.
BROADCAST_DOCUMENTS = 1_000_000


END = -1  # the term of the row that has a document's length


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _windows(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(item, start, window): `size` consecutive words, or all words of a shorter item."""
    items = benchmark.select(F.col(item_col).alias("item"), words(F.col(text_col).cast("string")).alias("w"))
    items = items.where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return items.select("item", "w", F.explode(starts).alias("start")).select(
        "item", "start", F.slice("w", F.col("start") + 1, size).alias("window")
    )


def _key(id_col: str, text: Column) -> list[Column]:
    """Rows are told apart by id and text, so a repeated id does no harm."""
    return [F.col(id_col).alias("id"), F.xxhash64(text).alias("mark")]


def _index(docs: DataFrame, id_col: str, text: Column, terms: DataFrame) -> DataFrame:
    """Stored postings (id, mark, pos, t) of the terms; t = END at a document's length.

    Words travel one by one and without their text, so no task holds more of a long text
    than its split words, and a term that is everywhere can be split in the join.
    """
    end = docs.sparkSession.createDataFrame([("", END)], "term string, t long")
    known = broadcast_if(stored(terms.unionByName(end)), BROADCAST_TERMS)
    # Words are never empty; the empty one at the end carries the length. Outer: a plain
    # explode would make the optimizer split the text twice, for a filter on size.
    split = F.concat(F.coalesce(words(text), F.array().cast("array<string>")), F.array(F.lit("")))
    tokens = docs.select(*_key(id_col, text), F.posexplode_outer(split).alias("pos", "term"))
    return written(tokens.join(known, "term").select("id", "mark", "pos", "t"), "postings")


def _same(a: DataFrame, b: DataFrame) -> Column:
    """One document; b's key columns are called b_id and b_mark."""
    return (a["mark"] == b["b_mark"]) & a["id"].eqNullSafe(b["b_id"])


def _other(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"id": "b_id", "mark": "b_mark"})


class _Search:
    """Windows of a benchmark, the index of the documents, and what the lists have in common."""

    def __init__(self, docs, benchmark, id_col, text_col, item_col, item_text_col, size, rare, slop):
        self.slop = slop
        text = F.col(text_col).cast("string")
        listed = stored(_windows(benchmark, item_col, item_text_col, size))
        # Numbers given to stored rows stay the same.
        numbered = stored(listed.select("window").distinct()).withColumn("w", F.monotonically_increasing_id())
        self.windows = stored(listed.join(numbered, "window").select("item", "start", "w", F.size("window").alias("length")))
        places = numbered.select("w", F.size("window").alias("length"), F.posexplode("window").alias("off", "term"))
        places = stored(places)
        terms = stored(places.select("term").distinct()).withColumn("t", F.monotonically_increasing_id())
        self.postings = _index(docs, id_col, text, terms)
        counts = self.postings.where(F.col("t") != END).groupBy("t").count()
        by_window = Window.partitionBy("w")
        ranked = (
            places.join(terms, "term")
            .join(broadcast_if(stored(counts), BROADCAST_TERMS), "t", "left")
            # A window with a word that no document has cannot occur.
            .withColumn("fewest", F.min(F.coalesce("count", F.lit(0))).over(by_window))
            .where("fewest > 0")
            .withColumn("rank", F.row_number().over(by_window.orderBy("count", "off")))
        )
        self.places = stored(ranked.select("w", "length", "off", "t", "rank"))
        self.lists = F.least(F.col("length"), F.lit(rare))
        self.rarest = stored(self.places.where(F.col("rank") <= rare))

    def starts(self) -> DataFrame:
        """The starts that the lists of the rarest terms offer."""
        rarest = broadcast_if(self.rarest, BROADCAST_TERMS)
        offered = self.postings.join(rarest, "t")
        return offered.select("id", "mark", "w", (F.col("pos") - F.col("off")).alias("at"), "rank", "length")

    def exact(self) -> DataFrame:
        """(id, mark, w, at): the starts that the lists of all terms have in common."""
        by = ["id", "mark", "w", "at"]
        met = self.starts().where("at >= 0").groupBy(*by).agg(F.count_distinct("rank").alias("n"), F.first("length").alias("length"))
        met = stored(met.where(F.col("n") == self.lists).select(*by))
        there = broadcast_if(_other(stored(met.select("id", "mark").distinct())), BROADCAST_DOCUMENTS)
        lists = self.postings.join(there, _same(self.postings, there), "left_semi")
        asked = met.join(self.places, "w").select(*by, "t", "length", (F.col("at") + F.col("off")).alias("spot"))
        asked = _other(asked).withColumnRenamed("t", "b_t")
        on = _same(lists, asked) & (lists["pos"] == asked["spot"]) & (lists["t"] == asked["b_t"])
        found = lists.join(asked, on).groupBy("id", "mark", "w", "at")
        found = found.agg(F.count_distinct("spot").alias("n"), F.first("length").alias("length"))
        return stored(found.where("n = length").select(*by))

    def near(self, exact: DataFrame) -> DataFrame:
        """(id, mark, w, at): the rarest term's starts from which each of the other rare terms
        is at most `slop` words off, and which are no exact ones."""
        by, width = ["id", "mark", "w", "at"], self.slop + 1
        starts = self.starts().withColumn("cell", F.floor(F.col("at") / width))
        around = F.explode(F.sequence(F.col("cell") - 1, F.col("cell") + 1)).alias("cell")
        first = starts.where("rank = 1").select(*by, "length", around)
        others = _other(starts.where("rank > 1")).select(
            "b_id", "b_mark", F.col("w").alias("b_w"), F.col("cell").alias("b_cell"), F.col("at").alias("b_at"), "rank"
        )
        close = F.abs(F.col("at") - F.col("b_at")) <= self.slop
        both = _same(first, others) & (first["w"] == others["b_w"]) & (first["cell"] == others["b_cell"])
        met = first.join(others, both & close).groupBy(*by)
        met = met.agg(F.count_distinct("rank").alias("n"), F.first("length").alias("length"))
        met = met.where(F.col("n") == self.lists - 1).select(*by)
        known = _other(exact).withColumnsRenamed({"w": "b_w", "at": "b_at"})
        on = _same(met, known) & (met["w"] == known["b_w"]) & (met["at"] == known["b_at"])
        return met.join(known, on, "left_anti")

    def of_items(self, found: DataFrame) -> DataFrame:
        return found.join(self.windows, "w").drop("w")


def _search(docs, benchmark, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
            size=WINDOW_WORDS, rare=RARE_TERMS, slop=SLOP) -> _Search:
    return _Search(docs, benchmark, id_col, text_col, item_col, item_text_col, size, rare, slop)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Window matches: id, mark (hash of the text), item, start, at, length, kind.

    kind 'exact': the window's words stand from word `at` of the document on. kind 'near':
    its rarest term is where it should be for a start at `at`, each of the other rare terms
    (there is one at least) within `slop` words of its place, and the window is not there
    itself. Options: item_col, item_text_col, size (words of a window), rare (lists
    intersected first), slop.

    Null and empty texts have no words; very long texts are read whole. `docs` may be empty,
    repeat rows or have null ids, which are told apart by the text; the benchmark may be
    empty. Other columns are not read.
    """
    search = _search(docs, benchmark, id_col, text_col, **options)
    exact = search.exact()
    found = exact.withColumn("kind", F.lit("exact")).unionByName(search.near(exact).withColumn("kind", F.lit("near")))
    return search.of_items(found).withColumnRenamed("id", id_col)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (sorted as strings), n_near, mark.

    n_hit counts the words inside any exact match, n_near the windows of items that occur
    nearly and nowhere exactly. Documents without words have zeros and an empty list. The
    rest is as for `matches`.
    """
    search = _search(docs, benchmark, id_col, text_col, **options)
    places = search.exact()
    near = search.of_items(search.near(places)).select("id", "mark", "item", "start").distinct()
    exact = stored(search.of_items(places))
    by = ["id", "mark"]
    spot = F.explode(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)).alias("spot")
    # Windows of several items at one place count once; each task merges its own first.
    hits = exact.select(*by, "at", "length").distinct().select(*by, spot).distinct()
    hits = hits.groupBy(*by).agg(F.count("*").alias("n_hit"))
    items = exact.groupBy(*by).agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    once = exact.select(*by, "item", "start").distinct()
    known = _other(once).withColumnsRenamed({"item": "b_item", "start": "b_start"})
    same = _same(near, known) & (near["item"].eqNullSafe(known["b_item"])) & (near["start"] == known["b_start"])
    near = near.join(known, same, "left_anti").groupBy(*by).agg(F.count("*").alias("n_near"))
    sums = hits
    for more in (items, near):
        sums = _full_join(sums, more, by)
    sums = _other(sums)
    rows = search.postings.where(F.col("t") == END)
    return rows.join(sums, _same(rows, sums), "left").select(
        F.col("id").alias(id_col),
        F.col("pos").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "mark",
    )


def _full_join(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    left, right = a, b.select(*[F.col(c).alias(f"r_{c}") if c in by else F.col(c) for c in b.columns])
    same = [left[c].eqNullSafe(right[f"r_{c}"]) for c in by]
    rest = [c for c in [*a.columns, *b.columns] if c not in by]
    ids = [F.coalesce(left[c], right[f"r_{c}"]).alias(c) for c in by]
    return left.join(right, same[0] & same[1], "full").select(*ids, *rest)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of `docs`, all columns kept, in which no window occurs exactly.

    Odd rows are as for `matches`; those without words stay.
    """
    text = F.col(text_col).cast("string")
    found = _search(docs, benchmark, id_col, text_col, **options).exact()
    dropped = stored(found.select(F.col("id").alias("_hit_id"), F.col("mark").alias("_hit_mark")).distinct())
    dropped = broadcast_if(dropped, BROADCAST_DOCUMENTS)
    same = docs[id_col].eqNullSafe(dropped["_hit_id"]) & F.xxhash64(text).eqNullSafe(dropped["_hit_mark"])
    return docs.join(dropped, same, "left_anti")
