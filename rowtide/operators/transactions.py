"""Transaction sets: which transactions of which server a feed has, as ranges of their numbers.

After a fail-over the new primary's log has other files and positions, and only transaction
identifiers (server:number) tell whether the feed has everything that was executed. A set is
a table (server, first, last) of disjoint ranges that do not touch. One server may have executed nearly
all transactions, so its numbers are taken block by block; of blocks' ranges only those that reach
a block's edge are held against their neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Numbers of a block, and of the parts in which blocks' edges are joined first: 2^16 and 2^32.
BLOCK_BITS, PART_BITS = 16, 32
RANGES = "server string, first long, last long"


def server_and_number(gtid: Column) -> tuple[Column, Column]:
    """`server:number` taken apart; both null where it is something else.

    The server may carry a tag (`server:tag:number`), which counts as a part of its name.
    """
    text = F.trim(gtid)
    number = F.regexp_extract(text, r"^.+:([0-9]+)$", 1).try_cast("long")
    return F.when(number.isNotNull(), F.regexp_extract(text, r"^(.+):[0-9]+$", 1)), number


def _block(number: str, bits: int) -> Column:
    return F.shiftright(number, bits)


def _island_ranges(ranges: DataFrame, *by: Column) -> DataFrame:
    """Disjoint ranges of a group, those that touch made one."""
    names = [f"by{i}" for i in range(len(by))]
    keyed = ranges.select("server", "first", "last", *[c.alias(n) for c, n in zip(by, names)])
    order = Window.partitionBy("server", *names).orderBy("first")
    begins = F.coalesce(F.col("first") > F.lag("last").over(order) + 1, F.lit(True))
    numbered = keyed.withColumn("begins", begins.cast("long")).withColumn("island", F.sum("begins").over(order))
    ends = numbered.groupBy("server", *names, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return ends.select("server", "first", "last")


def _joined(ranges: DataFrame) -> DataFrame:
    """Ranges cut at blocks made whole: edges of blocks within parts first, then edges of parts.

    Ranges at no edge have no neighbour; they stay in a group of their block.
    """
    for bits, part in ((BLOCK_BITS, _block("first", PART_BITS)), (PART_BITS, F.lit(0))):
        size = F.lit(1 << bits)
        at_edge = (F.pmod("first", size) == 0) | (F.pmod(F.col("last") + 1, size) == 0)
        own = F.when(~at_edge, _block("first", BLOCK_BITS))
        ranges = _island_ranges(ranges, part, own)
    return ranges


def transaction_set(events: DataFrame, gtid: str = "source_gtid") -> DataFrame:
    """The set of the transactions in a column of identifiers. Others, and nulls, are passed over."""
    server, number = server_and_number(F.col(gtid))
    numbers = events.select(server.alias("server"), number.alias("first")).where("server IS NOT NULL").distinct()
    return _joined(_island_ranges(numbers.withColumn("last", F.col("first")), _block("first", BLOCK_BITS)))


def parse_set(spark: SparkSession, text: str) -> DataFrame:
    """A set as the database writes it: `server:1-5:7,other:1-3`. Ranges may overlap."""
    rows = []
    for part in filter(None, "".join(text.split()).split(",")):
        server, *spans = part.split(":")
        for span in spans:
            if not span[:1].isdigit():  # a tag
                server = f"{part.split(':')[0]}:{span}"
                continue
            first, _, last = span.partition("-")
            rows.append((server, int(first), int(last or first)))
    return spark.createDataFrame(rows, RANGES)


def _cut(ranges: DataFrame, bits: int) -> DataFrame:
    """Ranges cut where blocks of 2^bits numbers end."""
    blocks = F.explode(F.sequence(_block("first", bits), _block("last", bits)))
    begin = F.shiftleft("b", bits)
    return ranges.select("*", blocks.alias("b")).select(
        "server",
        F.greatest("first", begin).alias("first"),
        F.least("last", begin + F.lit((1 << bits) - 1)).alias("last"),
    )


def missing_transactions(executed: DataFrame, present: DataFrame) -> DataFrame:
    """The set of transactions that are executed and not present, e.g. in the feed.

    Both sides are cut into blocks; a block's boundaries are swept in order with the number of
    ranges open on each side. Ranges of a side may overlap. An empty range (first > last) is refused.
    """
    def bounds(ranges: DataFrame, a: int, b: int) -> DataFrame:
        ranges = ranges.select("server", "first", F.when(F.col("first") <= F.col("last"), F.col("last")).otherwise(
            F.raise_error(F.lit("a range ends before it begins"))).alias("last"))
        cut = _cut(_cut(ranges, PART_BITS), BLOCK_BITS).withColumn("block", _block("first", BLOCK_BITS))
        ends = f"inline(array(struct(first AS at, {a}L AS a, {b}L AS b), struct(last + 1 AS at, {-a}L AS a, {-b}L AS b)))"
        return cut.selectExpr("server", "block", ends)

    both = bounds(executed, 1, 0).unionByName(bounds(present, 0, 1))
    both = both.groupBy("server", "block", "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    order = Window.partitionBy("server", "block").orderBy("at")
    swept = both.select(
        "server",
        "block",
        F.col("at").alias("first"),
        (F.lead("at").over(order) - 1).alias("last"),
        (F.sum("a").over(order) > 0).alias("wanted"),
        (F.sum("b").over(order) > 0).alias("there"),
    )
    # Pieces between two boundaries of the wanted side alone touch each other.
    return _joined(_island_ranges(swept.where("wanted AND NOT there"), F.col("block")))
