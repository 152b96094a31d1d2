"""URL filter: domain and path rules, and a character language-model ratio for the rest.

DataFrame operations only. Variable-order Markov models of accepted and rejected URLs are
counted from the URLs the rules decide; each order is smoothed towards the one below by
Witten-Bell weights. A URL without a rule is blocked when the difference of the two
log-likelihoods per character lies below a limit set on URLs the models never saw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import ascii_lower, broadcast_if, shuffle_partitions, stored

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
ORDER = 4
# Symbols a character is spread over where nothing is known.
ALPHABET = 256.0
FOLDS = 5
# Width of the bins in which held-out scores are compared.
BIN = 0.02
BROADCAST_GRAMS = 300_000
BEGIN, END = "\u0002", "\u0003"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ://, A-Z lower-cased) and path; both empty where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        cut = text.index("/") if "/" in text else len(text)
        name, begin = text[:cut], text[cut:]
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(begin)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def _grams(url: Column) -> Column:
    """For each character of a URL and its end: the ORDER symbols before it, and it."""
    padded = F.split(F.concat(F.lit(BEGIN * ORDER), url, F.lit(END)), "")
    places = F.sequence(F.lit(1), F.length(url) + 1)
    return F.transform(places, lambda i: F.array_join(F.slice(padded, i, ORDER + 1), ""))


def _gram_scores(grams: DataFrame) -> DataFrame:
    """(gram, delta): log-probability of its last symbol if accepted, less that if rejected.

    `grams` has every gram once with its counts a and b in accepted and rejected URLs.
    """
    length = F.explode(F.array(*[F.lit(k) for k in range(1, ORDER + 2)])).alias("length")
    tails = grams.select("gram", "a", "b", length)
    tails = tails.withColumn("tail", F.expr("right(gram, length)"))
    counts = tails.groupBy("tail").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    before = F.expr("left(tail, length(tail) - 1)")
    contexts = counts.groupBy(before.alias("context")).agg(
        F.sum("a").alias("na"),
        F.sum("b").alias("nb"),
        F.count_if(F.col("a") > 0).alias("ta"),
        F.count_if(F.col("b") > 0).alias("tb"),
    )
    counts = counts.withColumn("context", before).join(contexts, "context")
    joined = tails.select("gram", "length", "tail").join(counts, "tail")
    steps = F.array_sort(F.collect_list(F.struct("length", "a", "na", "ta", "b", "nb", "tb")))
    joined = joined.groupBy("gram").agg(steps.alias("steps"))

    def chance(c: str, n: str, t: str) -> Column:
        def smooth(p: Column, x: Column) -> Column:
            seen = (x[c] + x[t] * p) / (x[n] + x[t])
            return F.when(x[n] > 0, seen).otherwise(p)

        return F.aggregate("steps", F.lit(1.0 / ALPHABET), smooth)

    delta = F.log(chance("a", "na", "ta")) - F.log(chance("b", "nb", "tb"))
    return joined.select("gram", delta.alias("delta"))


def _limit(scored: DataFrame) -> float:
    """The bin edge that parts held-out accepted from rejected URLs best; 0 without both.

    `scored` has score and verdict. Of equally good edges the lowest is taken.
    """
    bins = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b")
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    share = [F.try_divide(F.sum(c).over(below), F.sum(c).over(everything)) for c in "ba"]
    best = bins.select("bin", (share[0] - share[1]).alias("gain")).orderBy(F.desc("gain"), "bin").first()
    return 0.0 if best is None or best["gain"] is None else (best["bin"] + 1) * BIN


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score, limit.

    Without accepted or without rejected URLs to learn from there is no score, and a URL
    without a rule is allowed. A null URL counts as empty. Each distinct URL is learnt from
    and scored once. Other columns are not read; an empty table gives no rows.
    """
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    host, path = host_and_path(F.col("url"))
    # A URL unfolds into many grams: its rows are dealt out anew, however few bytes they have.
    distinct = pages.select(url.alias("url")).distinct().repartition(shuffle_partitions(pages), "url")
    named = distinct.select("url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    urls = named.select(
        "url", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
        (F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(FOLDS)) == 0).alias("late"),
        F.monotonically_increasing_id().alias("n"),
    )
    urls = stored(urls)
    spread = urls.select("n", "ruled", "late", F.explode(_grams(F.col("url"))).alias("gram"))
    learnt = {w: F.count_if((F.col("ruled") == w) & ~F.col("late")) for w in ("allow", "block")}
    grams = spread.groupBy("gram").agg(learnt["allow"].alias("a"), learnt["block"].alias("b"))
    scores = broadcast_if(stored(_gram_scores(stored(grams))), BROADCAST_GRAMS)
    summed = spread.join(scores, "gram").groupBy("n").agg(F.avg("delta").alias("score"))
    scored = stored(urls.join(summed, "n").select("url", "host", "path", "rule", "ruled", "late", "score"))
    sizes = urls.agg(*[F.count_if((F.col("ruled") == w) & ~F.col("late")) for w in ("allow", "block")]).first()
    limit = _limit(scored.where("late AND ruled IS NOT NULL").withColumnRenamed("ruled", "verdict"))
    score = F.col("score") if all(sizes) else F.lit(None).cast("double")
    own = F.when(score < limit, "block").otherwise("allow")
    verdicts = scored.select(
        "url", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), score.alias("score"),
        F.lit(limit).alias("limit"),
    )
    rows = pages.select(F.col(id_col).alias(id_col), url.alias("url"))
    return rows.join(verdicts, "url").select(id_col, "host", "path", "rule", "verdict", "score", "limit")
