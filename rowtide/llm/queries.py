"""One registered query per operator, over whole tables and whole texts, and the SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import (
    decontam,
    exact_dedup,
    hard_negatives,
    langid,
    lm,
    parts,
    pieces,
    pii,
    secret_scan,
    sharding,
    simhash,
    token_counts,
    url_filter,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"), keep="largest")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_scan.scan_column(F.col("text")).alias("s"))

    def number(kind: str):
        return F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("s", lambda x: x["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        *[number(k) for k in secret_scan.BASE_KINDS],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("s")).alias("spans"),
        number("entropy"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found, held_out = langid.identify(docs)
    judged = docs.select("doc_id", held_out.alias("held_out"), found.alias("p"))
    return judged.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near",
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether decoding gives the text back."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = docs.select("doc_id", pieces.encode_column(spark, F.col("text")).alias("p"))
    return coded.select("doc_id", "p.pieces", F.size("p.pieces").cast("long").alias("n_pieces"), "p.round_trip")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    counted = docs.select("doc_id", token_counts.count_column(spark, F.col("text")).alias("n"))
    return counted.select("doc_id", F.col("n.words").alias("n_words"), F.col("n.tokens").alias("n_tokens"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    fixed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", fixed.alias("fingerprint"), "component_id")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] != pii.KINDS[pii.CONTEXT])
    number = {k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}") for k in pii.KINDS}
    return found.select(
        "doc_id",
        *[number[k] for k in pii.BASE_KINDS],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
        number["context"],
    )


def _whole_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings whose vectors have every component, as whole numbers of 1/256."""
    rows = _table(spark, sf_dir, "embeddings").where(hard_negatives.is_finite(F.col("embedding")))
    return rows.select("vec_id", "label", hard_negatives.quantised(F.col("embedding")).alias("vector"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    rows = _whole_vectors(spark, sf_dir).withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_whole_vectors(spark, sf_dir).select("vec_id", "vector"))


def secret_fixed_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the contract fixes of op2."""
    return op2_secret_scan(spark, sf_dir).drop("spans", "n_entropy")


def personal_fixed_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the contract fixes of op11."""
    return op11_personal_data(spark, sf_dir).drop("spans", "n_context")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.url_rules(op3_url_filter(spark, sf_dir))


def whitening_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole numbers among the results of op13."""
    return op13_whitening(spark, sf_dir).select("vec_id", "component", "n", "deviation")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_url_filter": op3_url_filter,
    "op4_language_id": op4_language_id,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_sharding": op6_sharding,
    "op7_decontamination": op7_decontamination,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_personal_data": op11_personal_data,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
    "secret_fixed_spans": secret_fixed_spans,
    "url_rules": url_rules,
    "frequency_scores": parts.frequency_scores,
    "personal_fixed_spans": personal_fixed_spans,
    "whitening_sums": whitening_sums,
}

ORACLES = {
    **parts.ORACLES,
    "op1_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY text) AS keep_id,
               count(*) OVER (PARTITION BY text) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text) AS kept,
               sha256(text) AS text_sha256
        FROM t
    """,
    "op7_decontamination": """
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
        ), windows AS (
            SELECT item_id, i AS s, least(10, len(w)) AS n, list_slice(w, i, i + 9) AS win
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
        ), sizes AS (SELECT DISTINCT n FROM windows),
        starts AS (
            SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
        ), found AS (
            SELECT s.doc_id, s.i, s.n, x.item_id, x.s FROM starts s JOIN windows x ON s.n = x.n AND s.win = x.win
        ), hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
        ), tokens AS (
            SELECT doc_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos FROM d
        ), counts AS (SELECT term, count(*) AS c FROM tokens GROUP BY term),
        rare AS (
            SELECT win, term, off, row_number() OVER (PARTITION BY win ORDER BY coalesce(c, 0), off) AS rank,
                   min(coalesce(c, 0)) OVER (PARTITION BY win) AS fewest
            FROM (SELECT win, unnest(win) AS term, unnest(range(len(win))) AS off FROM (SELECT DISTINCT win FROM windows))
            LEFT JOIN counts USING (term)
        ), offered AS (
            SELECT t.doc_id, r.win, r.rank, t.pos - r.off AS i
            FROM rare r JOIN tokens t USING (term) WHERE r.rank <= 2 AND r.fewest > 0
        ), close AS (
            SELECT DISTINCT a.doc_id, a.win, a.i
            FROM offered a JOIN offered b ON a.doc_id = b.doc_id AND a.win = b.win AND abs(a.i - b.i) <= 5
            WHERE a.rank = 1 AND b.rank = 2
        ), near AS (
            SELECT doc_id, count(*) AS n_near FROM (
                SELECT DISTINCT c.doc_id, x.item_id, x.s FROM close c JOIN windows x ON c.win = x.win
                WHERE NOT EXISTS (
                    SELECT 1 FROM found f WHERE f.doc_id = c.doc_id AND f.item_id = x.item_id AND f.s = x.s
                )
            ) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
    """,
    "op12_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([1 FOR c IN embedding IF c IS NOT NULL AND isfinite(c)]) = len(embedding)
        ), scores AS (
            SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
                   CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
            FROM rows a JOIN rows r ON a.vec_id <> r.vec_id
            WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INT) AS rank,
               s.other_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
             AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
        QUALIFY rank <= 3
    """,
}
