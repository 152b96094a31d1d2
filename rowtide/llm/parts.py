"""The parts of operators 2, 3, 5, 11 and 13 that SQL can say, and their twins.

The whole queries of these operators have none (entropy windows, Markov models, networks, context
graphs, eigenvectors). What the contracts fix of them is held against SQL here: fixed patterns,
rules, word frequencies, exact sums. Rows come through the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import lm


def frequency_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word-frequency half of the language-model scores, without the network."""
    found = lm.base_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("base_score", F.round("base_score", 4))


def url_rules(judged: DataFrame) -> DataFrame:
    """Host, path and rule of every URL; the verdict where a rule gives it."""
    verdict = F.when(F.col("rule").isNotNull(), F.col("verdict"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("rule_verdict"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _matches(number: int, kind: str, pattern: str, holds: str) -> str:
    """Rows of the matches of one kind: a gap and a match at a time, so that lengths give places.

    `m` is a match, `parts` the groups of the pattern (from 1), in the condition `holds`.
    """
    gap = _quoted(f"(?s)(.*?)({pattern})")
    return f"""
        SELECT doc_id, {number} AS nr, '{kind}' AS kind, e - length(m) AS s, e
        FROM (
            SELECT doc_id, m, last, sum(length(whole)) OVER (PARTITION BY doc_id ORDER BY i) AS e
            FROM (
                SELECT doc_id, unnest(regexp_extract_all(text, {gap}, 0)) AS whole,
                       unnest(regexp_extract_all(text, {gap}, 2)) AS m,
                       unnest(regexp_extract_all(text, {gap}, {4 if kind == "assign" else 2})) AS last,
                       unnest(range(len(regexp_extract_all(text, {gap}, 0)))) AS i
                FROM t
            )
        ) WHERE {holds}"""


def _span_counts(kinds: list[tuple[str, str, str]]) -> str:
    """A row per document: the number of matches of each kind, and the digest of their places."""
    rows = " UNION ALL ".join(_matches(i, *k) for i, k in enumerate(kinds))
    numbers = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, _, _ in kinds)
    whole = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k, _, _ in kinds)
    return f"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        found AS ({rows}),
        summed AS (
            SELECT doc_id, {numbers}, string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, nr) AS spans
            FROM found GROUP BY doc_id
        )
        SELECT t.doc_id, {whole}, sha256(coalesce(spans, '')) AS base_sha256
        FROM t LEFT JOIN summed USING (doc_id)
    """


_SECRET_WORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum([
    CASE WHEN i % 2 = 1 THEN CAST({_DIGITS}[-i] AS INT)
         ELSE CAST({_DIGITS}[-i] AS INT) * 2 - CASE WHEN {_DIGITS}[-i] > '4' THEN 9 ELSE 0 END END
    FOR i IN range(1, length({_DIGITS}) + 1)]) % 10 = 0"""
_AT_MOST_255 = """len([1 FOR p IN string_split(m, '.')
    IF length(ltrim(p, '0')) > 3 OR coalesce(TRY_CAST(right(p, 3) AS INT), 0) > 255]) = 0"""

ORACLES = {
    "secret_fixed_spans": _span_counts(
        [
            (
                "assign",
                rf"""({_SECRET_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                "length(last) >= 8",
            ),
            ("access", "AKIA[A-Z0-9]+", "length(m) >= 16"),
            ("hex", "[0-9a-f]+", "length(m) >= 32"),
        ]
    ),
    "personal_fixed_spans": _span_counts(
        [
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", _AT_MOST_255),
            ("card", r"[0-9]([\x20-]?[0-9])+", _LUHN),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
        ]
    ),
    "url_rules": """
        WITH cut AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
            FROM cut
        ), named AS (
            SELECT page_id, path,
                   translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
            FROM parts
        ), rules(word, rule, name, start) AS (
            VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
                   ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
                   ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
        )
        SELECT page_id, host, path, rule, word AS rule_verdict
        FROM named LEFT JOIN rules
          ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1
    """,
    # The checksum of an id is taken byte by byte, by a table of 256 remainders.
    "frequency_scores": """
        WITH RECURSIVE shifted(i, c, k) AS (
            SELECT i, i, 0 FROM range(256) r(i)
            UNION ALL
            SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM shifted WHERE k < 8
        ), crc(doc_id, s, taken, c) AS (
            SELECT doc_id, CAST(doc_id AS VARCHAR), 0, 4294967295 FROM documents
            UNION ALL
            SELECT doc_id, s, taken + 1, xor(crc.c >> 8, b.c)
            FROM crc JOIN shifted b ON b.k = 8 AND b.i = xor(crc.c & 255, ascii(substr(s, taken + 1, 1)))
            WHERE taken < length(s)
        ), folds AS (
            SELECT doc_id, xor(c, 4294967295) % 7 = 2 AS held_out FROM crc WHERE taken = length(s)
        ), t AS (
            SELECT doc_id, held_out, list_append(regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), ' ') AS w
            FROM documents JOIN folds USING (doc_id)
        ), tokens AS (SELECT doc_id, held_out, unnest(w) AS word FROM t),
        counts AS (SELECT word, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY word),
        size AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n, count(*) AS v FROM counts)
        SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens,
               round(sum(log10((coalesce(c, 0) + 1) / CAST(n + v + 1 AS DOUBLE))), 4) AS base_score
        FROM tokens LEFT JOIN counts USING (word), size GROUP BY doc_id, held_out
    """,
    "whitening_sums": """
        WITH rows AS (
            SELECT vec_id, [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([1 FOR c IN embedding IF c IS NOT NULL AND isfinite(c)]) = len(embedding)
        ), fitted AS (SELECT DISTINCT x FROM rows),
        size AS (SELECT count(*) AS n FROM fitted),
        sums AS (
            SELECT j, sum(c) AS s FROM (SELECT unnest(x) AS c, unnest(range(1, len(x) + 1)) AS j FROM fitted) GROUP BY j
        ), placed AS (SELECT vec_id, unnest(x) AS c, unnest(range(1, len(x) + 1)) AS j FROM rows)
        SELECT vec_id, CAST(component AS INT) AS component, n, deviation
        FROM (
            SELECT vec_id, any_value(n) AS n, CAST(sum((n * c - s) * (n * c - s)) AS BIGINT) AS deviation
            FROM placed JOIN sums USING (j), size GROUP BY vec_id
        ), range(1, 5) r(component)
    """,
}
