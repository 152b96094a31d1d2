"""Decontamination, URL filter, sharding, the registered queries and the pipeline."""

import collections
import hashlib
import math
import pathlib
import random
import re
import string
import zlib

import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from rowtide.llm import decontam, parts, secret_scan, sharding, simhash, url_filter
from rowtide.llm import queries as llm

# --- decontamination

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(decontam.WORD)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_hits(docs, items, size=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[s : s + size])].add(item)
    out = []
    for i, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if (key := tuple(w[s : s + n])) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[key]
        out.append((i, len(w), len(hit), sorted(map(str, found))))
    return sorted(out, key=str)


PASSAGE = "The quick brown fox jumps over the lazy dog and then runs far away from Écho hills at 9"
ITEMS = [(1, PASSAGE), (2, "tiny Item"), (10, "the the the"), (3, None), (4, "  --  "), (5, PASSAGE[10:]), (6, "not in corpus at all")]
DOCS = [
    (1, "Before: " + PASSAGE.upper().replace("ÉCHO", "Écho") + " after.", "x"),
    (2, None, "x"),
    (3, "", None),
    (4, "a tiny, item; and the the the the end", "x"),
    (5, PASSAGE.replace("lazy", "sleepy"), "x"),
    (6, " ".join(PASSAGE.split()[:9]), "x"),
    (7, (PASSAGE + " filler ") * 30, "x"),
    (7, "tiny item", "x"),
    (7, "tiny item", "x"),
    (None, PASSAGE, "x"),
    (8, PASSAGE.replace("Écho", "écho"), "x"),
    (9, "nothing of it", "x"),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return (
        spark.createDataFrame(DOCS, "doc_id long, text string, mark string"),
        spark.createDataFrame(ITEMS, "item_id long, text string"),
    )


def counted(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [0, 1000])
def test_contamination_equals_brute_force(corpus, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_TERMS", limit)
    assert counted(decontam.contamination(*corpus)) == brute_hits(DOCS, ITEMS)


def test_contamination_with_other_windows(corpus):
    got = decontam.contamination(*corpus, size=4, rare=3)
    assert counted(got) == brute_hits(DOCS, ITEMS, size=4)


def test_random_corpora(spark):
    draw = random.Random(6)
    text = lambda n: " ".join(draw.choice("abcdefgh") for _ in range(n))
    items = [(i, text(draw.randint(1, 14))) for i in range(8)]
    docs = [(i, text(draw.randint(0, 60)), "") for i in range(60)]
    got = decontam.contamination(
        spark.createDataFrame(docs, "doc_id long, text string, n string"),
        spark.createDataFrame(items, "item_id long, text string"),
        size=4,
    )
    assert counted(got) == brute_hits(docs, items, size=4)


def test_near_matches_are_told_apart(corpus):
    got = {(r.doc_id, r.kind) for r in decontam.matches(*corpus).collect()}
    assert {(5, "near"), (1, "exact"), (8, "exact")} <= got  # 5 and 8 differ in one word
    assert not any(i == 9 for i, _ in got)


@pytest.mark.parametrize("rare", [2, 3])
def test_near_matches_equal_plain_loops(spark, rare):
    draw = random.Random(9)
    text = lambda n: " ".join(draw.choice("abcdefghijklmnop") for _ in range(n))
    items = [(i, text(draw.randint(1, 9))) for i in range(6)]
    docs = [(i, text(draw.randint(0, 40)), "") for i in range(25)]
    found = decontam.matches(
        spark.createDataFrame(docs, "doc_id long, text string, n string"),
        spark.createDataFrame(items, "item_id long, text string"), size=4, rare=rare, slop=2,
    ).collect()
    counts = collections.Counter(w for _, t, _ in docs for w in words(t))
    want = set()
    for item, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 3)):
            win = w[s : s + 4]
            if not all(counts[x] for x in win):
                continue
            order = sorted(range(len(win)), key=lambda o: (counts[win[o]], o))[:rare]
            for i, doc, _ in docs:
                d = words(doc)
                for at in range(-9, len(d)):
                    holds = lambda o, at: 0 <= at + o < len(d) and d[at + o] == win[o]
                    if all(holds(o, at) for o in range(len(win))):
                        want.add((i, item, s, at, "exact"))
                    elif len(order) > 1 and holds(order[0], at) and all(any(holds(o, at + m) for m in range(-2, 3)) for o in order[1:]):
                        want.add((i, item, s, at, "near"))
    assert {(r.doc_id, r["item"], r.start, r["at"], r.kind) for r in found} == want and len(found) == len(want)


def test_long_texts_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(decontam, "BROADCAST_DOCUMENTS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    draw = random.Random(2)
    docs = [(i, " ".join(draw.choice(string.ascii_lowercase) for _ in range(32_000)), "") for i in range(8)]
    try:
        frames = (spark.createDataFrame(docs, "doc_id long, text string, n string"), spark.createDataFrame(ITEMS, "item_id long, text string"))
        assert counted(decontam.contamination(*frames)) == brute_hits(docs, ITEMS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_contaminated_rows_leave(corpus):
    left = decontam.drop_contaminated(*corpus)
    assert left.columns == corpus[0].columns
    want = sorted((i for i, _, n, _ in brute_hits(DOCS, ITEMS) if n == 0), key=str)
    assert sorted((r.doc_id for r in left.collect()), key=str) == want


def test_empty_corpora(corpus):
    docs, items = corpus
    assert decontam.contamination(docs.limit(0), items).count() == 0
    got = decontam.contamination(docs, items.limit(0)).collect()
    assert len(got) == len(DOCS) and all(r.n_hit == 0 and r["items"] == [] for r in got)


# --- URL filter

PAGES = [
    (1, "http://Sub.Example.COM/en/1?q#f"),
    (2, "https://www.example.com/en/"),
    (3, "https://www.example.com/fr?x"),
    (4, "http://a.net/es/1"),
    (5, "net/es/"),
    (6, None),
    (7, ""),
    (8, "http://example.com"),
    (9, "http://notexample.com/en/x"),
    (10, "ftp://x.net?y=/fr/"),
    (11, "http://é😀.org/ü"),
    (11, "http://é😀.org/ü"),
    (None, "http://a.b.net/fr/"),
]


def host_path(url):
    if "://" not in (url or ""):
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    fits = []
    for verdict, rule in url_filter.RULES:
        name, _, begin = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + begin):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def slow_scores(urls):
    order = url_filter.ORDER

    def grams(u):
        s = url_filter.BEGIN * order + u + url_filter.END
        return [s[i : i + order + 1] for i in range(len(u) + 1)]

    tails = {w: collections.Counter() for w in ("allow", "block")}
    for u in urls:
        _, verdict = rule_of(*host_path(u))
        if verdict and zlib.crc32(u.encode()) % url_filter.FOLDS:
            tails[verdict].update(g[-k:] for g in grams(u) for k in range(1, order + 2))
    sums = {}
    for w, c in tails.items():
        n, t = collections.Counter(), collections.Counter()
        for tail, times in c.items():
            n[tail[:-1]] += times
            t[tail[:-1]] += 1
        sums[w] = n, t

    def chance(w, gram):
        p, (n, t) = 1 / url_filter.ALPHABET, sums[w]
        for k in range(1, order + 2):
            context = gram[-k:][:-1]
            if n[context]:
                p = (tails[w][gram[-k:]] + t[context] * p) / (n[context] + t[context])
        return p

    return {u: np.mean([math.log(chance("allow", g) / chance("block", g)) for g in grams(u)]) for u in urls}


@pytest.mark.parametrize("limit", [0, 100_000])
def test_pages_are_judged_as_by_hand(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_GRAMS", limit)
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()
    rows = [tuple(r) for r in pages] + [(1000 + (i or 0), u) for i, u in PAGES]
    frame = spark.createDataFrame([(*r, "http://other", 1.0) for r in rows], "page_id long, url string, host string, score double")
    got = url_filter.judge(frame).collect()
    assert len(got) == len(rows)
    urls, scores = dict(rows), slow_scores({u or "" for _, u in rows})
    judged = [(scores[u], v) for u in scores for v in [rule_of(*host_path(u))[1]] if v and zlib.crc32(u.encode()) % 5 == 0]
    share = collections.Counter(v for _, v in judged)

    def gain(edge):
        below = collections.Counter(v for s, v in judged if math.floor(s / url_filter.BIN) <= edge)
        return below["block"] / share["block"] - below["allow"] / share["allow"]

    for r in got:
        url = urls[r.page_id] or ""
        rule, verdict = rule_of(*host_path(url))
        assert (r.host, r.path, r.rule) == (*host_path(url), rule)
        assert abs(r.score - scores[url]) < 1e-9
        assert r.verdict == (verdict or ("block" if r.score < r.limit else "allow"))
    if len(share) == 2:
        edges = sorted({math.floor(s / url_filter.BIN) for s, _ in judged})
        best = max(edges, key=lambda e: (round(gain(e), 12), -e))
        assert abs(got[0].limit - (best + 1) * url_filter.BIN) < 1e-9
    else:
        assert got[0].limit == 0.0


def test_pages_without_a_model(spark):
    frame = spark.createDataFrame([(1, "http://a.org/x"), (2, None), (3, "http://b.com/")], "page_id long, url string")
    assert {(r.page_id, r.verdict, r.score) for r in url_filter.judge(frame).collect()} == {(i, "allow", None) for i in (1, 2, 3)}
    assert url_filter.judge(frame.limit(0)).count() == 0


@pytest.mark.parametrize("word, url", [("allow", "http://a.com/{}"), ("block", "http://a.net/es/{}")])
def test_pages_ruled_one_way_only(spark, word, url):
    urls = [url.format(i) for i in range(40)]
    assert {rule_of(*host_path(u))[1] for u in urls} == {word}
    assert any(zlib.crc32(u.encode()) % url_filter.FOLDS == 0 for u in urls)
    frame = spark.createDataFrame([*enumerate(urls), (40, "http://b.org/x")], "page_id long, url string")
    got = {r.page_id: (r.verdict, r.score, r.limit) for r in url_filter.judge(frame).collect()}
    assert got == {**{i: (word, None, 0.0) for i in range(40)}, 40: ("allow", None, 0.0)}


# --- sharding


def check_shards(rows, got, shards=16):
    assert len(got) == len(rows)
    for shard in range(shards):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    texts = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert texts == collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got)


def test_sharding_of_odd_rows(spark):
    rows = [(i, "x" * (i % 50), i) for i in range(500)] + [(7, "xxxxxxx", 7), (None, None, 0), (9, "é" * 3, 1), (10, None, 2)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string, shard long")).collect()
    check_shards(rows, got)
    assert len({(r.text_crc32, r.shard) for r in got}) == len({r.text_crc32 for r in got})


def test_a_hot_group_is_split_only_beyond_a_share(spark):
    rows = [(i, "hot text here", 0) for i in range(1000)] + [(i, f"cold text {i:05d}", 0) for i in range(1000, 3000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string, n long")).collect()
    check_shards(rows, got)
    sizes = collections.Counter(r.shard for r in got)
    assert max(sizes.values()) < 1.1 * min(sizes.values())
    totals = collections.Counter()
    for r in got:
        totals[r.shard] += r["size"]
    assert max(totals.values()) < 1.1 * min(totals.values())


def test_sharding_of_no_rows_and_packing(spark):
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    sizes = np.random.default_rng(1).lognormal(0, 1, (4000, 3))
    loads = np.zeros((16, 3))
    np.add.at(loads, sharding.pack(sizes), sizes)
    assert (loads.max(axis=0) < 1.01 * loads.min(axis=0)).all()
    assert sharding.pack(np.zeros((0, 3))).size == 0


# --- registered queries


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in pathlib.Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    assert [n.split("_")[0] for n in llm.QUERIES if n.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    assert {n for n in llm.QUERIES if not n.startswith("op")} == set(parts.ORACLES)
    assert {*llm.QUERIES, "pipeline"} <= set(queries())
    assert set(llm.ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(llm.ORACLES))
def test_query_equals_its_twin(spark, duck, name):
    cursor = duck.execute(llm.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    got = llm.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(cursor.fetchall())


NATIVE = ("op1_exact_dedup", "op3_url_filter", "op7_decontamination")


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, name):
    plan = llm.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_secret_query_digests(spark, texts):
    for r in llm.op2_secret_scan(spark, SMALL).collect():
        text = texts[r.doc_id] or ""
        base = [(m.start(), 0, m.end()) for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 8]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        named = [f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(base)]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r.spans.split(",")) | {""}
        assert r.n_assign + r.n_access + r.n_hex == len(base)


def test_simhash_query(spark, texts):
    got = llm.op9_simhash_near_dedup(spark, SMALL).collect()
    own = {i: simhash.fingerprint((t or "").encode()) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{f:016x}" for i, f in own.items()}
    label = {i: i for i in own}
    for a in own:
        for b in own:
            if label[a] != label[b] and bin(own[a] ^ own[b]).count("1") <= 4:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    assert {r.doc_id: r.component_id for r in got} == label


def test_sharding_query(spark, texts):
    got = llm.op6_sharding(spark, SMALL).collect()
    check_shards(list(texts.items()), got)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_other_queries_return_every_row(spark, texts):
    for name in ("op4_language_id", "op5_lm_scoring", "op8_sentencepiece", "op10_token_counts"):
        rows = llm.QUERIES[name](spark, SMALL).collect()
        assert sorted(r.doc_id for r in rows) == sorted(texts), name
        if name == "op8_sentencepiece":
            assert all(r.round_trip for r in rows)


# --- pipeline


def test_pipeline_equals_its_operators_by_brute_force(spark, texts):
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sure = corpus_pipeline.known_language(spark, docs, SMALL)
    assert sure.columns == docs.columns
    left = {r.doc_id: r.text for r in sure.collect()}
    first = {}
    for i in sorted(left):
        first.setdefault(left[i], i)
    left = {i: left[i] for i in first.values()}
    own = {i: simhash.fingerprint(t.encode()) for i, t in left.items()}
    label = {i: i for i in own}
    for a in own:
        for b in own:
            if label[a] != label[b] and bin(own[a] ^ own[b]).count("1") <= 4:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    left = {i: t for i, t in left.items() if label[i] == i}
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {i for i, _, n, _ in brute_hits(left.items(), items) if n == 0}
    assert set(got) == clean
    assert all(r.round_trip and r.n_pieces == len(r.pieces) for r in got.values())


def test_stages_on_odd_and_no_rows(spark):
    rows = [
        (1, None, "en", "s", 0),
        (2, "", "en", None, 0),
        (3, "12 34", None, "s", 5),
        (None, "the and of the and words here", "en", "s", 1),
        (4, "the and of the and words here", "en", "s", 1),
        (5, "la el de los que y en un " * 20, "es", "s", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        columns = frame.columns
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SMALL)
            assert name == "sentencepiece" or frame.columns == columns
        assert {r.doc_id for r in frame.select("doc_id").where(F.col("doc_id").isNotNull()).collect()} <= {4, 5}
