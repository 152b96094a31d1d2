"""Exact dedup, SimHash near-dedup and components against brute force; odd rows."""

import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash

from rowtide.llm import common, exact_dedup, graph, simhash

ODD = [
    (1, "same text here again", "x"),
    (2, None, None),
    (3, "", "y"),
    (4, "same text here again", None),
    (None, "same text here again", "z"),
    (5, "Same text here again", "x"),
    (6, "  \t\n", "x"),
    (7, "wörld " * 5000, "x"),
    (7, "wörld " * 5000, "x"),
    (8, "a" * 100_000, "x"),
]
SCHEMA = "doc_id long, text string, _text string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def groups(rows, keep):
    by = {}
    for i, t, _ in rows:
        by.setdefault(t or "", []).append(i)
    pick = max if keep == "largest" else min
    return {t: (pick([i for i in ids if i is not None]), len(ids)) for t, ids in by.items()}


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_duplicate_groups_of_odd_rows(odd, keep):
    want = groups(ODD, keep)
    got = exact_dedup.duplicate_groups(odd, keep=keep).collect()
    assert len(got) == len(ODD)
    texts = {hashlib.sha256(t.encode()).hexdigest(): t for t in want}
    kept = [texts[r.text_sha256] for r in got if r.kept]
    assert sorted(kept) == sorted(want)
    for r in got:
        assert (r.keep_id, r.group_size) == want[texts[r.text_sha256]]
        assert not r.kept or r.doc_id == r.keep_id


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_hot_and_cold_texts_give_the_same(spark, keep):
    draw = random.Random(3)
    rows = [(i, draw.choice(["hot"] * 30 + [f"t{k}" for k in range(40)]), "c") for i in range(600)]
    rows += [(600, None, None), (None, "hot", None), (599, "hot", "again"), (599, "hot", "again")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert exact_dedup._hot_hashes(exact_dedup._texts(docs, "doc_id", "text", None).selectExpr("xxhash64(_text) AS _hash"))
    want = groups(rows, keep)
    got = exact_dedup.duplicate_groups(docs, keep=keep).collect()
    assert len(got) == len(rows)
    texts = {hashlib.sha256(t.encode()).hexdigest(): t for t in want}
    assert all((r.keep_id, r.group_size) == want[texts[r.text_sha256]] for r in got)
    assert sorted(texts[r.text_sha256] for r in got if r.kept) == sorted(want)
    left = exact_dedup.drop_duplicates(docs, keep=keep)
    assert left.columns == docs.columns
    assert sorted((r.text or "", r.doc_id) for r in left.collect()) == sorted((t, i) for t, (i, _) in want.items())


def test_normalised_texts_and_no_rows(spark, odd):
    from pyspark.sql import functions as F

    got = exact_dedup.duplicate_groups(odd, normalise=F.lower).where("doc_id = 5").first()
    assert (got.keep_id, got.group_size) == (1, 4)
    none = odd.limit(0)
    assert exact_dedup.duplicate_groups(none).count() == 0
    assert exact_dedup.drop_duplicates(none).columns == odd.columns


def test_exact_dedup_has_no_python_in_its_plan(odd):
    for df in (exact_dedup.duplicate_groups(odd.selectExpr("*")), exact_dedup.drop_duplicates(odd)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def slow_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    texts = ["", " \n", None, "one", "a b c", "a b c d", "A b\tC d e", "É é É", "x y " * 400]
    monkeypatch.setattr(simhash, "BLOCK", 7)
    for t, size in itertools.product(texts, (1, 4, 9, 1 << 22)):
        monkeypatch.setattr(common, "TEXT_PART", size)
        assert simhash.fingerprint(None if t is None else t.encode()) == slow_fingerprint(t)


def brute_components(values, bits=4):
    label = {v: v for v in values}
    for a in values:
        for b in values:
            if bin(a ^ b).count("1") <= bits and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    return label


@pytest.mark.parametrize("limit", [3, 40, 512])
def test_links_connect_what_brute_force_connects(spark, limit):
    draw = random.Random(limit)
    values = set()
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(40):
            v = centre
            for _ in range(draw.randint(0, 7)):
                v ^= 1 << draw.randrange(64)
            values.add(v)
    values |= {0, (1 << 64) - 1, 1 << 63}
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    edges = simhash.links(frame, limit=limit).collect()
    mask = (1 << 64) - 1
    own = {v: v for v in values}
    for e in edges:
        a, b = own[e.u & mask], own[e.v & mask]
        own = {k: min(a, b) if v in (a, b) else v for k, v in own.items()}
    assert own == brute_components(sorted(values))


def test_a_tight_ball_gives_few_edges(spark):
    base = 0x1234567890ABCDEF
    values = {base} | {base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(64)}
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    edges = simhash.links(frame, limit=100)
    assert edges.count() < 200 * len(values)
    assert graph.components(edges).select("root").distinct().count() == 1


def test_near_duplicates_of_odd_rows(spark, odd):
    got = {}
    for r in simhash.near_duplicates(odd).collect():
        got.setdefault(r.component_id, []).append(r.doc_id)
    blank = [2, 3, 6]
    assert sorted(got[2]) == blank
    assert sorted(got[1], key=str) == [1, 4, 5, None]
    assert got[7] == [7, 7] and got[8] == [8]
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == [1, 2, 7, 7, 8, None]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(odd.limit(0)).count() == 0


def test_bits_beyond_the_guarantee_are_refused(odd):
    with pytest.raises(ValueError):
        simhash.near_duplicates(odd, max_bits=5)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    edges = [*chain, *star, (7, 7), (None, 5), (2000, 1999), (1999, 2000)]
    found = dict(tuple(r) for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert {found.get(i, i) for i in range(41)} == {0}
    assert {found.get(1000 + i, 1000 + i) for i in range(200)} == {1000}
    assert found[2000] == 1999


def test_merge_matches_a_simple_union():
    draw = np.random.default_rng(1)
    labels = np.arange(50)
    a, b = draw.integers(0, 50, 30), draw.integers(0, 50, 30)
    simhash._merge(labels, a, b)
    want = list(range(50))
    for x, y in zip(a.tolist(), b.tolist()):
        low, high = sorted((want[x], want[y]))
        want = [low if w == high else w for w in want]
    assert labels.tolist() == want
