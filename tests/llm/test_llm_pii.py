"""Personal data: fixed patterns against plain regular expressions, contexts against plain loops."""

import collections
import hashlib
import random
import re
import time

import numpy as np
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowtide.llm import pii
from rowtide.llm import queries as llm


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * 2 if i % 2 else int(d)
        total += sum(map(int, str(n)))
    return total % 10 == 0


def plain_base(text):
    out = []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m)) <= 19 and plain_luhn(digits(m)):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1@.- +()09_é%2", max_size=60))
def test_fixed_patterns_on_dense_texts(text):
    assert pii.found_in(text)[0] == plain_base(text)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["a.b+c@x.y.z", "x@y@z.w", "a@b.c@d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.4", "4111 1111 1111 1111",
             "4111-1111-1111-1111", "4111  1111", "+1 (555) 123-4567", "+49 30 1234567", "+1", " ", "-", ".", "x", "9", "\n", "--", "ü"]
        ),
        max_size=14,
    )
)
def test_fixed_patterns_on_joined_parts(parts):
    text = "".join(parts)
    assert pii.found_in(text)[0] == plain_base(text)


def test_long_texts_take_time_in_proportion():
    long = 1_000_000
    for text in ("a" * long, "a@" * (long // 2), "1." * (long // 2), "1 " * (long // 2), "+1" + " " * long, "7" * long, " at a" * (long // 5),
                 "+" * long, ("9" * 30 + ".") * (long // 31), "x" * long + "@y.z", "1-" * (long // 2) + "a"):
        began = time.time()
        pii.found_in(text)
        assert time.time() - began < 8, text[:20]


def test_look_alikes():
    kinds = lambda text: [(k, text[s:e]) for s, k, e in pii.found_in(text)[1]]
    assert kinds("mail jo.doe at example dot org now") == [(0, "jo.doe at example dot org")]
    assert kinds("jo [at] example.org, bo (at) host, al@host") == [(0, "jo [at] example.org"), (0, "al@host")]
    assert kinds("look at the sea") == []
    assert kinds("tel 0555 123 4567.") == [(3, "0555 123 4567")]
    assert kinds("card 4111 1111 1111 1112!") == [(2, "4111 1111 1111 1112")]
    assert kinds("ip 300.1.2.3") == [(1, "300.1.2.3")]
    assert kinds("id a5551234567 and 5551234567b") == []
    assert kinds("+1 (555) 123-4567 and 1.2.3.4 and a@b.c") == []


def test_context_words():
    text = "Please call my Mobile: +1 555 123 4567"
    assert pii.context(text, text.index("+")) == ["my", "Mobile"]
    assert pii.context("7 +1", 2) == [] and pii.context("word\n+1", 5) == [] and pii.context("+1", 0) == []
    assert pii.context("word" + " " * 20 + "+1", 24) == []
    assert pii.context("x" * 500 + " " + "y" * 300 + " +1", 802) == ["x" * 500, "y" * 300]


def test_pattern_counts_equal_plain_ones(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "Bb", "ünd", "x1y", "9", "call", "me,"]) for _ in range(rng.randint(0, 60))) for _ in range(30)]
    plain = collections.Counter()
    keys = pii.Keys()
    for t in texts:
        words = pii.WORD.findall(t)
        for i in range(len(words)):
            plain.update(pii.pattern_keys(words[max(0, i - 1) : i + 1], keys))
    for part in (1 << 20, 7):
        monkeypatch.setattr(pii, "PART", part)
        wanted = np.sort(np.array(list(plain), np.int64).view(np.uint64))
        got = pii.count_patterns(iter(texts), wanted)
        assert dict(zip(wanted.view(np.int64).tolist(), got.tolist())) == dict(plain)


def plain_trusted(texts, rounds=pii.ROUNDS):
    """The graph's scores in loops: {(kind, instance)} of the trusted candidates."""
    keys, occurs = pii.Keys(), collections.Counter()
    mentions = []
    for t in texts:
        words = pii.WORD.findall(t or "")
        for i in range(len(words)):
            occurs.update(pii.pattern_keys(words[max(0, i - 1) : i + 1], keys))
        mentions += pii.read_text(t, keys)["mentions"]
    weight = collections.defaultdict(float)
    seeds = {(m["kind"], m["instance"]) for m in mentions if m["seed"]}
    for _ in range(rounds):
        r = lambda m: 1.0 if (m["kind"], m["instance"]) in seeds else weight[m["kind"], m["instance"]]
        total, support = collections.Counter(), collections.defaultdict(dict)
        for m in mentions:
            for p in set(m["patterns"]):
                total[m["kind"], p] += r(m)
                support[m["kind"], p][m["instance"]] = r(m)
        share = {kp: t / (occurs[kp[1]] + 1) for kp, t in total.items()}
        good = {kp for kp in share if share[kp] >= pii.LEAST_SHARE and sum(support[kp].values()) >= pii.LEAST_INSTANCES}
        weight = collections.defaultdict(float)
        for m in mentions:
            key = m["kind"], m["instance"]
            if key not in seeds:
                weight[key] = max([weight[key], *[share[m["kind"], p] for p in m["patterns"] if (m["kind"], p) in good]])
    open_ = {(m["kind"], m["instance"]) for m in mentions if not m["seed"]}
    return {k for k in open_ if k in seeds or weight[k]}


def planted(seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice("river stone cloud green table seven apple north light paper".split())
    prose = lambda n: " ".join(word() for _ in range(n))
    phone = lambda: f"+1 555 {rng.randint(100, 999)} {rng.randint(1000, 9999)}"
    texts = [f"{prose(8)} reach Telephone: {phone()} {prose(5)}" for _ in range(12)]
    # Found by the seeds' pattern; their own other pattern is then learnt from them.
    found = [f"0{rng.randint(200, 999)} {rng.randint(100, 999)} {rng.randint(1000, 9999)}" for _ in range(5)]
    texts += [f"{prose(4)} Telephone: {f} {prose(4)}" for f in found]
    texts += [f"{prose(4)} dial hotline {f} {prose(4)}" for f in found]
    second = "0777 123 9876"
    texts.append(f"{prose(3)} hotline {second} {prose(3)}")
    # Numbers in ordinary prose, even where a seed happened to stand.
    texts += [f"{prose(9)} {phone()} {prose(3)}" for _ in range(6)]
    clean = [f"{prose(9)} {rng.randint(10**8, 10**9)} {prose(3)}" for _ in range(6)]
    texts += [f"{prose(5)} write to mail {prose(1)}{i}@post.example.org {prose(2)}" for i in range(5)]
    obscured = "kim (at) post dot example dot org"
    texts.append(f"{prose(5)} write to mail {obscured} {prose(2)}")
    return texts + clean + [None, ""], [*found, second, obscured], clean


def test_contexts_discover_unseen_identifiers(spark):
    texts, wanted, clean = planted()
    rows = list(enumerate(texts))
    got = {r.doc_id: r.spans for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sorted(got) == [i for i, _ in rows]
    hits = [t[s.start : s.end] for i, t in rows for s in got[i] if s.kind == "context"]
    assert set(hits) == set(wanted) and len(hits) == 5 * 2 + 2
    assert not any(s.kind == "context" for i, t in rows if t in clean for s in got[i])
    keys, trusted = pii.Keys(), plain_trusted(texts)
    assert {(m["kind"], m["instance"]) for t in wanted for m in pii.read_text("hotline " + t, keys)["mentions"]} >= trusted
    for i, t in rows:
        base = [(s, pii.KINDS[k], e) for s, k, e in plain_base(t or "")]
        assert [(s.start, s.kind, s.end) for s in got[i] if s.kind != "context"] == base


def test_graph_equals_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(pii, "PASS_PATTERNS", 3)
    rng = random.Random(6)
    seeds, open_ = [f"+1 555 12{i} 45{i}8" for i in range(8)], [f"0555 12{i} 45{i}9" for i in range(8)]
    follows = {"tel": seeds + open_[:4], "fax": open_[:5] + ["none"], "call": open_[4:] + ["none"] * 4, "see": ["none", "no", *seeds[:2]]}
    texts = []
    for _ in range(40):
        heads = [rng.choice(list(follows)) for _ in range(12)]
        texts.append(" ".join(f"{h} {rng.choice(follows[h])}," for h in heads))
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    mentions = docs.select(F.explode(pii._found_column(F.col("text"))["mentions"]).alias("m")).select("m.*")
    got = {(r.kind, r.instance) for r in pii.trusted_instances(docs, F.col("text"), mentions).collect()}
    assert got == plain_trusted(texts) and len(got) == 5
    assert len(plain_trusted(texts, rounds=1)) == 4  # what stands after tel, and then after fax


def test_odd_rows(spark):
    schema = "doc_id long, text string, row long, f string, mentions int"
    rows = [(1, None, 1, "x", 2), (1, "", 1, "x", 2), (None, "a@b.c", 5, None, None), (2, "a@b.c", 5, None, None), (2, "a@b.c", 5, None, None)]
    got = pii.scan(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in got) == [
        ("1", []), ("1", []), ("2", [("email", 0, 5)]), ("2", [("email", 0, 5)]), ("None", [("email", 0, 5)])
    ]
    assert pii.scan(spark.createDataFrame([], schema)).collect() == []


def test_personal_data_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = llm.op11_personal_data(spark, SMALL)
    assert got.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    seen = 0
    for r in got.collect():
        base = plain_base(texts.pop(r.doc_id))
        named = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [sum(k == i for _, k, _ in base) for i in range(4)] == [r.n_email, r.n_ip, r.n_card, r.n_phone]
        assert set(named) <= set(r.spans.split(",")) | {""}
        seen += len(base)
    assert not texts and seen
