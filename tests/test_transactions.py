"""Transaction sets against plain sets of numbers."""

import random

import pytest

from rowtide.operators import transactions


def spans(numbers):
    out = []
    for n in sorted(numbers):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return sorted(map(tuple, out))


def ranges_of(df, server="a"):
    return sorted((r["first"], r["last"]) for r in df.collect() if r.server == server)


def seen(spark, ids):
    return transactions.transaction_set(spark.createDataFrame([(i,) for i in ids], "source_gtid string"))


# Numbers about the edges of blocks and parts.
EDGES = [*range(65_530, 65_545), *range(131_060, 131_080), *range(2**32 - 5, 2**32 + 5), *range(1, 9)]


def test_sets_equal_plain_sets(spark):
    rng = random.Random(4)
    for size in (5, 30, len(EDGES)):
        a, b = set(rng.sample(EDGES, size)), set(rng.sample(EDGES, size // 2))
        left = seen(spark, [*(f"a:{n}" for n in a), *(f"a:{n}" for n in a), *(f"other:{n}" for n in b)])
        assert ranges_of(left) == spans(a) and ranges_of(left, "other") == spans(b)
        gone = transactions.missing_transactions(left, seen(spark, [f"a:{n}" for n in b]))
        assert ranges_of(gone) == spans(a - b) and ranges_of(gone, "other") == spans(b)


def test_wide_ranges_over_many_blocks(spark):
    executed = transactions.parse_set(spark, "a:1-300000:200000-400000:900000,b:tag:3-4")
    present = transactions.parse_set(spark, " a:5-7:65536-131071:\n399999 ")
    got = transactions.missing_transactions(executed, present)
    assert ranges_of(got) == [(1, 4), (8, 65_535), (131_072, 399_998), (400_000, 400_000), (900_000, 900_000)]
    assert ranges_of(got, "b:tag") == [(3, 4)]
    assert transactions.missing_transactions(executed, executed).count() == 0


def test_odd_identifiers_and_empty_sets(spark):
    odd = [None, "", "a", "a:", "a:x", ":4", "a:1-5", "a:99999999999999999999", " a:tag:7 ", "a:007"]
    assert sorted(map(tuple, seen(spark, odd).collect())) == [("a", 7, 7), ("a:tag", 7, 7)]
    none = transactions.parse_set(spark, "")
    assert transactions.missing_transactions(none, none).count() == 0 and seen(spark, []).count() == 0
    with pytest.raises(Exception, match="ends before"):
        transactions.missing_transactions(transactions.parse_set(spark, "a:5-3"), none).collect()
