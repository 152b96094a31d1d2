"""Key sets as bitmaps against plain sets."""

import random

from rowtide.operators import keysets


def keyed(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k long")


def test_difference_union_and_size_equal_plain_sets(spark):
    rng = random.Random(2)
    edge = [0, 1, -1, 32_767, 32_768, 32_769, -32_767, -32_768, -32_769, 65_536, 65_537, 10**12, -(10**12)]
    for _ in range(3):
        a = set(rng.sample(range(-70_000, 70_000), 400)) | set(rng.sample(edge, 9))
        b = set(rng.sample(sorted(a), 200)) | set(rng.sample(edge, 9)) | {5, 99_999}
        left, right = (keysets.key_set(keyed(spark, [*s, *list(s)[:50], None]), "k") for s in (a, b))
        assert sorted(r.key for r in keysets.difference(left, right).collect()) == sorted(a - b)
        assert sorted(r.key for r in keysets.difference(right, left).collect()) == sorted(b - a)
        assert keysets.size(left).first().n == len(a)
        assert keysets.size(keysets.united(left, right)).first().n == len(a | b)


def test_empty_sets(spark):
    none, some = (keysets.key_set(keyed(spark, k), "k") for k in ([], [3, 4]))
    assert keysets.difference(none, some).count() == 0 and keysets.size(none).first().n == 0
    assert sorted(r.key for r in keysets.difference(some, none).collect()) == [3, 4]


def test_bitmaps_and_not_keys_cross_the_shuffle(spark):
    dense = spark.range(200_000).toDF("k").repartition(4)
    sets = keysets.key_set(dense, "k")
    assert sets.count() == 8  # 200,000 keys, less than 32 kB
    assert keysets.difference(sets, keysets.key_set(dense.where("k <> 77777"), "k")).first().key == 77_777
