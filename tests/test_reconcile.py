"""Two copies compared by digests of buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from bikeflow.operators import quality

SCHEMA = "k bigint, v string, bucket int"


def copies(spark, n=4000):
    a = [(i if i % 50 else None, f"v{i % 700}" if i % 3 else None, i % 2) for i in range(n)]
    b = list(a)
    b[17], b[2000] = (17, "other", 1), b[2001]
    return spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b[:-1] + [b[5]], SCHEMA)


def test_tree_finds_what_the_plain_comparison_finds(spark, rows):
    a, b = copies(spark)
    want = rows(quality.reconcile_rows(a, b))
    assert len(want) >= 5
    for levels in ((4,), (4, 10), (8, 16, 24)):
        assert rows(quality.reconcile_tree(a, b, levels)) == want


def test_only_rows_of_differing_buckets_are_compared(spark):
    a, b = copies(spark)
    top = quality.differing_buckets(a, b, 8).cache()
    assert 1 <= top.count() <= 6
    deep = quality.differing_buckets(a, b, 16, top).cache()
    kept = quality._inside(quality.hashed(a, a.columns), deep).count()
    assert 0 < kept < 12 and {r.bucket >> 8 for r in deep.collect()} == {r.bucket for r in top.collect()}


def test_equal_copies_move_nothing(spark):
    a, _ = copies(spark)
    assert quality.differing_buckets(a, a.repartition(3), 8).count() == 0
    assert quality.reconcile_tree(a, a.orderBy(F.rand(1))).count() == 0
    none = a.limit(0)
    assert quality.reconcile_tree(none, none).count() == 0
    assert quality.reconcile_tree(a.limit(3), none).agg(F.sum("copies")).first()[0] == 3


def test_nulls_count_by_their_place(spark, rows):
    a = spark.createDataFrame([("x", None)], "p string, q string")
    b = spark.createDataFrame([(None, "x")], "p string, q string")
    assert rows(quality.reconcile_tree(a, b), "p", "side") == [("x", "only_a"), (None, "only_b")]
