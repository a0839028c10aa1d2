"""The broadcast filter of keys."""

import pytest
from pyspark.sql import functions as F

from worklink.operators.keyfilter import KeyFilter


@pytest.mark.parametrize("n_keys", [0, 1, 5_000])
def test_no_key_is_missed_and_few_others_pass(spark, n_keys):
    keys = spark.range(n_keys).select((F.col("id") * 7).alias("k"), F.concat(F.lit("t"), "id").alias("t"))
    filt = KeyFilter.of(keys, ["k", "t"], n_keys)
    rows = spark.range(20_000).select((F.col("id") * 7).alias("a"), F.concat(F.lit("t"), "id").alias("b"))
    marked = filt.mark(rows, [F.col("a"), F.col("b")], "may")
    assert marked.columns == ["a", "b", "may"]
    got = {r.a // 7: r.may for r in marked.collect()}
    assert len(got) == 20_000 and all(got[i] for i in range(n_keys))
    assert sum(got.values()) - n_keys <= 0.1 * (20_000 - n_keys)


def test_a_filter_that_is_too_small_lets_more_through(spark):
    keys = spark.range(100_000).select("id")
    filt = KeyFilter.of(keys, ["id"], 100_000, most_bits=1 << 15)
    assert filt.size == 1 << 15
    assert filt.mark(keys, [F.col("id")], "may").filter("may").count() == 100_000
