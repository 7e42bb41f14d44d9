"""What is gathered from a corpus stays bounded: samples and broadcast words."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clicklens.llm import common, lm


def plain_sample(rows, bound):
    return sorted(r.id for r in rows.orderBy(F.xxhash64("id"), "id").limit(bound).collect())


@pytest.mark.parametrize("bits, bound", [(1, 50), (5, 1), (12, 7), (12, 5000)])
def test_sample_is_the_ordered_take(spark, monkeypatch, bits, bound):
    monkeypatch.setattr(common, "SAMPLE_BITS", bits)
    rows = spark.range(3000)
    assert sorted(r.id for r in common.sampled(rows, bound, F.col("id")).collect()) == plain_sample(
        rows, bound)


def test_sample_orders_few_rows(spark):
    """The rows that reach the ordered take are at most twice the bound, in any partitioning."""
    rows = spark.range(200_000).withColumn("text", F.lit("x" * 10))
    found = []
    for parts in (1, 100):
        taken = common.sampled(rows.repartition(parts), 100, F.col("id"))
        plan = taken._jdf.queryExecution().optimizedPlan().toString()
        bound = int(plan.split("<= ")[1].split(")")[0])
        assert 100 <= rows.where(F.xxhash64("id") <= bound).count() <= 200
        found.append(sorted(r.id for r in taken.collect()))
    assert found[0] == found[1] == plain_sample(rows, 100)


def test_sample_of_equal_and_missing_keys(spark):
    rows = spark.createDataFrame([(None,)] * 300 + [(1,)] * 50 + [(2,)], "id long")
    assert common.sampled(rows, 40, F.col("id")).count() == 40
    assert common.sampled(rows.limit(0), 40, F.col("id")).count() == 0
    assert common.sampled(rows, 1000, F.col("id")).count() == 351


def test_frequent_words(spark):
    table = [(f"w{i}", i // 10) for i in range(1000)] + [("long" * 50, 10**9), ("zero", 0)]
    lexicon = spark.createDataFrame(table, "word string, c long").withColumn("lp", F.lit(0.0))
    for bound in (0, 5, 10, 35, 500, 10_000):
        found = lm.most_frequent(lexicon, bound).toPandas()
        assert len(found) <= bound and found["word"].str.len().max() != 200
        rest = pd.DataFrame([t for t in table if t[0] not in set(found["word"]) and len(t[0]) < 99])
        assert not len(found) or found["c"].min() > rest[1].max()
        assert len(found) >= min(bound, 990) - 20 or bound < 20
