"""Tables of many rows are joined, sorted and written slice by slice, and shuffle files go with the write."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimsmith.operators import keys as K
from claimsmith.plans.catalog import QUERIES
from claimsmith.sources.io import materialize
from tests.conftest import SF_SMALL


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.length()) if files.apply(i).getName().startswith("shuffle_")}


def rows_of(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("kind", ["string", "int"])
def test_sliced_keys_equal_those_of_one_sort(spark, monkeypatch, kind):
    """Null keys, a key of a third of all rows, and rows that are copies."""
    number = F.col("id") % 700
    df = spark.range(3000).select(
        F.when(number % 50 == 0, F.lit(None)).when(number % 3 == 0, 77).otherwise(number).cast(kind).alias("k"),
        (F.col("id") % 4).alias("v"))
    want = rows_of(K.add_surrogate_key(df, "sk", ["k"]))
    monkeypatch.setattr(K, "SLICE_ROWS", 400)
    bounds = K.slice_bounds(df.select("k"))
    assert len(bounds) >= 4
    written = []
    ordered = K._write_ordered
    monkeypatch.setattr(K, "_write_ordered", lambda own, *a: written.append(own.count()) or ordered(own, *a))
    got = K.add_surrogate_key(df, "sk", ["k"], bounds=bounds)
    assert rows_of(got) == want and got.cs_row_count == 3000
    assert len(written) == len(bounds) + 1 and sum(written) == 3000 and max(written) < 1800


def test_bounds_of_small_empty_and_null_keys(spark, monkeypatch):
    assert K.slice_bounds(spark.range(100).select("id")) == []
    monkeypatch.setattr(K, "SLICE_ROWS", 10)
    assert K.slice_bounds(spark.range(0).select("id")) == []
    nulls = spark.range(100).select(F.lit(None).cast("string").alias("k"))
    assert K.slice_bounds(nulls) == []
    assert sorted(r.sk for r in K.add_surrogate_key(nulls, "sk", ["k"], bounds=["a"]).collect()) == list(range(1, 101))


def test_slices_hold_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(K, "SLICE_ROWS", 100)
    df = spark.range(1000).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("k"))
    for slices in (K.hash_slices("k", 1000), K.range_slices("k", K.slice_bounds(df))):
        assert len(slices) == 10
        assert [r.n for r in df.select(sum(F.coalesce(c, F.lit(False)).cast("int") for c in slices).alias("n")).distinct().collect()] == [1]
        assert rows_of(materialize(df, "test", slices)) == rows_of(df)


def test_shuffle_files_go_with_the_write(spark):
    before, conf = shuffle_files(spark), spark.conf.get(K._FREED, None)
    df = spark.range(5000).groupBy((F.col("id") % 91).alias("k")).count()
    keyed, table = K.add_surrogate_key(df, "sk", ["k"], num_partitions=5), materialize(df, "test")
    left = {f.split("_")[1] for f in shuffle_files(spark) - before}
    assert len(left) <= 1  # that of the rows per partition, a small frame's
    assert spark.conf.get(K._FREED, None) == conf
    assert sorted(r.sk for r in keyed.collect()) == list(range(1, 92)) and table.count() == 91


def test_freed_blocks_may_overlap(spark):
    conf = spark.conf.get(K._FREED, None)
    first, second = K.shuffles_freed(spark), K.shuffles_freed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(K._FREED) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(K._FREED, None) == conf


@pytest.mark.parametrize("name", ["b6_fact_claims", "q1_q7_python_checks_broken", "q8_q12_sql_checks_broken",
                                  "x2_patient_journey"])
def test_queries_give_the_same_rows_in_slices(spark, monkeypatch, name):
    want = rows_of(QUERIES[name](spark, SF_SMALL))
    monkeypatch.setattr(K, "SLICE_ROWS", 2000)
    written = []
    for f in ("range_slices", "hash_slices"):
        monkeypatch.setattr(K, f, lambda *a, own=getattr(K, f): written.append(len(x := own(*a))) or x)
    got = QUERIES[name](spark, SF_SMALL)
    assert rows_of(got) == want
    if name != "x2_patient_journey":
        assert max(written) >= 3
