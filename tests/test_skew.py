import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.operators import frequent, skew


@pytest.fixture
def big(spark):
    """Half of the rows have key 'hot', some have none."""
    pick = random.Random(3)
    keys = ["hot"] * 60 + [None] * 10 + [f"k{pick.randrange(20)}" for _ in range(50)]
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, n int")


@pytest.fixture
def small(spark):
    data = [("hot", "a"), ("hot", "b"), ("unused", "c"), (None, "d")]
    data += [(f"k{i}", f"v{i}") for i in range(0, 20, 2)]
    return spark.createDataFrame(data, "key string, v string")


def test_heavy_keys_are_found_with_their_slices(big, rows):
    assert rows(skew.heavy_keys(big, "key", 25)) == [("hot", 3)]
    assert skew.heavy_keys(big, "key", 60).isEmpty()


def test_all_heavy_keys_are_found(spark):
    many = spark.range(12_000).select((F.col("id") % 1_500).alias("key"))
    found = skew.heavy_keys(many, "key", 2)
    assert found.count() == 1_500
    assert found.agg(F.min("_slices")).first()[0] == 4


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_slice", [1, 7, 1000])
def test_sliced_join_equals_plain_join(big, small, rows, how, rows_per_slice):
    joined = skew.skewed_join(big, small, "key", how, rows_per_slice)
    assert joined.columns == ["key", "n", "v"]
    assert rows(joined) == rows(big.join(small, "key", how))


def test_heavy_keys_that_are_not_broadcast_join_alike(big, small, rows, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_KEYS", 0)
    assert rows(skew.skewed_join(big, small, "key", rows_per_slice=1)) == rows(
        big.join(small, "key")
    )


def test_heavy_key_is_spread(spark, big, small):
    heavy = skew.heavy_keys(big, "key", 10)
    spread = skew.with_slices(big, "key", heavy).where(F.col("key") == "hot")
    slices = spread.select(F.pmod(F.xxhash64("key", "n"), "_slices").alias("s"))
    counts = [r["count"] for r in slices.groupBy("s").count().collect()]
    assert len(counts) == 6 and max(counts) < 30


def test_table_without_heavy_keys_needs_no_slices(big):
    assert skew.heavy_in_table(big, "key", 1000) is None
    assert skew.heavy_in_table(big, "key", 100) is None
    assert skew.heavy_in_table(big, "key", 20).count() == 1


def test_other_join_kinds_are_refused(big, small):
    with pytest.raises(ValueError):
        skew.skewed_join(big, small, "key", "full")


def test_lookup_is_the_same_with_and_without_broadcast(big, small, rows):
    assert not skew.fits_broadcast(small, max_rows=3)
    assert not skew.fits_broadcast(small, max_bytes=10)
    assert skew.fits_broadcast(small)
    expected = rows(big.join(small, "key", "left"))
    assert rows(skew.lookup(big, small, "key")) == expected
    assert rows(skew.lookup(big, small, "key", max_rows=3)) == expected
    assert rows(skew.lookup(big, small, "key", costly=True, max_rows=3)) == expected


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_frequent_keys_equal_the_counts(spark, kind):
    pick = random.Random(8)
    keys = [i % 7 for i in range(3_000)] + [10 + pick.randrange(4_000) for _ in range(6_000)] + [5_000] * 400 + [None] * 900
    pick.shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").select(F.col("k").cast(kind).alias("k")).repartition(6)
    for least in (20, 300, 420, 10_000):
        found = frequent.frequent_keys(df, "k", least, len(keys))
        exact = df.where("k is not null").groupBy("k").count().where(f"count > {least}")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.collect()))


def test_counters_stay_few(spark):
    batches = [pa.RecordBatch.from_arrays([pa.array([1] * 300 + list(range(at, at + 700)))], ["k"]) for at in range(0, 70_000, 700)]
    (found,) = list(frequent._summary(0.2)(iter(batches)))
    assert found.column("key").to_pylist() == [1]
    assert found.num_rows < 5


def test_looking_for_heavy_keys_does_not_shuffle_rows_by_key(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).select((F.col("id") % 9_000).alias("k")).union(spark.sql("SELECT explode(repeat_of) FROM (SELECT array_repeat(7L, 3000) AS repeat_of)")).write.parquet(path)
    df = spark.read.parquet(path)
    assert [tuple(r) for r in skew.heavy_in_table(df, "k", 1_000).collect()] == [(7, 4)]
    assert skew.heavy_in_table(df, "k", 10_000) is None
    plan = frequent.frequent_keys(df, "k", 1_000, df.count())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan  # what is grouped are rows of the named keys


def test_counters_are_merged_seldom(monkeypatch):
    """A batch of new keys does not go through all counters again: merges are as many as the rows double."""
    batches = [pa.record_batch({"k": pa.array([f"k{n}" for n in range(at, at + 500)])}) for at in range(0, 20_000, 500)]
    merged, whole = [], pa.concat_tables
    monkeypatch.setattr(frequent, "MERGED_ROWS", 500)
    monkeypatch.setattr(frequent.pa, "concat_tables", lambda tables: merged.append(sum(map(len, tables))) or whole(tables))
    found = list(frequent._summary(1e-5)(iter(batches)))
    assert sum(map(len, found)) == 20_000
    assert 0 < len(merged) < 10 and sum(merged) < 4 * 20_000


def test_keys_above_equal_the_counts(spark, monkeypatch):
    """Also where keys share a bucket, and where a bucket is above the threshold and none of its keys."""
    pick = random.Random(9)
    keys = [i % 7 for i in range(3_000)] + [10 + pick.randrange(4_000) for _ in range(6_000)] + [5_000] * 400 + [None] * 900
    numbers = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(6)
    for kind, fewest in (("bigint", 4_096), ("string", 4_096), ("bigint", 3)):
        monkeypatch.setattr(frequent, "LEAST_BUCKETS", fewest)
        df = numbers.select(F.col("k").cast(kind).alias("k"))
        for least in (20, 300, 420):
            found = frequent.keys_above(df, "k", least, len(keys))
            exact = df.where("k is not null").groupBy("k").count().where(f"count > {least}")
            assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.collect()))
        assert frequent.keys_above(df, "k", 10_000, len(keys)) is None


def test_a_table_without_heavy_keys_is_not_sent_to_python(spark, tmp_path, monkeypatch):
    """Keys are counted by hash bucket where they are read; before, every row went to a Python worker."""
    path = str(tmp_path / "t")
    spark.range(20_000).select((F.col("id") % 9_000).alias("k")).write.parquet(path)
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda *a, **b: pytest.fail("rows sent to Python"))
    assert skew.heavy_in_table(spark.read.parquet(path), "k", 1_000) is None
