import pytest
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.catalog.batch import text_in_order
from tidemill.session import new_folder, scratch, shared_root, stage
from tidemill.sinks import batches
from tidemill.sinks.keyed_table import KeyedTable
from tidemill.sinks.text import cached, write_sorted_text


def test_sorted_text_is_in_order_across_files(spark, tmp_path):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("n")).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted_text(df, f"{tmp_path}/out", ["n"], F.col("n").cast("string"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len(files) > 1
    written = [line for f in files for line in f.read_text().split()]
    assert written == [str(n) for n in range(5000)]
    numbered = {r.place: r.line for r in text_in_order(spark, f"{tmp_path}/out").collect()}
    assert numbered == {n + 1: str(n) for n in range(5000)}


def test_cached_is_released(spark):
    with cached(spark.range(5)) as kept:
        assert kept.count() == 5 and kept.storageLevel.useMemory and kept.storageLevel.useDisk
    assert not kept.storageLevel.useMemory


def batch(spark, *clicks):
    return spark.createDataFrame(list(clicks), "uid string, click_count bigint")


def totals(spark, folder):
    return {r.key: r.total for r in batches.read_totals(spark, folder, schemas.COUNTS).collect()}


def test_replayed_batches_do_not_count_twice(spark, tmp_path):
    add = batches.increment_writer(str(tmp_path), "uid", "click_count")
    add(batch(spark, ("u1", 5), ("u2", 1)), 0)
    for _ in range(2):
        add(batch(spark, ("u1", 2)), 1)
    add(batch(spark, ("u2", 4)), 2)
    assert totals(spark, str(tmp_path)) == {"u1": 7, "u2": 5}


def test_compaction_keeps_totals(spark, tmp_path):
    folder = str(tmp_path)
    add = batches.increment_writer(folder, "uid", "click_count")
    add(batch(spark, ("u1", 5), ("u2", 1)), 0)
    add(batch(spark, ("u1", 2)), 1)
    assert batches.compact_totals(spark, folder, schemas.COUNTS) == 1
    assert totals(spark, folder) == {"u1": 7, "u2": 1}
    assert batches.compact_totals(spark, folder, schemas.COUNTS) == 1
    add(batch(spark, ("u2", 4)), 2)
    assert totals(spark, folder) == {"u1": 7, "u2": 5}
    assert batches.compact_totals(spark, folder, schemas.COUNTS) == 2
    assert totals(spark, folder) == {"u1": 7, "u2": 5}


def test_compaction_that_fails_half_way_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    batches.increment_writer(folder, "uid", "click_count")(batch(spark, ("u1", 5)), 0)
    # The table is there but its number was never committed.
    batch(spark, ("u1", 99)).toDF("key", "total").write.parquet(f"{folder}/compacted/upto=0")
    assert totals(spark, folder) == {"u1": 5}
    batches.compact_totals(spark, folder, schemas.COUNTS)
    assert totals(spark, folder) == {"u1": 5}


def test_staged_tables_lie_in_the_shared_folder(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    table = stage(df, "numbers", together="k")
    assert rows(table) == rows(df) and table.schema == df.schema
    root = spark.conf.get("spark.checkpoint.dir")
    assert all(root in f for f in table.inputFiles())
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return "file:/warehouse" if key == "spark.sql.warehouse.dir" else default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())
    Context.master = "local[2]"
    Context.setCheckpointDir = lambda self, path: None
    assert shared_root(Session()) == "file:/warehouse/staging"
    Session.conf.get = staticmethod(lambda key, default=None: "hdfs:/shared" if "checkpoint" in key else default)
    Context.master = "yarn"
    assert shared_root(Session()) == "hdfs:/shared"


def keyed(spark, tmp_path, **options):
    return KeyedTable(spark, str(tmp_path / "table"), **options)


def clicks_of(spark, *rows):
    return spark.createDataFrame(list(rows), "key string, total bigint")


def read(table):
    return {r.key: r.total for r in table.read().collect()}


def test_keyed_table_adds_every_batch_once(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=4)
    assert read(table) == {}
    table.add(clicks_of(spark, ("a", 1), ("b", 2), ("a", 3), (None, 4)), 0)
    table.add(clicks_of(spark, ("a", 1), ("b", 2), ("a", 3), (None, 4)), 0)
    table.add(clicks_of(spark, ("b", 5), ("c", 6)), 3)
    table.add(clicks_of(spark, ("b", 5)), 1)  # before the last one: a replay
    table.add(clicks_of(spark), 4)
    assert read(table) == {"a": 4, "b": 7, None: 4, "c": 6}
    assert table.state().batch_id == 4
    assert [(r.key, r.total) for r in table.lookup("b").collect()] == [("b", 7)]
    assert table.lookup("nobody").count() == 0


def test_batch_rewrites_its_buckets_only(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=16)
    table.add(clicks_of(spark, *[(f"k{i}", 1) for i in range(100)]), 0)
    before = table.state()
    table.add(clicks_of(spark, ("k5", 1)), 1)
    after = table.state()
    assert sum(a != b for a, b in zip(before.buckets, after.buckets)) == 1
    assert read(table)["k5"] == 2 and len(read(table)) == 100


def test_crash_between_write_and_commit_changes_nothing(spark, tmp_path, monkeypatch):
    table = keyed(spark, tmp_path, buckets=4)
    table.add(clicks_of(spark, ("a", 1)), 0)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "_commit", crash)
        with pytest.raises(RuntimeError):
            table.add(clicks_of(spark, ("a", 10), ("z", 1)), 1)
    again = keyed(spark, tmp_path, buckets=4)
    assert read(again) == {"a": 1}
    again.add(clicks_of(spark, ("a", 10), ("z", 1)), 1)
    assert read(again) == {"a": 11, "z": 1}


def test_reader_keeps_its_version_and_old_ones_go(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=2, kept=2)
    table.add(clicks_of(spark, ("a", 1)), 0)
    early, rows = table.state(), table.read()  # planned before the next commit
    table.add(clicks_of(spark, ("a", 1)), 1)
    assert [(r.key, r.total) for r in rows.collect()] == [("a", 1)]
    for batch in range(2, 7):
        table.add(clicks_of(spark, ("a", 1)), batch)
    assert read(table) == {"a": 7}
    assert len(table.states()) == 2 and early.version not in [s.version for s in table.states()]
    held = {p.parent.parent.name for p in (tmp_path / "table" / "data").glob("*/*/part-*")}
    assert held == {f"version={v}" for s in table.states() for v in s.buckets if v >= 0}


def test_keyed_table_as_the_sink_of_a_stream(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=4)
    write = table.writer("uid", "click_count")
    write(batch(spark, ("u1", 5), ("u2", 1)), 0)
    write(batch(spark, ("u1", 7)), 1)
    assert read(table) == {"u1": 12, "u2": 1}


def test_staged_tables_go_with_their_scope(spark):
    def there(df):
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent()
        return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)

    with scratch(spark):
        with scratch(spark):
            inner = stage(spark.range(3), "inner")
            kept = stage(inner, "kept", keep=True)
            files = there(inner)
        assert files and not there(inner) and there(kept) and kept.count() == 3
    assert not there(kept)
    outside = stage(spark.range(2), "outside")
    with scratch(spark):
        final = stage(outside, "final", keep=True)
    assert there(outside) and there(final)


def test_compaction_removes_what_an_earlier_one_has_folded(spark, tmp_path):
    folder = str(tmp_path)
    write = batches.increment_writer(folder, "uid", "click_count")
    for n in range(6):
        write(batch(spark, ("u1", 1), (f"u{n}", 10)), n)
        if n % 2:
            batches.compact_totals(spark, folder, schemas.COUNTS)
            assert totals(spark, folder)["u1"] == n + 1 + 10
    assert sorted(p.name for p in (tmp_path / "batches").iterdir()) == ["batch_id=4", "batch_id=5"]
    assert sorted(p.name for p in (tmp_path / "compacted").iterdir()) == ["upto=3", "upto=5"]
    write(batch(spark, ("u9", 9)), 6)
    assert totals(spark, folder) == {"u1": 16, "u0": 10, "u2": 10, "u3": 10, "u4": 10, "u5": 10, "u9": 9}
