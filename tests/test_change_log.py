"""The replica as a change log: batches write what they hold, compaction keeps the table."""

from pathlib import Path

from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.streaming.keyed import KeyedReplica

NAME = StructType([StructField("id", LongType()), StructField("v", StringType())])


def replica(spark, root):
    return KeyedReplica(spark, root, NAME, "id", order=("pos",), order_types={"pos": LongType()}, buckets=2)


def change(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, v string, op string, pos long")


def bytes_of(root, batch):
    folder = Path(f"{root}/table/changes/batch={batch}".removeprefix("file:"))
    return sum(p.stat().st_size for p in folder.glob("*.parquet"))


def state(rep):
    return sorted(map(tuple, rep.current().collect()))


def test_a_batch_writes_its_rows_and_not_the_state(spark, scratch):
    root = scratch("log")
    rep = replica(spark, root)
    rep.initialize(spark.range(50_000).selectExpr("id", "concat('v', id) v", "'r' op", "-1L pos"))
    rep.process(change(spark, (3, "x", "u", 1)), 0)
    assert bytes_of(root, 0) < bytes_of(root, -1) / 50
    assert rep.current().count() == 50_000
    assert rep.current().where("id = 3").first()["v"] == "x"


def test_compaction_keeps_table_and_tombstones(spark, scratch):
    root = scratch("compact")
    rep = replica(spark, root)
    assert state(rep) == []
    rep.process(change(spark, (1, "a", "c", 1), (2, "b", "c", 2), (2, "b2", "u", 3)), 0)
    rep.process(change(spark, (1, None, "d", 5)), 1)
    rep.compact()
    assert state(rep) == [(2, "b2")]
    rep.process(change(spark, (1, "late", "u", 4), (3, "c", "c", 6)), 2)  # older than the delete
    rep.process(change(spark, (1, "late", "u", 4), (3, "c", "c", 6)), 2)  # replay
    assert state(rep) == [(2, "b2"), (3, "c")]
    rep.compact()
    rep.compact()
    assert state(rep) == [(2, "b2"), (3, "c")]
    assert rep.table._done("changes", "batch") == [2] and rep.table._done("base", "upto") == [1, 2]


def test_an_unfinished_batch_is_not_seen(spark, scratch):
    root = scratch("broken")
    rep = replica(spark, root)
    rep.process(change(spark, (1, "a", "c", 1)), 0)
    rep.process(change(spark, (1, "b", "u", 2)), 1)
    Path(f"{root}/table/changes/batch=1/_SUCCESS".removeprefix("file:")).unlink()
    assert state(rep) == [(1, "a")]
    rep.process(change(spark, (1, "b", "u", 2)), 1)
    assert state(rep) == [(1, "b")]
