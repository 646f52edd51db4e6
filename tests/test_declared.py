"""SQL inserts into declared tables; inserts' casts; low-water positions."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidemark.sinks.declared import _Upsert, declare
from tidemark.spec import T2, TableSpec, align_to
from tidemark.streaming.keyed import KeyedReplica

NAME = StructType([StructField("id", LongType()), StructField("name", StringType())])


def test_insert_as_text_upserts(spark, scratch):
    t2 = declare(spark, replace(T2, options={"root": scratch("t2")}))
    assert t2.read().count() == 0
    spark.sql("insert into t2 select cast(id as int), concat('a', id) from range(10)")
    spark.sql("insert into t2 select id, 'b' from range(8, 12)")  # bigint into int
    spark.sql("insert into t2 values (9, null)")
    got = {r["id"]: r["name"] for r in t2.read().collect()}
    assert got == {**{i: f"a{i}" for i in range(8)}, 8: "b", 9: None, 10: "b", 11: "b"}
    with pytest.raises(PySparkException):
        spark.sql("insert into t2 select id + 3000000000, 'x' from range(3)")  # fails in its tasks: nothing of it is seen
    assert t2.read().count() == 12
    spark.sql("insert into t2 select cast(id as int), 'x' from range(0)")
    assert t2.read().count() == 12
    with pytest.raises(ValueError, match="root"):
        declare(spark, T2)


def test_an_insert_counts_as_a_whole(spark, scratch):
    import pyarrow as pa
    root = scratch("whole")
    table = declare(spark, TableSpec("whole", NAME, options={"root": root}))
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array(["a", "b"])], ["id", "name"])
    w = _Upsert(root, NAME)
    first, again = w.write(iter([rows])), w.write(iter([rows]))  # a task that ran twice
    assert table.read().count() == 0
    w.commit([first, None])
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b")] and first.name != again.name
    assert len(list(Path(f"{root}/changes/batch={w.batch}".removeprefix("file:")).glob("part-*.parquet"))) == 1
    late = _Upsert(root, NAME)
    late.write(iter([rows]))
    late.abort([])
    assert not Path(f"{root}/changes/batch={late.batch}".removeprefix("file:")).exists()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_do_not_fit_fail(spark, ansi):
    target = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = spark.createDataFrame([(1.9, 5), (-1.9, None), (None, 7)], "x double, y long")
        assert [tuple(r) for r in align_to(good, target).collect()] == [(1, "5"), (-1, None), (None, "7")]
        for bad, kind in ((3e9, "double"), (3_000_000_000, "long"), ("x", "string")):
            with pytest.raises(PySparkException, match="is no int"):
                align_to(spark.createDataFrame([(bad, 1)], f"x {kind}, y long"), target).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_low_water_position_retires_deletes(spark, scratch):
    rep = KeyedReplica(spark, scratch("retire"), NAME, "id", order=("pos",), order_types={"pos": LongType()}, buckets=2)
    change = lambda *rows: spark.createDataFrame(list(rows), "id long, name string, op string, pos long")
    state = lambda: sorted(map(tuple, rep.current().collect()))
    rep.process(change((1, "a", "c", 1), (2, "b", "c", 2), (3, "c", "c", 3)), 0)
    rep.process(change((1, None, "d", 10), (2, None, "d", 20)), 1)
    rep.compact()
    assert rep.table.read().count() == 3  # no position is set: deletes stay
    rep.retire({"p0": (15,), "p1": (40,)})
    rep.process(change((4, "d", "c", 41)), 2)
    rep.compact()
    assert sorted(r["id"] for r in rep.table.read().collect()) == [2, 3, 4]  # the delete at 20 stays, the one at 10 went
    rep.process(change((1, "late", "u", 5), (2, "late", "u", 16)), 3)  # before the position, and before the delete
    assert state() == [(3, "c"), (4, "d")]
    rep.process(change((1, "new", "c", 42)), 4)
    assert state() == [(1, "new"), (3, "c"), (4, "d")]
    with pytest.raises(ValueError, match="already"):
        rep.retire({"p0": (3,)})
