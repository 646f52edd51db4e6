"""Changelog operators against a Python model; keyed replica over any batch split."""

import random

import pytest
from pyspark.sql import functions as F

from model import lww
from tidemark.operators.changelog import (apply_changes, changelog_diff, changes_since, current_state,
                                          last_per_key, upsert_by_key)
from tidemark.streaming.keyed import KeyedReplica

SCHEMA = "id long, op string, v string, ts long, pos long"


def _changes(seed, n=300, ids=25):
    rnd = random.Random(seed)
    return [(rnd.randrange(ids), "d" if rnd.random() < 0.2 else rnd.choice("rcu"),
             None if rnd.random() < 0.1 else f"v{rnd.randrange(4)}", p // 4, p) for p in range(n)]


def _model_state(rows):
    st = {}
    for r in sorted(rows, key=lambda r: (r[3], r[4])):
        st[r[0]] = r
    return {i: r[2] for i, r in st.items() if r[1] != "d"}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_current_state_matches_model(spark, seed):
    rows = _changes(seed)
    got = current_state(spark.createDataFrame(rows, SCHEMA), "id", ("ts", "pos"), value_cols=["v"])
    assert {r.id: r.v for r in got.collect()} == _model_state(rows)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    # one key carries a third of all changes
    rows = [(0 if p % 3 == 0 else p, "u", f"v{p}", p, p) for p in range(3000)]
    df = last_per_key(spark.createDataFrame(rows, SCHEMA), "id", ("ts", "pos"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert {r.id: r.v for r in df.collect()}[0] == "v2997"


@pytest.mark.parametrize("seed", [4, 5])
def test_diff_then_apply_gives_new_state(spark, seed):
    rows = _changes(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    old = current_state(df.where("pos < 150"), "id", ("ts", "pos"), value_cols=["v"])
    new = current_state(df, "id", ("ts", "pos"), value_cols=["v"])
    diff = changelog_diff(old, new)
    ops = {r.op for r in diff.collect()}
    assert ops <= {"c", "u", "d"}
    applied = apply_changes(old, diff)
    assert sorted(map(tuple, applied.collect())) == sorted(map(tuple, new.collect()))
    # null-safe compare: an unchanged null value is not a change
    same = changelog_diff(new, new)
    assert same.count() == 0


def test_upsert_by_key_last_source_row_wins(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, name string")
    src = spark.createDataFrame([(2, "x", 5), (2, "y", 9), (4, "z", 1)], "id long, name string, pos long")
    out = upsert_by_key(tgt, src, "id", order=("pos",))
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "y"), (3, "c"), (4, "z")]


@pytest.mark.parametrize("splits", [[300], [1, 150, 299, 300]])
def test_keyed_replica_any_split_and_replay(spark, scratch, splits):
    rows = _changes(7)
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([StructField("id", LongType()), StructField("v", StringType())])
    rep = KeyedReplica(spark, scratch("replica"), schema, "id", order=("ts", "pos"),
                       order_types={"ts": LongType(), "pos": LongType()}, buckets=4)
    lo = 0
    for k, hi in enumerate(splits):
        rep.process(df.where((F.col("pos") >= lo) & (F.col("pos") < hi)), k)
        lo = hi
    want = _model_state(rows)
    assert {r.id: r.v for r in rep.current().collect()} == want
    # replaying the last batch (at-least-once delivery) changes nothing
    last = len(splits) - 1
    rep.process(df.where(F.col("pos") >= (splits[-2] if len(splits) > 1 else 0)), last)
    assert {r.id: r.v for r in rep.current().collect()} == want


def test_keyed_replica_batches_out_of_order(spark, scratch):
    rows = _changes(8)
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([StructField("id", LongType()), StructField("v", StringType())])
    rep = KeyedReplica(spark, scratch("replica_ooo"), schema, "id", order=("ts", "pos"),
                       order_types={"ts": LongType(), "pos": LongType()}, buckets=4)
    # newest changes first: tombstones keep older changes from bringing rows back
    rep.process(df.where("pos >= 200"), 0)
    rep.process(df.where("pos >= 100 and pos < 200"), 1)
    rep.process(df.where("pos < 100"), 2)
    assert {r.id: r.v for r in rep.current().collect()} == _model_state(rows)


def test_lww_model_sanity():
    st = lww([("t1", 1, "u", "a", None, None, 0, 0), ("t1", 1, "u", "b", None, None, 0, 1)])
    assert st["t1"][1][3] == "b"


def test_replica_declared_by_table_spec(spark, scratch):
    """t5 mirrors t1: declared by its TableSpec, fed by a changelog with deletes."""
    from pyspark.sql.types import LongType
    from tidemark.spec import T5
    rep = KeyedReplica.for_spec(spark, T5, scratch("t5"), order=("pos",), order_types={"pos": LongType()},
                                buckets=2)
    ch = spark.createDataFrame([(1, " male", "c", 0), (2, " female", "c", 1), (1, " female", "u", 2),
                                (2, None, "d", 3), (3, " male", "c", 4)], "id int, gender string, op string, pos long")
    rep.process(ch, 0)
    assert sorted(map(tuple, rep.current().collect())) == [(1, " female"), (3, " male")]
    assert rep.current().schema == T5.schema


def test_console_preview_runs(spark):
    from tidemark.streaming.jobs import producer_lines, run_until_done, start_preview
    run_until_done(start_preview(producer_lines(spark, "test2", rows_per_batch=3), rows=3, available_now=True))


def test_envelope_round_trip(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from tidemark.sources.streams import read_changelog, to_envelope
    row = StructType([StructField("id", LongType()), StructField("gender", StringType())])
    flat = spark.createDataFrame(
        [(1, " male", "r", 10, 0), (2, "x", "c", 11, 1), (1, None, "u", 12, 2), (2, "x", "d", 13, 3)],
        "id long, gender string, op string, ts_ms long, pos long")
    env = to_envelope(flat, ["id", "gender"], file=F.lit("binlog.1"))
    raw = {r.value for r in env.collect()}
    assert any('"before":{"id":2' in v and '"after"' not in v for v in raw)   # a delete carries its old image
    back = read_changelog(env, row).orderBy("pos")
    assert [tuple(r) for r in back.collect()] == [
        ("r", 1, " male", 10, "binlog.1", 0), ("c", 2, "x", 11, "binlog.1", 1),
        ("u", 1, None, 12, "binlog.1", 2), ("d", 2, "x", 13, "binlog.1", 3)]


def test_replication_resumes_from_its_checkpoint(spark, scratch):
    """A restarted job continues where its checkpoint stopped: new files only, batch ids go on."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from tidemark.streaming.jobs import replicate, run_until_done
    root = scratch("resume")
    rows = _changes(9, n=240)
    df = spark.createDataFrame(rows, SCHEMA)
    schema = StructType([StructField("id", LongType()), StructField("v", StringType())])
    rep = KeyedReplica(spark, f"{root}/state", schema, "id", order=("ts", "pos"),
                       order_types={"ts": LongType(), "pos": LongType()}, buckets=4)
    seen = []
    orig = rep.process

    def process(batch, batch_id):
        seen.append(batch_id)
        orig(batch, batch_id)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/feed")
        run_until_done(replicate(stream, type("R", (), {"process": staticmethod(process)})(),
                                 f"{root}/checkpoint", available_now=True))

    df.where("pos < 120").repartitionByRange(2, "pos").write.mode("append").parquet(f"{root}/feed")
    run()
    first = list(seen)
    assert {r.id: r.v for r in rep.current().collect()} == _model_state(rows[:120])
    df.where("pos >= 120").repartitionByRange(2, "pos").write.mode("append").parquet(f"{root}/feed")
    run()
    assert seen[len(first):] and min(seen[len(first):]) > max(first)   # batch ids continue
    assert {r.id: r.v for r in rep.current().collect()} == _model_state(rows)


def test_diff_of_two_states_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "feed")
    spark.createDataFrame(_changes(10), SCHEMA).write.parquet(path)
    feed = spark.read.parquet(path)
    old = current_state(feed.where("pos < 150"), "id", ("ts", "pos"), value_cols=["v"])
    new = current_state(feed, "id", ("ts", "pos"), value_cols=["v"])
    out = changes_since(feed, F.col("pos") < 150, value_cols=["v"])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, changelog_diff(old, new).collect()), key=repr)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
