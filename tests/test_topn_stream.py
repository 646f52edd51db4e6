"""Streamed join and top-N equal a recompute after every batch, with restarts, replays and crashes."""

import random
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from model import joined, random_changes, top_n
from tidemark.operators.changelog import current_state
from tidemark.operators.join import join_by_key
from tidemark.operators.rank import top_n_per_group
from tidemark.streaming.jobs import batch_seconds, run_until_done
from tidemark.streaming.join import KeyedJoin, Side
from tidemark.streaming.topn import Ranges, TopN, rank_key

SCHEMA = StructType([StructField("side", StringType()), StructField("id", LongType()),
                     StructField("op", StringType()), StructField("gender", StringType()),
                     StructField("name", StringType()), StructField("score", DoubleType()),
                     StructField("ts", LongType()), StructField("pos", LongType())])
SIDES = [Side("t1", ("gender",)), Side("t2", ("name",)), Side("t3", ("score",))]
ROW, TOP = ["id", "name", "gender", "score"], ["id", "name", "gender", "score", "rn"]


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: r[0])


class Jobs:
    """Both jobs over a feed folder that grows; each `run` starts them again from their checkpoints."""

    def __init__(self, spark, root, shards=3, sink=None, size=4):
        self.spark, self.root, self.n = spark, root, 0
        self.join = KeyedJoin(spark, f"{root}/state", SIDES, SCHEMA)
        self.top = TopN(spark, f"{root}/state", self.join.row_schema, n=2, shards=shards, external_sink=sink, size=size)

    def feed(self, changes):
        (self.spark.createDataFrame(changes, SCHEMA).coalesce(1).write.parquet(f"{self.root}/feed/part={self.n}"))
        self.n += 1

    def run_join(self):
        stream = self.spark.readStream.schema(StructType([*SCHEMA.fields, StructField("part", LongType())]))
        q = self.join.start([stream.parquet(f"{self.root}/feed").drop("part")], f"{self.root}/ck-join", partitions=2, available_now=True)
        run_until_done(q)
        return q

    def run_top(self):
        q = self.top.start(self.join.updates(), f"{self.root}/ck-top", partitions=2, available_now=True)
        run_until_done(q)
        return q

    def check(self, seen):
        assert _rows(self.join.current(), ROW) == sorted(joined(seen))
        assert _rows(self.top.top(), TOP) == top_n(joined(seen))


def test_incremental_equals_recompute(spark, scratch):
    changes = random_changes(11, n=240, ids=30)
    jobs, cuts = Jobs(spark, scratch("topn")), [0, 60, 61, 160, 240]
    for lo, hi in zip(cuts, cuts[1:]):
        jobs.feed(changes[lo:hi])
        jobs.run_join()
        assert batch_seconds(jobs.run_top())
        jobs.check(changes[:hi])
    shards = {r[0].split(":")[0] for r in jobs.top.table.read().where("size(best) > 0 and slot like '%:va'").select("slot").collect()}
    assert len(shards) == 3  # one group, all shards


def test_late_and_repeated_changes(spark, scratch):
    """Batches in another order than the changes, and one of them twice, end in the same state."""
    changes = random_changes(13, n=180, ids=20)
    jobs = Jobs(spark, scratch("late"))
    for lo, hi in [(120, 180), (0, 60), (60, 120), (0, 60)]:
        jobs.feed(changes[lo:hi])
    jobs.run_join()
    jobs.run_top()
    jobs.check(changes)


@pytest.mark.parametrize("step", ["join", "top"])
def test_crash_after_a_write_then_replay(spark, scratch, step):
    changes = random_changes(21, n=150, ids=20)
    jobs = Jobs(spark, scratch(f"crash_{step}"))
    crashed = []

    def fault(at, k):
        if k == 1 and not crashed:
            crashed.append(k)
            raise RuntimeError("crash")

    (jobs.join if step == "join" else jobs.top).fault = fault
    for lo, hi in [(0, 50), (50, 100), (100, 150)]:
        jobs.feed(changes[lo:hi])
        for run in (jobs.run_join, jobs.run_top):
            try:
                run()
            except StreamingQueryException:
                run()  # Spark replays the batch from its checkpoint
    assert crashed
    jobs.check(changes)


def test_external_sink_receives_exact_changes(spark, scratch):
    """Applying the per-batch diffs (upsert / delete by id) to an empty table gives the top-N table."""
    changes = random_changes(41, n=200, ids=25)
    applied = {}

    def sink(diff, batch_id):
        for r in diff.collect():          # test-only: the diff of a tiny fixture
            if r.op == "d":
                applied.pop(r.id, None)
            else:
                applied[r.id] = tuple(r[c] for c in TOP)

    jobs = Jobs(spark, scratch("sink"), sink=sink)
    for lo, hi in [(0, 70), (70, 140), (140, 200)]:
        jobs.feed(changes[lo:hi])
        jobs.run_join()
        jobs.run_top()
        assert sorted(applied.values()) == top_n(joined(changes[:hi]))


def test_a_join_batch_writes_what_it_touches(spark, scratch):
    root = scratch("bytes")
    jobs = Jobs(spark, root)
    jobs.feed([(s, i, "r", "a", "n", 1.0, 0, i) for i in range(20_000) for s in ("t1", "t2", "t3")])
    jobs.feed([("t3", 7, "u", None, None, 2.0, 1, 1)])
    jobs.run_join()
    jobs.feed([("t3", 8, "u", None, None, 3.0, 1, 2)])
    jobs.run_join()
    size = [sum(p.stat().st_size for p in Path(f"{root}/state/joined/changes/batch={k}".removeprefix("file:")).glob("*.parquet")) for k in (0, 1)]
    assert size[1] < size[0] / 50
    got = {r["id"]: r["score"] for r in jobs.join.current().where("id in (7, 8, 9)").collect()}
    assert got == {7: 2.0, 8: 3.0, 9: 1.0}


def test_batch_operators_agree_with_model(spark):
    changes = random_changes(31, n=200, ids=25)
    df = spark.createDataFrame(changes, SCHEMA)
    states = []
    for side, col in [("t1", "gender"), ("t2", "name"), ("t3", "score")]:
        states.append(current_state(df.where(F.col("side") == side), "id", ("ts", "pos"), value_cols=[col]))
    j = join_by_key(*states).select("id", "name", "gender", "score")
    assert _rows(j, ROW) == sorted(joined(changes))
    t = top_n_per_group(j, "gender", "score", 2)
    assert _rows(t, TOP) == top_n(joined(changes))


class FakeMap:
    """A map state that counts what is read."""

    def __init__(self):
        self.held, self.reads = {}, 0

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        self.reads += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]


def test_updates_reach_the_shards_in_blocks(spark, scratch):
    job = TopN(spark, scratch("blocks"), StructType([SCHEMA[c] for c in ROW]), shards=3)
    updates = StructType([*job.schema.fields, StructField("live", BooleanType()), StructField("ver", LongType())])
    folder = scratch("updates")
    spark.createDataFrame([(1, "a", "g", 1.0, True, 1)], "id long, name string, gender string, score double, live boolean, ver long").write.parquet(folder)
    plan = job.shard_best(spark.readStream.schema(updates).parquet(folder))._jdf.queryExecution().analyzed().toString()
    assert "block" in plan and "MapInArrow" in plan


def test_ranges_follow_a_sorted_list():
    rng, ranges, slices, model = random.Random(4), FakeMap(), FakeMap(), []
    for _ in range(60):
        held = Ranges(ranges, slices, 3)
        for _ in range(rng.randrange(12)):
            if model and rng.random() < 0.45:
                held.remove("g", model.pop(rng.randrange(len(model))))
            else:
                entry = (rng.choice([None, float("inf"), -1.5, 2.0, rng.random(), rng.randrange(5)]), rng.randrange(1000))
                if entry not in model:
                    model.append(entry)
                    held.add("g", entry)
        held.flush()
        held = Ranges(ranges, slices, 3)
        assert held.best("g", 5) == sorted(model, key=rank_key)[:5]
        assert held.best("none", 5) == []
    assert rank_key((float("nan"), 1)) < rank_key((float("inf"), 0)) < rank_key((0, 0)) < rank_key((0, 1)) < rank_key((None, 0))


def test_promotion_reads_the_next_slice_only():
    ranges, slices = FakeMap(), FakeMap()
    held = Ranges(ranges, slices, 32)
    for i in range(20_000):
        held.add("g", (i, i))
    held.flush()
    slices.reads = 0
    held = Ranges(ranges, slices, 32)
    for i in range(19_999, 19_899, -1):
        held.remove("g", (i, i))
    assert held.best("g", 3) == [(19_899, 19_899), (19_898, 19_898), (19_897, 19_897)]
    assert slices.reads <= 8 < len(slices.held) / 20
