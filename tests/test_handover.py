"""A snapshot in chunks beside a changing source ends in the source's state, whatever the order of the chunks."""

import random

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidemark.sources.handover import ORDER, ChunkedSnapshot, LostChanges, even_bounds, handover
from tidemark.streaming.jobs import replicate, run_until_done
from tidemark.streaming.keyed import KeyedReplica

ROW = StructType([StructField("id", LongType()), StructField("v", StringType())])
CHANGE = StructType([*ROW.fields, StructField("op", StringType()), StructField("pos", LongType())])


class Source:
    """A table and its log: changes at positions 1, 2, ..; reads and looks at the log advance it."""

    def __init__(self, spark, seed, changes=60, ids=12):
        self.spark, self.rng, self.at = spark, random.Random(seed), 0
        self.log = [(self.rng.randrange(ids), None if self.rng.random() < 0.3 else f"v{p}", p) for p in range(1, changes + 1)]
        self.base = {i: f"b{i}" for i in range(0, ids, 2)}
        self.reads = 0

    def state(self, upto):
        rows = dict(self.base)
        for i, v, p in self.log:
            if p <= upto:
                rows.pop(i, None)
                if v is not None:
                    rows[i] = v
        return rows

    def _go_on(self):
        self.at = min(len(self.log), self.at + self.rng.randrange(8))

    def position(self):
        self._go_on()
        return self.at

    def read_chunk(self, bound):
        self._go_on()
        self.reads += 1
        rows = list(self.state(self.at).items())
        self._go_on()
        return self.spark.createDataFrame(rows, ROW)

    def changes(self):
        return self.spark.createDataFrame([(i, v, "d" if v is None else "u", p) for i, v, p in self.log], CHANGE)


def follow(spark, root, source, snap, files=3):
    source.changes().repartitionByRange(files, "pos").write.parquet(f"{root}/log")
    live = spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).parquet(f"{root}/log")
    rep = KeyedReplica(spark, f"{root}/state", ROW, "id", order=ORDER, order_types={"pos": LongType(), "seq": IntegerType()}, buckets=2)
    run_until_done(replicate(handover(snap, live, files_per_batch=1), rep, f"{root}/ck", available_now=True))
    return {r["id"]: r["v"] for r in rep.current().collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_chunk_order_and_overlap(spark, scratch, seed):
    root, source = scratch(f"handover{seed}"), Source(spark, seed)
    snap = ChunkedSnapshot(spark, root, ROW, "id", [(None, 3), (3, 8), (8, None)], source.read_chunk, source.position)
    order = [0, 1, 2]
    source.rng.shuffle(order)
    snap.run(order=order[:2])
    # A restart: finished chunks are not read again.
    snap = ChunkedSnapshot(spark, root, ROW, "id", [(None, 3), (3, 8), (8, None)], source.read_chunk, source.position)
    with pytest.raises(ValueError, match="1 chunks"):
        snap.consistent_from()
    snap.run()
    assert source.reads == 3 and len(snap.windows()) == 3
    assert all(low <= high for low, high in snap.windows().values()) and snap.consistent_from() <= len(source.log)
    assert follow(spark, root, source, snap) == source.state(len(source.log))


def test_a_chunk_that_broke_off_is_read_again(spark, scratch):
    root, source = scratch("handover_crash"), Source(spark, 9)
    calls = []

    def position():
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("crash after the rows, before the window")
        return source.position()

    snap = ChunkedSnapshot(spark, root, ROW, "id", [(None, None)], source.read_chunk, position)
    with pytest.raises(RuntimeError):
        snap.run()
    assert snap.windows() == {}
    snap.run()
    assert source.reads == 2
    assert follow(spark, root, source, snap) == source.state(len(source.log))


def test_lost_changes_and_other_bounds_are_refused(spark, scratch):
    root, source = scratch("handover_lost"), Source(spark, 4)
    source.at = 20
    snap = ChunkedSnapshot(spark, root, ROW, "id", [(None, 5), (5, None)], source.read_chunk, source.position)
    snap.run()
    low = snap.first_position()
    assert snap.first_position(earliest=low + 1) == low >= 20
    with pytest.raises(LostChanges):
        snap.first_position(earliest=low + 2)
    with pytest.raises(ValueError, match="layout"):
        ChunkedSnapshot(spark, root, ROW, "id", [(None, 6), (6, None)], source.read_chunk, source.position).run()


def test_even_bounds(spark):
    bounds = even_bounds(spark.range(1000), "id", 4)
    assert bounds[0][0] is None and bounds[-1][1] is None and len(bounds) == 4
    assert all(abs(b[1] - 250 * (i + 1)) < 20 for i, b in enumerate(bounds[:-1]))
    assert even_bounds(spark.range(0), "id", 3) == [(None, None)] and even_bounds(spark.range(5), "id", 1) == [(None, None)]
