"""Start positions of consumer groups, and stopping at a bad record."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.sources.positions import (GroupOffsets, LostRange, from_positions, log_range, next_positions, start_positions, starting_offsets)
from tidemark.streaming.jobs import run_until_done, start_foreach_batch
from tidemark.streaming.keyed import KeyedReplica
from tidemark.streaming.stop import StopAtBad

BOUNDS = {0: (10, 20), 1: (0, 5), 2: (7, 7)}


def test_committed_else_default():
    assert start_positions(BOUNDS, {}) == {0: 20, 1: 5, 2: 7}
    assert start_positions(BOUNDS, {}, "earliest") == {0: 10, 1: 0, 2: 7}
    assert start_positions(BOUNDS, {0: 12, 1: 5}, "earliest") == {0: 12, 1: 5, 2: 7}
    assert json.loads(starting_offsets("t", {1: 5, 0: 12})) == {"t": {"0": 12, "1": 5}}
    with pytest.raises(ValueError):
        start_positions(BOUNDS, {}, "middle")


@pytest.mark.parametrize("committed", [{0: 9}, {1: 6}])
def test_lost_ranges(committed):
    with pytest.raises(LostRange):
        start_positions(BOUNDS, committed)
    (partition,) = committed
    assert start_positions(BOUNDS, committed, accept_loss=True)[partition] == BOUNDS[partition][0]


def test_groups_read_on(spark, scratch):
    root = scratch("offsets")
    log = spark.createDataFrame([(p, i, f"{p}-{i}") for p in (0, 1, 2) for i in range(10 * p, 10 * p + 6)], "partition int, pos long, value string")
    first = log.where("pos % 10 < 4 and partition < 2")
    group = GroupOffsets(spark, root, "g")
    assert from_positions(first, start_positions(log_range(first), group.committed("t"), "earliest")).count() == 8
    group.commit("t", next_positions(first))
    assert GroupOffsets(spark, root, "g").committed("t") == {0: 4, 1: 14}
    starts = start_positions(log_range(log.where("partition < 2")), group.committed("t"))
    got = {r["value"] for r in from_positions(log, starts).collect()}  # partition 2 appeared since: it is read whole
    assert got == {"0-4", "0-5", "1-14", "1-15"} | {f"2-{i}" for i in range(20, 26)}
    group.commit("t", {0: 6})
    assert group.committed("t") == {0: 6, 1: 14}
    assert from_positions(log, {}).count() == log.count()


ROW = StructType([StructField("id", LongType()), StructField("v", StringType())])


def test_stop_and_resume(spark, scratch):
    """Each stop commits what stands before the first bad record of each partition, and nothing behind it."""
    root = scratch("stop")
    lines = [(p, pos, "bad" if (p, pos) in {(0, 3), (0, 6), (1, 4)} else f"{10 * p + pos},a") for p in (0, 1, 2) for pos in range(8)]
    spark.createDataFrame(lines, "partition long, pos long, value string").coalesce(1).write.parquet(f"{root}/in")
    rep = KeyedReplica(spark, f"{root}/state", ROW, "id", order=("pos",), order_types={"pos": LongType()}, buckets=2)
    rejected = []
    job = StopAtBad(spark, root, ROW, rep.process, lambda b, i: rejected.extend((r["partition"], r["pos"], r["reason"]) for r in b.collect()))

    def run():
        stream = spark.readStream.schema("partition long, pos long, value string").parquet(f"{root}/in")
        run_until_done(start_foreach_batch(stream, job.process, f"{root}/ck", available_now=True))

    def ids():
        return sorted(r["id"] for r in rep.current().collect())

    with pytest.raises(StreamingQueryException, match="bad records at 0:3, 1:4"):
        run()
    assert ids() == [0, 1, 2, 10, 11, 12, 13, *range(20, 28)] and rejected == []
    with pytest.raises(StreamingQueryException, match="0:3"):
        run()  # nothing was decided: it stops there again
    job = StopAtBad(spark, root, ROW, rep.process, job.rejects)  # a new process
    assert job.stopped_at() == {0: 3, 1: 4}
    job.skip(job.stopped_at())
    with pytest.raises(StreamingQueryException, match="bad records at 0:6"):
        run()
    assert ids() == [0, 1, 2, 4, 5, *(i for i in range(10, 18) if i != 14), *range(20, 28)]
    job.skip(job.stopped_at())
    run()
    assert job.stopped_at() == {}
    assert ids() == [i for p in (0, 1, 2) for i in range(10 * p, 10 * p + 8) if i not in (3, 6, 14)]
    assert {r[:2] for r in rejected} == {(0, 3), (0, 6), (1, 4)}
