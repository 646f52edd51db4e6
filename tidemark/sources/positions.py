"""Where a consumer group starts in a partitioned log.

A group's committed offsets say the next record of each partition. A partition
that the group has not committed starts at the end of the log ("latest") or its
beginning ("earliest"). Offsets that the log no longer holds are a loss, which
the group has to be told of, or asked to accept.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.state_folder import StateFolder

EARLIEST, LATEST = "earliest", "latest"


class LostRange(ValueError):
    """Records between the committed offset and the log's beginning are gone."""


class GroupOffsets(StateFolder):
    """The committed offsets of one group: a small file a topic, written whole."""

    def __init__(self, spark: SparkSession, root: str, group: str):
        self.spark, self.path, self._checked = spark, f"{root.rstrip('/')}/offsets/{group}", False

    def committed(self, topic: str) -> dict[int, int]:
        text = self._read_text(f"{self.path}/{topic}.json")
        return {int(p): o for p, o in json.loads(text).items()} if text else {}

    def commit(self, topic: str, offsets: Mapping[int, int]) -> None:
        """Set the next record of some partitions; others keep theirs."""
        held = {**self.committed(topic), **offsets}
        self._write_text(f"{self.path}/{topic}.json", json.dumps({str(p): int(o) for p, o in sorted(held.items())}))


def log_range(log: DataFrame) -> dict[int, tuple[int, int]]:
    """(first, next) offset of each partition of a log (partition, pos); a row a partition reaches the driver."""
    rows = log.groupBy("partition").agg(F.min("pos").alias("first"), (F.max("pos") + 1).alias("next")).collect()
    return {r["partition"]: (r["first"], r["next"]) for r in rows}


def start_positions(bounds: Mapping[int, tuple[int, int]], committed: Mapping[int, int], default: str = LATEST,
                    accept_loss: bool = False) -> dict[int, int]:
    """The next record of each partition: as committed, else by `default`.

    An offset before the log's beginning, or past its end (the log was made anew), raises
    LostRange; with `accept_loss` such a partition starts at its beginning.
    """
    if default not in (EARLIEST, LATEST):
        raise ValueError(f"default must be {EARLIEST} or {LATEST}, not {default!r}")
    out = {}
    for partition, (first, after) in bounds.items():
        at = committed.get(partition)
        if at is None:
            at = first if default == EARLIEST else after
        elif not first <= at <= after:
            if not accept_loss:
                raise LostRange(f"partition {partition}: offset {at} is committed, the log holds {first} to {after - 1}")
            at = first
        out[partition] = at
    return out


def starting_offsets(topic: str, starts: Mapping[int, int]) -> str:
    """The `startingOffsets` option of Spark's log source."""
    return json.dumps({topic: {str(p): o for p, o in sorted(starts.items())}})


def from_positions(log: DataFrame, starts: Mapping[int, int]) -> DataFrame:
    """The log's records from `starts` on; partitions that appeared since are read whole.

    Batch or stream. One condition a partition, so that the scan is cut by partition and position.
    """
    known = [(F.col("partition") == p) & (F.col("pos") >= o) for p, o in sorted(starts.items())]
    wanted = ~F.col("partition").isin(*starts) if starts else F.lit(True)
    for k in known:
        wanted = wanted | k
    return log.where(wanted)


def next_positions(read: DataFrame) -> dict[int, int]:
    """What to commit after the records of `read` are processed."""
    return {p: after for p, (_, after) in log_range(read).items()}
