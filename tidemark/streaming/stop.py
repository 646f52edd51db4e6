"""Stop at the bad record, and go on behind it.

A consumer that fails on a bad line has processed what came before it. Per batch
the first bad position of each log partition is a minimum (combined in the map
tasks); rows before it go to the sink, the positions are noted and the batch fails,
so that Spark does not commit it. After a restart the batch comes again: the rows
before are written once more under the same batch id, and if the position has
been put on the skip list the job goes on behind it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.lines import parse_lines
from ..sinks.state_folder import StateFolder

Sink = Callable[[DataFrame, int], None]


class BadRecord(RuntimeError):
    """`positions`: the first bad position of each partition that has one."""

    def __init__(self, positions: Mapping[int, int]):
        super().__init__("bad records at " + ", ".join(f"{p}:{at}" for p, at in sorted(positions.items())))
        self.positions = dict(positions)


class StopAtBad(StateFolder):
    """Use `process` as the foreachBatch function over lines (value, partition, pos).

    `sink(rows, batch_id)` gets typed rows with partition, pos and `op`; `rejects` gets
    the skipped lines with their reason. Positions on the skip list are exact.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, sink: Sink, rejects: Sink | None = None):
        self.spark, self.path, self._checked = spark, f"{root.rstrip('/')}/stops", False
        self.schema, self.sink, self.rejects = schema, sink, rejects

    def _listed(self, name: str) -> list[tuple[int, int]]:
        text = self._read_text(f"{self.path}/{name}.json")
        return [tuple(x) for x in json.loads(text)] if text else []

    def stopped_at(self) -> dict[int, int]:
        """The positions that the job stopped at last; empty once a batch went through."""
        return dict(self._listed("stopped"))

    def skip(self, positions: Mapping[int, int]) -> None:
        """Let the job go on behind these bad records; each is a decision, so the list stays short."""
        held = sorted({*self._listed("skipped"), *((int(p), int(at)) for p, at in positions.items())})
        self._write_text(f"{self.path}/skipped.json", json.dumps(held))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        good, bad = parse_lines(batch, self.schema, on_bad="divert", keep=("partition", "pos"))
        where = StructType([StructField("partition", LongType()), StructField("pos", LongType())])
        skipped = self.spark.createDataFrame(self._listed("skipped"), where)
        stops = bad.join(skipped, ["partition", "pos"], "left_anti")
        first = {r["partition"]: r["pos"] for r in stops.groupBy("partition").agg(F.min("pos").alias("pos")).collect()}  # a row a partition
        limits = self.spark.createDataFrame([(int(p), int(at)) for p, at in first.items()], "partition long, limit long")
        # As many rows as the batch has log partitions.
        good = good.join(F.broadcast(limits), "partition", "left").where("limit is null or pos < limit").drop("limit")
        bad = bad.join(F.broadcast(limits), "partition", "left").where("limit is null or pos < limit").drop("limit")
        if self.rejects is not None:
            self.rejects(bad, batch_id)
        self.sink(good.withColumn("op", F.lit("u")), batch_id)
        if first or self.stopped_at():
            self._write_text(f"{self.path}/stopped.json", json.dumps(sorted(first.items())))
        if first:
            raise BadRecord(first)
