"""A join of keyed change feeds, kept current in Spark's own state.

Each feed holds the changes of one table; all share the key. The state of a key
is the latest change of every side, by the change order: one streaming
aggregation with a conditional `max_by` a side, in update mode. So the store
holds one row a key, a batch reads and writes the keys that it touches, and
replays, reordered and late changes end in the same state. Deletes stay as the
latest change of their side.

Each batch's updated keys are appended to a `ChangeLog`: what is written follows
the batch, never the state. The joined table is the log's last row of each key,
and the log's batches are a feed for jobs that follow it (`updates`).

A snapshot is a feed like any other: put its rows before the changes (or beside
them; the order columns decide) and let `maxBytesPerTrigger` cut it into batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.changelog import OP_DELETE
from ..sinks.change_log import ChangeLog
from ..sinks.state_folder import stream_job
from .jobs import CHECKPOINT_INTERVAL, start_foreach_batch
from .state import keyed_state

VERSION = "ver"  # the batch that a joined row is of


@dataclass(frozen=True)
class Side:
    """One input table of the join: its name and value columns (the key is shared)."""
    name: str
    columns: tuple[str, ...]


class KeyedJoin:
    """Rows of `feeds` are (side, key, op, values of all sides, order columns)."""

    def __init__(self, spark: SparkSession, root: str, sides: Sequence[Side], schema: StructType, key: str = "id",
                 change_order: Sequence[str] = ("ts", "pos"), parts: int = 64):
        self.spark, self.sides, self.key, self.change_order = spark, list(sides), key, list(change_order)
        types = {f.name: f.dataType for f in schema.fields}
        self.columns = [c for s in self.sides for c in s.columns]
        self.row_schema = StructType([StructField(c, types[c]) for c in (key, *self.columns)])
        order = [StructField(c, types[c]) for c in self.change_order]
        images = [StructField(s.name, StructType([StructField("op", StringType()), *[StructField(c, types[c]) for c in s.columns], *order]))
                  for s in self.sides]
        self.table = ChangeLog(spark, f"{root.rstrip('/')}/joined", StructType(
            [StructField(key, types[key]), *images, StructField(VERSION, LongType())]), key, (VERSION,), parts)
        self.fault: Callable[[str, int], None] | None = None  # test hook: crash after a step

    def latest(self, changes: DataFrame) -> DataFrame:
        """The latest change of each side, for every key of a feed (stream or not)."""
        aggs = []
        for s in self.sides:
            mine = F.col("side") == s.name
            image = F.struct("op", *s.columns, *self.change_order)
            aggs.append(F.max_by(image, F.when(mine, F.struct(*self.change_order))).alias(s.name))
        return changes.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(*aggs)

    def _live(self) -> Column:
        live = F.lit(True)
        for s in self.sides:
            live = live & F.col(s.name).isNotNull() & (F.col(f"{s.name}.op") != OP_DELETE)
        return F.coalesce(live, F.lit(False))

    def _values(self) -> list[Column]:
        return [F.col(f"{s.name}.{c}").alias(c) for s in self.sides for c in s.columns]

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch entry point: the keys that the batch updated, with their new state."""
        self.table.claim(batch_id, stream_job(self.spark))
        self.table.append(batch.withColumn(VERSION, F.lit(batch_id).cast("bigint")), batch_id, unique=True)
        if self.fault:
            self.fault("joined", batch_id)

    def start(self, feeds: Sequence[DataFrame], checkpoint: str, partitions: int | None = None, available_now: bool = False,
              interval: str = CHECKPOINT_INTERVAL) -> StreamingQuery:
        """Run the job over the feeds, unioned so that a batch covers them all."""
        stream = feeds[0]
        for f in feeds[1:]:
            stream = stream.unionByName(f)
        with keyed_state(self.spark, partitions):
            return start_foreach_batch(self.latest(stream), self.process, checkpoint, available_now=available_now,
                                       interval=interval, mode="update")

    def current(self) -> DataFrame:
        """The joined table: keys that every side holds and none has deleted."""
        return self.table.read().where(self._live()).select(self.key, *self._values())

    def updates(self, files_per_batch: int | None = None) -> DataFrame:
        """The joined rows as a stream of updates: key, values, `live`, `ver`."""
        return self.table.stream(files_per_batch).select(self.key, *self._values(), self._live().alias("live"), VERSION)
