"""Top-N per group, kept current in sharded state.

Input is a feed of keyed rows: each row is the newest image of its key (`live`
false where the key is gone) with a version. Rows are dealt to shards by a hash
of the key, so a key's old and new group are in the same shard, a key that moves
needs no retraction, and a group of any size spreads over all shards.

A shard keeps (`RankedShard`, one `transformWithState` operator):
  rows    the newest image of each key
  ranges  of each group: its keys' score ranges, best first, with their counts
  slices  of each range: its (score, key) entries in order
A change opens the slice that its score falls into, and no other. A group's best
N come from its first ranges, whose counts say how many are needed: where the
best rows go, the next ones are read from the following slice, never from the
rest of the group. A slice that grows is cut in two; an empty one goes.

A batch emits, for each group that a shard changed, the shard's best N. They are
appended to a `ChangeLog` by (shard, group), and the top N of a group is the
top N of its shards' best: at most N rows a shard, whatever the group's size.

Order is the order column descending with nulls last, then the key ascending.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, NumericType, StringType, StructField, StructType)

from ..operators.changelog import changelog_diff
from ..operators.rank import top_n_per_group
from ..sinks.change_log import ChangeLog
from ..sinks.state_folder import stream_job
from .jobs import CHECKPOINT_INTERVAL, start_foreach_batch
from .state import keyed_state, pack, read_blocks

ChangeSink = Callable[[DataFrame, int], None]
SLICE = 256  # entries of a range; twice as many are cut in two


def rank_key(entry) -> tuple:
    """Sort key of (score, key): descending, NaN first as Spark has it, nulls last."""
    score, key = entry
    if score is None:
        return 2, 0, key
    return (0, 0, key) if isinstance(score, float) and math.isnan(score) else (1, -score, key)


class Ranges:
    """The ordered entries of a shard's groups, over two map states; changes are held until `flush`."""

    def __init__(self, ranges, slices, size: int):
        self._ranges, self._slices, self._size = ranges, slices, size
        self._marks: dict[str, list] = {}  # group -> [[number, count, first entry], ..], best first
        self._open: dict[tuple[str, int], list] = {}
        self._changed: set = set()

    def _of(self, group: str) -> list:
        if group not in self._marks:
            got = self._ranges.getValue((group,))
            self._marks[group] = json.loads(got[0]) if got else []
        return self._marks[group]

    def _slice(self, group: str, number: int) -> list:
        at = (group, number)
        if at not in self._open:
            self._open[at] = [tuple(e) for e in json.loads(self._slices.getValue(at)[0])]
        return self._open[at]

    def _find(self, marks: list, entry) -> int:
        return max(bisect_right(marks, rank_key(entry), key=lambda m: rank_key(m[2])) - 1, 0)

    def add(self, group: str, entry) -> None:
        marks = self._of(group)
        if not marks:
            marks.append([0, 0, entry])
            self._open[group, 0] = []
        i = self._find(marks, entry)
        number = marks[i][0]
        entries = self._slice(group, number)
        insort(entries, entry, key=rank_key)
        self._changed |= {group, (group, number)}
        if len(entries) > 2 * self._size:
            new = 1 + max(m[0] for m in marks)
            half = len(entries) // 2
            self._open[group, new], entries[half:] = entries[half:], []
            marks.insert(i + 1, [new, len(self._open[group, new]), self._open[group, new][0]])
            self._changed.add((group, new))
        marks[i][1:] = [len(entries), entries[0]]

    def remove(self, group: str, entry) -> None:
        marks = self._of(group)
        i = self._find(marks, entry)
        number = marks[i][0]
        entries = self._slice(group, number)
        entries.remove(entry)
        self._changed |= {group, (group, number)}
        if entries:
            marks[i][1:] = [len(entries), entries[0]]
        else:
            del marks[i]

    def best(self, group: str, n: int) -> list:
        """The first `n` entries; only slices that hold one of them are read."""
        out: list = []
        for number, _, _ in self._of(group):
            if len(out) >= n:
                break
            out += self._slice(group, number)
        return out[:n]

    def flush(self) -> None:
        for at in self._changed:
            if isinstance(at, tuple):
                if self._open[at]:
                    self._slices.updateValue(at, (json.dumps(self._open[at]),))
                elif self._slices.containsKey(at):
                    self._slices.removeKey(at)
            elif self._marks[at]:
                self._ranges.updateValue((at,), (json.dumps(self._marks[at]),))
            elif self._ranges.containsKey((at,)):
                self._ranges.removeKey((at,))
        self._changed = set()


class RankedShard(StatefulProcessor):
    """Keeps one shard's rows ranked by group; yields its best N of the groups that a batch changes."""

    def __init__(self, schema: StructType, key: str, group: str, order: str, n: int, size: int = SLICE):
        self.schema, self.key, self.group, self.order, self.n, self.size = schema, key, group, order, n, size
        self.names = schema.fieldNames()

    def _row(self, *values) -> Row:
        return Row(**dict(zip(("_shard", "_name", "_g", "_r", *self.names), values)))

    def init(self, handle: StatefulProcessorHandle) -> None:
        image = StructType([StructField("ver", LongType()), StructField("live", BooleanType()), *self.schema.fields])
        self.rows = handle.getMapState("rows", StructType([self.schema[self.key]]), image)
        self.ranges = handle.getMapState("ranges", StructType([StructField("grp", StringType())]), StructType([StructField("marks", StringType())]))
        self.slices = handle.getMapState("slices", StructType([StructField("grp", StringType()), StructField("number", LongType())]),
                                         StructType([StructField("entries", StringType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest: dict = {}
        score, grp, at = (2 + self.names.index(c) for c in (self.order, self.group, self.key))
        given = read_blocks(rows)
        for r in zip(*(given[c].to_pylist() for c in ("ver", "live", *self.names))):
            if r[at] not in newest or newest[r[at]][0] < r[0]:
                newest[r[at]] = r
        held = Ranges(self.ranges, self.slices, self.size)
        changed: dict[str, object] = {}
        for ident, r in newest.items():
            old = self.rows.getValue((ident,))  # None for a new key
            if old is not None and old[0] >= r[0]:
                continue  # replayed or late
            if old is not None and old[1]:
                held.remove(_name(old[grp]), (old[score], ident))
                changed[_name(old[grp])] = old[grp]
            if r[1]:
                held.add(_name(r[grp]), (r[score], ident))
                changed[_name(r[grp])] = r[grp]
            self.rows.updateValue((ident,), r)
        held.flush()
        for name, group in changed.items():
            best = held.best(name, self.n)
            yield self._row(key[0], name, group, 0, *([None] * len(self.names)))  # also where nothing is left
            for i, (_, ident) in enumerate(best, 1):
                yield self._row(key[0], name, group, i, *self.rows.getValue((ident,))[2:])

    def close(self) -> None:
        pass


def _name(group) -> str:
    """A group's name in the state; null has its own."""
    return "n" if group is None else f"v{group}"


class TopN:
    """`schema` are the rows' columns; the order column is a number."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, group: str = "gender", order: str = "score", n: int = 2,
                 key: str = "id", shards: int = 64, external_sink: ChangeSink | None = None, size: int = SLICE):
        if n < 1:
            raise ValueError("n must be >= 1")
        if not isinstance(schema[order].dataType, NumericType) or schema[order].dataType.typeName() == "decimal":
            raise ValueError("the order column must be an integer or a floating-point number")
        self.spark, self.schema, self.group, self.order, self.n, self.key = spark, schema, group, order, n, key
        self.shards, self.external_sink, self.size = shards, external_sink, size
        best = ArrayType(StructType([StructField("_r", IntegerType()), *schema.fields]))
        self.table = ChangeLog(spark, f"{root.rstrip('/')}/best", StructType(
            [StructField("slot", StringType()), StructField("best", best), StructField("ver", LongType())]), "slot", ("ver",))
        self.fault: Callable[[str, int], None] | None = None  # test hook: crash after a step

    def shard_best(self, updates: DataFrame) -> DataFrame:
        """Each shard's best N of the groups that a batch of `updates` (row columns, live, ver) changes."""
        out = StructType([StructField("_shard", IntegerType()), StructField("_name", StringType()),
                          StructField("_g", self.schema[self.group].dataType), StructField("_r", IntegerType()), *self.schema.fields])
        shard = F.pmod(F.xxhash64(self.key), F.lit(self.shards))
        rows = updates.where(F.col(self.key).isNotNull()).select(*self.schema.fieldNames(), "live", "ver")
        processor = RankedShard(self.schema, self.key, self.group, self.order, self.n, self.size)
        return pack(rows, shard).groupBy("_shard").transformWithState(processor, out, "Update", "None")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch entry point: the shards' new lists; an external sink gets the changes of the top N."""
        self.table.claim(batch_id, stream_job(self.spark))
        row = F.struct("_r", *self.schema.fieldNames())
        slots = batch.groupBy(F.concat_ws(":", "_shard", "_name").alias("slot")).agg(
            F.array_sort(F.collect_list(F.when(F.col("_r") > 0, row))).alias("best"))  # at most N rows
        self.table.append(slots.withColumn("ver", F.lit(batch_id).cast("bigint")), batch_id, unique=True)
        if self.fault:
            self.fault("best", batch_id)
        if self.external_sink is not None:
            name = F.expr("substring(slot, locate(':', slot) + 1)")
            touched = self.table.batch(batch_id).select(name.alias("_name")).distinct()

            def top(upto: int) -> DataFrame:
                return self._top(self.table.read(upto).withColumn("_name", name).join(touched, "_name", "left_semi"))

            # By key over all groups: a row that changes its group is one upsert.
            self.external_sink(changelog_diff(top(batch_id - 1), top(batch_id), key=self.key), batch_id)

    def start(self, updates: DataFrame, checkpoint: str, partitions: int | None = None, available_now: bool = False,
              interval: str = CHECKPOINT_INTERVAL) -> StreamingQuery:
        with keyed_state(self.spark, partitions):
            return start_foreach_batch(self.shard_best(updates), self.process, checkpoint, available_now=available_now,
                                       interval=interval, mode="update")

    def _top(self, slots: DataFrame) -> DataFrame:
        rows = slots.select(F.inline("best")).drop("_r")
        return top_n_per_group(rows, self.group, self.order, self.n, self.key)

    def top(self) -> DataFrame:
        """The top-N table: row columns and `rn`."""
        return self._top(self.table.read())
