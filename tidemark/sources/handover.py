"""A snapshot of a source table, then its live changes, without stopping the source.

The table is read in chunks of its key while it goes on changing. Around each
chunk the log position is noted: `low` before the read, `high` after it. A row of
the chunk is as the source had it somewhere in between, so every change behind
`low` may or may not be in it. The chunk's rows take `low` as their position and
the changes keep theirs; as a change carries the whole row, the last position of
a key wins and changes inside the window are reconciled with the rows they meet:
one that the read had seen already is applied once more to the same effect.
So chunks may come in any order, beside the log or before it, and again.

The log has to be kept from the smallest `low` on, and the target is a state that
the source has had once all changes up to the largest `high` are in.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..operators.changelog import OP_READ
from ..sinks.state_folder import StateFolder

Bound = tuple[object | None, object | None]
ORDER = ("pos", "seq")  # a chunk's rows (seq 0) stand before the change at the same position (seq 1)


def even_bounds(table: DataFrame, key: str, chunks: int) -> list[Bound]:
    """Key ranges [lower, upper) of about equal numbers of rows, open at both ends; one row reaches the driver."""
    cuts = table.agg(F.percentile_approx(key, [i / chunks for i in range(1, chunks)]).alias("c")).first()["c"] if chunks > 1 else []
    edges = [None, *sorted(set(cuts or [])), None]
    return list(zip(edges[:-1], edges[1:]))


def in_bound(key: str, bound: Bound):
    lower, upper = bound
    inside = F.col(key).isNotNull()
    inside = inside if lower is None else inside & (F.col(key) >= F.lit(lower))
    return inside if upper is None else inside & (F.col(key) < F.lit(upper))


class LostChanges(ValueError):
    """The log no longer holds changes that a chunk needs."""


class ChunkedSnapshot(StateFolder):
    """Reads a table chunk by chunk into a folder; a chunk that is done is not read again.

    `read_chunk(bound)` gives the source's rows of a key range as they are now,
    `position()` the newest position of its change log.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str, bounds: Sequence[Bound],
                 read_chunk: Callable[[Bound], DataFrame], position: Callable[[], int]):
        self.spark, self.path, self.key, self.bounds = spark, f"{root.rstrip('/')}/snapshot", key, list(bounds)
        self.read_chunk, self.position, self._checked = read_chunk, position, False
        self.schema = StructType([*schema.fields, StructField("op", StringType()), StructField("pos", LongType()), StructField("seq", IntegerType())])

    def _layout(self) -> dict:
        return {"key": self.key, "columns": self.schema.fieldNames(), "bounds": [[repr(b) for b in x] for x in self.bounds]}

    def _done(self, chunk: int) -> tuple[int, int] | None:
        text = self._read_text(f"{self.path}/chunk-{chunk}.json")
        return (json.loads(text)["low"], json.loads(text)["high"]) if text else None

    def windows(self) -> dict[int, tuple[int, int]]:
        """(low, high) of each finished chunk."""
        return {i: w for i in range(len(self.bounds)) if (w := self._done(i))}

    def run(self, order: Sequence[int] | None = None) -> None:
        """Read the chunks that are not done yet, in the given order."""
        self._check_layout()
        for i in order if order is not None else range(len(self.bounds)):
            if self._done(i):
                continue
            low = self.position()
            rows = self.read_chunk(self.bounds[i]).where(in_bound(self.key, self.bounds[i]))
            rows = rows.withColumns({"op": F.lit(OP_READ), "pos": F.lit(low).cast("bigint"), "seq": F.lit(0)})
            rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/rows/chunk={i}")
            # A chunk counts once its window is written: its position after the read is known then.
            self._write_text(f"{self.path}/chunk-{i}.json", json.dumps({"low": low, "high": self.position()}))

    def rows(self, files_per_batch: int | None = None) -> DataFrame:
        """The chunks as a stream of changes: row columns, op, pos, seq."""
        r = self.spark.readStream.schema(StructType([*self.schema.fields, StructField("chunk", IntegerType())]))
        if files_per_batch:
            r = r.option("maxFilesPerTrigger", files_per_batch)
        return r.parquet(f"{self.path}/rows").select(*self.schema.fieldNames())

    def first_position(self, earliest: int | None = None) -> int:
        """Changes behind this position are needed; `earliest` is the first that the log still holds."""
        low = min(w[0] for w in self.windows().values())
        if earliest is not None and earliest > low + 1:
            raise LostChanges(f"the log begins at {earliest}, changes from {low + 1} on are needed: read the chunks again")
        return low

    def consistent_from(self) -> int:
        """The target is a state of the source once changes up to here are applied; all chunks have to be done."""
        done = self.windows()
        if len(done) < len(self.bounds):
            raise ValueError(f"{len(self.bounds) - len(done)} chunks are not read yet")
        return max(w[1] for w in done.values())


def handover(snapshot: ChunkedSnapshot, changes: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """The feed of a target kept by `ORDER`: the chunks' rows and the changes behind the first of them."""
    changes = changes.where(F.col("pos") > snapshot.first_position()).withColumn("seq", F.lit(1))
    return snapshot.rows(files_per_batch).unionByName(changes.select(*snapshot.schema.fieldNames()))
