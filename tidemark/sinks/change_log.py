"""A keyed table kept as its changes: each batch writes its own rows and nothing else.

  {path}/changes/batch=<k>/part-*.parquet   one row per key that batch k changed
  {path}/base/upto=<k>/part-*.parquet       one row per key as of batch k (compaction)

The table is the newest base and the later changes, reduced to the last change
of each key; deletes stay as tombstones, so a late older change cannot bring a
row back. A batch costs what it holds, whatever the size of the table. Taking
the last change is idempotent and free of order: a replayed batch overwrites its
own folder with the same rows, and rows that stand in both a base and a batch do
no harm. A folder counts once Spark has marked it `_SUCCESS`, so a batch that
broke off is not seen before its replay. `head.json` names the newest finished
batch, so what a batch asks before it writes does not grow with their number.

`compact` is one aggregation by key; run it beside the stream or every so many
batches, as readers look at every batch since the last base.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.changelog import last_per_key
from .state_folder import StateFolder

_BATCH, _UPTO = "batch", "upto"


class ChangeLog(StateFolder):
    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, order: Sequence[str],
                 parts: int = 64):
        if _BATCH in schema.fieldNames():
            raise ValueError(f"reserved column name {_BATCH!r}")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.order, self.parts = key, list(order), parts
        self._checked = False

    def _layout(self) -> dict:
        return {"key": [self.key], "order": self.order, "columns": self.schema.fieldNames()}

    def _done(self, kind: str, name: str) -> list[int]:
        """Numbers of the finished folders {path}/{kind}/{name}=<number>, in order."""
        fs, p = self._fs(f"{self.path}/{kind}")
        if not fs.exists(p):
            return []
        found = (st.getPath() for st in fs.listStatus(p))
        jvm_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(int(f.getName().split("=", 1)[1]) for f in found
                      if f.getName().startswith(f"{name}=") and fs.exists(jvm_path(f, "_SUCCESS")))

    def latest_version(self) -> int | None:
        """The newest finished batch, or None. One small file, however many batches there are."""
        text = self._read_text(f"{self.path}/head.json")
        return json.loads(text)["batch"] if text else None

    def append(self, changes: DataFrame, batch_id: int, unique: bool = False) -> None:
        """Write one batch: its last change of each key. A replay writes the same folder again.

        `unique` says that the batch has one row a key, as the updates of a keyed aggregation do.
        """
        self._check_layout()
        last = changes if unique else last_per_key(changes, self.key, self.order, self.schema.fieldNames())
        last.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/changes/{_BATCH}={batch_id}")
        self._write_text(f"{self.path}/head.json", json.dumps({"batch": batch_id}))

    def batch(self, batch_id: int) -> DataFrame:
        """The rows that one batch wrote."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/changes/{_BATCH}={batch_id}")

    def stream(self, files_per_batch: int | None = None) -> DataFrame:
        """The batches as a stream, for jobs that follow this table; a replayed batch may come again."""
        r = self.spark.readStream.schema(StructType([*self.schema.fields, StructField(_BATCH, LongType())]))
        r = r.option("ignoreMissingFiles", "true")  # of a batch that broke off and was written again
        if files_per_batch:
            r = r.option("maxFilesPerTrigger", files_per_batch)
        return r.parquet(f"{self.path}/changes")

    def read(self, upto: int | None = None) -> DataFrame:
        """The last change of each key, tombstones included; as of batch `upto` if it is given."""
        self._check_layout()
        bases, batches = ([x for x in self._done(*of) if upto is None or x <= upto] for of in (("base", _UPTO), ("changes", _BATCH)))
        names, base = self.schema.fieldNames(), bases[-1] if bases else None
        rows = self.spark.createDataFrame([], self.schema)
        if bases:
            rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/base/{_UPTO}={base}")
        if batches and (base is None or batches[-1] > base):
            # One read of the folder, cut to a range of batches by partition pruning.
            full = StructType([*self.schema.fields, StructField(_BATCH, LongType())])
            later = self.spark.read.schema(full).parquet(f"{self.path}/changes").where(F.col(_BATCH) <= batches[-1])
            later = later if base is None else later.where(F.col(_BATCH) > base)
            rows = rows.unionByName(later.select(*names)) if bases else later.select(*names)
        return last_per_key(rows, self.key, self.order, names).select(*names)

    def mark(self) -> dict | None:
        """The low-water position: no change at or before it comes any more (None: not set)."""
        text = self._read_text(f"{self.path}/mark.json")
        return json.loads(text) if text else None

    def set_mark(self, position: dict) -> None:
        """Set the low-water position (a number or text for each order column); it only rises."""
        if sorted(position) != sorted(self.order):
            raise ValueError(f"a position of {self.order} is needed")
        held = self.mark()
        if held is not None and tuple(position[c] for c in self.order) < tuple(held[c] for c in self.order):
            raise ValueError(f"the low-water position is {held} already")
        self._write_text(f"{self.path}/mark.json", json.dumps(position))

    def beyond_mark(self, rows: DataFrame) -> DataFrame:
        """Rows behind the low-water position; older ones cannot be told from deleted keys any more."""
        held = self.mark()
        if held is None:
            return rows
        at = F.struct(*[F.lit(held[c]).cast(self.schema[c].dataType).alias(c) for c in self.order])
        return rows.where(F.struct(*[F.col(c) for c in self.order]) > at)

    def compact(self, tombstone: Column | None = None) -> int | None:
        """Write the table as of the newest batch as a new base; returns that batch.

        Rows that are `tombstone`s and not beyond the low-water position are left out.

        What only the bases before the previous one needed is deleted; the
        previous base and its batches stay for readers that began with them.
        """
        batches, bases = self._done("changes", _BATCH), self._done("base", _UPTO)
        if not batches or (bases and bases[-1] >= batches[-1]):
            return bases[-1] if bases else None
        upto = batches[-1]
        rows = self.read()
        if tombstone is not None and self.mark() is not None:
            rows = rows.where(~tombstone).unionByName(self.beyond_mark(rows.where(tombstone)))
        rows.repartition(self.parts, self.key).write.mode("overwrite").parquet(f"{self.path}/base/{_UPTO}={upto}")
        if bases:
            stale = [f"changes/{_BATCH}={b}" for b in batches if b <= bases[-1]] + [f"base/{_UPTO}={b}" for b in bases[:-1]]
            for name in stale:
                fs, p = self._fs(f"{self.path}/{name}")
                fs.delete(p, True)
        return upto
