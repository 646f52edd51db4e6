"""A keyed table kept current from a changelog stream (replication / upsert sink).

`insert into sink select * from t` where t is a changelog table and sink has
a primary key: inserts and updates replace the row of their key, deletes
remove it. Each micro-batch is reduced to the last change of each key by the
change order (e.g. (ts, pos) or a log offset) and written as it is to a
`ChangeLog`; the table is the last change of each key, deletes kept as
tombstones so a late older change cannot bring a row back. A batch writes what
it holds and reads no state. A replayed batch (at-least-once delivery, restart
after a crash) writes its own folder again: effectively-once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.changelog import OP_DELETE
from ..sinks.change_log import ChangeLog
from ..sinks.state_folder import stream_job

Fault = Callable[[str, int], None]


class KeyedReplica:
    """`buckets` is the number of parts, by key, that `compact` writes the table in; it
    runs after every `compact_every` batches, or where that is None when it is called.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str = "id",
                 order: Sequence[str] = ("ts", "pos"), op_col: str = "op", buckets: int = 64,
                 order_types: dict | None = None, compact_every: int | None = None):
        self.compact_every = compact_every
        self.spark, self.key, self.order, self.op_col = spark, key, list(order), op_col
        self.columns = [f.name for f in schema.fields]
        types = {f.name: f.dataType for f in schema.fields}
        types.update(order_types or {})
        fields = [*schema.fields, StructField(op_col, StringType()),
                  *[StructField(c, types[c]) for c in self.order]]
        self.table = ChangeLog(spark, f"{root.rstrip('/')}/table", StructType(fields), key, self.order, buckets)
        self.fault: Fault | None = None

    def initialize(self, snapshot: DataFrame) -> None:
        """Load a snapshot (key, values, op, order columns) as the state before batch 0.

        Its order values must sort before every change that follows.
        """
        self.table.append(snapshot.select(*self.table.schema.fieldNames()), -1)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch entry point. `batch` carries key, values, op and order columns."""
        self.table.claim(batch_id, stream_job(self.spark))
        self.table.append(self.table.beyond_mark(batch.select(*self.table.schema.fieldNames())), batch_id)
        if self.fault:
            self.fault("table", batch_id)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self.compact()

    def compact(self) -> None:
        """Fold the batches so far into one base; deletes up to the low-water position are forgotten."""
        self.table.compact(F.col(self.op_col) == OP_DELETE)

    def retire(self, positions: Mapping[object, tuple]) -> None:
        """Set the low-water position from the newest position (order values) of every partition of the feed.

        Each partition is in order, so no change at or before the smallest of them is
        still to come. Deletes up to there go with the next `compact`, and a change that
        comes from before it all the same is left out: its key may have been deleted since.
        """
        self.table.set_mark(dict(zip(self.order, min(positions.values()))))

    @classmethod
    def for_spec(cls, spark: SparkSession, spec, root: str, order: Sequence[str] = ("ts", "pos"),
                 order_types: dict | None = None, **kw) -> "KeyedReplica":
        """A replica of a declared keyed table (`tidemark.spec.TableSpec`)."""
        if len(spec.key) != 1:
            raise ValueError("single-column keys only")
        return cls(spark, root, spec.schema, spec.key[0], order=order, order_types=order_types, **kw)

    def current(self) -> DataFrame:
        return self.table.read().where(F.col(self.op_col) != OP_DELETE).select(*self.columns)
