"""Settings of queries that keep state: one place for the store and its partitions.

And rows that go to a shard's state in Python as Arrow blocks: `transformWithState`
reads and writes its rows cell by cell, so a block of rows is one row to it (`pack`,
`read_blocks`; `write_block`, `unpack` for what comes out).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BLOCK = "_shard int, block binary"

# State on each executor's disk, and only its changes in the checkpoint of a batch.
STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Queries started inside keep their state in the store above.

    A query takes its settings when it starts and holds them for the life of its
    checkpoint, `partitions` (of the state) too: choose them for the full state.
    """
    mine = STORE | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    before = {k: spark.conf.get(k, None) for k in mine}
    for k, v in mine.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def pack(rows: DataFrame, shard: Column) -> DataFrame:
    """Rows -> (_shard, block): the rows of each shard in each Arrow batch as one block."""
    def run(batches):
        for b in batches:
            at = b.column(0).to_numpy()
            order = np.argsort(at, kind="stable")
            names, starts = np.unique(at[order], return_index=True)
            taken = pa.RecordBatch.from_arrays(b.columns[1:], names=b.schema.names[1:]).take(pa.array(order))
            blocks = [write_block(taken.slice(lo, hi - lo)) for lo, hi in zip(starts, [*starts[1:], len(at)])]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blocks, pa.binary())], ["_shard", "block"])

    return rows.select(shard.cast("int").alias("_shard"), "*").mapInArrow(run, BLOCK)


def write_block(rows: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as w:
        w.write_batch(rows)
    return out.getvalue().to_pybytes()


def read_blocks(rows: Iterable[Row]) -> pa.Table:
    """All rows of a shard's blocks."""
    return pa.concat_tables([pa.ipc.open_stream(r["block"]).read_all() for r in rows]).combine_chunks()


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def unpack(blocks: DataFrame, schema: StructType) -> DataFrame:
    """(.., block) -> the blocks' rows."""
    def run(batches):
        for b in batches:
            for block in b.column(0):
                yield from pa.ipc.open_stream(block.as_py())

    return blocks.select("block").mapInArrow(run, schema)
