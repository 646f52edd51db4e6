"""Declared keyed tables that plain SQL writes to: `INSERT INTO t4 SELECT ...`.

`declare` makes a table of a `TableSpec`: its name becomes a view over a Python
data source whose writer upserts by key. Every task writes its rows as a Parquet
part that readers do not see; the commit message names it. The commit shows the
parts that Spark has accepted, and no others, and marks the insert as finished; an
abort deletes them. So an insert counts as a whole or not at all, whatever is run
again or twice. Inserts are batches of a `ChangeLog`, numbered by the clock of the
driver that plans them: the last insert of a key wins (of one insert with a
key twice, either row may stay). Rows are read back by `read`.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.changelog import OP_DELETE, OP_UPDATE
from ..spec import TableSpec
from .change_log import ChangeLog

SOURCE = "tidemark_keyed"


@dataclass
class _Part(WriterCommitMessage):
    name: str


def _folder(path: str):
    """(file system, folder) of a path or URI that all executors reach."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


class _Upsert(DataSourceArrowWriter):
    def __init__(self, root: str, schema: StructType):
        self.root, self.schema, self.batch = root, schema, time.time_ns() // 1000
        self.path = f"{root}/changes/batch={self.batch}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Part:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema
        files, folder = _folder(self.path)
        files.create_dir(folder, recursive=True)
        arrow = to_arrow_schema(self.schema)
        full = arrow.append(pa.field("op", pa.string())).append(pa.field("ver", pa.int64()))
        name = f"part-{uuid.uuid4().hex}.parquet"
        with files.open_output_stream(f"{folder}/_{name}") as out, pq.ParquetWriter(out, full) as parts:
            for b in iterator:
                own = [pa.array([OP_UPDATE] * b.num_rows, pa.string()), pa.array([self.batch] * b.num_rows, pa.int64())]
                parts.write_batch(pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(b.columns, arrow)), *own], schema=full))
        return _Part(name)

    def commit(self, messages: list[_Part | None]) -> None:
        files, folder = _folder(self.path)
        files.create_dir(folder, recursive=True)
        for m in messages:
            if m is not None:
                files.move(f"{folder}/_{m.name}", f"{folder}/{m.name}")
        with files.open_output_stream(f"{folder}/_SUCCESS"):
            pass
        _, root = _folder(self.root)
        with files.open_output_stream(f"{root}/_head-{self.batch}") as out:
            out.write(f'{{"batch": {self.batch}}}'.encode())
        files.move(f"{root}/_head-{self.batch}", f"{root}/head.json")

    def abort(self, messages: list[_Part | None]) -> None:
        files, folder = _folder(self.path)
        if files.get_file_info(folder).type.name == "Directory":
            files.delete_dir(folder)


class KeyedSource(DataSource):
    """Options: `root` (a folder that all executors share) and `ddl` (the columns)."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return self.options["ddl"]

    def writer(self, schema: StructType, overwrite: bool) -> _Upsert:
        if overwrite:
            raise ValueError("a keyed table is upserted, not overwritten")
        return _Upsert(self.options["root"], schema)


class DeclaredTable:
    """The table behind a declared name."""

    def __init__(self, spark: SparkSession, spec: TableSpec, root: str):
        if len(spec.key) != 1:
            raise ValueError("single-column keys only")
        self.spec = spec
        self.log = ChangeLog(spark, root, StructType([*spec.schema.fields, StructField("op", StringType()), StructField("ver", LongType())]),
                             spec.key[0], ("ver",))

    def read(self) -> DataFrame:
        """One row a key: the last that was inserted."""
        return self.log.read().where(f"op <> '{OP_DELETE}'").select(*self.spec.columns)


def declare(spark: SparkSession, spec: TableSpec) -> DeclaredTable:
    """Make `spec.name` a table that SQL inserts into; `spec.options["root"]` is its folder."""
    if "root" not in spec.options:
        raise ValueError(f"table {spec.name} needs the option 'root', a folder that all executors share")
    root = str(spec.options["root"]).rstrip("/")
    spark.dataSource.register(KeyedSource)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
    quoted = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"create or replace temporary view `{spec.name}` using {SOURCE} options (root {quoted(root)}, ddl {quoted(ddl)})")
    return DeclaredTable(spark, spec, root)
