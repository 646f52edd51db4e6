"""Keyed JDBC sink: upserts and deletes by primary key, effectively-once per batch.

Spark's JDBC writer only inserts (a repeated key fails), so each micro-batch:
  1. writes its changes (key, op, values; at most one row per key) to a
     staging table, in parallel from the executors (`DataFrame.write.jdbc`);
  2. applies them in the database with one transaction on the driver: the
     dialect's merge statement(s) plus a row in a batch-marker table; a batch
     whose id is already recorded is skipped, so a replay after a crash
     between steps 2 and the stream commit does nothing twice;
  3. drops the staging table.
Connection settings (url, user, password, driver) come from the caller's
configuration; nothing is built into the code.

Only the statement text is tested in this repository: no database server is
available to run it against.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators.changelog import OP_DELETE, last_per_key
from .state_folder import stream_job

DIALECTS = ("ansi", "derby", "mysql")


def _q(name: str, dialect: str) -> str:
    """Quote a staging column (Spark creates staging columns with quoted lower-case names)."""
    return f"`{name}`" if dialect == "mysql" else f'"{name}"'


def merge_statements(dialect: str, table: str, staging: str, key: Sequence[str],
                     columns: Sequence[str], op_col: str = "op") -> list[str]:
    """Statements that apply a staging table of changes to `table`, in order."""
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}")
    keys, cols = list(key), list(columns)
    values = [c for c in cols if c not in keys]
    s = lambda c: f"s.{_q(c, dialect)}"
    on = " AND ".join(f"t.{k} = {s(k)}" for k in keys)
    delete = f"'{OP_DELETE}'"
    if dialect == "mysql":
        updates = ", ".join(f"{c} = VALUES({c})" for c in values) or f"{keys[0]} = {keys[0]}"
        return [
            f"DELETE t FROM {table} t JOIN {staging} s ON {on} WHERE {s(op_col)} = {delete}",
            f"INSERT INTO {table} ({', '.join(cols)}) "
            f"SELECT {', '.join(s(c) for c in cols)} FROM {staging} s WHERE {s(op_col)} <> {delete} "
            f"ON DUPLICATE KEY UPDATE {updates}",
        ]
    sets = ", ".join(f"{c} = {s(c)}" for c in values)
    matched_update = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
    return [
        f"MERGE INTO {table} t USING {staging} s ON {on}"
        f" WHEN MATCHED AND {s(op_col)} = {delete} THEN DELETE"
        f"{matched_update}"
        f" WHEN NOT MATCHED AND {s(op_col)} <> {delete} THEN INSERT ({', '.join(cols)})"
        f" VALUES ({', '.join(s(c) for c in cols)})",
    ]


def marker_statements(marker_table: str, job: str, batch_id: int) -> tuple[str, str]:
    """(check, record) statements of the batch-marker table (job, batch_id).

    Only this very batch of this job counts as done; `job` names the run too
    (see `JdbcKeyedSink`), so a stream with a new checkpoint skips nothing.
    """
    name = job.replace("'", "''")
    return (f"SELECT COUNT(*) FROM {marker_table} WHERE job = '{name}' AND batch_id = {int(batch_id)}",
            f"INSERT INTO {marker_table} (job, batch_id) VALUES ('{name}', {int(batch_id)})")


def marker_ddl(marker_table: str) -> str:
    """Statement that creates the batch-marker table; run it once, before the first job."""
    return f"CREATE TABLE {marker_table} (job VARCHAR(200) NOT NULL, batch_id BIGINT NOT NULL, PRIMARY KEY (job, batch_id))"


@dataclass
class JdbcKeyedSink:
    """foreachBatch-compatible sink: `sink(changes, batch_id)`."""
    url: str
    table: str
    key: Sequence[str]
    columns: Sequence[str]
    job: str
    dialect: str = "ansi"
    op_col: str = "op"
    marker_table: str = "tidemark_batches"
    properties: dict = field(default_factory=dict)
    write_partitions: int | None = None
    order: Sequence[str] = ()  # change order; with it a batch is reduced to the last change of each key

    @classmethod
    def for_spec(cls, spec, url: str, job: str, dialect: str = "ansi", properties: dict | None = None,
                 **kw) -> "JdbcKeyedSink":
        """A keyed sink for a declared table (`tidemark.spec.TableSpec`); options come from the caller."""
        return cls(url=url, table=spec.name, key=list(spec.key), columns=spec.columns, job=job,
                   dialect=dialect, properties=dict(properties or {}), **kw)

    def statements(self, batch_id: int) -> list[str]:
        """The statements one batch runs inside its transaction (for review and tests)."""
        check, record = marker_statements(self.marker_table, self.job, batch_id)
        return [check, *merge_statements(self.dialect, self.table, self.staging_name(batch_id),
                                          self.key, self.columns, self.op_col), record]

    def staging_name(self, batch_id: int) -> str:
        return f"{self.table}_stg_{self.job}_{int(batch_id)}"

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        staging = self.staging_name(batch_id)
        if self.order:
            changes = last_per_key(changes, list(self.key), self.order)
        rows = changes.select(*self.columns, self.op_col)
        if self.write_partitions:
            rows = rows.repartition(self.write_partitions, *self.key)
        rows.write.jdbc(self.url, staging, mode="overwrite", properties=self.properties)
        self._apply(changes.sparkSession, staging, batch_id)

    def process(self, changes: DataFrame, batch_id: int) -> None:
        """The same under the name that `KeyedReplica` has, for `replicate` and `ingest`."""
        self(changes, batch_id)

    def _apply(self, spark, staging: str, batch_id: int) -> None:
        jvm = spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in self.properties.items():
            props.setProperty(k, str(v))
        conn = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            conn.setAutoCommit(False)
            stmt = conn.createStatement()
            run = stream_job(spark)  # a new checkpoint is a new run: its batches count anew
            check, record = marker_statements(self.marker_table, f"{self.job}:{run}" if run else self.job, batch_id)
            rs = stmt.executeQuery(check)
            rs.next()
            if rs.getLong(1) == 0:
                for sql in merge_statements(self.dialect, self.table, staging, self.key,
                                            self.columns, self.op_col):
                    stmt.executeUpdate(sql)
                stmt.executeUpdate(record)
            conn.commit()
            stmt.executeUpdate(f"DROP TABLE {staging}")
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            conn.close()
