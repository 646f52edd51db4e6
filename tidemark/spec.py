"""Table declarations: name, schema, primary key, connector options.

A `TableSpec` is what a `CREATE TABLE ... PRIMARY KEY (id) NOT ENFORCED WITH (...)`
declares. The key is not enforced on write; it drives de-duplication, merges
and diffs. Connection options are passed in by the caller (config or
environment), never written into code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, IntegerType, LongType, StringType, StructField,
                               StructType)


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    key: tuple[str, ...] = ("id",)
    options: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def value_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.key]

    def with_types(self, **types: DataType) -> "TableSpec":
        """Same table with some column types replaced (stand-ins use bigint keys, double scores)."""
        fields = [StructField(f.name, types.get(f.name, f.dataType), f.nullable)
                  for f in self.schema.fields]
        return TableSpec(self.name, StructType(fields), self.key, dict(self.options))


def _schema(*cols: tuple[str, DataType, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in cols])


# Row types and keyed tables of the reference jobs.
# Parsed line rows (their ints are never null).
GENDER_ROW = _schema(("id", IntegerType(), False), ("gender", StringType(), True))
NAME_ROW = _schema(("id", IntegerType(), False), ("name", StringType(), True))
SCORE_ROW = _schema(("id", IntegerType(), False), ("score", IntegerType(), False))
# Keyed tables, key `id`; t4 is the top-2 result, t5 the replica of t1.
T1 = TableSpec("t1", _schema(("id", IntegerType(), True), ("gender", StringType(), True)))
T2 = TableSpec("t2", _schema(("id", IntegerType(), True), ("name", StringType(), True)))
T3 = TableSpec("t3", _schema(("id", IntegerType(), True), ("score", IntegerType(), True)))
T4 = TableSpec("t4", _schema(("id", IntegerType(), True), ("name", StringType(), True),
                             ("gender", StringType(), True), ("score", IntegerType(), True),
                             ("rn", LongType(), True)))
T5 = TableSpec("t5", _schema(("id", IntegerType(), True), ("gender", StringType(), True)))


def fitted(value: Column, source: DataType, target: DataType, name: str) -> Column:
    """`value` as the target type; a value that does not fit fails the query, whatever the session's ANSI mode.

    Numbers lose their fraction where the target has none, as an insert's cast does.
    """
    if source == target:
        return value
    cast = value.try_cast(target)
    failed = F.raise_error(F.concat(F.lit(f"column {name}: "), value.cast("string"), F.lit(f" is no {target.simpleString()}")))
    return F.when(value.isNotNull() & cast.isNull(), failed.cast(target)).otherwise(cast)


def align_to(df: DataFrame, schema: StructType, by_position: bool = True) -> DataFrame:
    """Shape `df` like an `INSERT INTO target SELECT ...`.

    `by_position=True` is SQL insert semantics: the i-th input column feeds the
    i-th target column, whatever its name. `by_position=False` matches by name.
    Each value is cast to the target type (`fitted`); the output carries target names.
    """
    if by_position and len(df.columns) != len(schema.fields):
        raise ValueError(f"insert needs {len(schema.fields)} columns, got {len(df.columns)}")
    sources = df.columns if by_position else [f.name for f in schema.fields]
    return df.select(*[fitted(F.col(f"`{src}`"), df.schema[src].dataType, f.dataType, f.name).alias(f.name)
                       for src, f in zip(sources, schema.fields)])
