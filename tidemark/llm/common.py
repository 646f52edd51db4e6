"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: the contracts' word
CHUNK_CHARS = 1 << 20  # text that a task holds as words at a time
_WRITTEN: ContextVar[list | None] = ContextVar("tidemark_scratch", default=None)  # tables of the current `scratch_scope`


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo `mod`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def write_scratch(df: DataFrame, name: str, **options) -> DataFrame:
    """Cut lineage: write a table into the shared folder and read it back.

    The table outlives lost executors. `options` go to its writer. Shuffle files of the write are removed
    when it ends, so that a chain of steps holds only one step's shuffles.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(key, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    if _WRITTEN.get() is not None:
        _WRITTEN.get().append(out)
    return out


@contextmanager
def scratch_scope() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """On leaving, drops the tables that `write_scratch` wrote inside, but for those passed to the function it gives."""
    written, kept = [], []
    outer = _WRITTEN.set(written)
    try:
        yield lambda df: kept.append(df) or df
    finally:
        _WRITTEN.reset(outer)
        drop_scratch(*(t for t in written if not any(t is k for k in kept)))
        if _WRITTEN.get() is not None:
            _WRITTEN.get().extend(kept)


def drop_scratch(*tables: DataFrame) -> None:
    """Delete tables of `write_scratch` that no later step reads; others are left alone."""
    for df in tables:
        path = getattr(df, "_scratch", None) if "_scratch" not in df.columns else None
        if path:
            p = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict]]],
                schema: StructType | str) -> DataFrame:
    """`mapInArrow` with state: `make()` runs once a task and returns the batch function.

    The batch function yields dicts of column -> values (lists or numpy arrays).
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        fn = make()
        for batch in batches:
            for out in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def text_chunks(texts: list[str | None], max_chars: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `max_chars` characters; a longer text is a range of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and size + n > max_chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column,
                    per_class: int, max_chars: int) -> DataFrame:
    """A bounded, repeatable sample of labelled rows: (doc_id, text, label).

    For each label value, however many there are, the `per_class` rows of
    smallest id hash among those with a null-free id, text and label, `learn`
    true and at most `max_chars` characters. A label without such rows has its
    shortest texts: one, and more up to per_class x max_chars characters. A
    document labelled several times has its largest label. The sample holds at
    most per_class x labels x max_chars characters, besides single longer texts.
    """
    marked = (labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("_label"))
              .where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
              .groupBy("_id").agg(F.max("_label").alias("_label")))
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).where(F.col("_text").isNotNull())
    near = (marked.where(learn).select("_id", "_label", F.xxhash64("_id").alias("_h")))
    lengths = rows.groupBy("_id").agg(F.min(F.length("_text")).alias("_len"))
    pool = write_scratch(near.join(lengths, "_id").withColumn("_part", F.shiftright("_h", 54)), "sample-pool")
    usual = pool.where(F.col("_len") <= max_chars)
    # Ranges of the hash are counted, and only rows of those up to the per_class-th row are ranked: no task has a whole label.
    ahead = Window.partitionBy("_label").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = usual.groupBy("_label", "_part").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).where(F.col("_ahead") < per_class)
    nth = F.row_number().over(Window.partitionBy("_label").orderBy("_h", "_id"))
    picked = usual.join(parts.select("_label", "_part"), ["_label", "_part"], "left_semi").withColumn("_nth", nth).where(
        F.col("_nth") <= per_class).select("_id", "_label", "_len")
    # Labels with long texts only.
    by_length = ("_len", "_h", "_id")
    some = F.row_number().over(Window.partitionBy("_label", "_part").orderBy(*by_length))
    nth = F.row_number().over(Window.partitionBy("_label").orderBy(*by_length))
    upto = F.sum("_len").over(Window.partitionBy("_label").orderBy(*by_length).rowsBetween(Window.unboundedPreceding, 0))
    most = F.least(F.lit(per_class), F.greatest(F.floor(F.lit(per_class) * F.lit(max_chars) / F.col("_least")), F.lit(1)))
    least = pool.groupBy("_label").agg(F.min("_len").alias("_least")).where(F.col("_least") > max_chars)
    longer = pool.join(least, "_label").withColumn("_nth", some).where(F.col("_nth") <= most)
    longer = longer.withColumn("_nth", nth).withColumn("_upto", upto).where(
        (F.col("_nth") == 1) | ((F.col("_nth") <= per_class) & (F.col("_upto") <= per_class * max_chars)))
    picked = picked.unionByName(longer.select("_id", "_label", "_len"))
    # At most per_class rows for each label, and of three numbers each.
    return (rows.join(F.broadcast(picked), "_id").where(F.length("_text") <= F.greatest(F.col("_len"), F.lit(max_chars)))
            .dropDuplicates(["_id"]).orderBy("_id")
            .select(F.col("_id").alias("doc_id"), F.col("_text").alias("text"), F.col("_label").alias("label")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def sf_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
