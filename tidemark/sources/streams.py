"""Stream sources: message-log lines, text files, change-event envelopes.

All line sources return a DataFrame with one string column `value` (plus a
position column when the source has one), batch or streaming alike, so the
same parser runs on both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.lines import fail_on
from ..operators.changelog import OP_DELETE

_CORRUPT = "_corrupt"

KAFKA_PROVIDER = "org.apache.spark.sql.kafka010.KafkaSourceProvider"


def require_kafka(spark: SparkSession) -> None:
    """Fail early, with the fix, when the Kafka connector is not on the classpath."""
    try:
        # Packages given at launch are known to the context class loader only.
        spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(KAFKA_PROVIDER)
    except Exception as e:  # py4j wraps ClassNotFoundException
        raise RuntimeError("the message-log source/sink needs the spark-sql-kafka-0-10 package "
                           "(e.g. --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>)") from e


def kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str,
                starting_offsets: str = "latest", stream: bool = True,
                extra_options: dict | None = None) -> DataFrame:
    """Value-only string records of one topic, with their log position.

    Start position: "latest" (the reference's default when a group has no
    committed offset) or "earliest". Spark keeps its position in the query's
    checkpoint, not in a consumer group: give every query its own
    checkpointLocation. Needs the spark-sql-kafka package on the classpath.
    Offsets order records only within a partition; with keyless records use
    (ts, partition, pos) as the change order of last-writer-wins upserts.
    """
    require_kafka(spark)
    reader = spark.readStream if stream else spark.read
    r = (reader.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    for k, v in (extra_options or {}).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"),
                           F.col("timestamp").alias("ts"), "partition", F.col("offset").alias("pos"))


def file_lines(spark: SparkSession, path: str, stream: bool = True,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files as a line source (`value` column): the log stand-in for tests."""
    if stream:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)
    return spark.read.text(path)


def envelope_schema(row_schema: StructType) -> StructType:
    """`before`/`after` row images, `op`, `ts_ms`, `source{file,pos}`."""
    return StructType([
        StructField("before", row_schema, True),
        StructField("after", row_schema, True),
        StructField("op", StringType(), True),
        StructField("ts_ms", LongType(), True),
        StructField("source", StructType([StructField("file", StringType(), True),
                                          StructField("pos", LongType(), True)]), True),
    ])


BAD_EVENT = "bad_event"


def read_changelog(df: DataFrame, row_schema: StructType, value_col: str = "value",
                   keep: Sequence[str] = (), on_bad: str = "fail") -> DataFrame | tuple[DataFrame, DataFrame]:
    """JSON change envelopes -> flat changelog rows (op, <row columns>, ts_ms, file, pos).

    Values come from `after` for r/c/u and from `before` for d (a delete
    carries only its old image). Batch or streaming input. A bad event is one
    that is no JSON, has a value of another type than declared, no known op, or
    no row image: "fail" fails the query, "drop" leaves it out, "divert" returns
    (changes, rejects) where rejects carry `value` and `reason`.
    """
    if on_bad not in ("fail", "divert", "drop"):
        raise ValueError(f"on_bad must be fail, divert or drop, not {on_bad!r}")
    schema = envelope_schema(row_schema).add(_CORRUPT, StringType(), True)
    e = F.from_json(F.col(value_col), schema, {"columnNameOfCorruptRecord": _CORRUPT})
    # Parsed once a row: no predicate or projection passes the generator and repeats the parse.
    staged = df.select(*keep, F.col(value_col).alias("_value"), F.inline(F.array(F.struct(e.alias("e")))))
    known = F.col("e.op").isin("r", "c", "u") & F.col("e.after").isNotNull() | (
        (F.col("e.op") == OP_DELETE) & F.col("e.before").isNotNull())
    good = F.col(f"e.{_CORRUPT}").isNull() & F.coalesce(known, F.lit(False))
    staged = staged.withColumn("_reason", F.when(~good, F.lit(BAD_EVENT)))
    parsed = fail_on(staged, "_reason", "_value") if on_bad == "fail" else staged.where("_reason is null")
    image = F.when(F.col("e.op") == OP_DELETE, F.col("e.before")).otherwise(F.col("e.after"))
    changes = parsed.select(
        *keep, F.col("e.op").alias("op"),
        *[image.getField(f.name).alias(f.name) for f in row_schema.fields],
        F.col("e.ts_ms").alias("ts_ms"), F.col("e.source.file").alias("file"),
        F.col("e.source.pos").alias("pos"))
    if on_bad == "divert":
        return changes, staged.where("_reason is not null").select(
            *keep, F.col("_value").alias("value"), F.col("_reason").alias("reason"))
    return changes


def to_envelope(changes: DataFrame, row_cols: Sequence[str], op_col: str = "op",
                ts_ms: Column | str = "ts_ms", pos: Column | str = "pos",
                file: Column | str | None = None, out: str = "value") -> DataFrame:
    """Flat changes -> JSON envelopes (the inverse of `read_changelog`)."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    image = F.struct(*[F.col(r) for r in row_cols])
    is_delete = F.col(op_col) == OP_DELETE
    env = F.struct(
        F.when(is_delete, image).alias("before"),
        F.when(~is_delete, image).alias("after"),
        F.col(op_col).alias("op"),
        c(ts_ms).cast("long").alias("ts_ms"),
        F.struct((c(file) if file is not None else F.lit(None).cast("string")).alias("file"),
                 c(pos).cast("long").alias("pos")).alias("source"))
    return changes.select(F.to_json(env).alias(out))
