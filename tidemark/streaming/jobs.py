"""Streaming jobs: wiring sources, operators and keyed sinks into queries.

Conventions (the reference's checkpoint settings, in Spark terms):
* every query has its own checkpoint folder under the shared root
  (`spark.checkpoint.dir`): `<root>/tidemark/checkpoints/<job>`;
* the default trigger is every 2 seconds; tests and backfills use
  `available_now=True` (process everything there is, in bounded batches, stop);
* no watermark: nothing in these jobs uses event time, nothing is late.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_root

CHECKPOINT_INTERVAL = "2 seconds"
FINISHED: deque = deque(maxlen=64)  # (query name, seconds of its batches) of the last queries that ended


def checkpoint_location(spark: SparkSession, job: str) -> str:
    return f"{shared_root(spark)}/tidemark/checkpoints/{job}"


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def start_foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                        name: str | None = None, available_now: bool = False,
                        interval: str = CHECKPOINT_INTERVAL, mode: str = "append") -> StreamingQuery:
    """Run `fn(batch, batch_id)` per micro-batch (keyed sinks; the updates of a query with state)."""
    w = stream.writeStream.outputMode(mode).foreachBatch(fn).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return _trigger(w, available_now, interval).start()


def start_append(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 available_now: bool = False, interval: str = CHECKPOINT_INTERVAL) -> StreamingQuery:
    """Append-only file sink (exactly-once through the sink's own log)."""
    w = (stream.writeStream.format(fmt).outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    return _trigger(w, available_now, interval).start()


def start_preview(stream: DataFrame, rows: int = (1 << 31) - 1, available_now: bool = False,
                  interval: str = CHECKPOINT_INTERVAL) -> StreamingQuery:
    """Print each micro-batch, all rows (`rows` shortens the preview of a large stream)."""
    w = stream.writeStream.format("console").option("numRows", rows).option("truncate", False)
    return _trigger(w, available_now, interval).start()


def start_log_sink(lines: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str,
                   available_now: bool = False, interval: str = CHECKPOINT_INTERVAL) -> StreamingQuery:
    """Lines (`value` column) to a message-log topic, value only, at-least-once.

    Needs the spark-sql-kafka package at deploy time.
    """
    from ..sources.streams import require_kafka
    require_kafka(lines.sparkSession)
    w = (lines.select("value").writeStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, available_now, interval).start()


def run_until_done(query: StreamingQuery) -> None:
    """Wait for an availableNow query; re-raise its failure."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise exc
    FINISHED.append((query.name, batch_seconds(query)))


# ---------------------------------------------------------------- the four job shapes

# The three producers' topics, value generators and separators.
PRODUCERS = {
    "test1": ("gender", ", "),
    "test2": ("name", ", "),
    "test3": ("score", ","),
}


def producer_lines(spark: SparkSession, topic: str, rows_per_second: int = 1,
                   rows_per_batch: int | None = None) -> DataFrame:
    """The generated line stream of one producer: "<n><sep><value>" for n = 1, 2, 3, ...

    `rows_per_second` uses the `rate` source (a live producer); `rows_per_batch`
    the `rate-micro-batch` source (fixed-size batches, usable with availableNow).
    """
    from ..functions import generate as gen
    from ..functions.lines import format_lines
    kind, sep = PRODUCERS[topic]
    if rows_per_batch:
        src = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
    else:
        src = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    ids = src.select((F.col("value") + 1).alias("id"))
    value = {"gender": gen.gender_col, "name": gen.name_col, "score": gen.score_col}[kind]("id")
    return format_lines(ids.select("id", value.alias(kind)), "id", kind, sep)


def produce(spark: SparkSession, topic: str, bootstrap_servers: str, rows_per_second: int = 1,
            available_now: bool = False) -> StreamingQuery:
    """Producer job: generated lines -> message-log topic (value only, at-least-once)."""
    return start_log_sink(producer_lines(spark, topic, rows_per_second), bootstrap_servers, topic,
                          checkpoint_location(spark, f"produce-{topic}"), available_now=available_now)


def ingest(lines: DataFrame, schema, sink: Callable[[DataFrame, int], None] | None = None,
           view: str | None = None, sql: str | None = None, on_bad: str = "fail",
           keep: tuple[str, ...] = ("ts", "partition", "pos"), checkpoint: str | None = None,
           available_now: bool = False, rejects: Callable[[DataFrame, int], None] | None = None,
           op: str | None = "u") -> tuple[DataFrame | tuple[DataFrame, DataFrame], StreamingQuery | None]:
    """Consumer job: lines -> typed rows -> (view + SQL) -> keyed sink.

    Returns the typed stream and, when a sink is given, the running query.
    `sink(batch, batch_id)` is e.g. `KeyedReplica.process` or a JDBC sink;
    rows carry `keep` columns (log positions) for last-writer-wins upserts, and
    `op` (each line is an upsert) unless that is None or the rows have one.
    With on_bad="divert", `rejects(batch, batch_id)` gets each batch's bad lines
    before the sink gets its rows; without a sink the typed stream is returned
    as (rows, rejects).
    """
    from ..functions.lines import parse_lines
    keep = tuple(c for c in keep if c in lines.columns)

    def typed(source: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        rows, bad = parse_lines(source, schema, on_bad=on_bad, keep=keep), None
        if on_bad == "divert":
            rows, bad = rows
        if view:
            rows.createOrReplaceTempView(view)
            if sql:
                rows = rows.sparkSession.sql(sql)
        if op is not None and sink is not None and "op" not in rows.columns:
            rows = rows.withColumn("op", F.lit(op))
        return rows, bad

    if sink is None:
        rows, bad = typed(lines)
        return (rows if bad is None else (rows, bad)), None
    if checkpoint is None:
        raise ValueError("a sink needs its own checkpoint location")
    if on_bad != "divert":
        rows, _ = typed(lines)
        return rows, start_foreach_batch(rows, sink, checkpoint, available_now=available_now)
    if rejects is None:
        raise ValueError('on_bad="divert" needs a rejects sink; use "drop" to leave bad lines out')

    def both(batch: DataFrame, batch_id: int) -> None:
        rows, bad = typed(batch)
        rejects(bad, batch_id)
        sink(rows, batch_id)

    return lines, start_foreach_batch(lines, both, checkpoint, available_now=available_now)


def replicate(changes: DataFrame, replica, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Replication job: changelog stream -> keyed replica (inserts, updates, deletes)."""
    return start_foreach_batch(changes, replica.process, checkpoint, available_now=available_now)


def batch_seconds(query: StreamingQuery) -> list[float]:
    """Seconds of each of the query's last batches that had input, as the query itself reports them."""
    return [p["durationMs"]["triggerExecution"] / 1000 for p in map(_progress, query.recentProgress) if p["numInputRows"]]


def _progress(p) -> dict:
    import json
    return json.loads(p.json) if hasattr(p, "json") and isinstance(p.json, str) else dict(p)
