"""Streaming queries of the catalogue.

Each query derives its input feed from the driver tables with Spark, writes
it as several files into a fresh folder under the shared root, runs the
streaming job over it with `availableNow` in bounded micro-batches, and
returns the job's output table. The result must equal the batch answer on
the end state, which the oracle SQL computes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)
from pyspark.errors import StreamingQueryException

from ..session import scratch_path
from ..operators.changelog import current_state
from ..sources import tables as tb
from ..sources.handover import ORDER, ChunkedSnapshot, even_bounds, handover
from ..sources.positions import GroupOffsets, from_positions, log_range, next_positions, start_positions
from ..sources.streams import read_changelog
from ..spec import GENDER_ROW
from ..streaming.jobs import ingest, replicate, run_until_done, start_append, start_foreach_batch
from ..streaming.keyed import KeyedReplica
from ..streaming.kinds import row_kinds
from ..streaming.state import keyed_state
from ..streaming.stop import StopAtBad
from ..streaming.join import KeyedJoin, Side
from ..streaming.topn import TopN
from .catalog import TOP_N, envelopes, text_lines
from .oracle import ORACLE_SQL

FILES_PER_FEED = 4
STATE_PARTS = 8  # partitions of the streaming queries' state, and files of a batch that they write
FEED_SCHEMA = StructType([
    StructField("side", StringType()), StructField("id", LongType()), StructField("op", StringType()),
    StructField("gender", StringType()), StructField("name", StringType()),
    StructField("score", DoubleType()), StructField("ts", TimestampNTZType()),
    StructField("pos", LongType())])
SIDES = [Side("t1", ("gender",)), Side("t2", ("name",)), Side("t3", ("score",))]
# Which event types change which stand-in table.
T1_EVENTS = ("signup", "view", "error")
T2_EVENTS = ("signup", "click", "error")
T3_EVENTS = ("click", "purchase", "error")


def _snapshot_ts():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _wide(df: DataFrame, side: str, **cols) -> DataFrame:
    out = []
    for f in FEED_SCHEMA.fields:
        if f.name == "side":
            out.append(F.lit(side).alias("side"))
        elif f.name in cols:
            out.append(cols[f.name].cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def join_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Change feeds of t1, t2, t3: a snapshot of customer, then events as changes.

    t1 (gender): events signup/view set the group to the event type (rows move
    between groups), error deletes. t2 (name): signup/click set the name to the
    event type and number, error deletes. t3 (score): click/purchase set the
    score to the event value, error deletes. Snapshot rows sort before changes.
    """
    cust = tb.table(spark, sf_dir, "customer")
    feed = tb.change_feed(spark, sf_dir)
    snap = dict(op=F.lit("r"), ts=_snapshot_ts(), pos=F.col("c_custkey"), id=F.col("c_custkey"))
    chg = dict(op=F.col("op"), ts=F.col("ts"), pos=F.col("pos"), id=F.col("id"))
    f1 = _wide(cust, "t1", gender=F.col("c_mktsegment"), **snap).unionByName(
        _wide(feed.where(F.col("event_type").isin(*T1_EVENTS)), "t1", gender=F.col("event_type"), **chg))
    name = F.concat_ws("#", "event_type", "pos")
    f2 = _wide(cust, "t2", name=F.col("c_name"), **snap).unionByName(
        _wide(feed.where(F.col("event_type").isin(*T2_EVENTS)), "t2", name=name, **chg))
    f3 = _wide(cust, "t3", score=F.col("c_acctbal"), **snap).unionByName(
        _wide(feed.where(F.col("event_type").isin(*T3_EVENTS)), "t3", score=F.col("value"), **chg))
    return {"t1": f1, "t2": f2, "t3": f3}


def _write_files(df: DataFrame, path: str, fmt: str = "parquet", order=("ts", "pos")) -> None:
    """Write a feed as FILES_PER_FEED files, each a contiguous range of the change order."""
    df.repartitionByRange(FILES_PER_FEED, *order).write.format(fmt).save(path)


def _write_in_order(df: DataFrame, path: str) -> None:
    """Write a feed as FILES_PER_FEED files one after the other, each behind the ones before in (ts, pos)."""
    at = F.timestamp_diff("MICROSECOND", _snapshot_ts(), F.col("ts"))
    cuts = df.agg(F.percentile_approx(at, [i / FILES_PER_FEED for i in range(1, FILES_PER_FEED)]).alias("c")).first()["c"] or []
    edges = [None, *cuts, None]
    for lower, upper in zip(edges[:-1], edges[1:]):
        part = df if lower is None else df.where(at >= lower)
        (part if upper is None else part.where(at < upper)).coalesce(1).write.mode("append").parquet(path)


def _feed_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run_join(spark: SparkSession, sf_dir: str, root: str) -> KeyedJoin:
    """Snapshot and changes of three tables -> the joined table: a batch of snapshots, then batches of changes."""
    for side, df in join_feeds(spark, sf_dir).items():
        df.where(F.col("op") == "r").coalesce(1).write.parquet(f"{root}/feeds/{side}/part=0")
        df.where(F.col("op") != "r").repartitionByRange(FILES_PER_FEED, "ts", "pos").write.parquet(f"{root}/feeds/{side}/part=1")
    job = KeyedJoin(spark, f"{root}/state", SIDES, FEED_SCHEMA)
    schema = StructType([*FEED_SCHEMA.fields, StructField("part", LongType())])
    feeds = [_feed_stream(spark, f"{root}/feeds/{s.name}", schema).drop("part") for s in SIDES]
    run_until_done(job.start(feeds, f"{root}/checkpoint-join", STATE_PARTS, available_now=True))
    return job


def q_stream_join3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_join(spark, sf_dir, scratch_path(spark, "join3")).current().select("id", "name", "gender", "score")


def run_topn(spark: SparkSession, sf_dir: str) -> TopN:
    """The joined table's updates -> the top N of each group, batch by batch as the join wrote them."""
    root = scratch_path(spark, "topn")
    joined = run_join(spark, sf_dir, root)
    job = TopN(spark, f"{root}/state", joined.row_schema, "gender", "score", TOP_N, shards=STATE_PARTS)
    run_until_done(job.start(joined.updates(files_per_batch=STATE_PARTS), f"{root}/checkpoint-topn", STATE_PARTS, available_now=True))
    return job


def q_stream_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_topn(spark, sf_dir).top().select("id", "name", "gender", "score", "rn")


def q_stream_parse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines -> typed rows -> temp view -> SQL -> file sink, in micro-batches."""
    root = scratch_path(spark, "parse_lines")
    text_lines(spark, sf_dir).repartitionByRange(FILES_PER_FEED, "pos").select("value") \
        .write.text(f"{root}/text")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{root}/text")
    (rows, bad), _ = ingest(stream, GENDER_ROW, view="gender_rows", sql="select * from gender_rows", on_bad="divert")
    run_until_done(start_append(rows, f"{root}/out", f"{root}/checkpoint", available_now=True))
    run_until_done(start_append(bad, f"{root}/rejects", f"{root}/checkpoint-rejects", available_now=True))
    return spark.read.parquet(f"{root}/out")


def q_stream_replicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes (JSON lines) -> keyed replica, deletes included."""
    root = scratch_path(spark, "replicate")
    env = envelopes(spark, sf_dir)
    (env.withColumn("pos", F.get_json_object("value", "$.source.pos").cast("long"))
        .repartitionByRange(FILES_PER_FEED, "pos").select("value").write.text(f"{root}/changes"))
    row = StructType([StructField("id", LongType()), StructField("event_type", StringType()),
                      StructField("value", DoubleType())])
    stream = read_changelog(spark.readStream.option("maxFilesPerTrigger", 1).text(f"{root}/changes"), row)
    rep = KeyedReplica(spark, f"{root}/state", row, "id", order=("ts_ms", "file", "pos"),
                       order_types={"ts_ms": LongType(), "file": StringType(), "pos": LongType()}, buckets=16)
    run_until_done(replicate(stream, rep, f"{root}/checkpoint", available_now=True))
    return rep.current()


def q_stream_upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines "id,name" upserted into a keyed table; batch 1 crashes after its write and is replayed."""
    root = scratch_path(spark, "upsert_replay")
    ev = tb.table(spark, sf_dir, "events")
    lines = ev.select(F.concat(F.col("user_id").cast("string"), F.lit(","), F.col("event_type")).alias("value"),
                      F.col("event_id").alias("pos"))
    _write_files(lines, f"{root}/lines", order=("pos",))
    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    rep = KeyedReplica(spark, f"{root}/state", schema, "id", order=("pos",),
                       order_types={"pos": LongType()}, buckets=16)
    snap = tb.t2(spark, sf_dir).select("id", "name", F.lit("r").alias("op"), F.lit(-1).cast("long").alias("pos"))
    rep.initialize(snap)
    src = spark.readStream.schema("value string, pos long").option("maxFilesPerTrigger", 1) \
        .parquet(f"{root}/lines")

    crashed = []

    def crash_once(step: str, batch_id: int) -> None:
        if batch_id == 1 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("injected crash after the table write of batch 1")

    rep.fault = crash_once
    ck = f"{root}/checkpoint"
    try:
        run_until_done(ingest(src, schema, sink=rep.process, checkpoint=ck, available_now=True)[1])
    except StreamingQueryException:
        pass
    rep.fault = None
    run_until_done(ingest(src, schema, sink=rep.process, checkpoint=ck, available_now=True)[1])
    if not crashed:
        raise AssertionError("the replay path was not exercised")
    return rep.current()


def _events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a table (id, name), positioned by event_id: events set the name, error deletes."""
    feed = tb.change_feed(spark, sf_dir)
    return feed.select("id", F.concat_ws("#", "event_type", "pos").alias("name"), "op", "pos")


def q_stream_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot in chunks while the table changes, out of order, then its live changes -> replica."""
    root = scratch_path(spark, "handover")
    log = _events_log(spark, sf_dir)
    base = tb.t2(spark, sf_dir).select("id", "name", F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("pos"))
    top = log.agg(F.max("pos")).first()[0]
    chunks = 4
    clock = {"at": 0}

    def position() -> int:
        """The log goes on between a chunk's two looks at it and between chunks."""
        clock["at"] += top // (3 * chunks)
        return clock["at"]

    def read_chunk(bound) -> DataFrame:
        now = clock["at"] + top // (6 * chunks)
        return current_state(base.unionByName(log.where(F.col("pos") <= now)), "id", ("pos",), value_cols=["name"])

    row = StructType([StructField("id", LongType()), StructField("name", StringType())])
    snap = ChunkedSnapshot(spark, root, row, "id", even_bounds(base, "id", chunks), read_chunk, position)
    snap.run(order=[2, 0])
    snap.run(order=[3, 1, 0])  # as after a restart: chunk 0 is not read again
    _write_files(log, f"{root}/log", order=("pos",))
    live = _feed_stream(spark, f"{root}/log", StructType([*row.fields, StructField("op", StringType()), StructField("pos", LongType())]))
    rep = KeyedReplica(spark, f"{root}/state", row, "id", order=ORDER, order_types={"pos": LongType(), "seq": IntegerType()})
    run_until_done(replicate(handover(snap, live, files_per_batch=4), rep, f"{root}/checkpoint", available_now=True))
    return rep.current()


def q_stream_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed as a changelog with row kinds, in micro-batches."""
    root = scratch_path(spark, "changelog")
    feed = tb.change_feed(spark, sf_dir)
    _write_in_order(feed, f"{root}/feed")
    stream = _feed_stream(spark, f"{root}/feed", feed.schema)
    with keyed_state(spark, STATE_PARTS):
        query = start_append(row_kinds(stream, "id", ("event_type", "value"), ("ts", "pos"), shards=STATE_PARTS), f"{root}/out", f"{root}/checkpoint",
                             available_now=True)
    run_until_done(query)
    return spark.read.parquet(f"{root}/out")


def q_stream_stop_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with two bad ones: what is committed at the stop, and once both are skipped."""
    root = scratch_path(spark, "stop_resume")
    cust = tb.t1(spark, sf_dir)
    top = cust.agg(F.max("id")).first()[0]
    bad = F.col("id").isin(top // 3, 2 * top // 3)
    lines = cust.select(F.when(bad, F.lit("x")).otherwise(F.concat(F.col("id").cast("string"), F.lit(","), F.col("gender"))).alias("value"),
                        (F.col("id") % 2).alias("partition"), F.col("id").alias("pos"))
    lines.coalesce(1).write.parquet(f"{root}/lines")
    row = StructType([StructField("id", LongType()), StructField("gender", StringType())])
    rep = KeyedReplica(spark, f"{root}/state", row, "id", order=("pos",), order_types={"pos": LongType()})
    job = StopAtBad(spark, root, row, rep.process)

    def run() -> None:
        run_until_done(start_foreach_batch(_feed_stream(spark, f"{root}/lines", lines.schema), job.process, f"{root}/checkpoint", available_now=True))

    try:
        run()
    except StreamingQueryException:
        pass
    write = f"{root}/stopped"
    rep.current().select(F.lit("stopped").alias("stage"), "id", "gender").write.parquet(write)
    job.skip(job.stopped_at())
    try:
        run()
    except StreamingQueryException:  # where both bad lines are in one partition
        job.skip(job.stopped_at())
        run()
    return spark.read.parquet(write).unionByName(rep.current().select(F.lit("done").alias("stage"), "id", "gender"))


def q_stream_start_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three groups over one partitioned log: no offsets and earliest, offsets of half of the log, no offsets and latest."""
    root = scratch_path(spark, "positions")
    ev = tb.table(spark, sf_dir, "events").select((F.col("event_id") % 4).cast("int").alias("partition"),
                                                  F.floor(F.col("event_id") / 4).cast("bigint").alias("pos"), F.col("event_type").alias("value"))
    ev.write.partitionBy("partition").parquet(f"{root}/log")
    log = spark.read.schema("pos long, value string, partition int").parquet(f"{root}/log")
    bounds, out = log_range(log), []
    half = GroupOffsets(spark, root, "half")
    read = from_positions(log, start_positions(bounds, half.committed("events"), "earliest")).where(
        F.col("pos") * 2 < F.lit(max(after for _, after in bounds.values())))
    half.commit("events", next_positions(read))
    for group, default in (("new", "earliest"), ("half", "latest"), ("tail", "latest")):
        starts = start_positions(bounds, GroupOffsets(spark, root, group).committed("events"), default)
        stream = from_positions(spark.readStream.schema(log.schema).parquet(f"{root}/log"), starts)
        run_until_done(start_append(stream, f"{root}/out/{group}", f"{root}/checkpoint-{group}", available_now=True))
        out.append(spark.read.schema(log.schema).parquet(f"{root}/out/{group}").select(F.lit(group).alias("group_id"), "partition", "pos", "value"))
    return out[0].unionByName(out[1]).unionByName(out[2])


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_parse_lines": q_stream_parse_lines,
    "stream_replicate": q_stream_replicate,
    "stream_join3": q_stream_join3,
    "stream_topn": q_stream_topn,
    "stream_upsert_replay": q_stream_upsert_replay,
    "stream_handover": q_stream_handover,
    "stream_changelog": q_stream_changelog,
    "stream_stop_resume": q_stream_stop_resume,
    "stream_start_positions": q_stream_start_positions,
}

_FEED_STATE = """
f1 as (select c_custkey id, c_mktsegment gender, 'r' op, TIMESTAMP '1970-01-01 00:00:00' ts, c_custkey pos
       from customer
       union all
       select user_id, event_type, case when event_type = 'error' then 'd' else 'u' end, ts, event_id
       from events where event_type in ('signup', 'view', 'error')),
f2 as (select c_custkey id, c_name "name", 'r' op, TIMESTAMP '1970-01-01 00:00:00' ts, c_custkey pos
       from customer
       union all
       select user_id, event_type || '#' || event_id, case when event_type = 'error' then 'd' else 'u' end, ts, event_id
       from events where event_type in ('signup', 'click', 'error')),
f3 as (select c_custkey id, c_acctbal score, 'r' op, TIMESTAMP '1970-01-01 00:00:00' ts, c_custkey pos
       from customer
       union all
       select user_id, value, case when event_type = 'error' then 'd' else 'u' end, ts, event_id
       from events where event_type in ('click', 'purchase', 'error')),
s1 as (select id, gender from (select *, row_number() over (partition by id order by ts desc, pos desc) k
                               from f1) z where k = 1 and op <> 'd'),
s3 as (select id, score from (select *, row_number() over (partition by id order by ts desc, pos desc) k
                              from f3) z where k = 1 and op <> 'd'),
s2 as (select id, "name" from (select *, row_number() over (partition by id order by ts desc, pos desc) k
                               from f2) z where k = 1 and op <> 'd'),
j as (select s1.id, name, gender, score from s1 join s2 on s1.id = s2.id join s3 on s1.id = s3.id)"""

STREAM_ORACLE_SQL: dict[str, str] = {
    "stream_parse_lines": ORACLE_SQL["parse_id_text"],
    "stream_replicate": """
        select user_id id, event_type, value
        from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) k
              from events) z
        where k = 1 and event_type <> 'error'""",
    "stream_join3": f"with {_FEED_STATE} select * from j",
    "stream_topn": f"""with {_FEED_STATE}
        select * from (select id, name, gender, score,
                              cast(row_number() over (partition by gender order by score desc nulls last, id) as bigint) rn
                       from j) t where rn <= 2""",
    "stream_upsert_replay": """
        with src as (select user_id id, event_type name
                     from (select *, row_number() over (partition by user_id order by event_id desc) k
                           from events) z where k = 1)
        select c_custkey id, c_name name from customer where c_custkey not in (select id from src)
        union all select id, name from src""",
    "stream_handover": """
        with last as (select user_id id, event_type || '#' || event_id "name", event_type
                      from (select *, row_number() over (partition by user_id order by event_id desc) k from events) z where k = 1)
        select c_custkey id, c_name "name" from customer where c_custkey not in (select id from last)
        union all select id, "name" from last where event_type <> 'error'""",
    "stream_changelog": """
        with e as (select user_id id, event_type, value, ts, event_id pos,
                          lag(event_type) over w p_type, lag(value) over w p_value,
                          coalesce(lag(event_type) over w, 'error') <> 'error' was, event_type <> 'error' live
                   from events window w as (partition by user_id order by ts, event_id))
        select '+I' kind, id, event_type, value, ts, pos from e where live and not was
        union all select '-U', id, p_type, p_value, ts, pos from e where live and was
        union all select '+U', id, event_type, value, ts, pos from e where live and was
        union all select '-D', id, p_type, p_value, ts, pos from e where was and not live""",
    "stream_stop_resume": """
        with m as (select max(c_custkey) top from customer),
             l as (select c_custkey id, c_mktsegment gender, c_custkey % 2 p, c_custkey in (top // 3, 2 * top // 3) bad from customer, m),
             f as (select p, min(id) first_bad from l where bad group by p)
        select 'stopped' stage, id, gender from l left join f on l.p = f.p where not bad and (first_bad is null or id < first_bad)
        union all select 'done', id, gender from l where not bad""",
    "stream_start_positions": """
        with l as (select cast(event_id % 4 as integer) "partition", event_id // 4 pos, event_type value from events),
             h as (select max(pos) + 1 after from l)
        select 'new' group_id, "partition", pos, value from l
        union all select 'half', "partition", pos, value from l, h where pos * 2 >= after""",
}
