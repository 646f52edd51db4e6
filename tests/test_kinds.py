"""Row kinds of a running query equal those of a replay in Python."""

import math
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from model import random_changes
from tidemark.streaming.jobs import run_until_done, start_append
from tidemark.streaming.kinds import row_kinds
from tidemark.streaming.state import keyed_state, pack, unpack

SCHEMA = StructType([StructField("id", LongType()), StructField("op", StringType()), StructField("g", StringType()),
                     StructField("ts", LongType()), StructField("pos", LongType())])


def model(changes):
    out, live = [], {}
    for i, op, g, ts, pos in changes:
        was = i in live
        if op == "d":
            if was:
                out.append(("-D", i, live.pop(i), ts, pos))
            continue
        if was:
            out.append(("-U", i, live[i], ts, pos))
        out.append(("+U" if was else "+I", i, g, ts, pos))
        live[i] = g
    return out


def test_row_kinds_over_restarts(spark, scratch):
    root = scratch("kinds")
    changes = [(c[1], c[2], c[3], c[6], c[7]) for c in random_changes(7, n=200, ids=9, sides=("t1",))]
    late = [(changes[0][0], "u", "late", -1, -1), (None, "u", "x", 900, 900), (1, "u", "x", None, 901)]
    for k, part in enumerate([changes[:80], changes[80:81], [*changes[81:], *late], late]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        with keyed_state(spark, 2):
            q = start_append(row_kinds(stream, "id", ("g",), shards=3), f"{root}/out", f"{root}/ck", available_now=True)
        run_until_done(q)
    got = [tuple(r) for r in spark.read.parquet(f"{root}/out").collect()]
    assert sorted(got, key=str) == sorted(model(changes), key=str)


def test_a_batch_reaches_the_state_in_blocks(spark, scratch):
    """Rows cross to a shard's state as Arrow blocks; their values, null and not a number included, as they are."""
    rows = spark.range(3000, numPartitions=2).selectExpr("id", "id * 7 as x")
    blocks = pack(rows, F.col("id") % 3)
    assert blocks.count() <= 6 and unpack(blocks, rows.schema).orderBy("id").collect() == rows.orderBy("id").collect()

    root = scratch("blocks")
    schema = "id long, op string, big long, x double, t timestamp, ts timestamp_ntz"
    at = [datetime(2024, 1, 1, 0, 0, k, 5) for k in range(3)]
    data = [(1, "u", 2 ** 60 + 1, None, at[0], at[0]), (1, None, None, math.nan, None, at[1]), (1, "d", 3, 3.0, None, at[2])]
    for r in data:
        spark.createDataFrame([r], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    with keyed_state(spark, 2):
        kinds = row_kinds(stream, "id", ("big", "x", "t"), ("ts",), shards=3)
        assert "block" in kinds._jdf.queryExecution().analyzed().toString()
        run_until_done(start_append(kinds, f"{root}/out", f"{root}/ck", available_now=True))
    got = sorted(map(str, (tuple(r) for r in spark.read.parquet(f"{root}/out").collect())))
    first, second = (2 ** 60 + 1, None, at[0]), (None, math.nan, None)
    want = [("+I", 1, *first, at[0]), ("-U", 1, *first, at[1]), ("+U", 1, *second, at[1]), ("-D", 1, *second, at[2])]
    assert got == sorted(map(str, want))
