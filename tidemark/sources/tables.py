"""Readers for the driver's parquet tables and the stand-ins built from them.

The reference's keyed tables live in a database it cannot share; the driver
tables stand in for them (see FIXTURES.md):
  t1 = customer (c_custkey -> id, c_mktsegment -> gender)
  t2 = customer (c_custkey -> id, c_name -> name)
  t3 = customer (c_custkey -> id, c_acctbal -> score)
  change feed = events (user_id -> id, event_type 'error' = delete, order (ts, event_id))
Every reader selects only the columns it needs so the scan is pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The change-feed encoding of the events stand-in.
DELETE_EVENT = "error"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def t1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("gender"))


def t2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def t3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("score"))


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a keyed change feed: (id, op, event_type, value, ts, pos).

    op is 'd' for an error event and 'u' (upsert) otherwise; (ts, pos) orders changes.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("id"),
        F.when(F.col("event_type") == DELETE_EVENT, F.lit("d")).otherwise(F.lit("u")).alias("op"),
        "event_type", "value", "ts", F.col("event_id").alias("pos"))


def feed_cut(feed: DataFrame, share_num: int = 1, share_den: int = 2,
             pos_col: str = "pos") -> DataFrame:
    """The prefix of a change feed up to a share of its position range.

    `pos * den < max(pos) * num + num`, i.e. the first num/den of positions 0..max.
    Used to take the state "before" a change set; the max is a scalar subquery.
    """
    return feed.where(before_cut(feed, share_num, share_den, pos_col))


def before_cut(feed: DataFrame, share_num: int = 1, share_den: int = 2, pos_col: str = "pos") -> Column:
    """Whether a change lies in the prefix that `feed_cut` takes."""
    top = feed.agg(F.max(pos_col)).scalar()
    return F.col(pos_col) * share_den < (F.lit(top) + 1) * share_num


def rank_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
