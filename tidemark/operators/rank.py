"""Ranking within a group and top-N per group.

Order is `order_col DESC NULLS LAST` with the key ascending as tie-break, so
equal scores rank the same way in every run and every engine. The rank is a
bigint, as the result table declares it.

Plan shape for `top_n_per_group`: Catalyst turns `row_number() ... <= n` into a
WindowGroupLimit that keeps n rows per group in every map task before the
exchange, and again after it. A group holding a third of all rows therefore
ships at most n rows per map task, never the group itself. For an `n` beyond
Catalyst's limit a distributed selection does the same: histograms find a value
of each group that its n-th row cannot be behind, and only rows up to it are
ranked, by ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType

from ..session import ensure_checkpoint_dir


def order_spec(order_col: str, key: str | tuple[str, ...] = "id", descending: bool = True) -> list[Column]:
    keys = (key,) if isinstance(key, str) else tuple(key)
    first = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    return [first, *[F.col(k).asc_nulls_last() for k in keys]]


def row_number_by_group(df: DataFrame, group: str, order_col: str, key: str = "id",
                        descending: bool = True, rank_col: str = "rn", method: str = "range",
                        num_partitions: int | None = None,
                        max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Full ranking: every row gets its 1-based position within its group.

    method="window": one window partitioned by the group. Every row of a group
      goes to one task; right only when groups are many and bounded in size.
    method="range" (default): skew-safe. Rows are range-partitioned on
      (group, order, key), so one large group spreads over many partitions,
      and sorted within each. A partition's rows of one group are then
      contiguous, and `monotonically_increasing_id` numbers them consecutively.
      rn = (rows of the group in earlier partitions) + (position in this
      partition). The numbered rows are checkpointed to the shared checkpoint
      folder (one pass, lineage cut, safe against lost executors). The offsets
      come from a count per (group, partition): at most #groups + #partitions
      rows. They are counted, and broadcast only when under
      `max_broadcast_rows`; otherwise a shuffle join is used.
    """
    if method == "window":
        w = Window.partitionBy(group).orderBy(*order_spec(order_col, key, descending))
        return df.withColumn(rank_col, F.row_number().over(w).cast("long"))
    if method != "range":
        raise ValueError("method must be 'range' or 'window'")
    spark = df.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spec = [F.col(group).asc_nulls_first(), *order_spec(order_col, key, descending)]
    ensure_checkpoint_dir(spark)
    numbered = (df.repartitionByRange(parts, *spec).sortWithinPartitions(*spec)
                  .withColumn("_m", F.monotonically_increasing_id())
                  .withColumn("_p", F.shiftright(F.col("_m"), 33))
                  .checkpoint(eager=True))
    counts = numbered.groupBy(F.col(group).alias("_g"), "_p").agg(
        F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_g", F.col("_p").alias("_q"), "_m0",
                            F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off")) \
        .checkpoint(eager=True)  # small; cut here too, so the final plan is two scans and a join
    if offsets.count() <= max_broadcast_rows:
        offsets = F.broadcast(offsets)
    joined = numbered.join(offsets, (F.col("_p") == F.col("_q")) & F.col(group).eqNullSafe(F.col("_g")))
    rn = (F.col("_off") + (F.col("_m") - F.col("_m0")) + 1).cast("long")
    return joined.select(*df.columns, rn.alias(rank_col))


BINS, ROUNDS = 1024, 2  # of a selection: each round cuts the range that holds the n-th row to one of the bins


def group_limit(spark: SparkSession) -> int:
    """The least n for which Catalyst does not limit the rows of a group before the exchange."""
    return int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def top_n_per_group(df: DataFrame, group: str, order_col: str, n: int, key: str = "id",
                    descending: bool = True, rank_col: str = "rn", method: str | None = None) -> DataFrame:
    """Rows ranked 1 to n of each group.

    method="window" relies on Catalyst's group limit, "select" on `selected`; by
    default the first where it applies to this n. Both give the same rows.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    if method not in (None, "window", "select"):
        raise ValueError("method must be 'window' or 'select'")
    if (method or ("window" if n < group_limit(df.sparkSession) else "select")) == "window":
        ranked = row_number_by_group(df, group, order_col, key, descending, rank_col, method="window")
    else:
        ranked = row_number_by_group(selected(df, group, order_col, n, descending), group, order_col, key, descending, rank_col)
    return ranked.where(F.col(rank_col) <= n)


def _number(column: Column, kind: DataType) -> Column | None:
    """A double that does not fall where the column rises; None for types without one."""
    if isinstance(kind, NumericType):
        return column.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), column).cast("double")
    return None


def selected(df: DataFrame, group: str, order_col: str, n: int, descending: bool = True) -> DataFrame:
    """The rows of `df` that can rank among the first n of their group: those and few more.

    Values fall into classes (NaN, infinities, numbers, null) and, among numbers,
    into bins of the range that still holds the n-th row; counts by group and bin
    are partial aggregates, so a group of any size is a histogram when it is
    shuffled. Ties at the cut all stay. Each round scans the group and order
    columns only. Where the order column is no number or time, all rows stay.
    """
    x = _number(F.col(order_col), df.schema[order_col].dataType)
    if x is None:
        return df
    x = x if descending else -x
    inf = float("inf")
    # Best first: the order of `order_spec`.
    kind = (F.when(x.isNull(), -1).when(F.isnan(x), 4 if descending else 0).when(x == inf, 3).when(x == -inf, 1).otherwise(2))
    rows = df.select(F.col(group).alias("_g"), x.alias("_x"), kind.alias("_k"))
    ahead = F.coalesce(F.sum("_c").over(Window.partitionBy("_g").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    extent = (F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))

    def cut(histogram: DataFrame, need: Column) -> DataFrame:
        """The bin of each group that holds the row at place `need`; groups with fewer rows have none."""
        bins = histogram.withColumn("_ahead", ahead).where((F.col("_ahead") < need) & (F.col("_ahead") + F.col("_c") >= need))
        return bins.select("_g", "_b", "_lo", "_hi", (need - F.col("_ahead")).alias("_need"))

    ensure_checkpoint_dir(df.sparkSession)
    found = cut(rows.groupBy("_g", F.col("_k").alias("_b")).agg(*extent), F.lit(n)).withColumnRenamed("_b", "_kind").checkpoint()
    for _ in range(ROUNDS):
        inside = rows.join(found.where("_kind = 2 and _lo < _hi").withColumnRenamed("_g", "_h"), F.col("_g").eqNullSafe(F.col("_h")))
        inside = inside.where("_k = 2 and _x >= _lo and _x <= _hi")
        # Halves, so that the width of the widest range is a number; that of the narrowest may be 0.
        share = F.try_divide(F.col("_x") / 2 - F.col("_lo") / 2, F.col("_hi") / 2 - F.col("_lo") / 2)
        bins = inside.groupBy("_g", "_need", F.floor(F.coalesce(share, F.lit(0.0)) * BINS).alias("_b")).agg(*extent)
        finer = cut(bins, F.col("_need")).select(F.col("_g").alias("_h"), F.col("_lo").alias("_lo2"), F.col("_hi").alias("_hi2"), F.col("_need").alias("_need2"))
        found = found.join(finer, F.col("_g").eqNullSafe(F.col("_h")), "left").select(
            "_g", "_kind", *[F.coalesce(f"{c}2", c).alias(c) for c in ("_lo", "_hi", "_need")]).checkpoint()  # a row a group
    last = found.select(F.col("_g").alias("_h"), "_kind", "_lo")
    staged = df.select(F.struct(*df.columns).alias("_row"), F.col(group).alias("_g"), x.alias("_x"), kind.alias("_k"))
    kept = staged.join(last, F.col("_g").eqNullSafe(F.col("_h")), "left").where(
        F.col("_kind").isNull() | (F.col("_k") > F.col("_kind")) | ((F.col("_k") == F.col("_kind")) & ((F.col("_k") != 2) | (F.col("_x") >= F.col("_lo")))))
    return kept.select("_row.*")
