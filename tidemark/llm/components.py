"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_scratch, write_scratch


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    to_least = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_least.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges of long ids -> (id, component): the least id that `id` is joined to.

    Vertices without edges and least vertices are not listed. Each round halves
    the remaining distances or so; two numbers a round reach the driver.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    e, before = write_scratch(e, "components"), None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.coalesce(F.expr("bit_xor(xxhash64(u, v))"), F.lit(0))).first()
        if before == tuple(mark):
            return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = tuple(mark)
        last, e = e, write_scratch(_small_star(_large_star(e)), "components")
        drop_scratch(last)
