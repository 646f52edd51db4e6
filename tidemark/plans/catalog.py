"""The query catalogue: every operator of the inventory as a runnable query.

Each entry takes (spark, sf_dir) and returns a DataFrame over the driver
tables (or data Spark derives from them), built only from library functions.
`tidemark.plans.oracle` holds independent SQL for the same results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import generate as gen
from ..functions.lines import line_col, parse_lines
from ..operators.changelog import apply_changes, changes_since, current_state, upsert_by_key
from ..operators.join import join_by_key
from ..operators.rank import row_number_by_group, top_n_per_group
from ..operators.topn import top_n_delta
from ..session import scratch_path
from ..sinks.declared import declare
from ..sources import tables as tb
from ..sources.streams import read_changelog, to_envelope
from ..spec import GENDER_ROW, SCORE_ROW, T4, align_to

TOP_N = 2
RESULT_COLUMNS = ["id", "name", "gender", "score", "rn"]
TOP_SQL = f"""
        select * from
          (select t1.id, name, gender, score,
                  cast(row_number() over (partition by gender
                                          order by score desc nulls last, t1.id) as bigint) rn
           from t1 join t2 on t1.id = t2.id
                   join t3 on t1.id = t3.id) t
        where rn <= {TOP_N}"""


# ---------------------------------------------------------------- join + rank

def joined3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t1 JOIN t2 ON id JOIN t3 ON id, projected as (id, name, gender, score)."""
    j = join_by_key(tb.t1(spark, sf_dir), tb.t2(spark, sf_dir), tb.t3(spark, sf_dir))
    return j.select("id", "name", "gender", "score")


def q_topn_join3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: top 2 scores per gender over the three-way keyed join."""
    ranked = top_n_per_group(joined3(spark, sf_dir), "gender", "score", TOP_N)
    return ranked.select(*RESULT_COLUMNS)


def q_topn_join3_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same statement as SQL text over temp views (view registration + SQL execution)."""
    tb.t1(spark, sf_dir).createOrReplaceTempView("t1")
    tb.t2(spark, sf_dir).createOrReplaceTempView("t2")
    tb.t3(spark, sf_dir).createOrReplaceTempView("t3")
    return spark.sql(TOP_SQL)


def q_join3_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined3(spark, sf_dir)


def q_row_number_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = join_by_key(tb.t1(spark, sf_dir), tb.t3(spark, sf_dir))
    return row_number_by_group(t, "gender", "score").select("id", "gender", "score", "rn")


def q_topn_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n_per_group(tb.rank_input(spark, sf_dir), "o_orderpriority", "o_totalprice",
                           TOP_N, key="o_orderkey")


def q_insert_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_to(q_topn_join3(spark, sf_dir), T4.schema)


def q_insert_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The insert as SQL text into a declared table, over rows that an earlier insert left; read back."""
    q_topn_join3_sql(spark, sf_dir)  # the views t1, t2, t3
    t4 = declare(spark, replace(T4, options={"root": scratch_path(spark, "t4")}))
    spark.sql("insert into t4 select id, 'old', gender, 0, 0 from (" + TOP_SQL + ") where rn = 1")
    spark.sql("insert into t4 " + TOP_SQL)
    return t4.read()


def q_topn_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top 1500 of each group: beyond Catalyst's group limit, by selection."""
    return top_n_per_group(tb.rank_input(spark, sf_dir), "o_orderpriority", "o_totalprice", 1500, key="o_orderkey")


def q_replicate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t1 = tb.t1(spark, sf_dir)
    return t1.select(*t1.columns)


# ---------------------------------------------------------------- generators, lines

def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))


def q_gen_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.gen_gender(_ids(spark, sf_dir))


def q_gen_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.gen_name(_ids(spark, sf_dir))


def q_gen_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.gen_score(_ids(spark, sf_dir))


def q_gen_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.gen_bounded(_ids(spark, sf_dir))


def q_format_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three producers' payloads "n, gender", "n, Name", "n,score": one scan, three rows per key."""
    ids = _ids(spark, sf_dir)
    topics = [("test1", gen.gender_col("id"), ", "), ("test2", gen.name_col("id"), ", "),
              ("test3", gen.score_col("id"), ",")]
    return ids.select(F.inline(F.array(*[
        F.struct(line_col("id", value, sep).alias("value"), F.lit(topic).alias("topic"))
        for topic, value, sep in topics])))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer lines "id, segment" from customer, every rule of the parser exercised.

    The line form is chosen by the last digit of the key: valid lines, a
    corrupted id, a missing field, a leading blank, a sign, empty and extra
    fields. All rows are kept; the digit only picks the form.
    """
    c = tb.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    k, seg = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    d = F.col("c_custkey") % 10
    value = (F.when(d == 0, F.concat(F.lit("x"), k, F.lit(", "), seg))      # bad_int
              .when(d == 1, F.concat(k, F.lit(",")))                        # missing_field
              .when(d == 2, F.concat(F.lit("+"), k, F.lit(","), seg))       # valid, signed
              .when(d == 3, F.concat(k, F.lit(",,"), seg))                  # valid, empty text
              .when(d == 4, F.concat(F.lit(" "), k, F.lit(",a")))           # bad_int, blank
              .when(d == 5, k)                                              # missing_field
              .when(d == 6, F.concat(k, F.lit(", "), seg, F.lit(",extra"))) # valid, extra field
              .otherwise(F.concat(k, F.lit(", "), seg)))                    # valid
    return c.select(F.col("c_custkey").alias("pos"), value.alias("value"))


def int_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer lines "id,score" from customer with the int,int parser's edge cases."""
    ids = _ids(spark, sf_dir)
    k, s = F.col("id").cast("string"), gen.score_col("id").cast("string")
    d = F.col("id") % 10
    value = (F.when(d == 0, F.concat(k, F.lit(", "), s))             # bad_int: " 9"
              .when(d == 1, F.concat(k, F.lit(",3000000000")))        # bad_int: overflow
              .when(d == 2, F.concat(k, F.lit(","), s, F.lit(",")))   # valid, trailing comma
              .when(d == 3, F.concat(k, F.lit(",-"), s))              # valid, negative
              .otherwise(F.concat(k, F.lit(","), s)))
    return ids.select(F.col("id").alias("pos"), value.alias("value"))


def q_parse_id_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = parse_lines(text_lines(spark, sf_dir), GENDER_ROW, on_bad="divert")
    return good


def q_parse_id_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = parse_lines(int_lines(spark, sf_dir), SCORE_ROW, on_bad="divert")
    return good


def q_parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = parse_lines(text_lines(spark, sf_dir), GENDER_ROW, on_bad="divert")
    return bad


# ---------------------------------------------------------------- changelogs

STATE_COLUMNS = ["event_type", "value"]


def feed_state(spark: SparkSession, sf_dir: str, share: tuple[int, int] | None = None) -> DataFrame:
    """Current state of the events change feed, whole or up to a share of positions."""
    feed = tb.change_feed(spark, sf_dir)
    if share:
        feed = tb.feed_cut(feed, *share)
    return current_state(feed, "id", ("ts", "pos"), value_cols=STATE_COLUMNS)


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = tb.change_feed(spark, sf_dir)
    # milliseconds since the epoch of a TIMESTAMP_NTZ: no session time zone involved
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return to_envelope(feed.withColumn("ts_ms", F.timestamp_diff("MILLISECOND", epoch, F.col("ts"))),
                       ["id", "event_type", "value"], ts_ms="ts_ms", pos="pos",
                       file=F.lit("events"))


def q_cdc_parse_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
    row = StructType([StructField("id", LongType()), StructField("event_type", StringType()),
                      StructField("value", DoubleType())])
    return read_changelog(envelopes(spark, sf_dir), row)


def q_cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_state(spark, sf_dir)


def q_changelog_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = tb.change_feed(spark, sf_dir)
    return changes_since(feed, tb.before_cut(feed, 1, 2), value_cols=STATE_COLUMNS)


def q_apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = feed_state(spark, sf_dir, (1, 2))
    return apply_changes(old, q_changelog_diff(spark, sf_dir))


def q_upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = tb.change_feed(spark, sf_dir).select("id", F.col("event_type").alias("name"), "ts", "pos")
    return upsert_by_key(tb.t2(spark, sf_dir), src, "id", order=("ts", "pos"))


def q_topn_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = feed_state(spark, sf_dir, (1, 2)).withColumnRenamed("event_type", "g") \
        .withColumnRenamed("value", "score")
    new = feed_state(spark, sf_dir).withColumnRenamed("event_type", "g") \
        .withColumnRenamed("value", "score")
    return top_n_delta(old, new, "g", "score", TOP_N)


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "topn_join3": q_topn_join3,
    "topn_join3_sql": q_topn_join3_sql,
    "join3_inner": q_join3_inner,
    "row_number_by_group": q_row_number_by_group,
    "topn_per_group": q_topn_per_group,
    "insert_aligned": q_insert_aligned,
    "insert_declared": q_insert_declared,
    "topn_large": q_topn_large,
    "replicate_table": q_replicate_table,
    "gen_gender": q_gen_gender,
    "gen_name": q_gen_name,
    "gen_score": q_gen_score,
    "gen_bounded": q_gen_bounded,
    "format_lines": q_format_lines,
    "parse_id_text": q_parse_id_text,
    "parse_id_int": q_parse_id_int,
    "parse_rejects": q_parse_rejects,
    "cdc_parse_envelope": q_cdc_parse_envelope,
    "cdc_current_state": q_cdc_current_state,
    "changelog_diff": q_changelog_diff,
    "apply_changes": q_apply_changes,
    "upsert_by_key": q_upsert_by_key,
    "topn_delta": q_topn_delta,
}
