import re

from pyspark.sql import functions as F

from tidemark.functions import generate as gen


def test_generators_ranges_and_repeatability(spark):
    ids = spark.range(1, 3001)
    rows = (ids.select("id", gen.gender_col("id").alias("g"), gen.name_col("id").alias("n"),
                       gen.score_col("id").alias("s"), gen.int_col("id", 1, 1000).alias("b"),
                       gen.string_col("id", 40).alias("x"))
            .collect())
    again = ids.repartition(7).select("id", gen.name_col("id").alias("n")).collect()
    assert {r.id: r.n for r in rows} == {r.id: r.n for r in again}
    assert {r.g for r in rows} == {"male", "female"}
    assert all(re.fullmatch(r"[A-Z][A-Za-z]{5}", r.n) for r in rows)
    assert {r.s for r in rows} == set(range(101))          # 0..100, both ends
    assert min(r.b for r in rows) >= 1 and max(r.b for r in rows) <= 1000
    assert all(len(r.x) == 40 for r in rows)
    assert any(r.n[1:] != r.n[1:].lower() for r in rows)   # mixed case after the first letter


def test_gen_bounded_schema(spark):
    df = gen.gen_bounded(spark.range(5))
    assert df.columns == ["seq", "id", "name", "gender"]
    assert all(len(r.name) == 9 and len(r.gender) == 6 for r in df.collect())


def test_rate_ids_stream(spark):
    s = gen.rate_ids(spark, rows_per_second=5)
    assert s.isStreaming and s.columns == ["id"]
    lines = s.select(F.concat(F.col("id").cast("string"), F.lit(", "), gen.gender_col("id")).alias("value"))
    assert lines.isStreaming


def test_producer_stream_lines_parse_back(spark, scratch):
    from tidemark.functions.lines import parse_lines
    from tidemark.spec import GENDER_ROW, SCORE_ROW
    from tidemark.streaming.jobs import producer_lines, run_until_done, start_append
    root = scratch("produce")
    for topic, schema in [("test1", GENDER_ROW), ("test3", SCORE_ROW)]:
        q = start_append(producer_lines(spark, topic, rows_per_batch=50), f"{root}/{topic}",
                         f"{root}/ck_{topic}", fmt="text", available_now=True)
        run_until_done(q)
        lines = spark.read.text(f"{root}/{topic}")
        rows = parse_lines(lines, schema, on_bad="fail").collect()
        assert sorted(r.id for r in rows) == list(range(1, 51))
        if topic == "test1":
            assert {r.gender for r in rows} <= {" male", " female"}   # the space after the comma is kept
        else:
            assert all(0 <= r.score <= 100 for r in rows)


def test_message_log_needs_its_connector(spark):
    import pytest
    from tidemark.sources.streams import KAFKA_PROVIDER, kafka_lines
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(KAFKA_PROVIDER)
        pytest.skip("connector present")
    except Exception:
        pass
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        kafka_lines(spark, "broker:9092", "test1")
