"""Bad records never pass, state knows its stream and layout, merges read each side once."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidemark.functions.lines import parse_lines
from tidemark.operators.changelog import apply_changes, upsert_by_key
from tidemark.sinks.jdbc import JdbcKeyedSink, marker_ddl, marker_statements
from tidemark.sinks.change_log import ChangeLog
from tidemark.sources.streams import read_changelog
from tidemark.spec import GENDER_ROW
from tidemark.streaming.jobs import ingest, run_until_done
from tidemark.streaming.keyed import KeyedReplica

NAME = StructType([StructField("id", LongType()), StructField("name", StringType())])


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_newlines_are_not_digits_or_separators(spark):
    good, bad = parse_lines(lines(spark, "5\n,male", "6,a,\n", "7,b,,"), GENDER_ROW, on_bad="divert")
    assert {tuple(r) for r in good.collect()} == {(6, "a"), (7, "b")}
    assert [r["value"] for r in bad.collect()] == ["5\n,male"]


@pytest.mark.parametrize("ask", [lambda d: d.select("gender").collect(), lambda d: d.count(), lambda d: d.collect()])
def test_fail_mode_fails_whatever_is_asked_for(spark, ask):
    with pytest.raises(PySparkException, match="bad record"):
        ask(parse_lines(lines(spark, "1,a", "x,b"), GENDER_ROW))


def test_bad_events_never_become_rows(spark):
    events = ['{"after":{"id":1,"name":"a"},"op":"c","ts_ms":1,"source":{"file":"f","pos":1}}',
              '{"after":{"id":"x1","name":"b"},"op":"c","ts_ms":2}', "{broken", '{"op":"u","ts_ms":3}', None,
              '{"before":{"id":2,"name":"z"},"op":"d","ts_ms":4}', '{"after":{"id":5,"name":"a"},"op":"?"}']
    df = lines(spark, *events)
    good, bad = read_changelog(df, NAME, on_bad="divert")
    assert {(r["op"], r["id"], r["name"]) for r in good.collect()} == {("c", 1, "a"), ("d", 2, "z")}
    assert bad.count() == 5
    assert read_changelog(df, NAME, on_bad="drop").count() == 2
    with pytest.raises(PySparkException, match="bad record"):
        read_changelog(df, NAME).count()


def stream(spark, path, *values):
    lines(spark, *values).coalesce(1).write.mode("append").text(path)
    return spark.readStream.text(path)


def test_ingest_gives_rejects_and_upserts_without_an_op(spark, scratch):
    root = scratch("ingest")
    rep = KeyedReplica(spark, f"{root}/state", NAME, "id", order=("id",), order_types={"id": LongType()}, buckets=2)
    got = []
    source = stream(spark, f"{root}/in", "1,a", "oops", "2,b")
    with pytest.raises(ValueError, match="rejects"):
        ingest(source, NAME, sink=rep.process, on_bad="divert", checkpoint=f"{root}/ck")
    _, query = ingest(source, NAME, sink=lambda b, i: got.extend((r["op"], r["id"], r["name"]) for r in b.collect()),
                      on_bad="divert", checkpoint=f"{root}/ck", available_now=True,
                      rejects=lambda b, i: got.extend(r["value"] for r in b.collect()))
    run_until_done(query)
    assert got == ["oops", ("u", 1, "a"), ("u", 2, "b")]


def test_a_reset_checkpoint_is_refused(spark, scratch):
    root = scratch("reset")
    order = dict(order=("pos",), order_types={"pos": LongType()}, buckets=2)
    rep = KeyedReplica(spark, root, NAME, "id", **order)
    change = lambda i: spark.createDataFrame([(i, "a", "u", i)], "id long, name string, op string, pos long")
    for i in range(3):
        rep.process(change(i), i)
    rep.process(change(2), 2)  # a replay of the newest batch is fine
    with pytest.raises(ValueError, match="checkpoint was reset"):
        rep.process(change(100), 0)
    assert rep.current().count() == 3
    rep.table.claim(2, "query-1")
    with pytest.raises(ValueError, match="another stream"):
        rep.table.claim(3, "query-2")


def test_a_changed_layout_is_refused(spark, scratch):
    root, schema = scratch("layout"), StructType([StructField("id", LongType()), StructField("v", IntegerType())])
    ChangeLog(spark, root, schema, "id", ("v",)).append(spark.createDataFrame([(i, i) for i in range(20)], schema), 0)
    assert ChangeLog(spark, root, schema, "id", ("v",)).read().count() == 20
    with pytest.raises(ValueError, match="layout"):
        ChangeLog(spark, root, schema, "id", ("id",)).read()


def test_a_claim_asks_as_much_after_many_batches(spark, scratch, monkeypatch):
    """What a batch asks of the file system before it writes does not grow with the batches so far."""
    schema = StructType([StructField("id", LongType()), StructField("v", IntegerType())])
    log = ChangeLog(spark, scratch("claims"), schema, "id", ("v",))
    calls = []
    asked = ChangeLog._fs
    monkeypatch.setattr(ChangeLog, "_fs", lambda self, path: calls.append(path) or asked(self, path))
    log.append(spark.createDataFrame([(1, 1)], schema), 0)
    seen = {}
    for k in range(1, 201):
        log._write_text(f"{log.path}/changes/batch={k}/_SUCCESS", "")
        log._write_text(f"{log.path}/head.json", f'{{"batch": {k}}}')
        if k in (1, 200):
            calls.clear()
            log.claim(k + 1, "query")
            seen[k] = len(calls)
    assert seen[200] <= seen[1] <= 4


def test_replica_compacts_by_itself(spark, scratch):
    rep = KeyedReplica(spark, scratch("auto"), NAME, "id", order=("pos",), order_types={"pos": LongType()}, buckets=2, compact_every=2)
    for i in range(5):
        rep.process(spark.createDataFrame([(i % 3, f"v{i}", "u", i)], "id long, name string, op string, pos long"), i)
    assert rep.table._done("base", "upto") == [1, 3]
    assert {tuple(r) for r in rep.current().collect()} == {(0, "v3"), (1, "v4"), (2, "v2")}


def test_merges_read_each_side_once(spark, tmp_path):
    old = str(tmp_path / "old")
    spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id long, name string").write.parquet(old)
    target = spark.read.parquet(old)
    changes = spark.createDataFrame([(1, "A", "u", 2), (1, "x", "u", 1), (2, None, "d", 3), (3, "c", "c", 4)],
                                    "id long, name string, op string, pos long")
    out = apply_changes(target, changes, order=("pos",))
    assert {tuple(r) for r in out.collect()} == {(1, "A"), (3, "c"), (None, "n")}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    out = upsert_by_key(target, changes, order=("pos",))
    assert {tuple(r) for r in out.collect()} == {(1, "A"), (2, None), (3, "c"), (None, "n")}


def test_jdbc_marker_is_exact_and_quoted():
    check, record = marker_statements("m", "o'job", 7)
    assert "batch_id = 7" in check and "'o''job'" in check and "'o''job', 7" in record
    assert "PRIMARY KEY (job, batch_id)" in marker_ddl("m")
    assert callable(JdbcKeyedSink("jdbc:x", "t", ["id"], ["id"], "j").process)
