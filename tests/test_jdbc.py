"""The external keyed sink: statement text (a live run needs a database)."""

from tidemark.sinks.jdbc import marker_statements, merge_statements


def test_merge_statement_text():
    (ansi,) = merge_statements("derby", "t4", "stg", ["id"], ["id", "name", "score"])
    assert ansi.startswith("MERGE INTO t4 t USING stg s ON t.id = s.\"id\"")
    assert "WHEN MATCHED AND s.\"op\" = 'd' THEN DELETE" in ansi
    assert "WHEN MATCHED THEN UPDATE SET name = s.\"name\", score = s.\"score\"" in ansi
    assert "WHEN NOT MATCHED AND s.\"op\" <> 'd' THEN INSERT (id, name, score)" in ansi
    delete, upsert = merge_statements("mysql", "t4", "stg", ["id"], ["id", "name"])
    assert delete.startswith("DELETE t FROM t4 t JOIN stg s ON t.id = s.`id`")
    assert upsert.endswith("ON DUPLICATE KEY UPDATE name = VALUES(name)")
    check, record = marker_statements("m", "job1", 7)
    assert "batch_id = 7" in check and "VALUES ('job1', 7)" in record


def test_jdbc_sink_declared_by_spec():
    from tidemark.sinks.jdbc import JdbcKeyedSink
    from tidemark.spec import T4
    sink = JdbcKeyedSink.for_spec(T4, "jdbc:example://db/app", job="topn", dialect="mysql")
    check, delete, upsert, record = sink.statements(12)
    assert sink.staging_name(12) == "t4_stg_topn_12"
    assert "t4_stg_topn_12" in delete and upsert.startswith("INSERT INTO t4 (id, name, gender, score, rn)")
    assert "batch_id = 12" in check and "'topn', 12" in record
