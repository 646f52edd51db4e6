"""tidemark: keyed change-stream pipelines on PySpark DataFrames and Structured Streaming.

Where to start, by task:

* generate records         tidemark.functions.generate (gen_gender, gen_name, gen_score, gen_bounded)
                           tidemark.streaming.jobs.producer_lines / produce
* lines -> typed rows      tidemark.functions.lines.parse_lines (fail | divert | drop), format_lines
* read sources             tidemark.sources.streams (kafka_lines, file_lines, read_changelog)
* changelogs               tidemark.operators.changelog (current_state, changelog_diff,
                           apply_changes, upsert_by_key)
* join and rank            tidemark.operators.join.join_by_key,
                           tidemark.operators.rank (row_number_by_group, top_n_per_group),
                           tidemark.operators.topn.top_n_delta
* keep tables current      tidemark.streaming.keyed.KeyedReplica (replication / upsert sink),
                           tidemark.streaming.join.KeyedJoin (join), tidemark.streaming.topn.TopN
                           (top-N per group), tidemark.streaming.kinds.row_kinds (changelog),
                           tidemark.streaming.stop.StopAtBad (stop and resume),
                           tidemark.streaming.jobs (ingest, replicate)
* start and hand over      tidemark.sources.positions (committed offsets, start positions),
                           tidemark.sources.handover (snapshot in chunks, then live changes)
* keyed sinks              tidemark.sinks.change_log.ChangeLog, tidemark.sinks.jdbc.JdbcKeyedSink
"""

__version__ = "0.1.0"
