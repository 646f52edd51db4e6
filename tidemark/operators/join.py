"""Equi-joins of keyed tables on their shared primary key.

`join_by_key(t1, t2, t3)` is `t1 JOIN t2 ON t1.id = t2.id JOIN t3 ON t1.id = t3.id`:
one output row per key present in every input, one key column. Null keys
never match (Catalyst adds IsNotNull and pushes it into the scans).

Scale: all joins use the same key, so after the first shuffle both later
joins find their input already hash-partitioned on it and add no exchange
for that side. Catalyst/AQE choose broadcast only for sides whose measured
size is under `spark.sql.autoBroadcastJoinThreshold`; there is no hint here,
so a keyed table that grows is never forced into memory.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def join_by_key(*tables: DataFrame, key: str | list[str] = "id", how: str = "inner") -> DataFrame:
    if len(tables) < 2:
        raise ValueError("need two or more tables")
    keys = [key] if isinstance(key, str) else list(key)
    seen = set(keys)
    for t in tables:
        dup = (set(t.columns) - set(keys)) & seen
        if dup:
            raise ValueError(f"column(s) {sorted(dup)} appear in more than one input")
        seen |= set(t.columns)
    return reduce(lambda a, b: a.join(b, keys, how), tables)
