"""Keeping a top-N-per-group result up to date (batch form).

`top_n_delta(old, new, ...)` is what a keyed sink holding the top N must
receive when the ranked table moves from `old` to `new`: rows that entered
or moved rank ('c'/'u', upsert) and ids that left the result ('d', delete).
A row that changes group keeps its id, so the diff is by id over all groups:
it ends as one upsert, never a delete plus an insert.

The streaming job (`tidemark.streaming.topn`) produces the same changes
incrementally; this batch form is its oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .changelog import changelog_diff
from .rank import top_n_per_group


def top_n_delta(old: DataFrame, new: DataFrame, group: str, order_col: str, n: int,
                key: str = "id", rank_col: str = "rn", op_col: str = "op") -> DataFrame:
    top_old = top_n_per_group(old, group, order_col, n, key, rank_col=rank_col)
    top_new = top_n_per_group(new, group, order_col, n, key, rank_col=rank_col)
    return changelog_diff(top_old, top_new, key=key, op_col=op_col)
