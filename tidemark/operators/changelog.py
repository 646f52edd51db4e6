"""Changelogs and keyed tables: current state, diffs, applying changes, upserts.

A changelog row is (key..., op, values..., order...). `op` is one of
  r (snapshot read), c (create), u (update), d (delete);
and the order columns (e.g. event time and log position) say which change to
a key is the latest. "Last change wins; a delete removes the key."

Scale notes
* `last_per_key` is a `max_by` aggregate, so each map task reduces its rows to
  one per key before the shuffle (partial aggregation). A key holding a third
  of all changes costs one row per map task, not one task holding the key.
  No window over the key is used for that reason.
* `apply_changes` / `upsert_by_key` are an anti-join plus a union: the big
  target is shuffled once by key; Catalyst/AQE broadcast the change set only
  when its measured size is under the broadcast threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Change operation codes.
OP_READ, OP_CREATE, OP_UPDATE, OP_DELETE = "r", "c", "u", "d"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def last_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                 cols: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest `order` per key (order columns are kept in the output)."""
    keys = _keys(key)
    cols = [c for c in (cols if cols is not None else df.columns) if c not in keys]
    carry = list(dict.fromkeys([*cols, *order]))
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in carry]), _order_struct(order)).alias("_last"))
    return picked.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in carry])


def current_state(changes: DataFrame, key: str | Sequence[str] = "id",
                  order: Sequence[str] = ("ts", "pos"), op_col: str = "op",
                  value_cols: Sequence[str] | None = None,
                  delete_ops: Sequence[str] = (OP_DELETE,),
                  keep_tombstones: bool = False) -> DataFrame:
    """Fold a changelog into the table it describes: one row per live key.

    With `keep_tombstones` deleted keys stay as rows with their `op`, so a
    later merge can tell "deleted at (ts,pos)" from "never seen".
    """
    keys = _keys(key)
    if value_cols is None:
        value_cols = [c for c in changes.columns if c not in (*keys, op_col, *order)]
    last = last_per_key(changes, keys, order, [op_col, *value_cols])
    if keep_tombstones:
        return last.select(*keys, op_col, *value_cols, *order)
    return last.where(~F.col(op_col).isin(*delete_ops)).select(*keys, *value_cols)


def changelog_diff(old: DataFrame, new: DataFrame, key: str | Sequence[str] = "id",
                   value_cols: Sequence[str] | None = None, op_col: str = "op") -> DataFrame:
    """Changes that turn table `old` into table `new`.

    One row per key that was added ('c'), removed ('d') or changed ('u'),
    with the new values (NULL for 'd'). Values compare null-safely.
    """
    keys = _keys(key)
    if value_cols is None:
        value_cols = [c for c in new.columns if c not in keys]
    o = old.select(*keys, F.struct(*value_cols, F.lit(True).alias("_in")).alias("_old"))
    n = new.select(*keys, F.struct(*value_cols, F.lit(True).alias("_in")).alias("_new"))
    return _diff(o.join(n, keys, "full_outer"), keys, value_cols, op_col)


def _diff(states: DataFrame, keys: list[str], value_cols: Sequence[str], op_col: str) -> DataFrame:
    """Changes from the struct `_old` to the struct `_new`, each null where the key is absent."""
    op = (F.when(F.col("_old").isNull(), F.lit(OP_CREATE))
           .when(F.col("_new").isNull(), F.lit(OP_DELETE))
           .otherwise(F.lit(OP_UPDATE)))
    return (states.where(~F.col("_old").eqNullSafe(F.col("_new")))
                  .select(*keys, op.alias(op_col), *[F.col("_new").getField(c).alias(c) for c in value_cols]))


def changes_since(changes: DataFrame, before: Column, key: str | Sequence[str] = "id",
                  order: Sequence[str] = ("ts", "pos"), value_cols: Sequence[str] = (), op_col: str = "op",
                  delete_ops: Sequence[str] = (OP_DELETE,)) -> DataFrame:
    """`changelog_diff` of a feed's state over the rows that are `before` and over all, in one aggregation."""
    keys = _keys(key)
    image = F.struct(op_col, *value_cols)
    states = changes.withColumn("_before", before).groupBy(*keys).agg(
        F.max_by(image, F.when(F.col("_before"), _order_struct(order))).alias("_old"),
        F.max_by(image, _order_struct(order)).alias("_new"))
    live = {n: F.when(~F.col(f"{n}.{op_col}").isin(*delete_ops),
                      F.struct(*[F.col(f"{n}.{c}").alias(c) for c in value_cols])).alias(n) for n in ("_old", "_new")}
    return _diff(states.select(*keys, *live.values()), keys, value_cols, op_col)


def apply_changes(target: DataFrame, changes: DataFrame, key: str | Sequence[str] = "id",
                  op_col: str = "op", delete_ops: Sequence[str] = (OP_DELETE,),
                  order: Sequence[str] | None = None) -> DataFrame:
    """Upsert and delete `changes` (at most one per key, or `order` picks the last) into `target`."""
    keys = _keys(key)
    if order:
        changes = last_per_key(changes, keys, order)
    return _merge(target, changes, keys, ~F.col(op_col).isin(*delete_ops))


def upsert_by_key(target: DataFrame, source: DataFrame, key: str | Sequence[str] = "id",
                  order: Sequence[str] | None = None) -> DataFrame:
    """INSERT ... ON DUPLICATE KEY UPDATE: source rows replace target rows with the same key.

    Repeated keys in `source` are reduced to the greatest `order`; without an
    order the source must already be unique per key.
    """
    keys = _keys(key)
    if order:
        source = last_per_key(source, keys, order)
    return _merge(target, source, keys, F.lit(True))


def _merge(target: DataFrame, changes: DataFrame, keys: list[str], live: Column) -> DataFrame:
    """`target` with the rows of changed keys replaced or, where not `live`, removed.

    One full outer join by key decides keep, replace or delete; each side is read once.
    """
    cols = target.columns
    old = target.select(*keys, F.struct(*cols).alias("_old"))
    new = changes.select(*keys, F.struct(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in cols]).alias("_new"),
                         F.coalesce(live, F.lit(False)).alias("_live"))
    joined = old.join(new, keys, "full_outer").where("_new is null or _live")
    row = F.coalesce("_new", "_old")
    return joined.select(*[row.getField(c).alias(c) for c in cols])
