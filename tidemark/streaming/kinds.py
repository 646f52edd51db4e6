"""The changelog of a running query, with row kinds.

A feed of keyed changes says what a row is now; a changelog says what becomes of
the table: '+I' a row appears, '-U' and '+U' its image before and after an update,
'-D' the image that is deleted. The images come from the last one of each key,
kept in state (`transformWithState`, keys dealt to shards by hash). Changes of a
key that come in one batch are taken in their order; one that is not newer than
the key's last change has no effect. An update to the same values is an update.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType, TimestampType

from ..operators.changelog import OP_DELETE
from .state import arrow_schema, pack, read_blocks, unpack, write_block

# Row kinds.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


BLOCK_ROWS = 1 << 16  # rows of a block that comes out


class _Images(StatefulProcessor):
    """One shard: rows are (key, order columns, live, values) in blocks, what comes out is (kind, key, values, order columns)."""

    def __init__(self, schema: StructType, key: str, values: Sequence[str], order: Sequence[str], out: StructType):
        self.schema, self.key, self.values, self.order, self.out = schema, key, list(values), list(order), out

    def init(self, handle: StatefulProcessorHandle) -> None:
        image = [self.schema["live"], *[self.schema[f"o{i}"] for i in range(len(self.order))], *[self.schema[f"v{i}"] for i in range(len(self.values))]]
        self.image = StructType(image)
        self.last = handle.getMapState("last", StructType([self.schema["key"]]), self.image)

    def _held(self, keys: list) -> pa.Table:
        """The last images of those of the keys that have one."""
        held = [(k, i) for k, i in ((k, self.last.getValue((k,))) for k in keys) if i is not None]
        types = arrow_schema(self.schema)
        columns = {"key": [k for k, _ in held], **{c: [i[at] for _, i in held] for at, c in enumerate(self.image.fieldNames())}}
        return pa.table([pa.array(columns[f.name], f.type) for f in types], schema=types)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # The rows of one shard of a batch, bounded by the trigger's limit.
        new = read_blocks(rows).cast(arrow_schema(self.schema))
        held = self._held(pc.unique(new["key"]).to_pylist())
        both = pa.concat_tables([held.append_column("new", pa.array(np.zeros(len(held), np.int8))),
                                 new.append_column("new", pa.array(np.ones(len(new), np.int8)))]).combine_chunks()
        # By key and order; of equal ones the held image comes first, then the one that came first.
        at = ["key", *[f"o{i}" for i in range(len(self.order))]]
        both = both.take(pc.sort_indices(both, sort_keys=[(c, "ascending") for c in (*at, "new")]))
        first = _changes(both, ["key"])  # of each key
        is_new, run = both["new"].to_numpy() == 1, np.cumsum(first) - 1
        behind = np.full(first.sum(), -1)
        behind[run[~is_new]] = np.flatnonzero(~is_new)
        # Not newer than the key's held image, or than the change before it.
        keep = ~is_new | ((np.arange(len(run)) > behind[run]) & _changes(both, at))
        both = both.filter(pa.array(keep))
        first, is_new, live = _changes(both, ["key"]), both["new"].to_numpy() == 1, both["live"].to_numpy()
        was = ~first & np.append(False, live[:-1])
        before, after = np.flatnonzero(is_new & was), np.flatnonzero(is_new & live)
        kinds = np.concatenate((np.where(live[before], UPDATE_BEFORE, DELETE), np.where(was[after], UPDATE_AFTER, INSERT)))
        image, change = np.concatenate((before - 1, after)), np.concatenate((before, after))
        out = [pa.array(kinds.tolist(), pa.string()), both["key"].take(change),
               *[both[f"v{i}"].take(image) for i in range(len(self.values))], *[both[c].take(change) for c in at[1:]]]
        out = pa.table(out, schema=arrow_schema(self.out)).append_column("_n", pa.array(np.arange(len(kinds))))
        # In the order of the changes; an update's image before it stands first.
        out = out.take(pc.sort_indices(out, sort_keys=[(c, "ascending") for c in (*self.out.fieldNames()[-len(self.order):], "_n")])).drop_columns("_n")
        last = both.filter(pa.array(np.append(first[1:], True) & is_new))
        columns = [last[c].to_pylist() for c in ("key", *self.image.fieldNames())]
        none = [None] * len(self.values)
        for ident, alive, *rest in zip(*columns):
            self.last.updateValue((ident,), (alive, *(rest if alive else [*rest[:len(self.order)], *none])))
        for b in out.to_batches(BLOCK_ROWS):
            yield Row(block=write_block(b))

    def close(self) -> None:
        pass


def _changes(rows: pa.Table, columns: list[str]) -> np.ndarray:
    """Where a row differs from the one before it in any of the columns."""
    out = np.ones(len(rows), bool)
    if len(rows) > 1:
        differ = [pc.not_equal(rows[c].slice(1), rows[c].slice(0, len(rows) - 1)).to_numpy() for c in columns]
        out[1:] = np.logical_or.reduce(differ)
    return out


def row_kinds(changes: DataFrame, key: str = "id", values: Sequence[str] = (), order: Sequence[str] = ("ts", "pos"), op_col: str = "op",
              delete_ops: Sequence[str] = (OP_DELETE,), shards: int = 64) -> DataFrame:
    """A stream of changes -> (kind, key, values, order columns), for any append sink.

    Start the query under `state.keyed_state`. Rows with a null key or a null order value are left out.
    """
    fields = {f.name: f.dataType for f in changes.schema.fields}
    names = {"key": key, **{f"o{i}": c for i, c in enumerate(order)}, **{f"v{i}": c for i, c in enumerate(values)}}
    # Points in time go through Python as microseconds, which no time zone changes.
    instant = {n: isinstance(fields[c], TimestampType) for n, c in names.items()}
    types = {n: LongType() if instant[n] else fields[c] for n, c in names.items()} | {"live": BooleanType()}
    schema = StructType([StructField(n, t) for n, t in types.items()])
    out = StructType([StructField(n, StringType() if n == "kind" else types[n])
                      for n in ("kind", "key", *[f"v{i}" for i in range(len(values))], *[f"o{i}" for i in range(len(order))])])
    live = ~F.coalesce(F.col(f"`{op_col}`").isin(*delete_ops), F.lit(False))
    given = lambda n: F.unix_micros(F.col(f"`{names[n]}`")) if instant[n] else F.col(f"`{names[n]}`")
    rows = changes.dropna(subset=[key, *order]).select(*[given(n).alias(n) for n in names], live.alias("live"))
    blocks = pack(rows, F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("_shard").transformWithState(
        _Images(schema, key, values, order, out), StructType([StructField("block", BinaryType())]), "Append", "None")
    rows = unpack(blocks, out)
    back = lambda n: F.timestamp_micros(n) if instant[n] else F.col(n)
    return rows.select("kind", *[back(n).alias(names[n]) for n in out.fieldNames()[1:]])
