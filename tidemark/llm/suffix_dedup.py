"""Suffix-array dedup by bucket-pointer refinement: repeated 100-byte strings.

A byte goes if a 100-byte string that covers it also starts earlier (smaller
document id, or the same document and an earlier start). Strings that share
their first q-gram buckets are refined level by level, and only positions whose
bucket still has company go on, as in bucket-pointer refinement of a suffix
array to depth 100:

  level 0  runs of neighbouring strings that share their smallest 32-gram
           (their owner); the bucket is that 32-gram
  level 1  stretches of up to 8 strings of a run; the bucket is the 93 bytes
           that all of them hold
  level 2  single strings; the bucket is the string's 100 bytes

Bucket names of longer strings are made from the names at later offsets
(`bytenames`), so every level reuses the names of the one before. At each level
a run equal as a whole to an earlier run (same bucket, same name) goes at once;
only the first run of each kind, and only in buckets that hold several kinds,
is cut into the next level's runs. So copies and shared passages never reach
level 2, whatever the size of their group, and no rank of all suffixes is kept:
all that is asked of the order is each bucket's first member.

In Spark each level is aggregation (buckets with company; the first run of each
kind), which combines before its shuffle, and joins on bucket and name, whose
hot keys adaptive execution splits. Steps are cut by written tables.

Equality is by two independent 64-bit names, so 128 bits in all.

Defined results: a null text is empty; rows with the same id stand at the same
place, so neither is earlier than the other by its id, and each keeps what no
earlier start repeats; null ids count as the largest; texts under 100 bytes stay
whole; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bytenames import GRAM, PIECE, STRING_BYTES, names, refine, run_buckets, runs
from tidemark.llm.common import documents, map_batches, write_scratch

STRETCH = 8
BATCH_BYTES = 1 << 16
LAST = (1 << 63) - 1
RUN = "g bigint, t bigint, shape int, n int, id bigint, tag int, at int"
PLACE = ["id", "tag"]
KIND = ["g", "t", "shape", "n"]


def _texts(docs: DataFrame) -> DataFrame:
    """(id, tag, body): the tag tells apart different texts under one id."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("id"), body.alias("body")).withColumn(
        "tag", F.hash("body")).select("id", "tag", "body")


def _pieces(bodies: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (row, offset, bytes) to name together; long texts in overlapping pieces."""
    group, size = [], 0
    for row, body in enumerate(bodies):
        for at in range(0, max(len(body) - STRING_BYTES + 1, 0), PIECE - STRING_BYTES + 1):
            part = body[at:at + PIECE]
            group.append((row, at, part))
            size += len(part)
            if size >= BATCH_BYTES:
                yield group
                group, size = [], 0
    if group:
        yield group


def _owner_runs(bodies: list[bytes]):
    for group in _pieces(bodies):
        data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        ends = np.cumsum([len(p) for _, _, p in group])
        (text, first, n, owner, g, t, _), _, _ = runs(data, ends)
        if len(text):
            row = np.array([r for r, _, _ in group])
            shift = np.array([at for _, at, _ in group]) - np.concatenate(([0], ends[:-1]))
            yield row[text], first + shift[text], n, owner, g, t


def _buckets(texts: DataFrame) -> DataFrame:
    """The level 0 bucket of every run."""
    def make():
        def batch(b):
            for group in _pieces(b.column(0).to_pylist()):
                parts = [p for _, _, p in group]
                yield {"g": run_buckets(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts]))}
        return batch

    return map_batches(texts.select("body"), make, "g bigint")


def _level0(texts: DataFrame) -> DataFrame:
    def make():
        def batch(b):
            ids, tags = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for row, at, n, owner, g, t in _owner_runs(b.column(2).to_pylist()):
                yield {"g": g, "t": t, "shape": owner, "n": n, "id": ids[row], "tag": tags[row], "at": at}
        return batch

    return map_batches(texts, make, RUN)


def _cut(texts: DataFrame, wanted: DataFrame, single: bool) -> DataFrame:
    """The next level's runs of the `wanted` ones (id, tag, at, n, shape)."""
    # One list for each document, no longer than the document.
    lists = wanted.groupBy(*PLACE).agg(F.array_sort(F.collect_list(F.struct("at", "n", "shape"))).alias("w"))

    def make():
        def one(body: bytes, w: list[dict]):
            """Arrays for one text, named piece by piece."""
            at, n, owner = (np.array([x[k] for x in w]) for k in ("at", "n", "shape"))
            for lo in range(0, max(len(body) - STRING_BYTES + 1, 0), PIECE - STRING_BYTES + 1):
                here = (at >= lo) & (at < lo + PIECE - STRING_BYTES + 1)
                if here.any():
                    data = np.frombuffer(body[lo:lo + PIECE], np.uint8)
                    yield from _parts(data, at[here] - lo, n[here], owner[here], lo, single)

        def batch(b):
            ids, tags = (b.column(i).to_pylist() for i in (0, 1))
            for i, body in enumerate(b.column(2).to_pylist()):
                for g, t, shape, n, at in one(body, b.column(3)[i].as_py()):
                    k = len(g)
                    yield {"g": g, "t": t, "shape": shape, "n": n, "id": [ids[i]] * k, "tag": [tags[i]] * k, "at": at}

        return batch

    return map_batches(texts.join(lists, PLACE).select("id", "tag", "body", "w"), _joined(make), RUN)


def _joined(make, rows: int = 20_000):
    """Yield bigger record batches than one for each text."""
    def made():
        fn = make()

        def batch(b):
            held, size = [], 0
            for out in fn(b):
                held.append(out)
                size += len(out["g"])
                if size >= rows:
                    yield {k: np.concatenate([h[k] for h in held]) for k in held[0]}
                    held, size = [], 0
            if held:
                yield {k: np.concatenate([h[k] for h in held]) for k in held[0]}

        return batch

    return made


def _parts(data, at, n, owner, shift, single):
    gram, one, two = names(data)
    offsets = np.repeat(at, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    as_long = lambda x: x.view(np.int64)
    if single:
        zero = np.zeros(len(offsets), np.int64)
        yield as_long(one[offsets]), as_long(two[offsets]), zero, zero + 1, offsets + shift
        return
    owned = np.repeat(at + owner, n)
    # Strings whose distance to the owner falls into the same 8 are one stretch.
    step = (owned - offsets) // STRETCH
    new = np.ones(len(offsets), bool)
    new[1:] = (step[1:] != step[:-1]) | (owned[1:] != owned[:-1]) | (offsets[1:] != offsets[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(offsets)))
    twice = refine(gram[:-GRAM], gram[GRAM:])
    core = owned[first] - STRETCH * step[first]  # start of the bytes that the whole stretch holds
    later = STRING_BYTES - (STRETCH - 1) - 2 * GRAM
    g = refine(twice[core], twice[core + later])
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(one[offsets] ^ (two[offsets] >> np.uint64(9)))))
    t = upto[first + count] - upto[first]
    # The distance of the first string to the owner tells where in the stretch it is cut.
    shape = (owned - offsets)[first] % STRETCH
    yield as_long(g), as_long(t), shape, count, offsets[first] + shift


def _settle(level: DataFrame, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """(places of runs that go, runs to cut further) of a level's runs in shared buckets."""
    kinds = level.groupBy(*KIND).agg(F.min(F.struct("id", "at", "tag")).alias("first"), F.count(F.lit(1)).alias("m"))
    kinds = write_scratch(kinds, "runs-kinds")
    firsts = kinds.where("m > 1").select(*KIND, F.col("first.id").alias("f_id"), F.col("first.at").alias("f_at"))
    gone = level.join(firsts, KIND).where((F.col("id") != F.col("f_id")) | (F.col("at") != F.col("f_at")))
    gone = write_scratch(gone.select(*PLACE, "at", (F.col("n") + STRING_BYTES - 1).alias("len")), "runs-gone")
    if last:
        return gone, None
    mixed = kinds.groupBy("g").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("g")
    more = kinds.join(mixed, "g").select(
        F.col("first.id").alias("id"), F.col("first.tag").alias("tag"), F.col("first.at").alias("at"), "n", "shape")
    return gone, write_scratch(more, "runs-more")


def _in_shared_buckets(level: DataFrame, buckets: DataFrame, name: str) -> DataFrame:
    shared = buckets.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("g")
    return write_scratch(level.join(shared, "g"), name)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, tag, at, len): stretches of bytes to remove; they may overlap."""
    texts = _texts(docs)
    shared = write_scratch(_buckets(texts).groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("g"), "runs-shared")
    level = write_scratch(_level0(texts).join(shared, "g").select(*KIND, *PLACE, "at"), "runs-0")
    gone, more = _settle(level, False)
    parts = write_scratch(_cut(texts, more, False), "runs-1-all")
    gone1, more = _settle(_in_shared_buckets(parts, parts, "runs-1"), False)
    parts = write_scratch(_cut(texts, more, True), "runs-2")
    gone2, _ = _settle(parts, True)
    return gone.unionByName(gone1).unionByName(gone2)


def _removed(n: int, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal removed runs of bytes, in order, from overlapping stretches."""
    order = np.argsort(at)
    at, end = at[order], np.minimum((at + length)[order], n)
    upto = np.maximum.accumulate(end)
    new = np.flatnonzero(np.append(True, at[1:] > upto[:-1])) if len(at) else np.empty(0, np.int64)
    return at[new], upto[np.append(new[1:] - 1, len(at) - 1)] if len(at) else at


def _kept(body: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    edges = [0, *np.column_stack((starts, ends)).ravel().tolist(), len(body)]
    return b"".join([body[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)])


def _spans(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """(at, len) of each row of a list of those, None for rows without."""
    at, length = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in column.flatten().flatten())
    upto = np.cumsum([0, *pc.fill_null(pc.list_value_length(column), 0).to_pylist()]).tolist()
    for lo, hi in zip(upto, upto[1:]):
        yield (at[lo:hi], length[lo:hi]) if hi > lo else None


def dedup_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, body, removed, kept) for every row: the text's bytes, the maximal
    removed runs [(start, end)], and the remaining bytes."""
    spans = repeated_spans(docs).groupBy(*PLACE).agg(F.collect_set(F.struct("at", "len")).alias("w"))

    def make():
        def batch(b):
            out = {"doc_id": b.column(0), "body": b.column(1), "removed": [], "kept": []}
            for body, w in zip(b.column(1).to_pylist(), _spans(b.column(2))):
                cut = _removed(len(body), *w) if w else None
                out["kept"].append(_kept(body, *cut) if cut else body)
                out["removed"].append([{"start": a, "end": e} for a, e in zip(*(x.tolist() for x in cut))] if cut else [])
            yield out
        return batch

    rows = docs.select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))
    rows = rows.withColumn("id", F.coalesce(F.col("doc_id"), F.lit(LAST))).withColumn("tag", F.hash("body"))
    joined = rows.join(spans, PLACE, "left").select("doc_id", "body", "w")
    return map_batches(joined, make, "doc_id bigint, body binary, removed array<struct<start:int,end:int>>, kept binary")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, without the repeated bytes of their texts.

    A character of which a byte goes is dropped whole; texts that do not change
    stay as they are (null too); rows of whose text nothing is left go. An
    `n_chars` column follows the text.
    """
    spans = repeated_spans(docs).groupBy(*PLACE).agg(F.collect_set(F.struct("at", "len")).alias("w"))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # The row is one column, so that its columns may have any name.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("id"),
                       F.hash(body).alias("tag"))
    rows = rows.join(spans, PLACE, "left").select("row", "w")

    def run(batches):
        for b in batches:
            row, spans = b.column(0), list(_spans(b.column(1)))
            names, columns = [row.type.field(i).name for i in range(row.type.num_fields)], row.flatten()
            texts = columns[names.index("text")].to_pylist()
            for i, w in enumerate(spans):
                if w:
                    body = texts[i].encode()
                    texts[i] = _kept(body, *_removed(len(body), *w)).decode("utf-8", "ignore")
            left = [i for i, t in enumerate(texts) if t or not spans[i]]
            columns[names.index("text")] = pa.array(texts, row.type.field("text").type)
            yield pa.RecordBatch.from_arrays(columns, names).take(pa.array(left, pa.int64()))

    cut = rows.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_spans(documents(spark, sf_dir))
    cut = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return done.select("doc_id", F.length("body").cast("long").alias("n_bytes"), cut.alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
