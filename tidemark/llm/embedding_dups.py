"""Near-duplicate embeddings by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform;
the hash is the axis it is nearest to, with the sign. `HASHES` rotations make a
table's bucket, `TABLES` tables are drawn. A vector goes into several buckets of
a table: its own, and those where the hashes that were nearly decided otherwise
take their second axis (`PROBES`, least total gap first). As both vectors of a
pair are placed so, they meet unless all their probes differ in all tables; the
tests measure recall at the threshold itself, where it is lowest.

Vectors that share a bucket are candidates, and each candidate pair is judged by
its cosine in double precision. Equal vectors are one class from the start and
count as often as they occur. Buckets are compared in blocks of `BLOCK` vectors, so
that a group of bounded size makes a task's step whatever the bucket holds, and a
pair counts in the first of the buckets that it meets in. A block pair leaves its
task as numbers: the links of each vector, and edges that join what is linked.

Defined results: rows with a null label, a null or empty vector, or one that is
zero or holds null or non-finite components link with nothing: n_links 0, their
own component, kept. Vectors of different lengths do not link. Repeated rows are
copies and link with each other. A component's id is the smallest id in it that is
not null; a row with a null id is kept if its component has no id. An empty table
gives no rows. Only vec_id, embedding and label are read, so other columns may
have any name.
"""

from __future__ import annotations

from itertools import groupby, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, sf_table, write_scratch
from tidemark.llm.components import components
from tidemark.llm.ngram_join import _shared

THRESHOLD = 0.98
TABLES, HASHES, PROBES = 5, 3, 4
BLOCK = 1024
SEED = 20260611


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    width = 1
    while width < d:
        x = x.reshape(n, -1, 2, width)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), 2).reshape(n, d)
        width *= 2
    return x


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def bucket_keys(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> np.ndarray:
    """(rows, tables x probes) keys of the buckets that each unit vector goes into."""
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - dim)))
    rng = np.random.default_rng(SEED)
    flips = np.array(list(product((0, 1), repeat=hashes)))
    out = np.empty((n, tables, probes), np.int64)
    rows = np.arange(n)[:, None]
    for t in range(tables):
        axis, gap = np.empty((n, hashes, 2), np.int64), np.empty((n, hashes))
        for h in range(hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice((-1.0, 1.0), d)) / np.sqrt(d)
            size = np.abs(y)
            two = np.argpartition(size, d - 2, axis=1)[:, d - 2:]
            swap = size[rows, two][:, 0] > size[rows, two][:, 1]
            two[swap] = two[swap][:, ::-1]
            two = two[:, ::-1]  # nearest axis first
            near = size[rows, two]
            gap[:, h] = near[:, 0] - near[:, 1]
            axis[:, h] = 2 * two + (y[rows, two] < 0)
        cheapest = np.argsort(gap @ flips.T, axis=1, kind="stable")[:, :probes]
        for k in range(probes):
            which = flips[cheapest[:, k]]
            key = np.full(n, t, np.int64)
            for h in range(hashes):
                key = key * (2 * d) + axis[np.arange(n), h, which[:, h]]
            out[:, t, k] = key
    return out.reshape(n, tables * probes)


def _vectors(column: pa.Array, dims: np.ndarray):
    """(rows, matrix) of each length among the vectors of a batch."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(dims)
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        yield rows, flat[(ends[rows] - d)[:, None] + np.arange(d)]


def _buckets(classes: DataFrame) -> DataFrame:
    """(kid, keys): the buckets of each class's vector."""
    def make():
        def batch(b):
            kid = b.column(0).to_numpy()
            dims = b.column(2).to_numpy().astype(np.int64)
            for rows, x in _vectors(b.column(1), dims):
                yield {"kid": kid[rows], "keys": list(bucket_keys(unit(x)))}
        return batch

    return map_batches(classes.select("kid", "v", "dim"), make, "kid bigint, keys array<bigint>")


def _compare(group: list[tuple], threshold: float):
    """Links of one block pair: (kid, other, links) rows as arrays; kid and other are the same for a count."""
    key, cross = group[0][2], group[0][3] != group[0][4]
    block, kid, weight = (np.array([g[i] for g in group]) for i in (5, 6, 7))
    x = unit(np.array([g[8] for g in group]))
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    if cross:
        linked &= np.not_equal.outer(block, block)
    some = np.flatnonzero(linked.any(0))
    if not len(some):
        return None
    linked, kid, weight = linked[np.ix_(some, some)], kid[some], weight[some]
    # A pair counts in the first bucket that both vectors are in.
    before = [np.array([k for k in group[i][9] if k < key], np.int64) for i in some]
    if sum(map(len, before)):
        linked &= _shared(before) == 0
    links = linked @ weight
    label = np.arange(len(some))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(label)).min(1))
        if (least == label).all():
            break
        label = least
    has, joined = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(label)))
    return (np.concatenate((kid[has], kid[joined])), np.concatenate((kid[has], kid[label[joined]])),
            np.concatenate((links[has], np.zeros(len(joined), np.int64))))


def _judge(members: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Brute force inside the buckets: (kid, other, links) rows of `_compare`."""
    size = members.groupBy("label", "dim", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    rows = members.join(size.select("label", "dim", "key", F.ceil(F.col("m") / BLOCK).cast("int").alias("nb")), ["label", "dim", "key"])
    rows = write_scratch(rows, "vectors-members")
    active = rows.groupBy("kid").agg(F.collect_list("key").alias("active"))  # at most TABLES x PROBES
    held = classes.select("kid", "weight", "v").join(active, "kid")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("kid"), F.col("nb")).cast("int")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.select("label", "dim", "key", F.least("block", "with").alias("bi"), F.greatest("block", "with").alias("bj"), "block", "kid")
    rows = rows.join(held, "kid").select("label", "dim", "key", "bi", "bj", "block", "kid", "weight", "v", "active")
    group = ["label", "dim", "key", "bi", "bj"]
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(4 * n, *group).sortWithinPartitions(*group)
    names = ("kid", "other", "links")

    def run(batches):
        def stream():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        held, size = [], 0
        for _, g in groupby(stream(), key=lambda r: r[:5]):
            got = _compare(list(g), threshold)
            if got is not None:
                held.append(got)
                size += len(got[0])
            if size > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*held)], names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*held)], names)

    return rows.mapInArrow(run, "kid bigint, other bigint, links bigint")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept."""
    v = F.col("embedding")
    # NaN is above all numbers.
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & finite, F.lit(False))
    # Equal vectors of a label have the same 128-bit name.
    name = [F.xxhash64("label", "embedding").alias("x"), F.xxhash64(F.lit(1), "label", "embedding").alias("y")]
    rows = vectors.select("vec_id", "label", usable.alias("usable"), *name)
    classes = vectors.where(usable).select("vec_id", "label", "embedding", *name).groupBy("label", "x", "y").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"), F.first("embedding").alias("v"))
    classes = classes.withColumn("dim", F.size("v")).withColumn("kid", F.monotonically_increasing_id())
    classes = write_scratch(classes, "vectors-classes")
    keys = _buckets(classes).select("kid", F.explode("keys").alias("key"))
    members = write_scratch(keys.join(classes.select("kid", "label", "dim"), "kid"), "vectors-keys")
    found = write_scratch(_judge(members, classes, threshold), "vectors-found")
    links = found.where("kid = other").groupBy("kid").agg(F.sum("links").alias("links"))
    joined = components(found.where("kid <> other").select(F.col("kid").alias("u"), F.col("other").alias("v")))
    named = classes.select("label", "x", "y", "weight", "least", "kid").join(
        joined.select(F.col("id").alias("kid"), "component"), "kid", "left").join(links, "kid", "left").withColumn(
        "component", F.coalesce("component", "kid"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select(
        "label", "x", "y", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.where("usable").join(named, ["label", "x", "y"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(sf_table(spark, sf_dir, "embeddings"))
