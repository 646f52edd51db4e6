"""N-gram Jaccard join by chosen paths.

A document's set is its 5-word shingles. Each run gives a set some of its own
tokens, drawn by a hash that all sets share, `BRANCH` of them in expectation,
and with each the bucket of that path. A large bucket is split: its sets draw
again, by a hash of the path, and go to the buckets of the longer paths. Two sets as similar as the threshold share
at least BRANCH x threshold of their draws in expectation at each step, so a
run finds them with a probability that is known from the branching process, and
runs are repeated until the target recall (`runs_for`).

The sets of a bucket are compared by brute force, first by their sketches: one
bit for each of about as many places as the set has tokens, which says whether an odd
number of tokens falls there. Two sketches differ in at most as many bits as the
sets have tokens that only one of them holds, so a pair over that bound is below
the threshold for certain; sets without another candidate in the bucket leave it.
Chance meetings and texts with one passage in common end here, at a few dozen bytes
a set and bucket. Only what is left is compared by its texts, each pair judged by
its exact Jaccard similarity.

Sets that share almost everything do not split: a bucket whose largest child
keeps half of it, or that is still large at the last step, is compared in pairs
of blocks instead, each block pair a task's group of bounded size. So no bucket
is dropped or cut short. Buckets with the same members still split each by its
own path, or the runs would not be independent; such members are judged once. Candidates
that hang together by their buckets, up to a block of sets, are
compared as one, so that each set's text goes to one place. A pair that meets in several buckets is judged in the
first of them only, and reported as numbers: each block pair yields the links
of each set and the edges of a spanning forest, never all its pairs.

Equal texts are one class from the start and count once.

Defined results: a text with 1 to 4 words has one shingle of all its words;
null texts and texts without words are linked to nothing and are classes of their
own; rows with a null id take part, and a class id is the smallest id that is
not null; repeated rows are copies; an empty table gives no rows. Only id and
text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tidemark.llm.common import documents, map_batches, scratch_scope, write_scratch
from tidemark.llm.components import components

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.99999
BRANCH = 2.0
DEPTH = 3
SMALL = 1024  # sets whose sketches are compared without splitting
TURNS = 4  # rounds in which buckets with the same members draw, all that are left in the last
BLOCK = 1024  # sets in a block of a bucket that does not split
SLOTS = 1 << 24  # bits of the map of the texts that are asked for
_U = np.uint64
_A, _B, _C = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0xD6E8FEB86659FD93)


def runs_for(recall: float, threshold: float, branch: float = BRANCH, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold is found with probability `recall`.

    A pair shares a Poisson number of at least branch x threshold draws a step;
    a run loses it if that branching process dies out within `depth` steps.
    """
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(branch * threshold * (lost - 1))
    return math.ceil(math.log(1 - recall) / math.log(lost))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams."""
    ws = (text or "").encode("utf-8", "replace").split()
    if not ws:
        return np.empty(0, np.uint64)
    h = np.array([xxh3_64_intdigest(w) for w in ws], np.uint64)
    k = min(words, len(ws))
    x = h[:len(h) - k + 1] * _A
    for i in range(1, k):
        x ^= x >> _U(31)
        x = (x + h[i:len(h) - k + 1 + i]) * _B
    x ^= x >> _U(29)
    return np.unique(x * _C)


def _mix(x, salt):
    x = (x ^ salt) * _A
    x ^= x >> _U(32)
    x *= _C
    return x ^ (x >> _U(29))


def draw(tokens: np.ndarray, path: int, branch: float = BRANCH) -> np.ndarray:
    """Buckets (as signed longs) of the paths that a set follows from `path`."""
    salt = np.array([path % (1 << 64)], _U)  # arrays wrap without a warning
    least = min(branch / max(len(tokens), 1), 1.0)
    drawn = tokens[_mix(tokens, salt) <= _U(min(int(least * 2.0 ** 64), 2 ** 64 - 1))]
    return _mix(drawn * _B, _mix(salt, _C)).view(np.int64)


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the tokens that fall on each of 2^k bits, 2/3 to 4/3 as many as tokens (64 at least)."""
    width = max(64, 1 << math.ceil(math.log2(max(len(tokens), 1) / 1.5)))
    place = (_mix(tokens, _A) & _U(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def candidates(n: np.ndarray, sketches: list[bytes], threshold: float, block: np.ndarray | None = None) -> np.ndarray:
    """Whether a set can reach the threshold with another one (of another block, if given), by sizes and sketches."""
    out, width = np.zeros(len(n), bool), np.array([len(x) for x in sketches])
    most = (1 - threshold) / (1 + threshold)  # of both sizes, the share of tokens that one set holds alone
    bits = {}
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        bits[w] = own, np.frombuffer(b"".join([sketches[i] for i in own]), np.uint64).reshape(len(own), -1)
    for w, (i, a) in bits.items():
        # Sets of less than half the size are out of reach; other widths than these two occur with low thresholds only.
        for v, (j, b) in bits.items():
            if v < w:
                continue
            while b.shape[1] > a.shape[1]:
                half = b.shape[1] // 2
                b = b[:, :half] ^ b[:, half:]
            ni, nj = n[i][:, None], n[j][None, :]
            near = np.minimum(ni, nj) >= threshold * np.maximum(ni, nj) - 1e-9
            near &= (i[:, None] < j[None, :]) if v == w else True
            if block is not None:
                near &= block[i][:, None] != block[j][None, :]
            if not near.any():
                continue
            apart = np.zeros(near.shape, np.int32)
            for k in range(a.shape[1]):
                apart += np.bitwise_count(a[:, k][:, None] ^ b[:, k][None, :])
            near &= apart <= most * (ni + nj) + 1e-6
            out[i[near.any(1)]] = True
            out[j[near.any(0)]] = True
    return out


def _first_keys(docs: DataFrame, words: int, runs: int) -> DataFrame:
    """(doc_id, c, n, keys, sketch): content name, size of the set, buckets of the first step."""
    rows = docs.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("c"), "text")

    def make():
        def batch(b):
            n, keys, bits = [], [], []
            for t in b.column(2).to_pylist():
                s = shingles(t, words)
                n.append(len(s))
                keys.append(np.concatenate([draw(s, r + 1) for r in range(runs)]) if len(s) else [])
                bits.append(sketch(s) if len(s) else b"")
            yield {"doc_id": b.column(0), "c": b.column(1), "n": n, "keys": keys, "sketch": bits}
        return batch

    return map_batches(rows, make, "doc_id bigint, c string, n int, keys array<bigint>, sketch binary")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, text): one text for each of `wanted` (c, cid).

    Texts whose name meets none of the wanted ones in a bitmap of `SLOTS` bits stay where they are: of the
    others as many move as there are wanted ones, and a share that the bitmap's bound decides.
    """
    name = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    word = F.expr(f"shiftright(pmod(xxhash64(c), {SLOTS}L), 6)").alias("word")
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(c), 64) as int))")
    # At most SLOTS / 64 rows of two numbers, however many texts are wanted.
    bits = write_scratch(wanted.select(word, bit.alias("bit")).groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")), "join-bits")
    body = docs.select("doc_id", name.alias("c"), "text").withColumn("word", word).join(F.broadcast(bits), "word")
    body = body.where(F.col("bits").bitwiseAND(bit) != 0).select("doc_id", "c", "text")
    return body.join(wanted.select("c", "cid"), "c").where(F.col("doc_id").eqNullSafe(F.col("cid"))).select(
        "c", "text").dropDuplicates(["c"])


def _near(buckets: DataFrame, members: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """(key, kid, n): members that have a candidate in their bucket by `sketches` (kid, sketch).

    A large bucket is compared in pairs of blocks, each a group of bounded size.
    """
    rows = members.select("key", "kid", "n").join(buckets.select("key", "m"), "key").join(sketches, "kid")
    blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("kid", "key"), blocks).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pairs = rows.groupBy("key", F.least("block", "with").alias("bi"), F.greatest("block", "with").alias("bj")).agg(
        F.collect_list("block").alias("block"), F.collect_list("kid").alias("kid"), F.collect_list("n").alias("n"),
        F.collect_list("sketch").alias("sketch"))

    def make():
        def batch(b):
            keys, bi, bj = (b.column(i).to_pylist() for i in range(3))
            out = {"key": [], "kid": [], "n": []}
            for i in range(b.num_rows):
                block, kid, n = (b.column(c)[i].values.to_numpy() for c in (3, 4, 5))
                ok = candidates(n, b.column(6)[i].values.to_pylist(), threshold, block if bi[i] != bj[i] else None)
                out["key"] += [keys[i]] * int(ok.sum())
                out["kid"] += kid[ok].tolist()
                out["n"] += n[ok].tolist()
            yield out
        return batch

    return map_batches(pairs, make, "key bigint, kid bigint, n int").distinct()


def _sized(members: DataFrame, threshold: float) -> DataFrame:
    """Buckets that hold a pair: (key, m, x, y). Buckets with the same members have the same m, x and y."""
    size = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.min("n").alias("lo"), F.max("n").alias("hi"),
        F.expr("bit_xor(xxhash64(kid))").alias("x"), F.expr("bit_xor(xxhash64(kid, 1))").alias("y"))
    return size.where((F.col("m") > 1) & ((F.col("m") > 2) | (F.col("lo") >= F.lit(threshold) * F.col("hi")))).select(
        "key", "m", "x", "y")


def _once(buckets: DataFrame) -> DataFrame:
    """One of the buckets with the same members. Only for buckets that are judged: those that split draw each on their own."""
    return buckets.groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key", "m", "x", "y")


def _homes(buckets: DataFrame, members: DataFrame) -> DataFrame:
    """(key, kid, home, m, far, n_far) for the members of `buckets`; `home` is the largest bucket of the set.

    Pairs with the same home are judged there. So of a bucket that is home to none
    of its sets, those that share the most common home (`far`, `n_far` of them)
    need no comparison with each other, and a bucket that lies in another one goes.
    """
    held = members.select("key", "kid").join(buckets.select("key", "m"), "key")
    home = held.groupBy("kid").agg(F.max(F.struct("m", "key"))["key"].alias("home"))
    held = write_scratch(held.join(home, "kid"), "join-homes")
    each = held.where("home <> key").groupBy("key", "home").agg(F.count(F.lit(1)).alias("k")).groupBy("key").agg(
        F.max_by("home", F.struct("k", "home")).alias("far"), F.max("k").alias("n_far"))
    held = held.join(each, "key", "left").withColumn("n_far", F.coalesce("n_far", F.lit(0)))
    return held.where("n_far < m")


def _next_step(members: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Members (key, parent, kid, n) of the buckets that `members` (key, kid) split into."""
    paths = write_scratch(members.groupBy("kid").agg(F.collect_list("key").alias("paths")), "join-paths")  # a set is in few buckets

    def make():
        def batch(b):
            out = {"key": [], "parent": [], "kid": [], "n": []}
            for kid, t, keys in zip(*(b.column(i).to_pylist() for i in range(3))):
                s = shingles(t, words)
                for p in keys:
                    child = draw(s, p)
                    out["key"] += child.tolist()
                    out["parent"] += [p] * len(child)
                    out["kid"] += [kid] * len(child)
                    out["n"] += [len(s)] * len(child)
            yield out
        return batch

    return map_batches(texts.join(paths, "kid").select("kid", "text", "paths"), make, "key bigint, parent bigint, kid bigint, n int")


def _gathered(buckets: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, kid, m) of buckets that hold what hangs together by `buckets`, up to `BLOCK` sets, and of those of `buckets` that are in none.

    Sets of a group that meet in many different buckets are then compared once, in one place. What
    hangs together in larger numbers stays in its buckets.
    """
    held = write_scratch(members.select("key", "kid").join(buckets.select("key", "m"), "key").distinct(), "join-held")
    least = held.groupBy("key").agg(F.min("kid").alias("least"))
    joined = components(held.join(least, "key").select(F.col("kid").alias("u"), F.col("least").alias("v")))
    kids = held.select("kid").distinct().join(joined.withColumnRenamed("id", "kid"), "kid", "left").select(
        "kid", F.coalesce("component", "kid").alias("key"))
    size = kids.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    kids = write_scratch(kids.join(size, "key").select("key", "kid", "m"), "join-gathered")
    # All members of a bucket hang together.
    apart = held.join(kids.where(F.col("m") > BLOCK).select("kid"), "kid", "left_semi").select("key", "kid", "m")
    return kids.where(F.col("m") <= BLOCK), write_scratch(apart, "join-apart")


def _split(hot: DataFrame, members: DataFrame, texts: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Members of the children of `hot`, and its rows with `split`: no child keeps more than half of the bucket."""
    inside = members.join(hot.select("key"), "key", "left_semi")
    children = write_scratch(_next_step(inside, texts, words), "join-members")
    size = children.groupBy("parent", "key").agg(F.count(F.lit(1)).alias("m")).groupBy("parent").agg(F.max("m").alias("child"))
    split = hot.join(size, hot["key"] == size["parent"], "left").select(
        "key", "m", "x", "y", (F.coalesce("child", F.lit(0)) * 2 <= F.col("m")).alias("split"))
    return children, write_scratch(split, "join-split")


def _compare(group: list[tuple], threshold: float, words: int):
    """Links of one block pair: yields (kid, links) and forest edges (kid, other)."""
    key, kid, block, home = group[0][0], [g[4] for g in group], [g[3] for g in group], np.array([g[5] for g in group])
    sets = [shingles(g[6], words) for g in group]
    n = np.array([len(s) for s in sets])
    cross = group[0][1] != group[0][2]
    ok = np.minimum.outer(n, n) >= threshold * np.maximum.outer(n, n) - 1e-9
    ok &= np.arange(len(n))[:, None] < np.arange(len(n))[None, :]
    if cross:
        ok &= np.not_equal.outer(block, block)
    # A pair with one home is judged there, another one in the first bucket that both sets are compared in.
    same = np.equal.outer(home, home)
    ok &= ~same | (home == key)[:, None]
    before = [np.array([k for k in g[7] if k < key], np.int64) for g in group]
    if (ok & ~same).any() and sum(map(len, before)):
        ok &= same | (_shared(before) == 0)
    if not ok.any():
        return
    at = np.flatnonzero(ok.any(0) | ok.any(1))
    both = np.zeros((len(n), len(n)))
    both[np.ix_(at, at)] = _shared([sets[i] for i in at])
    linked = ok & (both >= threshold * (n[:, None] + n[None, :] - both) - 1e-9)
    links = linked.sum(0) + linked.sum(1)
    for i in np.flatnonzero(links):
        yield kid[i], None, int(links[i])
    root = list(range(len(n)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in np.argwhere(linked):
        a, b = find(i), find(j)
        if a != b:
            root[b] = a
            yield kid[i], kid[j], 0


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from the tokens that two sets or more hold."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    if not len(owner):
        return np.zeros((len(sets), len(sets)))
    _, token, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = held[token] > 1
    token, owner = np.unique(token[keep], return_inverse=True)[1], owner[keep]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = max(256, (1 << 24) // len(sets))  # columns at a time, 64 MB
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    for lo in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, [lo, lo + width])
        m = np.zeros((len(sets), min(width, int(token[b - 1]) + 1 - lo)), np.float32)
        m[owner[a:b], token[a:b] - lo] = 1
        out += m @ m.T
    return out


def _judge(members: DataFrame, buckets: DataFrame, names: DataFrame, texts: DataFrame, threshold: float, words: int) -> DataFrame:
    """Brute force of all `buckets`: (kid, other, links) rows of `_compare`; `names` are (kid, c) and `texts` (c, text).

    A large bucket is cut into blocks, those of its far sets first; each other block
    meets all blocks, and far blocks do not meet each other.
    """
    rows = write_scratch(_homes(buckets, members), "join-judged")
    active = rows.groupBy("kid").agg(F.array_sort(F.collect_list("key")).alias("active"))
    whole, far = F.col("m") <= BLOCK, F.col("home").eqNullSafe(F.col("far"))
    blocks = lambda k: F.when(whole, F.lit(0)).otherwise(F.ceil(k / F.lit(BLOCK))).cast("int")
    rows = rows.withColumns({"nf": blocks(F.col("n_far")), "no": F.when(whole, F.lit(1)).otherwise(blocks(F.col("m") - F.col("n_far")))})
    spread = F.xxhash64("kid", "key")
    rows = rows.withColumn("block", F.when(far & ~whole, F.pmod(spread, F.col("nf"))).otherwise(F.col("nf") + F.pmod(spread, F.col("no"))).cast("int"))
    met = F.sequence(F.when(F.col("block") < F.col("nf"), F.col("nf")).otherwise(F.lit(0)), F.col("nf") + F.col("no") - 1)
    rows = rows.withColumn("with", F.explode(met))
    rows = rows.select("key", F.least("block", "with").alias("bi"), F.greatest("block", "with").alias("bj"), "block", "kid", "home")
    rows = write_scratch(rows.join(active.join(names, "kid"), "kid"), "join-pairs")
    # Texts are dealt by their name already, and move once more, to their buckets.
    rows = rows.join(texts, "c").select("key", "bi", "bj", "block", "kid", "home", "text", "active")
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Groups are bounded, so hashing them apart spreads even the buckets that do not split.
    rows = rows.repartition(4 * n, "key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "kid")

    def run(batches):
        import pyarrow as pa

        def stream():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        out = []
        for _, group in groupby(stream(), key=lambda r: r[:3]):
            out += _compare(list(group), threshold, words)
            if len(out) > 20_000:
                yield pa.RecordBatch.from_pydict(_columns(out), schema)
                out = []
        yield pa.RecordBatch.from_pydict(_columns(out), schema)

    import pyarrow as pa
    schema = pa.schema([("kid", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])
    return rows.mapInArrow(run, "kid bigint, other bigint, links bigint")


def _columns(rows: list[tuple]) -> dict:
    return {name: [r[i] for r in rows] for i, name in enumerate(("kid", "other", "links"))}


def ngram_join(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row a document: doc_id, class_id (smallest id of its near-duplicate
    class), copy_id (smallest id with the same text), n_links (other texts whose
    similarity is the threshold or more), n_shingles.
    """
    with scratch_scope() as keep:
        return keep(write_scratch(_ngram_join(docs, words, threshold, runs_for(recall, threshold)), "join-result"))


def _ngram_join(docs: DataFrame, words: int, threshold: float, runs: int) -> DataFrame:
    rows = write_scratch(_first_keys(docs, words, runs), "join-rows")
    classes = rows.where("n > 0").groupBy("c").agg(
        F.min("doc_id").alias("cid"), *(F.first(x).alias(x) for x in ("n", "keys", "sketch")))
    classes = write_scratch(classes.withColumn("kid", F.monotonically_increasing_id()), "join-classes")

    members = classes.select(F.explode(F.array_distinct("keys")).alias("key"), F.lit(0).cast("bigint").alias("parent"), "kid", "n")
    shared = write_scratch(members.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key"), "join-shared")
    members = write_scratch(members.join(shared, "key", "left_semi"), "join-members")
    sized = write_scratch(_sized(members, threshold), "join-buckets")

    judged_buckets, judged_members = sized.where(F.col("m") <= SMALL), members
    hot = write_scratch(sized.where(F.col("m") > SMALL), "join-buckets")
    if not hot.isEmpty():
        drawing = members.join(hot.select("key"), "key", "left_semi").select("kid").distinct()
        drawing = write_scratch(classes.select("kid", "c", "cid").join(drawing, "kid"), "join-drawing")
        texts = write_scratch(_texts(docs, drawing).join(drawing.select("c", "kid"), "c").select("kid", "text"), "join-texts")
    for step in range(2, DEPTH + 1):
        if hot.isEmpty():
            break
        # Buckets with the same members draw in turns. Once one of them does not split, its members are compared as a
        # whole, and no other bucket of theirs can add a pair; if all split, each has drawn on its own in the end.
        rest, drawn, split = hot, None, None
        for turn in range(TURNS):
            now = write_scratch(_once(rest) if turn < TURNS - 1 else rest, "join-turn")
            more, done = _split(now, members, texts, words)
            drawn, split = (more, done) if drawn is None else (drawn.unionByName(more), split.unionByName(done))
            whole = _once(split.where("not split"))
            rest = rest.join(now.select("key"), "key", "left_anti").join(whole.select("m", "x", "y"), ["m", "x", "y"], "left_anti").select("key", "m", "x", "y")
            if turn < TURNS - 1 and rest.isEmpty():
                break
        judged_buckets = judged_buckets.unionByName(whole.select("key", "m", "x", "y"))
        parted = split.where("split").join(whole.select("m", "x", "y"), ["m", "x", "y"], "left_anti")
        members = drawn.join(parted.select(F.col("key").alias("parent")), "parent", "left_semi").select(
            "key", "parent", "kid", "n").distinct()
        sized = write_scratch(_sized(members, threshold), "join-buckets")
        judged_members = judged_members.unionByName(members.select(*judged_members.columns))
        small = F.lit(True) if step == DEPTH else F.col("m") <= SMALL
        judged_buckets = judged_buckets.unionByName(sized.where(small))
        hot = sized.where(~small)
    judged_buckets = write_scratch(_once(judged_buckets), "join-once")
    near = write_scratch(_near(judged_buckets, judged_members, classes.select("kid", "sketch"), threshold), "join-near")
    gathered, apart = _gathered(write_scratch(_once(_sized(near, threshold)), "join-once"), near)
    judged_members = write_scratch(gathered.unionByName(apart), "join-gathered")
    judged_buckets = judged_members.select("key", "m").distinct()
    wanted = write_scratch(classes.select("kid", "c", "cid").join(near.select("kid").distinct(), "kid"), "join-wanted")
    found = write_scratch(_judge(judged_members, judged_buckets, wanted.select("kid", "c"), _texts(docs, wanted), threshold, words), "join-found")
    links = found.where("other is null").groupBy("kid").agg(F.sum("links").alias("n_links"))
    joined = components(found.where("other is not null").select(F.col("kid").alias("u"), F.col("other").alias("v")))
    joined = joined.select(F.col("id").alias("kid"), "component")
    named = classes.select("c", "cid", "kid").join(joined, "kid", "left").join(links, "kid", "left").withColumn(
        "component", F.coalesce("component", "kid"))
    least = named.groupBy("component").agg(F.min("cid").alias("class_id"))
    named = named.join(least, "component").select("c", "cid", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = rows.select("doc_id", "c", "n").join(named, "c", "left")
    own = F.col("n") > 0
    return out.select("doc_id", F.when(own, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                      F.when(own, F.col("cid")).otherwise(F.col("doc_id")).alias("copy_id"),
                      F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.col("n").alias("n_shingles"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, with the smallest doc_id of their class.

    Rows without an id and rows without words stay, each apart. Of repeated rows
    with that id and text one stays.
    """
    # The row is one column, so that its columns may have any name.
    name = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), name.alias("c"))
    judged = ngram_join(docs).where("n_shingles > 0 and doc_id is not null").select(
        F.col("doc_id").alias("id"), (F.col("doc_id") == F.col("class_id")).alias("first"), F.lit(True).alias("judged")).distinct()
    rows = rows.join(judged, "id", "left").where("coalesce(first, true)")
    apart = F.when(F.col("judged"), F.lit("")).otherwise(F.uuid())
    return rows.withColumn("apart", apart).dropDuplicates(["id", "c", "apart"]).select("row.*")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir))
