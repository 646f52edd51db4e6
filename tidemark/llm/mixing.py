"""Mixing sources to target weights [native]: a low-discrepancy source schedule.

The mix is a sequence of slots, each `block_words` words long. Slot n has the
golden-ratio point frac(n * phi), which falls into one source's share of the
cumulative targets; the slot's rank among its source's slots names the block it
takes. A source's documents, in shuffled order, are one stream of words cut
into blocks of equal size; ranks beyond the last block start the stream again,
and stop after the second round. A document may be cut by a block, so each
source is met to about a block.

`schedule` writes the slots out with their source, rank and block; `mixed` joins
them to the stretches of the shuffled documents that their blocks hold, which is
the mix itself; `mix` adds up what it takes of each document.

Everything is DataFrame functions: one scan of the texts leaves narrow columns
(a written table); slots meet their shares by a bucketed join and their blocks by
an equi-join of (source, block). A slot's rank and a document's place are running
sums within pieces (runs of slots; leading digits of the md5 of the id that
orders a source's documents) behind the sums of the pieces before, so no source
sits in one task.

Defined results: a null text has size 0; null sources are one source, ranked
last; a source without words has target 0 and is taken 0 times; rows with the
same id are separate documents, ordered by size; an empty table gives no rows.
Columns besides doc_id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, documents, write_scratch

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 32
PIECE_ROWS = 20_000
PIECE_SLOTS = 1 << 16
ROUNDS = 2  # times that a source's blocks may be taken
# The golden-ratio sequence modulo 2^31 (odd multiplier nearest 2^31 * 0.618...).
GOLDEN, PERIOD = 1327217885, 1 << 31
CELLS = 1 << 12


def word_count(text):
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, num: int = 3, den: int = 2, most: int = 2) -> DataFrame:
    """(source, source_size) -> target words and share bounds, one row a source.

    Sources share num/den of all words by weight; a target stops at `most` times
    its source's size and the excess goes to the others by weight, again until
    none is above (in closed form: walk the sources by size / weight; those
    whose stop lies under the level of the rest are stopped). Integers up to
    one division, so that any engine finds the same doubles. One row a source
    passes through the windows here.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", F.row_number().over(order).alias("rank"), w.cast("long").alias("w"))
    by_fill = Window.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("rank"))
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # den x (words left for this source and the later ones), and their weight
    left = ranked.withColumn("left", num * F.sum("source_size").over(whole)
                             - den * most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
                             ).withColumn("weight", F.sum("w").over(rest))
    left = left.withColumn("stopped", den * most * F.col("source_size") * F.col("weight") <= F.col("w") * F.col("left"))
    level = left.where(~F.col("stopped")).orderBy((F.col("source_size") / F.col("w")).asc(), "rank").limit(1).select(
        F.col("left").alias("l_left"), F.col("weight").alias("l_weight"))
    target = F.when(F.col("stopped"), (most * F.col("source_size")).cast("double")).otherwise(
        (F.col("w") * F.col("l_left")).cast("double") / (den * F.col("l_weight")).cast("double"))
    met = left.join(level, F.lit(True), "left").select("source", "source_size", "rank", target.alias("target"))
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.round("target").cast("long")
    return met.withColumn("hi", F.sum(share).over(upto)).withColumn("lo", F.col("hi") - share)


def schedule(targets: DataFrame, n_words: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix in order: (slot, source_rank, rank, block).

    `source_rank` is the source's `rank` in `targets`, `rank` the slot's among those of
    its source (from 0), `block` the block of the source's stream that it takes.
    `n_words` are all the shares' words. Slots beyond the last round are left out.
    """
    spark = targets.sparkSession
    n_slots = -(-n_words // block_words)
    # Point in [0, n_words): the golden sequence scaled; cells make the interval join an equi-join.
    point = F.floor(F.pmod(F.pmod(F.col("slot"), F.lit(PERIOD)) * F.lit(GOLDEN), F.lit(PERIOD)).cast("double")
                    / F.lit(float(PERIOD)) * F.lit(float(n_words))).cast("long")
    cell = lambda p: F.floor(p.cast("double") / F.lit(float(max(n_words, 1))) * F.lit(float(CELLS))).cast("int")
    slots = spark.range(n_slots).withColumnRenamed("id", "slot").withColumn("p", point).withColumn("cell", cell(F.col("p")))
    blocks = F.greatest(F.ceil(F.col("source_size") / F.lit(block_words)).cast("long"), F.lit(1)).alias("blocks")
    shares = targets.where(F.col("hi") > F.col("lo")).select(
        F.col("rank").alias("source_rank"), "lo", "hi", blocks, F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))).alias("cell"))
    hit = slots.join(shares, "cell").where((F.col("p") >= F.col("lo")) & (F.col("p") < F.col("hi"))).select(
        "slot", "source_rank", "blocks", F.floor(F.col("slot") / F.lit(PIECE_SLOTS)).alias("piece"))
    # Rank: the slot's place within a run of slots, and the run's place within the source.
    ahead = Window.partitionBy("source_rank").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    runs = hit.groupBy("source_rank", "piece").agg(F.count(F.lit(1)).alias("k")).select(
        "source_rank", "piece", F.coalesce(F.sum("k").over(ahead), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("source_rank", "piece").orderBy("slot"))
    ranked = hit.withColumn("nth", within).join(runs, ["source_rank", "piece"]).withColumn("rank", F.col("before") + F.col("nth") - 1)
    return ranked.where(F.col("rank") < ROUNDS * F.col("blocks")).select("slot", "source_rank", "rank", (F.col("rank") % F.col("blocks")).alias("block"))


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights) -> tuple[DataFrame, DataFrame, int]:
    """Documents with their place in their source's shuffled stream, the sources' targets, and the words of all shares."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = rows.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    rows = write_scratch(rows.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")  # texts are read and counted once
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = write_scratch(source_targets(per_source.select("source", "source_size"), weights), "mix-targets")
    # Two numbers to the driver: words of the mix, and documents (for the number of pieces).
    n_words, n_docs = targets.agg(F.max("hi")).first()[0] or 0, per_source.agg(F.sum("n")).first()[0] or 0
    digits = max(1, len(f"{n_docs // PIECE_ROWS:x}"))

    # Start of each document: its place within a piece, and the piece's place within the source.
    rows = rows.withColumn("piece", F.substring("h", 1, digits))
    pieces = rows.groupBy("source", "piece").agg(F.sum("size").alias("piece_size"))
    ahead = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("piece_start", F.coalesce(F.sum("piece_size").over(ahead), F.lit(0)))
    pieces = pieces.alias("p").join(targets.alias("q"), F.expr("p.source <=> q.source")).select(
        F.col("p.source").alias("s"), F.col("piece").alias("b"), "piece_start", "source_size", "target", F.col("rank").alias("source_rank"))
    within = Window.partitionBy("source", "piece").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum("size").over(within))
    placed = rows.join(pieces, F.col("source").eqNullSafe(F.col("s")) & (F.col("piece") == F.col("b"))).select(
        "row", "doc_id", "source", "size", "source_size", "target", "source_rank",
        (F.col("piece_start") + F.col("upto") - F.col("size")).alias("start"))
    return write_scratch(placed, "mix-placed"), targets, n_words


def _mixed(placed: DataFrame, targets: DataFrame, n_words: int, block_words: int) -> DataFrame:
    """The schedule joined to what its blocks hold: (slot, source_rank, rank, block, row, doc_id, first, words)."""
    first_block, last_block = (F.floor(c / F.lit(block_words)).cast("long") for c in (F.col("start"), F.col("start") + F.col("size") - 1))
    held = placed.where(F.col("size") > 0).select(
        "source_rank", "row", "doc_id", "start", "size", F.explode(F.sequence(first_block, last_block)).alias("block"))
    lo = F.greatest(F.col("start"), F.col("block") * block_words)
    hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    held = held.select("source_rank", "block", "row", "doc_id", (lo - F.col("start")).alias("first"), (hi - lo).alias("words"))
    return schedule(targets, n_words, block_words).join(held, ["source_rank", "block"]).select(
        "slot", "source_rank", "rank", "block", "row", "doc_id", "first", "words")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights=WEIGHTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: (slot, source, rank, block, doc_id, first, words), a row for each stretch of a document that a slot takes.

    The stretch is the document's words `first` to `first + words - 1`, counted from 0; a slot's
    stretches follow each other in the order of the source's stream.
    """
    placed, targets, n_words = _placed(docs, id_col, text_col, source_col, weights)
    names = targets.select(F.col("rank").alias("source_rank"), "source")
    return _mixed(placed, targets, n_words, block_words).join(names, "source_rank").select(
        "slot", "source", "rank", "block", "doc_id", "first", "words")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Mix all documents; one row each: doc_id, source, size, source_size, target, start, taken.

    `start` is the document's first word in its source's shuffled stream.
    """
    placed, targets, n_words = _placed(docs, id_col, text_col, source_col, weights)
    taken = _mixed(placed, targets, n_words, block_words).groupBy("row").agg(F.sum("words").alias("taken"))
    return placed.join(taken, "row", "left").select("doc_id", "source", "size", "source_size", "target", "start",
                                                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1]::BIGINT AS w FROM r),
l AS (SELECT *, (SELECT 3 * sum(source_size) FROM w) - 4 * coalesce(sum(source_size) OVER (
        ORDER BY source_size / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
      sum(w) OVER (ORDER BY source_size / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wt FROM w),
t AS (SELECT *, 4 * source_size * wt <= w * lft AS stopped FROM l),
lv AS (SELECT lft AS l_left, wt AS l_weight FROM t WHERE NOT stopped ORDER BY source_size / w, rank LIMIT 1),
m AS (SELECT source, source_size, rank, CASE WHEN stopped THEN (2 * source_size)::DOUBLE
        ELSE (w * l_left)::DOUBLE / (2 * l_weight)::DOUBLE END AS target FROM t LEFT JOIN lv ON true),
b AS (SELECT *, sum(round(target)::BIGINT) OVER (ORDER BY rank)::BIGINT AS hi FROM m),
tot AS (SELECT max(hi) AS n FROM b),
slot AS (SELECT floor((((i % {PERIOD}) * {GOLDEN}) % {PERIOD})::DOUBLE / {float(PERIOD)} * n::DOUBLE)::BIGINT AS p
         FROM (SELECT unnest(range(((n + {BLOCK_WORDS - 1}) // {BLOCK_WORDS})::BIGINT)) AS i, n FROM tot)),
k AS (SELECT rank, count(*) AS slots FROM slot JOIN b ON p >= hi - round(target)::BIGINT AND p < hi GROUP BY rank),
q AS (SELECT b.*, greatest((source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS}, 1) AS blocks, coalesce(slots, 0) AS slots0
      FROM b LEFT JOIN k USING (rank)),
q2 AS (SELECT *, least(slots0, 2 * blocks) AS slots FROM q),
st AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM d)
SELECT st.doc_id, st.size, q2.source_size, q2.target,
  ((slots // blocks) * size + greatest(0, least(start + size, least((slots % blocks) * {BLOCK_WORDS}, q2.source_size)) - start))::BIGINT AS taken
FROM st JOIN q2 ON st.source IS NOT DISTINCT FROM q2.source
"""
