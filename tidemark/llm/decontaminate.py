"""Benchmark decontamination by pigeonhole edit matching.

Text and items are normalised (small letters, white space runs as one space). An
item of n characters may differ by k = floor(n x `budget`) edits. Cut into k + 1
pieces, an item within k edits of some part of a text leaves at least one piece
unharmed, so that piece stands in the text exactly, within k characters of its
place. One Aho-Corasick automaton finds all exact piece hits in a pass over the
whole text; a hit names an item and a stretch of text, and Myers' bit-parallel
edit distance (approximate search, one Python integer as bit vector) verifies the
stretch. Overlapping stretches of one item are verified once.

Items are broadcast in blocks: an item's block is its hash modulo a number that
is raised until no block exceeds `BLOCK_CHARS` characters (an item larger than
that is a block with whatever shares it). Each block is a pass over the texts, so
what is broadcast is bounded while the benchmark may grow.

Items of fewer than `MIN_CHARS` characters are searched without edits, as whole words.

Defined results: a null, empty or blank text holds no item; items that are null or
empty after normalising are not looked for; repeated items are found each under its id, a null item_id as null; rows
with the same id are searched apart; an empty table gives no rows.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import documents, map_batches, sf_table

BUDGET = 0.06
MIN_CHARS = 40  # shorter items are searched exactly, as whole words
BLOCK_CHARS = 8 << 20
HIT = "item_id bigint, edits int, start int, end int"


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def allowed(item: str, budget: float) -> int:
    """Edits that an item may have: none for short ones, which a few edits make another text."""
    return int(len(item) * budget) if len(item) >= MIN_CHARS else 0


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit goes on beyond the stretch's own."""
    cut = lambda a, b: a.isalnum() and b.isalnum()
    return not (start > 0 and cut(text[start - 1], text[start])) and not (end < len(text) and cut(text[end - 1], text[end]))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 stretches of the item that cover it: (offset, characters)."""
    edges = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


class Pattern:
    """Bit-parallel approximate search for one item (Myers)."""

    def __init__(self, item: str):
        self.n, self.bits = len(item), {}
        for i, c in enumerate(item):
            self.bits[c] = self.bits.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(fewest edits to any stretch of the text, first end of such a stretch)."""
        full, top = (1 << self.n) - 1, 1 << (self.n - 1)
        pv, mv, score = full, 0, self.n
        best, end = score, 0
        get = self.bits.get
        for j, c in enumerate(text, 1):
            eq = get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (full & ~(xh | pv))
            mh = pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = ph << 1 & full
            mh = mh << 1 & full
            pv = mh | (full & ~(xv | ph))
            mv = ph & xv
            if score < best:
                best, end = score, j
        return best, end


def finder(items: list[tuple[int | None, str]], budget: float):
    """Function from a normalised text to its hits (item id, edits, start, end)."""
    automaton, patterns = ahocorasick.Automaton(), [Pattern(t) for _, t in items]
    at: dict[str, list[tuple[int, int]]] = {}
    for i, (_, t) in enumerate(items):
        for offset, piece in pieces(t, allowed(t, budget)):
            at.setdefault(piece, []).append((i, offset))
    for piece, where in at.items():
        automaton.add_word(piece, (len(piece), where))
    if at:
        automaton.make_automaton()

    def find(text: str) -> list[tuple]:
        if not at or not text:
            return []
        stretches: dict[int, list[list[int]]] = {}
        for end, (length, where) in automaton.iter(text):
            for i, offset in where:
                k = allowed(items[i][1], budget)
                if len(items[i][1]) < MIN_CHARS and not whole_words(text, end + 1 - length, end + 1):
                    continue
                a = end + 1 - length - offset - k
                b = a + len(items[i][1]) + 2 * k
                known = stretches.setdefault(i, [])
                # Hits come by their end; the last few stretches may overlap this one.
                for s in reversed(known[-4:]):
                    if a <= s[1] and b >= s[0]:
                        s[0], s[1] = min(s[0], a), max(s[1], b)
                        break
                else:
                    known.append([a, b])
        out = []
        for i, known in stretches.items():
            k = allowed(items[i][1], budget)
            best = None
            for a, b in known:
                a = max(a, 0)
                edits, end = patterns[i].best(text[a:b])
                if edits <= k and (best is None or edits < best[1]):
                    best = (items[i][0], edits, max(a + end - len(items[i][1]), 0), a + end)
            if best:
                out.append(best)
        return out

    return find


def blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> list[DataFrame]:
    """The items to look for, in blocks of bounded size: (item_id, text)."""
    norm = F.trim(F.regexp_replace(F.lower(F.col("text")), r"\s+", " "))
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text")).where(F.length(norm) > 0)
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if not size:
        return []
    n = 1
    while True:
        part = F.pmod(F.xxhash64("text"), F.lit(n))
        most = items.groupBy(part.alias("p")).agg(F.sum(F.length("text")).alias("s"), F.count(F.lit(1)).alias("m")).where(
            (F.col("s") > block_chars) & (F.col("m") > 1)).agg(F.count(F.lit(1))).first()[0]
        if not most or n > 2 * size:
            return [items.where(part == i) for i in range(n)]
        n = max(n + 1, -(-2 * size // block_chars), 2 * n)


def contaminated(docs: DataFrame, items: DataFrame, budget: float = BUDGET, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, edits, start, end, text): each item that a row's text holds.

    The best place of the item in the normalised text; `text` is that stretch.
    """
    schema = StructType.fromDDL("doc_id bigint, " + HIT + ", text string")
    found = None
    for block in blocks(items, block_chars):
        wanted = [(r["item_id"], t) for r in block.collect() if (t := normalise(r["text"]))]
        held = docs.sparkSession.sparkContext.broadcast(wanted)

        def make(held=held):
            find = finder(held.value, budget)

            def batch(b):
                out = {f.name: [] for f in schema.fields}
                for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    t = normalise(t)
                    for item, edits, start, end in find(t):
                        for name, v in zip(out, (doc, item, edits, start, end, t[start:end])):
                            out[name].append(v)
                yield out
            return batch

        part = map_batches(docs.select("doc_id", "text"), make, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def keep_clean(docs: DataFrame, items: DataFrame, budget: float = BUDGET, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of `docs`, all columns, whose text holds no item."""
    for block in blocks(items, block_chars):
        wanted = [t for r in block.collect() if (t := normalise(r["text"]))]
        held = docs.sparkSession.sparkContext.broadcast([(None, t) for t in wanted])

        def run(batches, held=held):
            find = finder(held.value, budget)
            for b in batches:
                texts = b.column(b.schema.get_field_index("text")).to_pylist()
                clean = [i for i, t in enumerate(texts) if not find(normalise(t))]
                yield b.take(pa.array(clean, pa.int64()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), sf_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "edits", "start", "end")
