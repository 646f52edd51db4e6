"""Quality rules: a threshold table compiled into one Spark projection.

The statistics are built-in functions over the whole text (no user function):
words, symbols, repeated lines, repeated 5-word windows, stop words. A window
is told by the 64-bit hash of its five words, so finding repeated windows is
one distinct test and, only for texts that have any, one sort of numbers.

`RULES` is the table: each row names a statistic, the least and the most it may
be, and from how many words on the rule holds. `compile_rules` turns any such
table into one boolean column for each rule, in one projection.

Defined results: a null, empty or blank text has no words, fails the base and
is not kept; rows with the same id are judged apart; an empty table gives no
rows. Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, documents

WINDOW = 5
# Frequent function words of the languages the rules are meant for.
STOP_WORDS = ("the and of to in is that it for on with as are this be by was "
              "de la le les des et un une du que qui en pour dans el los las y del por con se al "
              "der die das und ist von zu den mit ein eine im au sur").split()
# (rule, statistic, least, most, from how many words on)
RULES = (
    ("mean_word_length", "mean_word_chars", 2.0, 20.0, 10),
    ("symbol_ratio", "symbol_ratio", None, 0.1, 10),
    ("exclamation_ratio", "exclamation_ratio", None, 0.3, 10),
    ("stop_word_ratio", "stop_ratio", 0.02, None, 50),
    ("repeated_line_ratio", "dup_line_ratio", None, 0.5, 10),
    ("text_length", "n_words", 10, None, 0),
)


def statistics(text: Column) -> dict[str, Column]:
    """Raw statistics of a text column; arrays first, so that each is made once."""
    body = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    return {
        "_words": words,
        "_lines": lines,
        "n_symbols": F.length(body) - F.length(F.translate(body, "#*$%&|<>", "")),
        "_exclaims": F.length(body) - F.length(F.translate(body, "!", "")),
        "_chars": F.length(F.translate(body, " \t\n\x0b\x0c\r", "")),
    }


def _windows(words: Column) -> Column:
    """Hash of the WINDOW words from each place on."""
    at = lambda i, k: F.get(words, i + k)
    places = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW))
    return F.coalesce(F.transform(places, lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])),
                      F.array().cast("array<bigint>"))


def _sorted_windows(windows: Column) -> Column:
    """(hash, place) of the windows in order of hash, then place."""
    return F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _repeat_words(pairs: Column) -> Column:
    """Words under a window found twice or more, from `_sorted_windows`.

    A window is repeated if a neighbour has its hash; the places of those, in
    order, each cover up to WINDOW words not covered yet. `pairs` has to be a
    column of its own: an expression would be made again for each element.
    """
    same = lambda p, i, d: F.coalesce(F.get(pairs, i + d)["h"] == p["h"], F.lit(False))
    marked = F.transform(pairs, lambda p, i: F.when(same(p, i, -1) | same(p, i, 1), p["i"]))
    return _covered(F.array_sort(F.filter(marked, lambda x: x.isNotNull())))


def _covered(places: Column) -> Column:
    zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(places, zero, lambda a, p: F.struct(
        (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])


def compile_rules(rules, stats: dict[str, Column]) -> dict[str, Column]:
    """One boolean column for each row of the table: the rule holds or does not apply."""
    out = {}
    for name, stat, least, most, from_words in rules:
        value, ok = stats[stat], F.lit(True)
        if least is not None:
            ok = ok & (value >= F.lit(least))
        if most is not None:
            ok = ok & (value <= F.lit(most))
        out[name] = (stats["n_words"] < F.lit(from_words)) | ok
    return out


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row a document: id, statistics, base_failed, a column `ok_<rule>` each, kept."""
    stats = statistics(F.col(text_col))
    made = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(n) for n, c in stats.items()])
    made = made.withColumn("_windows", _windows(F.col("_words")))
    # The sort runs only for texts with a repeated window.
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    n_words = F.size("_words").cast("long")
    made = made.withColumn("_pairs", F.when(repeated, _sorted_windows(F.col("_windows"))))
    made = made.select(
        "doc_id", "n_symbols", "_exclaims", n_words.alias("n_words"),
        F.col("_chars").cast("long").alias("word_chars"),
        F.coalesce(_repeat_words(F.col("_pairs")), F.lit(0)).cast("long").alias("n_repeat_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").alias("_n_lines"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).alias("_n_stop"))
    n = F.greatest(F.col("n_words"), F.lit(1))
    derived = {
        "n_words": F.col("n_words"),
        "mean_word_chars": F.col("word_chars") / n,
        "symbol_ratio": F.col("n_symbols") / n,
        "exclamation_ratio": F.col("_exclaims") / n,
        "stop_ratio": F.col("_n_stop") / n,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
    }
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    verdicts = compile_rules(rules, derived)
    kept = ~base_failed
    for v in verdicts.values():
        kept = kept & v
    return made.select("doc_id", "n_words", "word_chars", F.col("n_symbols").cast("long").alias("n_symbols"),
                       "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"),
                       *[v.alias(f"ok_{k}") for k, v in verdicts.items()], kept.alias("kept"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
b AS (SELECT rid, doc_id, len(ws)::BIGINT AS n_words, len(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
        (len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(t) - len(replace(t, '!', '')))::BIGINT AS n_ex,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
        len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop FROM w),
p AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, i, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS k,
        lead(i, 4) OVER o IS NOT NULL AS whole FROM p WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM g WHERE whole) WHERE c > 1),
cov AS (SELECT rid, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words
        FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM r) GROUP BY rid),
f AS (SELECT b.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words AS base_failed FROM b LEFT JOIN cov USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 20.0 AND n_symbols / n_words <= 0.1 AND n_ex / n_words <= 0.3
  AND (n_words < 50 OR n_stop / n_words >= 0.02) AND n_dup_lines / n_lines <= 0.5 AS kept
FROM f
"""
