"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Features: lengths of url, host and path, path depth, digit ratio, character
entropy, parameters, subdomains, hyphens, scheme, and statistics of the host's
suffix and the path's first segment: their share of all urls and the share of
blocked ones among the labelled urls. These statistics are kept for `BUCKETS`
hashes of the suffix or segment, counted by Spark over all rows; so what reaches
the driver does not grow.

The trees are trained from labelled urls (url, label 1 = block), a bounded sample
of `MAX_ROWS` of them by hash. The query has no labels but its rules, so the urls
that a rule decides are the labelled ones, and the trees decide the others.

Defined results: a null url or one without :// has an empty host and path, no
rule, and the trees' verdict for such a url; with no labelled urls or one kind of
label only, the verdict is that label's (allow without labels); rows with the same
id are judged apart; an empty table gives no rows. Only page_id and url are read.
"""

from __future__ import annotations

from collections import Counter
from math import log2

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import gbdt
from tidemark.llm.common import map_batches, sf_table

# The contract's rules (verdict, host and path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
MAX_ROWS = 20_000
BUCKETS = 256
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), upper, lower)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        h, p = text.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def _suffix(host: Column) -> Column:
    return F.pmod(F.crc32(F.substring_index(host, ".", -1).cast("binary")), F.lit(BUCKETS)).cast("int")


def _segment(path: Column) -> Column:
    return F.pmod(F.crc32(F.substring_index(F.substring_index(path, "/", 2), "/", -1).cast("binary")), F.lit(BUCKETS)).cast("int")


def statistics(urls: DataFrame) -> np.ndarray:
    """(2, BUCKETS, 2): share of all rows, share of blocked among labelled, by suffix and by segment.

    `urls` has host, path and label (null: not labelled).
    """
    out = np.zeros((2, BUCKETS, 2))
    for i, bucket in enumerate((_suffix(F.col("host")), _segment(F.col("path")))):
        rows = urls.groupBy(bucket.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.count("label").alias("k"), F.coalesce(F.sum("label"), F.lit(0)).alias("s")).collect()
        total = sum(r["n"] for r in rows) or 1
        mean = (sum(r["s"] for r in rows) + 1) / (sum(r["k"] for r in rows) + 2)
        out[i, :, 1] = mean
        for r in rows:
            out[i, r["b"]] = r["n"] / total, (r["s"] + 5 * mean) / (r["k"] + 5)
    return out


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * log2(c / n) for c in Counter(text).values()) if n else 0.0


def features(url: str | None, host: str, path: str, suffix: int, segment: int, stats: np.ndarray) -> list[float]:
    url = url or ""
    query = url.partition("?")[2].partition("#")[0]
    n = max(len(url), 1)
    return [len(url), len(host), len(path), path.count("/"), sum(c.isdigit() for c in url) / n, entropy(url), entropy(host),
            len([q for q in query.split("&") if q]), host.count("."), host.count("-"), float(url.startswith("https")),
            float("#" in url), float(path.rpartition("/")[2].count(".") > 0), sum(c.isdigit() for c in host),
            *stats[0, suffix], *stats[1, segment]]


def parsed(urls: DataFrame, url: Column) -> DataFrame:
    made = urls.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    return made.withColumn("suffix", _suffix(F.col("host"))).withColumn("segment", _segment(F.col("path")))


def train(labelled: DataFrame, every: DataFrame, max_rows: int = MAX_ROWS) -> tuple[gbdt.Trees, np.ndarray]:
    """Trees and suffix statistics from `labelled` (url, label), counting shares over `every` (url)."""
    known = parsed(labelled.select("url", "label").where("url is not null and label is not null"), F.col("url"))
    stats = statistics(parsed(every.select("url"), F.col("url")).withColumn("label", F.lit(None).cast("int")))
    stats[:, :, 1] = statistics(known)[:, :, 1]
    # Ranges of the hash are counted first, so that no task sends rows that are not among the first of all.
    part = F.shiftright(F.xxhash64("url"), 48)
    ahead = F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))  # 65,536 rows at most
    parts = known.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).withColumn("ahead", F.coalesce(ahead, F.lit(0)))
    last = parts.where(F.col("ahead") < max_rows).agg(F.max("p")).first()[0]
    rows = known.where(part <= last).orderBy(F.xxhash64("url"), "url").limit(max_rows).collect() if last is not None else []
    x = np.array([features(r["url"], r["host"], r["path"], r["suffix"], r["segment"], stats) for r in rows], float)
    y = np.array([r["label"] for r in rows], float)
    if not len(rows):
        return gbdt.Trees(-5.0, 4), stats
    return gbdt.fit(x, y), stats


def score(pages: DataFrame, model: gbdt.Trees, stats: np.ndarray) -> DataFrame:
    """(page_id, host, path, rule, said, p_block) for each row."""
    rows = parsed(pages.select("page_id", "url"), F.col("url"))
    rule, said = rule_of(F.col("host"), F.col("path"))
    rows = rows.select("page_id", "url", "host", "path", "suffix", "segment", rule.alias("rule"), said.alias("said"))

    def make():
        def batch(b):
            c = [b.column(i).to_pylist() for i in range(1, 6)]
            x = np.array([features(*r, stats) for r in zip(*c)], float)
            yield {"page_id": b.column(0), "host": b.column(2), "path": b.column(3), "rule": b.column(6),
                   "said": b.column(7), "p_block": model.probabilities(x) if len(x) else []}
        return batch

    return map_batches(rows, make, "page_id bigint, host string, path string, rule string, said string, p_block double")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = sf_table(spark, sf_dir, "pages")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    said = rule_of(host, path)[1]
    labelled = pages.select("url", F.when(said == "block", 1).when(said == "allow", 0).alias("label"))
    model, stats = train(labelled, pages)
    scored = score(pages, model, stats)
    verdict = F.coalesce("said", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block")
