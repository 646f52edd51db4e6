"""Language ID: sparse multinomial logistic regression on TF-IDF character
n-grams, trained with follow-the-regularised-leader updates and an elastic-net
penalty, then calibrated with one temperature.

N-grams of 1 to 3 characters of each word (between two marks) are hashed. A
feature's value is its share of the text's n-grams, in percent, times its
inverse document frequency. Document frequencies are counted by Spark over all
documents that may be learned from; the regression is fitted on a bounded
sample of them (`per_class` rows of each language of at most `max_chars`
characters), a fifth of which is kept to find the temperature.

Scoring sums idf x weight over the n-grams of the whole text.

Defined results: `und` with score 0 where the text is null or has no letter, or
nothing could be learned; rows with the same id are judged apart; an empty table
gives no rows. Only id, text (and lang, to learn) are read. A null id is held out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, fold, labelled_sample, map_batches, text_chunks
from tidemark.llm.ftrl import Ftrl
from tidemark.llm.subwords import grams
from tidemark.llm.toxicity import learnable, tokens

PER_CLASS = 800
MAX_CHARS = 10_000
N_MIN, N_MAX, BUCKETS = 1, 3, 1 << 15
PASSES = 2
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Language:
    languages: list[str]
    weights: np.ndarray  # bucket x language, idf included
    bias: np.ndarray
    temperature: float


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents that hold each n-gram bucket, and their number last.

    Each task adds up its own documents; at most BUCKETS + 1 sums reach the driver.
    """
    def run(batches):
        import pyarrow as pa
        df, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                seen = np.zeros(BUCKETS, bool)
                words = list(set(tokens(t)))
                for lo, hi in text_chunks(words, 1 << 18):
                    for ids, _ in grams(words[lo:hi], N_MIN, N_MAX, BUCKETS, False):
                        seen[ids] = True
                df += seen
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, BUCKETS), pa.int32()), pa.array(np.append(df[at], n), pa.int64())], ["bucket", "n"])

    parts = docs.select("text").where(F.col("text").isNotNull()).mapInArrow(run, "bucket int, n long")
    out = np.zeros(BUCKETS + 1, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def shares(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their share of its n-grams, in percent."""
    ids = np.concatenate([g for g, _ in grams(tokens(text), N_MIN, N_MAX, BUCKETS, False)] or [np.empty(0, np.int32)])
    at, n = np.unique(ids, return_counts=True)
    return at, 100.0 * n / max(n.sum(), 1)


def fit(texts: list[str], langs: list[str], frequencies: np.ndarray, seed: int = 3) -> Language | None:
    known = sorted(set(langs))
    if not known:
        return None
    idf = np.log((1 + frequencies[-1]) / (1 + frequencies[:-1])) + 1
    y = np.eye(len(known))[[known.index(x) for x in langs]]
    made = []
    for t in texts:
        at, share = shares(t)
        made.append((np.append(at, BUCKETS), np.append(share * idf[at], 1.0)))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    aside = order[:len(order) // 5]
    model = Ftrl(BUCKETS + 1, len(known), alpha=0.1, l1=0.05, l2=0.01)
    for _ in range(PASSES):
        for i in rng.permutation(order[len(aside):]):
            model.step(*made[i], y[i])
    w = model.weights()
    temperature = 1.0
    if len(aside):
        logits = np.stack([made[i][1] @ w[made[i][0]] for i in aside])

        def loss(t: float) -> float:
            z = logits / t
            z = z - z.max(1, keepdims=True)
            return float(-(y[aside] * (z - np.log(np.exp(z).sum(1, keepdims=True)))).sum())

        temperature = min(np.geomspace(0.1, 10, 81), key=loss)
    return Language(known, (w[:-1] * idf[:, None]).astype(np.float32), w[-1], float(temperature))


def train(docs: DataFrame, learn: Column, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Language | None:
    """Fit from text and non-null `lang`; `learn` is a condition on the column `_id`."""
    usable = docs.select(F.col("doc_id").alias("_id"), "text", "lang").where(learn & F.col("lang").isNotNull())
    usable = usable.withColumnRenamed("_id", "doc_id")
    rows = labelled_sample(usable, usable, "lang", F.lit(True), per_class, max_chars).collect()
    rows = [r for r in rows if LETTER.search(r["text"])]
    return fit([r["text"] for r in rows], [r["label"] for r in rows], document_frequencies(usable))


def predictor(model: Language | None):
    """Function from texts to (language, score) lists."""
    def predict(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if model is None:
            return names, score
        for a, b in text_chunks(texts, 1 << 18):
            docs = [tokens(t) for t in texts[a:b]]
            doc = np.repeat(np.arange(b - a), list(map(len, docs)))
            total, n = np.zeros((b - a, len(model.languages))), np.zeros(b - a)
            for ids, of in grams([w for d in docs for w in d], N_MIN, N_MAX, BUCKETS, False):
                at = doc[of]
                n += np.bincount(at, minlength=b - a)
                for k in range(total.shape[1]):
                    total[:, k] += np.bincount(at, model.weights[ids, k], b - a)
            logits = (100 * total / np.maximum(n, 1)[:, None] + model.bias) / model.temperature
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            for i, t in enumerate(texts[a:b]):
                if t and LETTER.search(t):
                    names[a + i], score[a + i] = model.languages[best[i]], p[i, best[i]]
        return names, score

    return predict


def predict(docs: DataFrame, model: Language | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of `docs`."""
    def make():
        fn = predictor(model)

        def batch(b):
            names, score = fn(b.column(1).to_pylist())
            return [{"doc_id": b.column(0), "lang_pred": names, "score": score}]

        return batch

    return map_batches(docs.select("doc_id", "text"), make, "doc_id bigint, lang_pred string, score double")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, train(docs, learnable(5, 0))).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score")
