"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its hashed character n-grams, so an
unseen misspelling shares most of its vector with the word it stands for. A bag
averages the words of a short window, and a linear softmax judges the bag.
Embeddings and softmax are trained jointly (Adagrad, whole batches, numpy). A
text's logit is a smooth maximum over its bags, in training as in scoring: one
abusive phrase marks a long text, whatever the length.

Scoring needs one number for each n-gram bucket (the softmax of a mean is linear
before the exponential), so whole texts stream through array operations.

The model is fitted on a bounded sample of labelled rows: `per_class` rows of
each label of at most `max_chars` characters. It is a few MB and travels with
the tasks.

Defined results: a null, empty or blank text is the empty bag, scored by the
bias (low); rows with the same id are scored apart; without labels of both
kinds the model is the constant share of toxic labels (0 if there is none); an
empty table gives no rows. Only id and text are read, so other columns may have
any name. A null id is held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, fold, labelled_sample, map_batches, sf_table, text_chunks
from tidemark.llm.subwords import grams, word_ngrams

PER_CLASS = 1200
MAX_CHARS = 20_000
N_MIN, N_MAX, BUCKETS, DIM = 3, 5, 1 << 18, 8
WINDOW, SHARP, EPOCHS = 4, 3.0, 60


@dataclass
class Toxicity:
    """Score of each bucket (its embedding seen by the softmax) and the bias, as log odds."""

    bucket: np.ndarray
    bias: float

    def word_logits(self, words: list[str]) -> np.ndarray:
        total, n = np.zeros(len(words)), np.zeros(len(words))
        for ids, of in grams(words, N_MIN, N_MAX, BUCKETS, True):
            total += np.bincount(of, self.bucket[ids], len(words))
            n += np.bincount(of, minlength=len(words))
        return total / np.maximum(n, 1)


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


def bags(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bags over texts of `lens` words laid end to end: (first word, words, text)."""
    n_bags = np.where(lens > 0, np.maximum(lens - WINDOW + 1, 1), 0)
    text = np.repeat(np.arange(len(lens)), n_bags)
    starts = np.cumsum(lens) - lens
    nth = np.arange(n_bags.sum()) - np.repeat(np.cumsum(n_bags) - n_bags, n_bags)
    return starts[text] + nth, np.minimum(lens[text], WINDOW), text


def pooled(logits: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Smooth maximum of the bags' logits of each text; minus infinity without bags."""
    top = np.full(n_texts, -np.inf)
    if len(text):
        first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
        top[text[first]] = np.maximum.reduceat(logits, first)
    total = np.bincount(text, np.exp(SHARP * (logits - top[text])), n_texts)
    with np.errstate(divide="ignore"):
        return top + np.log(total) / SHARP


def sums(values: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    upto = np.concatenate(([0.0], np.cumsum(values)))
    return upto[first + n] - upto[first]


def fit(texts: list[str], toxic: list[int], seed: int = 7) -> Toxicity:
    y = np.asarray(toxic, float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Toxicity(np.zeros(BUCKETS, np.float32), 12.0 * (share - 0.5) * 2)
    docs = [tokens(t) for t in texts]
    vocabulary = sorted(set().union(*docs))
    index = {w: i for i, w in enumerate(vocabulary)}
    lens = np.fromiter(map(len, docs), np.int64, len(docs))
    word = np.fromiter((index[w] for d in docs for w in d), np.int32, int(lens.sum()))
    ids, of = word_ngrams(vocabulary, N_MIN, N_MAX, BUCKETS, True)
    # Embeddings are kept for the buckets that occur.
    used = np.flatnonzero(np.bincount(ids, minlength=BUCKETS))
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    ids = place[ids]
    per_word = np.bincount(of, minlength=len(vocabulary))
    first, n, text = bags(lens)
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 1e-2, (len(used), DIM)).astype(np.float32)
    softmax = rng.normal(0, 1, (DIM, 2))
    bias = np.array([2.0, -2.0])
    g_e = np.full((len(used), DIM), 1e-6, np.float32)
    g_w, g_b = np.full((DIM, 2), 1e-6), np.full(2, 1e-6)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    for epoch in range(EPOCHS):
        rate = 0.5 * (1 - epoch / EPOCHS) + 0.02
        d = softmax[:, 1] - softmax[:, 0]
        bucket = embedding @ d.astype(np.float32)
        w_score = np.bincount(of, bucket[ids], len(vocabulary)) / per_word
        logit = sums(w_score[word], first, n) / n + (bias[1] - bias[0])
        whole = pooled(logit, text, len(docs))
        whole = np.where(np.isfinite(whole), whole, bias[1] - bias[0])
        miss = (1 / (1 + np.exp(-np.clip(whole, -30, 30))) - y) * weight
        g_bag = miss[text] * np.exp(SHARP * (logit - whole[text]))
        # Back through the windows (a word gets the sum of its bags' shares), the words and the n-grams.
        edge = np.bincount(first, g_bag / n, len(word) + 1) - np.bincount(first + n, g_bag / n, len(word) + 1)
        g_word = np.bincount(word, np.cumsum(edge)[:-1], len(vocabulary)) / per_word
        g_bucket = np.bincount(ids, g_word[of], len(used))
        grad_e = np.outer(g_bucket, d).astype(np.float32)
        grad_d = embedding.T @ g_bucket.astype(np.float32)
        grad_w = np.stack([-grad_d, grad_d], 1)
        grad_b = np.array([-miss.sum(), miss.sum()])
        for value, grad, seen in ((embedding, grad_e, g_e), (softmax, grad_w, g_w), (bias, grad_b, g_b)):
            seen += grad * grad
            value -= rate * grad / np.sqrt(seen)
    bucket = np.zeros(BUCKETS, np.float32)
    bucket[used] = embedding @ (softmax[:, 1] - softmax[:, 0]).astype(np.float32)
    return Toxicity(bucket, float(bias[1] - bias[0]))


def scorer(model: Toxicity):
    """Function from texts to scores."""
    def score(texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for a, b in text_chunks(texts, 1 << 18):
            docs = [tokens(t) for t in texts[a:b]]
            lens = np.fromiter(map(len, docs), np.int64, len(docs))
            first, n, text = bags(lens)
            logit = sums(model.word_logits([w for d in docs for w in d]), first, n) / n + model.bias
            whole = pooled(logit, text, len(docs))
            out[a:b] = np.where(np.isfinite(whole), whole, model.bias)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))

    return score


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "toxic",
          per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Toxicity:
    """Fit on a bounded sample; `learn` is a condition on the column `_id`."""
    rows = labelled_sample(docs, labels, label, learn, per_class, max_chars).collect()
    return fit([r["text"] for r in rows], [int(r["label"]) for r in rows])


def score(docs: DataFrame, model: Toxicity) -> DataFrame:
    """(doc_id, score) for every row of `docs`."""
    def make():
        fn = scorer(model)
        return lambda b: [{"doc_id": b.column(0), "score": fn(b.column(1).to_pylist())}]

    return map_batches(docs.select("doc_id", "text"), make, "doc_id bigint, score double")


def keep_clean(docs: DataFrame, model: Toxicity, below: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, that score below `below`."""
    def run(batches):
        fn = scorer(model)
        for b in batches:
            scores = fn(b.column(b.schema.get_field_index("text")).to_pylist())
            yield b.filter(pa.array(scores < below))

    return docs.mapInArrow(run, docs.schema)


def learnable(mod: int, held: int):
    """Condition on `_id`: the fold is known and is not the held-out one."""
    return F.coalesce(fold(F.col("_id"), mod) != held, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, sf_table(spark, sf_dir, "labels"), learnable(5, 0))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
