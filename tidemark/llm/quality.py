"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Words are hashed in two forms: as they stand, and by shape (runs of capitals,
small letters, digits or one other character, and whether the word is the
previous one again). N-grams of both forms go into one hashed space; a
feature's value is the square root of its share of the text's n-grams.

Fitted on a bounded sample: `per_class` rows of each label of at most
`max_chars` characters. Every text is scored whole.

Defined results: a null, empty or blank text scores as quality 0 would by the
bias feature alone; rows with the same id are scored apart; without labels of
both kinds the score is the labels' mean (0 without labels); an empty table gives
no rows. Only id and text are read. A null id is held out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, fold, labelled_sample, map_batches, sf_table, text_chunks
from tidemark.llm.ftrl import Ftrl
from tidemark.llm.toxicity import learnable

PER_CLASS = 2500
MAX_CHARS = 20_000
FEATURES = 1 << 20
PASSES = 3
_U = np.uint64
_C1, _C2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_PLACE = np.random.default_rng(43).integers(1, 1 << 62, 64, dtype=np.uint64) | _U(1)
# Kind of each byte: 0 white space, 1 capital, 2 small letter (or part of another character), 3 digit, else itself.
_KIND = np.arange(256, dtype=np.uint64) + _U(4)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58] = 1, 2, 2, 3


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + _U(salt)) * _C1
    x ^= x >> _U(29)
    x *= _C2
    return (x >> _U(40)) & _U(FEATURES - 1)


def _hash(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each stretch of `codes`; stretches begin at `first`."""
    place = np.arange(len(codes)) - np.repeat(first, np.diff(np.append(first, len(codes))))
    x = np.add.reduceat((codes + _U(1)) * _PLACE[place & 63], first)
    return x ^ (x >> _U(32))


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of each text: (text, feature id, value), by text.

    Feature 0 of value 1 is the bias; each text has it.
    """
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    text_ends = np.cumsum([len(r) + 1 for r in raw])
    kind = _KIND[data]
    inside = kind != 0
    code, kind_in, place = data[inside].astype(np.uint64), kind[inside], np.flatnonzero(inside)
    n = len(texts)
    none = np.zeros(0, np.int64)
    if not len(place):
        return np.arange(n), np.zeros(n, np.int64), np.ones(n)
    new_word = np.concatenate(([True], np.diff(place) > 1))
    first = np.flatnonzero(new_word)
    surface = _hash(code, first)
    new_run = new_word.copy()  # shape: one code for each run of a kind
    new_run[1:] |= kind_in[1:] != kind_in[:-1]
    runs = np.flatnonzero(new_run)
    form = _hash(kind_in[runs], np.searchsorted(runs, first))
    text = np.searchsorted(text_ends, place[first], "right")
    same = np.concatenate(([False], text[1:] == text[:-1]))  # the word before is of the same text
    form[1:] += (same[1:] & (surface[1:] == surface[:-1])).astype(np.uint64) * _U(0x51ED270B)
    two = form[:-1] * _C2 + form[1:]
    pair, triple = np.flatnonzero(same), np.flatnonzero(same[1:] & same[:-1]) + 1
    key = lambda x, at, salt: (text[at].astype(np.uint64) << _U(20)) | _mix(x, salt)
    every = np.arange(len(first))
    keys = np.concatenate([
        key(surface, every, 11), key(form, every, 13),
        key(surface[pair - 1] * _C2 + surface[pair], pair, 17), key(two[pair - 1], pair, 19),
        key(two[triple - 2] * _C1 + form[triple], triple, 23) if len(triple) else none.astype(np.uint64)])
    keys.sort()
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    count = np.diff(np.append(at, len(keys)))
    of = (keys[at] >> _U(20)).astype(np.int64)
    value = np.sqrt(count / np.bincount(of, count, n)[of])
    of, ids = np.concatenate((np.arange(n), of)), np.concatenate((np.zeros(n, np.int64), (keys[at] & _U(FEATURES - 1)).astype(np.int64)))
    return of, ids, np.concatenate((np.ones(n), value))


def fit(texts: list[str], quality: list[int], seed: int = 5) -> np.ndarray:
    """Weights of the hashed features (float32, FEATURES long)."""
    model = Ftrl(FEATURES, 1, alpha=0.5, l1=1e-3, l2=1e-3)
    y = np.asarray(quality, float)
    if not len(y) or y.min() == y.max():
        only = np.zeros(FEATURES, np.float32)
        only[0] = 24 * ((y.mean() if len(y) else 0.0) - 0.5)
        return only
    made = [features([t])[1:] for t in texts]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    order = np.random.default_rng(seed)
    for _ in range(PASSES):
        for i in order.permutation(len(y)):
            ids, x = made[i]
            model.step(ids, x * min(weight[i], 3.0) ** 0.5, y[i:i + 1])
    return model.weights()[:, 0].astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "quality",
          per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> np.ndarray:
    rows = labelled_sample(docs, labels, label, learn, per_class, max_chars).collect()
    return fit([r["text"] for r in rows], [int(r["label"]) for r in rows])


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) for every row of `docs`."""
    at = np.flatnonzero(weights)
    held = at.astype(np.int32), weights[at]  # sparse: what travels with the tasks

    def make():
        w = np.zeros(FEATURES)
        w[held[0]] = held[1]

        def batch(b):
            texts = b.column(1).to_pylist()
            out = np.zeros(len(texts))
            for lo, hi in text_chunks(texts, 1 << 18):
                of, ids, x = features(texts[lo:hi])
                out[lo:hi] = np.bincount(of, x * w[ids], hi - lo)
            return [{"doc_id": b.column(0), "score": 1 / (1 + np.exp(-np.clip(out, -30, 30)))}]

        return batch

    return map_batches(docs.select("doc_id", "text"), make, "doc_id bigint, score double")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights = train(docs, sf_table(spark, sf_dir, "labels"), learnable(3, 1))
    return score(docs, weights).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
