"""Toxicity by multiple-instance learning.

Method.  A document is a bag of sentences.  A sentence has probability
``p = sigmoid(bias + sum of the weights of its distinct terms)``, a term being a
word or the start of one (so that a stem counts under any ending); a document is toxic if
any sentence is: ``P = 1 - prod(1 - p)`` (noisy-or).  Only document labels are
given; the gradient of the document's loss is shared among its sentences, so the
sentences that explain the label get the weight.  Training uses a bounded,
stratified sample of labelled rows (``per_class`` of each class, the one
documented bound here); rows are re-weighted to the classes' true shares.  The
model is a table of at most ``FEATURES`` terms, those of the sample that tell its classes
apart best: weights for all of them would learn single documents (README has the figures).  Every sentence of every whole
text is scored, and sentences above ``threshold`` are returned with their code
point spans.

Defined results.  A null or empty text has no sentence and scores 0.  With no
training row of one of the classes every score is the class-1 share of the
labels (0 without any label).  Null ids are scored and never held out; repeated
rows give repeated rows, an empty table an empty result.  Of texts that share a labelled id the one whose
bag comes first is learnt.  Other columns of the input are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold, labelled_sample, materialize

PER_CLASS, FEATURES, ROUNDS = 2500, 1024, 400
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
STARTS = (4, 5, 6, 7)  # lengths of word starts that are terms


def sentences(text: str | None) -> list[tuple[int, int, list[str]]]:
    """(start, end, lower-case words) of each sentence that has words."""
    out = []
    for m in SENTENCE.finditer(text or ""):
        words = WORD.findall(m.group().lower())
        if words:
            out.append((m.start(), m.end(), words))
    return out


def terms(word: str) -> list[str]:
    """A word as a term, and its starts, marked by a hyphen."""
    return [word, *[word[:k] + "-" for k in STARTS if k < len(word)]]


def _bag_batches(batches):
    for batch in batches:
        bags = [[sorted({x for w in set(words) for x in terms(w)}) for _, _, words in sentences(t.as_py())]
                for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(bags, pa.list_(pa.list_(pa.string())))],
            ["doc_id", "y", "bag"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", *, id_col: str = "doc_id",
        text: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT,
        per_class: int = PER_CLASS, features: int = FEATURES, rounds: int = ROUNDS) -> dict:
    """Weights of words and the bias, learnt from document labels."""
    ids, counts = labelled_sample(labels, label, folds, held_out, per_class)
    total = sum(counts.values())
    model = {"prior": counts.get(1, 0) / total if total else 0.0, "weights": None, "bias": 0.0}
    if len(counts) < 2:
        return model
    bags = (docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
            .join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text")
            .mapInArrow(_bag_batches, f"doc_id {docs.schema[id_col].dataType.simpleString()}, y int, bag array<array<string>>")
            .groupBy("doc_id", "y").agg(F.min("bag").alias("bag")))
    bags = materialize(bags, "bags").select("doc_id", "y", F.posexplode_outer("bag").alias("s", "words"))
    # Words are chosen by their document frequency in either class of the sample.
    held = (bags.select("doc_id", "y", F.explode("words").alias("w")).distinct()
            .groupBy("w").agg(F.sum(F.col("y")).alias("n1"), F.sum(1 - F.col("y")).alias("n0")))
    size = {r["y"]: r["n"] for r in bags.groupBy("y").agg(F.countDistinct("doc_id").alias("n")).collect()}
    if len(size) < 2:
        return model
    odds = F.log(((F.col("n1") + 0.5) / (size[1] + 1)) / ((F.col("n0") + 0.5) / (size[0] + 1)))
    z = odds / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    vocab = [r["w"] for r in held.where("n1 + n0 >= 3").orderBy(F.abs(z).desc(), "w").limit(features).collect()]
    index = {w: i for i, w in enumerate(vocab)}
    # What reaches the driver: of the sample's sentences, those words that were chosen.
    keep = F.broadcast(docs.sparkSession.createDataFrame(list(index.items()), "w string, f int"))
    hits = (bags.select("doc_id", "s", F.explode("words").alias("w")).join(keep, "w")
            .groupBy("doc_id", "s").agg(F.sort_array(F.collect_list("f")).alias("f")))
    rows = (bags.select("doc_id", "y", "s").join(hits, ["doc_id", "s"], "left")
            .groupBy("doc_id", "y", F.coalesce("f", F.array().cast("array<int>")).alias("f"))
            .agg(F.count("s").alias("n")).orderBy("doc_id", "f").collect())
    shares = {c: counts[c] / total / (size[c] / sum(size.values())) for c in (0, 1)}
    model["weights"], model["bias"] = _train(rows, len(vocab), shares, rounds)
    model["weights"] = {w: float(model["weights"][i]) for w, i in index.items()}
    return model


def _train(rows, n_features: int, shares: dict, rounds: int) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the noisy-or likelihood.  Equal sentences of a document
    are one row with a count."""
    ids = {}
    doc = np.array([ids.setdefault(r["doc_id"], len(ids)) for r in rows])
    times = np.array([float(r["n"]) for r in rows])
    y = np.zeros(len(ids))
    y[doc] = [r["y"] for r in rows]
    cost = np.where(y == 1, shares[1], shares[0]) / len(ids)
    at = np.repeat(np.arange(len(rows)), [len(r["f"]) for r in rows])
    feat = np.array([f for r in rows for f in r["f"]], int)
    theta = np.zeros(n_features + 1)
    theta[-1] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        z = theta[-1] + np.bincount(at, theta[feat], len(rows))
        p = 1 / (1 + np.exp(-z.clip(-30, 30)))
        log_clean = -np.bincount(doc, times * np.logaddexp(0, z.clip(-30, 30)), len(ids))
        toxic = -np.expm1(log_clean)
        # d loss / d z of a sentence: p for clean bags, -p * (1-P)/P for toxic ones
        g_doc = cost * np.where(y == 1, -np.exp(log_clean) / np.maximum(toxic, 1e-9), 1.0)
        g_z = g_doc[doc] * times * p
        g = np.append(np.bincount(feat, g_z[at], n_features), g_z.sum()) + 2e-6 * np.append(theta[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:-1], float(theta[-1])


class _Known(dict):
    """The terms of a word that have a weight, looked up once for each word;
    forgets all when it has grown to ``most`` words."""

    def __init__(self, weights: dict, most: int = 200_000):
        super().__init__()
        self.weights, self.most = weights, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        self[word] = got = tuple(x for x in terms(word) if x in self.weights)
        return got


def judge(text: str | None, model: dict, threshold: float = THRESHOLD, known: _Known | None = None):
    """(score, offending sentences as (start, end, probability)) of a whole text."""
    if model["weights"] is None:
        return model["prior"], []
    known = (_Known(model["weights"]) if known is None else known).__getitem__
    get, bias, clean, found = model["weights"].get, model["bias"], 0.0, []
    for start, end, words in sentences(text):
        z = bias + sum(get(x, 0.0) for x in {x for w in words for x in known(w)})
        clean -= z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
        p = 1 / (1 + math.exp(-z)) if z > -30 else 0.0
        if p >= threshold:
            found.append((start, end, p))
    return -math.expm1(clean), found


def score(docs: DataFrame, model: dict, *, id_col: str = "doc_id", text: str = "text",
          folds: int = FOLDS, held_out: int = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, offending) of every row; ``offending``
    holds (start, end, probability) of sentences, in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def run(batches):
        m = shared.value
        known = _Known(m["weights"] or {})
        for batch in batches:
            got = [judge(t.as_py(), m, threshold, known) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([min(max(s, 0.0), 1.0) for s, _ in got], pa.float64()),
                 pa.array([[{"start": a, "end": b, "probability": p} for a, b, p in f] for _, f in got], spans)],
                ["doc_id", "score", "offending"])

    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double, "
             "offending array<struct<start:int,end:int,probability:double>>")
    return out.select("doc_id", F.coalesce(fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "offending")
