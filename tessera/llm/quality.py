"""Quality classifier: nearest-neighbour voting among labelled latent-semantic
vectors.

Method.  A text becomes counts of its byte trigrams, hashed into ``HASHED``
cells, and two terms for its share of words that repeat the word before them and
of lines that occurred before (by tenths); all are weighted ``log(1 + tf) * idf``
and scaled to length one.  Letter case, digits and punctuation all take part.  Document frequencies are counted over *all*
documents.  A bounded, stratified sample of labelled training rows
(``per_class`` of each class, the one documented bound here) is decomposed by a
truncated SVD, and its latent vectors are broadcast; their size is
``2 * per_class * rank`` floats whatever the corpus.  Every document is folded
in, its cosine to every reference is computed exactly in blocks, and its ``k``
nearest, ties (to six decimals) by the reference's id, vote with weight ``similarity ** sharpness``.  Votes are re-weighted by
class share over sample share, so stratifying does not shift the scores.

Defined results.  Null and empty texts are scored like any other: all-zero
vector, no neighbour is near, and the score is the class-1 share of the training
labels.  With no training row of one of the classes every score is that share
(0.5 without any label).  Null ids are scored and are never held out; repeated
rows give repeated rows, an empty table an empty result.  Of texts that share a labelled id the one whose
counts come first as bytes is learnt.  Other columns of the input are ignored.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold, labelled_sample

HASHED, RANK, PER_CLASS, NEIGHBOURS, SHARPNESS = 2048, 64, 1500, 15, 8.0
DIMS = HASHED + 22  # and eleven steps of either repetition
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
_PIECE = 1 << 20  # bytes hashed at once: memory stays flat for very long texts


def term_counts(text: str | None) -> np.ndarray:
    """Counts of the terms of a whole text."""
    whole = (text or "").encode("utf-8", "surrogatepass")
    raw, out = np.frombuffer(whole, np.uint8), np.zeros(DIMS, np.int64)
    words, lines = whole.split(), whole.split(b"\n")
    if len(words) > 1:
        again = 10 * sum(map(eq, words, words[1:])) // (len(words) - 1)
        out[HASHED + again] = len(raw)
        out[HASHED + 11 + 10 * (len(lines) - len(set(lines))) // len(lines)] = len(raw)
    for at in range(0, max(len(raw) - 2, 0), _PIECE):
        b = raw[at:at + _PIECE + 2].astype(np.uint32)
        cell = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(21)
        out[:HASHED] += np.bincount(cell, minlength=HASHED)
    return out


def _count_batches(batches):
    df, n = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            df += term_counts(text.as_py()) > 0
            n += 1
    cells = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(cells, -1), pa.int32()),
                                      pa.array(np.append(df[cells], n), pa.int64())], ["cell", "n"])


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Documents that hold each cell, and all documents: each task sends at most
    DIMS + 1 sums, and DIMS + 1 rows reach the driver."""
    rows = (docs.select(text).mapInArrow(_count_batches, "cell int, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    df, total = np.zeros(DIMS, np.int64), 0
    for cell, n in rows:
        if cell < 0:
            total = n
        else:
            df[cell] = n
    return df, total


def _feature_batches(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.array([term_counts(t.as_py()).astype("<f4").tobytes() for t in batch.column(2)],
                      pa.binary())], ["doc_id", "y", "cells"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", *, id_col: str = "doc_id",
        text: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT,
        per_class: int = PER_CLASS, rank: int = RANK) -> dict:
    """The model: idf, projection, reference vectors, their vote weights, prior."""
    ids, counts = labelled_sample(labels, label, folds, held_out, per_class)
    total = sum(counts.values())
    model = {"prior": counts.get(1, 0) / total if total else 0.5, "refs": None}
    if len(counts) < 2:
        return model
    df, n = document_frequencies(docs, text)
    idf = (np.log((1 + n) / (1 + df)) + 1e-3).astype(np.float32)
    # at most 2 * per_class ids, so this side is small by construction, and so is the group
    sample = (docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
              .join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text")
              .mapInArrow(_feature_batches, f"doc_id {docs.schema[id_col].dataType.simpleString()}, y int, cells binary")
              .groupBy("doc_id", "y").agg(F.min("cells").alias("cells")))
    found = (sample.withColumn("one", F.lit(True)).groupBy("one")
             .applyInArrow(lambda t: _decomposed(t, idf, rank), "y binary, basis binary, refs binary").first())
    if found is None:
        return model
    y = np.frombuffer(found["y"], "<i4")
    if len(set(y.tolist())) < 2:
        return model
    model["idf"] = idf
    model["basis"] = np.frombuffer(found["basis"], "<f4").reshape(DIMS, -1)
    model["refs"] = np.frombuffer(found["refs"], "<f4").reshape(len(y), -1)
    share = {c: counts[c] / total / np.mean(y == c) for c in (0, 1)}
    model["y"], model["vote"] = y.astype(np.float32), np.array([share[c] for c in y], np.float32)
    return model


def _decomposed(table: pa.Table, idf: np.ndarray, rank: int) -> pa.Table:
    """One row: classes, projection and latent vectors of the sample, in order of the
    ids.  Runs in a task; of the sample only these, under 2 MB, reach the driver."""
    table = table.sort_by([("doc_id", "ascending"), ("y", "ascending")])
    x = weighted(np.stack([np.frombuffer(c, "<f4") for c in table.column("cells").to_pylist()]), idf)
    values, vectors = np.linalg.eigh(x.T.astype(np.float64) @ x)
    basis = np.ascontiguousarray(vectors[:, np.argsort(values)[::-1][:rank]], "<f4")
    parts = (table.column("y").to_numpy().astype("<i4"), basis, unit(x @ basis).astype("<f4"))
    return pa.table({c: pa.array([v.tobytes()], pa.binary()) for c, v in zip(("y", "basis", "refs"), parts)})


def unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts.astype(np.float32)) * idf)


def vote(x: np.ndarray, model: dict, k: int = NEIGHBOURS) -> np.ndarray:
    """Scores of a block of weighted rows: exact cosines to every reference."""
    sim = unit(x @ model["basis"]) @ model["refs"].T
    sim = np.rint(sim * 1e6).astype(np.int64)  # ties are ties whatever block a row is in
    k, size = min(k, sim.shape[1]), sim.shape[1]
    near = np.argpartition(np.arange(size) - sim * size, k - 1, axis=1)[:, :k]
    near.sort(axis=1)
    sim = sim / 1e6
    w = np.clip(np.take_along_axis(sim, near, 1), 0, 1) ** SHARPNESS * model["vote"][near]
    size = w.sum(1)
    won = (w * model["y"][near]).sum(1)
    return np.where(size > 1e-6, won / np.maximum(size, 1e-6), model["prior"]).clip(0, 1)


def score(docs: DataFrame, model: dict, *, id_col: str = "doc_id", text: str = "text",
          folds: int = FOLDS, held_out: int = HELD_OUT, threshold: float = THRESHOLD,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, plus the columns named
    in ``keep``, as ``kept_`` and the name."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                if m["refs"] is None:
                    s = np.full(part.num_rows, m["prior"])
                else:
                    s = vote(weighted(np.stack([term_counts(t.as_py()) for t in part.column(0)]),
                                      m["idf"]), m)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(s.astype(np.float64))], [*part.schema.names[1:], "_score"])

    cols = [F.col(text).alias("_text"), F.col(id_col).alias("_id"),
            *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]]
    picked = docs.select(*cols)
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in picked.schema.fields[1:]]
                       + ["_score double"])
    out = picked.mapInArrow(run, schema)
    return out.select(
        F.col("_id").alias("doc_id"), F.coalesce(fold("_id", folds) == held_out, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"),
        *[F.col(f"_keep{i}").alias(f"kept_{c}") for i, c in enumerate(keep)])
