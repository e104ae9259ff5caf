"""The corpus pipeline: documents in, packed training sequences out.

Five stages, each one of the operators of ``tessera.llm`` over all that the stage
before it kept.  A stage takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet in the shared folder and reread as the next one's docs; so a
lost executor repeats part of one stage.  All but the last return the columns of
``documents``.

* quality: documents scored below the threshold go;
* near_duplicates: one document of each group stays, the one with the smallest id
  (of rows that repeat an id, the one with the smallest content hash);
* decontaminate: documents that hold a window of a benchmark item go;
* secrets: spans found are replaced by a mark, and n_chars follows; no row goes;
* pack: pieces of the documents in sequences of at most 2,048 tokens.

Null texts are empty texts; null ids are kept as they are.  Extra columns pass
through the filters.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, packing, quality, secretscan, simhash
from tessera.llm.common import materialize, row_key, small_side, table, vocabulary_path
from tessera.session import shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=tuple(docs.columns))
    return scored.where("predicted = 1").select(*[F.col(f"kept_{c}").alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cols = [F.col(c).alias(f"kept_{c}") for c in docs.columns]
    rows = docs.select(*row_key("doc_id", "text"), *cols)
    # a row is named by its id, nulls last, and its content
    name = F.struct(F.col("kept_doc_id").isNull().alias("none"), F.col("kept_doc_id").alias("doc_id"), "k1", "k2")
    found = simhash.cluster(rows.select(name.alias("name"), "kept_text"), id_col="name", text="kept_text")
    chosen = (found.where("doc_id = component_id").groupBy("doc_id.k1", "doc_id.k2")
              .agg(F.count("*").alias("copies")))
    chosen = materialize(chosen, "chosen")
    stays = rows.join(chosen.where("copies = 1"), ["k1", "k2"], "leftsemi")
    again = small_side(chosen.where("copies > 1").select("k1", "k2"))
    if not again.isEmpty():  # rows that are equal in id and text: one of each
        kept = [f"kept_{c}" for c in docs.columns]
        once = rows.join(again, ["k1", "k2"], "leftsemi").groupBy("k1", "k2").agg(
            F.first(F.struct(*kept)).alias("row"))
        stays = stays.unionByName(once.select("k1", "k2", *[F.col("row")[c].alias(c) for c in kept]))
    return stays.select(*[F.col(f"kept_{c}").alias(c) for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    leaks = small_side(found.where("n_hit > 0").select("k1", "k2"))
    cols = [F.col(c).alias(f"kept_{c}") for c in docs.columns]
    clean = docs.select(*row_key("doc_id", "text"), *cols).join(leaks, ["k1", "k2"], "leftanti")
    return clean.select(*[F.col(f"kept_{c}").alias(c) for c in docs.columns])


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ledger = shared_dir(spark, "secret-ledger")
    secretscan.scan(docs, ledger)
    found = secretscan.findings(docs, ledger, keep=tuple(docs.columns))
    text = F.col("kept_text")
    masked = secretscan.redact(text, F.col("spans"))
    new = {"text": masked, "n_chars": F.when(F.size("spans") > 0, F.length(masked).cast(
        docs.schema["n_chars"].dataType)).otherwise(F.col("kept_n_chars"))}
    return found.select(*[new.get(c, F.col(f"kept_{c}")).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("secrets", secret_stage),
    ("pack", packing_stage),
]

# Fingerprints, trained scores and tokens are beyond SQL; tests/llm holds the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
