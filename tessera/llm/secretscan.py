"""Secret scans through an incremental blob ledger.

Method.  Every version of every path is content-addressed: its blob is the SHA-256
of its text.  The ledger, a folder of Parquet files, records for each blob the rule
versions it was scanned with and the spans that each of them found.  A scan asks the ledger
what it knows, scans each blob once with the rule versions it has not seen, appends
what it found, and joins the findings of exactly the rule
versions asked for back to all paths.  Copies,
unchanged files and unchanged rules cost no scan; a new rule, or a new version of
one, costs only its own.

Scale.  One row of each blob is chosen by an aggregate over short rows; texts are
shuffled once, by blob and id, so that a blob which a third of the rows share is
spread, and only chosen rows are scanned.

Defined results.  A null text is the empty blob, which holds nothing.  Repeated
rows of a path each get the findings.  Rules that are not in the ledger's rows are
scanned anew; an empty table scans nothing.  Very long texts are scanned
whole, in time proportional to their length.  Other columns are ignored.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tessera.llm.common import small_side


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if ``group`` has at least ``least``
    characters.  A text without any of ``hints`` (lower case) cannot match."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = 0
    hints: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, re.IGNORECASE | re.ASCII, ("password", "passwd", "secret", "token", "api")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, 0, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so this is [0-9a-f]+ of 24 or more
)
MORE = (
    # a key up to its end; without an end, before the next key, the header and the base64 lines behind it
    Rule("pem", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]|-(?!----(?:END|BEGIN)))*+-----END [A-Z ]*PRIVATE KEY-----"
         r"|(?:\r?\n[A-Za-z0-9+/=]{16,}(?=\r?\n|\Z))*)", 0, 1, 0, ("-----begin ",)),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, 0, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("jwt", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, 0, ("eyj",)),
)
RULES = BASE + MORE
SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()),
                              StructField("end", IntegerType()), StructField("rule", StringType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("rule", pa.string())]))


def find(text: str, rules) -> list[dict]:
    """Spans in a whole text, by start, then in the order of the rules."""
    low, out = text.lower(), []
    for place, rule in enumerate(rules):
        if rule.hints and not any(h in low for h in rule.hints):
            continue
        for m in re.compile(rule.pattern, rule.flags).finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                out.append((m.start(), place, {"kind": rule.kind, "start": m.start(), "end": m.end(), "rule": rule.name}))
    return [x[2] for x in sorted(out, key=lambda x: x[:2])]


def addressed(versions: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, text, blob): the SHA-256 of the text names the blob."""
    body = F.coalesce(F.col(text), F.lit(""))
    return versions.select(F.col(id_col).alias("id"), body.alias("text"),
                           F.unhex(F.sha2(body, 256)).alias("blob"))


def read_ledger(spark, ledger: str) -> DataFrame:
    """(blob, scanned, spans): one row for each blob and scan; none yet is an
    empty table."""
    schema = StructType([*spark.createDataFrame([], "blob binary, scanned array<string>").schema.fields,
                         StructField("spans", SPANS)])
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(schema).parquet(ledger) if there else spark.createDataFrame([], schema)


def scan(versions: DataFrame, ledger: str, *, id_col: str = "doc_id", text: str = "text",
         rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger has not seen and append it to the ledger."""
    spark = versions.sparkSession
    rows = addressed(versions, id_col, text)
    names = F.array(*[F.lit(r.name) for r in rules])
    known = read_ledger(spark, ledger).groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_set("scanned"))).alias("scanned"))
    chosen = (rows.groupBy("blob").agg(F.min("id").alias("id")).join(known, "blob", "left")
              .select(F.col("blob").alias("address"), F.col("id").alias("chosen"),
                      F.array_except(names, F.coalesce("scanned", F.array().cast("array<string>"))).alias("todo"))
              .where("size(todo) > 0"))
    bodies = rows.join(chosen.hint("shuffle_hash"),
                       (F.col("blob") == F.col("address")) & F.col("id").eqNullSafe(F.col("chosen"))) \
        .select("blob", "todo", "text")
    by_name = {r.name: r for r in rules}

    def run(batches):
        for batch in batches:
            blob, todo, texts = batch.columns
            found = [find(t.as_py(), [by_name[n] for n in by_name if n in d.as_py()])
                     for t, d in zip(texts, todo)]
            yield pa.RecordBatch.from_arrays([blob, todo, pa.array(found, _ARROW)], ["blob", "scanned", "spans"])

    bodies.mapInArrow(run, StructType([bodies.schema["blob"], StructField("scanned", ArrayType(StringType())),
                                       StructField("spans", SPANS)])).write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, *, id_col: str = "doc_id", text: str = "text",
             rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, spans, kept_...) of every row of ``versions``: what the ledger knows of
    its blob under ``rules``, by start, then in the order of the rules; and the
    columns named in ``keep``, as ``kept_`` and the name."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = versions.select(F.col(id_col).alias("id"), F.unhex(F.sha2(body, 256)).alias("blob"),
                           *[F.col(c).alias(f"kept_{c}") for c in keep])
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    names = F.array(*[F.lit(r.name) for r in rules])
    hits = (read_ledger(versions.sparkSession, ledger).where("size(spans) > 0")
            .select("blob", F.explode("spans").alias("s")).where(F.array_contains(names, F.col("s.rule")))
            .groupBy("blob").agg(F.array_sort(F.collect_set(
                F.struct("s.start", order[F.col("s.rule")].alias("place"), "s.end", "s.kind"))).alias("hits")))
    spans = F.transform(F.coalesce("hits", F.array().cast(hits.schema["hits"].dataType)),
                        lambda h: F.struct(h["kind"].alias("kind"), h["start"].alias("start"), h["end"].alias("end")))
    joined = rows.join(small_side(hits), "blob", "left")
    return joined.select("id", spans.alias("spans"), *[c for c in rows.columns if c not in ("id", "blob")])


def redact(text: F.Column, spans: F.Column, mark: str = "[secret]") -> F.Column:
    """The text with every span replaced by ``mark``; spans that overlap are
    replaced together."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    def step(a, s):
        return F.struct(
            F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)))
            .otherwise(a["out"]).alias("out"), F.greatest(a["at"], s["end"]).alias("at"))
    return F.when(F.size(spans) > 0, F.aggregate(
        spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.lit(2147483647))))).otherwise(text)
