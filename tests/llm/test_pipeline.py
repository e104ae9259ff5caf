"""The corpus pipeline against brute force, and on awkward and empty tables."""

from collections import Counter

import pytest

import corpus_pipeline as cp
from tessera.llm import quality
from tessera.llm.common import materialize, table

from .fixtures import DOCS, EXTRA, SF, awkward_docs, empty_docs
from .test_texts import base_spans, check_packing, components, hits, plain_fingerprint

COLS = [f.name for f in DOCS.fields]


def rows_of(df):
    return [tuple(r) for r in df.select(*COLS).collect()]


def test_names_and_order():
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "secrets", "pack"]


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    kept = materialize(cp.quality_stage(spark, docs, SF), "t")
    good = {r.doc_id for r in quality.score(docs, quality.fit(docs, table(spark, SF, "labels"))).where("predicted = 1").collect()}
    assert Counter(rows_of(kept)) == Counter(r for r in rows_of(docs) if r[0] in good) and kept.columns == docs.columns
    source = rows_of(kept)
    fp = [plain_fingerprint(r[1]) for r in source]
    near = [(i, j) for i in range(len(fp)) for j in range(i) if bin(fp[i] ^ fp[j]).count("1") <= 4]
    first = {}
    for r, c in zip(source, components(len(fp), near)):
        first[c] = min(first.get(c, r), r)
    kept = materialize(cp.near_duplicate_stage(spark, kept, SF), "t")
    assert Counter(rows_of(kept)) == Counter(first.values()) and kept.columns == docs.columns
    kept = materialize(cp.decontamination_stage(spark, kept, SF), "t")
    assert Counter(rows_of(kept)) == Counter(r for r in first.values() if not hits(r[1], items)[1])
    before = {r[0]: r for r in rows_of(kept)}
    kept = materialize(cp.secret_stage(spark, kept, SF), "t")
    for r in rows_of(kept):
        old = before.pop(r[0])
        if base_spans(old[1]):
            assert "[secret]" in r[1] and not base_spans(r[1]) and r[4] == len(r[1])
        else:
            assert r == old
    assert not before
    used, least = check_packing(cp.packing_stage(spark, kept, SF), kept)
    assert used <= least * 1.02 + 1


@pytest.mark.parametrize("make", [awkward_docs, empty_docs])
def test_stages_on_awkward_rows(spark, make):
    docs = make(spark)
    for name, stage in cp.STAGES[:-1]:
        new = materialize(stage(spark, docs, SF), "t")
        assert new.columns == docs.columns
        assert not Counter(rows_of(new.drop("text", "n_chars").withColumns({"text": new.lang, "n_chars": new.doc_id}))) - Counter(
            rows_of(docs.drop("text", "n_chars").withColumns({"text": docs.lang, "n_chars": docs.doc_id})))
        if name == "secrets":
            assert new.count() == docs.count()
        docs = new
    cp.packing_stage(spark, docs, SF).collect()
    if make is awkward_docs:
        assert set(EXTRA) <= set(docs.columns)


def test_repeated_rows_leave_one(spark):
    docs = awkward_docs(spark)
    ids = Counter(r[0] for r in rows_of(cp.near_duplicate_stage(spark, docs, SF)))
    assert ids[1] == 1 and ids[2] == 0 and ids[3] <= 1 and ids[4] == 1 and ids[5] == 0


def test_run(spark):
    got = cp.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 100
