"""The pipeline's stages on planted cases, and the registered queries."""

import hashlib

import __spark_entry__ as entry
import corpus_pipeline
from tunefold.llm import decontam
from tunefold.llm.queries import llm_queries


def test_stages_and_queries_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "surrogates", "packing"]
    names = entry.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in llm_queries()) == list(range(1, 14))
    assert set(llm_queries()) <= set(names) and set(entry.oracle_sql()) <= set(names)


def test_stages_take_effect(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        seen[name] = docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = seen["quality"].join(labels, "doc_id")
    total = labels.groupBy("quality").count().collect()
    left = {r.quality: r["count"] for r in kept.groupBy("quality").count().collect()}
    assert left[1] >= 0.98 * {r.quality: r["count"] for r in total}[1] and left.get(0, 0) <= 0.25 * {r.quality: r["count"] for r in total}[0]
    # no two of the kept texts are equal, and every lost one still has its like
    assert seen["near_duplicates"].groupBy("text").count().where("count > 1").count() == 0
    assert seen["near_duplicates"].count() < seen["quality"].count()
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert decontam.matches(seen["decontamination"], bench).where("contaminated").count() == 0
    assert seen["surrogates"].count() == seen["decontamination"].count()
    assert seen["packing"].select("doc_id").distinct().count() == seen["surrogates"].count()


def test_near_duplicate_stage_on_odd_rows(spark, docs_of):
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    long = " ".join(f"w{i}" for i in range(80))
    docs = docs_of([(1, long), (1, long), (2, long + " end"), (3, None), (None, long), (4, ""), (5, "")], kept=1)
    rows = stage(spark, docs, "").collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 3, 4, 5]
    assert stage(spark, docs.limit(0), "").count() == 0


def test_texts_of_one_id_stay_unless_they_are_near_duplicates(docs_of):
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    text = [" ".join(f"{c}{i}" for i in range(80)) for c in "abcd"]
    pairs = [(7, t) for t in text] + [(7, text[0] + " end"), (7, text[1]), (3, text[2] + " end"), (9, text[3] + " end")]
    rows = sorted((r.doc_id, r.text) for r in stage(docs_of([]).sparkSession, docs_of(pairs), "").collect())
    first = min(text[0], text[0] + " end", key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert rows == sorted([(7, first), (7, text[1]), (3, text[2] + " end"), (7, text[3])])


def test_stages_keep_columns_of_internal_names(spark, docs_of):
    """Names that stages and operators use, or used, inside, as extra columns of their input."""
    sf = "/root/testdata/sf0.001"
    names = ["__id", "__hash", "__text", "__selected", "__items", "__before", "__mentions", "__key", "__to", "__doc", "__gone", "items", "to", "rep", "c"]
    long = " ".join(f"w{i}" for i in range(80))
    texts = [(1, long), (2, long + " end"), (3, "write to jane@example.org now"), (4, None)]
    docs = docs_of(texts, **{n: f"own {n}" for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert all(r[n] == f"own {n}" for r in out.collect() for n in names), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 4
