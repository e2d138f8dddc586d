import re

import corpus_pipeline
from tidemark.llm import exact, packing, simhash, toxicity
from tests.llm.cases import odd
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_packing import brute as pieces
from tests.llm.test_simhash import brute as near

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Each stage on its own input, except that the classifier is taken as it is."""
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    kept["read"] = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "pipeline-test")
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    first, toxic, exact, nears, clean = kept.values()

    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert toxic.items() <= first.items()
    lost = set(first) - set(toxic)
    clean_lost = sum(labels.get(i) == 0 for i in lost)
    assert clean_lost <= 0.02 * sum(v == 0 for v in labels.values()) and len(lost) <= len(first) / 5

    seen, want = set(), {}
    for i in sorted(toxic):
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", toxic[i])
        if norm not in seen:
            want[i] = toxic[i]
        seen.add(norm)
    assert exact == want
    assert set(nears) == {c for _, _, c in near(sorted(exact.items()))}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(clean) == set(nears) - {i for i, _, _ in leaks(sorted(nears.items()), items)}

    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=str) == pieces(
        sorted(clean.items()), 4096)


def test_odd_documents_pass_all_stages(spark):
    docs = odd(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "pipeline-test")
        assert docs.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_registered(spark):
    import __spark_entry__ as E
    numbers = {int(n[2:].split("_")[0]) for n in E.queries() if n.startswith("op") and n[2].isdigit()}
    assert numbers == set(range(1, 11)) and E.queries()["pipeline"] is corpus_pipeline.run
    assert len(corpus_pipeline.STAGES) == 5


def test_workers_hold_small_batches(spark, monkeypatch):
    """Texts reach Python workers a thousand rows at a time, in whatever action."""
    docs = spark.range(6_000).selectExpr("id as doc_id", "concat('some words of the text ', id) as text").coalesce(1)
    labels = spark.range(400).selectExpr("id as doc_id", "int(id % 2) as toxic")
    whole = toxicity.slices

    def checked(batches, column):
        for batch in batches:
            assert batch.num_rows <= 1_000
            yield from whole([batch], column)

    for module in (exact, packing, simhash, toxicity):
        monkeypatch.setattr(module, "slices", checked)
    assert toxicity.drop_toxic(docs, labels).count() <= 6_000
    assert toxicity.score_toxicity(docs, labels).count() == 6_000
    assert exact.drop_copies(docs).count() == 6_000
    assert simhash.drop_near(docs).count() <= 6_000
    assert corpus_pipeline.packing(spark, docs, SF).count() == 6_000


def test_stages_start_no_rdd_workers(spark, monkeypatch):
    """Rows from a list go through an RDD's Python workers, which stay beside the others."""
    def refuse(*_, **__):
        raise AssertionError("rows from a list")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 10 = 0")
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF)
        assert kept.count() > 0
