"""The pipeline: each stage on its own input."""

import corpus_pipeline
from callweave.llm import decontaminate, line_dedup, near_dedup, quality

ROOT = "/root/testdata/sf0.001"


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns = docs.columns
    items = spark.read.parquet(f"{ROOT}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = {r.doc_id: r for r in stage(spark, docs, ROOT).collect()}
        if name != "bpe":
            assert list(next(iter(out.values())).asDict()) == columns
        if name == "quality_rules":
            want = {r.doc_id: r.clean_text for r in quality.apply_rules(docs).where("kept").collect()}
            assert {i: r.text for i, r in out.items()} == want
        elif name == "line_dedup":
            left = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
            want = {i: r.text for i, r in left.items() if r.n_lines == 0 or r.n_removed < r.n_lines}
            assert {i: r.text for i, r in out.items()} == want
        elif name == "near_dedup":
            kept = {r.doc_id for r in near_dedup.near_duplicates(docs).collect() if r.kept}
            assert set(out) == kept
        elif name == "decontamination":
            found = decontaminate.find_leaks(docs, items).collect()
            assert set(out) == {r.doc_id for r in found if not r.leaks} and set(out) < set(before)
        else:
            assert set(out) == set(before) and all(r.round_trip for r in out.values())
        assert all(r.n_chars == len(r.text) for r in out.values())
        docs = spark.createDataFrame([r for r in out.values()], docs.schema) if name != "bpe" else docs
    run = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, ROOT).collect()}
    assert run == {i: r.ids_sha256 for i, r in out.items()}


def test_empty_table(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, ROOT).count() == 0


def test_a_page_of_boilerplate_goes(spark, docs_of):
    prose = " ".join(f"word{i}" for i in range(60))
    page = "\n".join(["Sign in to read the other pages of this site"] * 3 + ["Privacy policy and terms of this site and its owners"] * 3)
    rows = [(1, page + "\nHello"), (2, "Licensed under the MIT licence\n" + prose), (3, prose),
            (4, "Copyright of the owners and of all other authors of this page\nonly five words are left")]
    docs = docs_of(*rows)
    left = {r.doc_id: r.text for r in corpus_pipeline.quality_stage(spark, docs, ROOT).collect()}
    assert left == {2: prose, 3: prose}
