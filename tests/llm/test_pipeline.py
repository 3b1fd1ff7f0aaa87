import corpus_pipeline
from leadloom.llm import exact_dedup, packing, quality, simhash, toxicity
from leadloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdict = {r.doc_id: r.kept for r in quality.score_quality(docs).select("_row.doc_id", "kept").collect()}
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, k in verdict.items() if k}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = corpus_pipeline.toxicity(spark, docs, SF)
    scores = toxicity.toxicity(docs, toxicity.learn(docs, labels))
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in scores.collect() if r.score < 0.5}
    once = corpus_pipeline.exact_copies(spark, docs.union(docs), SF)
    assert once.columns == docs.columns
    assert sorted(r.doc_id for r in once.collect()) == sorted(r.doc_id for r in exact_dedup.exact_dedup(docs).collect() if r.kept)
    near = corpus_pipeline.near_copies(spark, docs, SF)
    groups = simhash.near_duplicates(docs).collect()
    assert near.columns == docs.columns and sorted(r.doc_id for r in near.collect()) == sorted({r.component_id for r in groups})


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    want = {(r.doc_id, r.start, r.ids_crc32) for r in packing.packed_digest(docs).collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.start, r.ids_crc32) for r in got} == want and len(got) == len(want)


def test_stages_on_no_rows_and_odd_rows(spark, odd, none):
    for df in (none, odd):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF)
            out.collect()
            assert name == "packing" or out.columns == df.columns


def test_queries_are_registered():
    assert len([q for q in QUERIES if q.startswith("op")]) == 13 and set(ORACLES) <= set(QUERIES)
