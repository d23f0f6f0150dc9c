import corpus_pipeline as pipeline
from cardwatch.llm import decontamination, packing, quality_rules
from tests.llm import brute


def test_stages_keep_the_columns_and_act(spark, sf_dir):
    docs = first = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == first.columns
        kept[name] = ({r.doc_id for r in before.collect()}, {r.doc_id for r in docs.collect()})
        assert kept[name][1] <= kept[name][0]
    a, b = kept["quality_rules"]
    assert b == {r.doc_id for r in quality_rules.verdicts(first).where("kept").collect()} and b < a
    texts = {r.doc_id: r.text for r in first.collect()}
    a, b = kept["near_duplicates"]
    plain = brute.components([(d, texts[d]) for d in a])
    assert b == {d for d, _, c in plain if d == c}
    a, b = kept["decontamination"]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    left = first.where(first.doc_id.isin(sorted(a)))
    assert a - b == {r.doc_id for r in decontamination.leaks(left, bench).collect()}
    out = pipeline.packed(spark, docs, sf_dir)
    assert {r.doc_id for r in out.select("doc_id").collect()} == b


def test_run_gives_the_pieces(spark, sf_dir):
    rows = pipeline.run(spark, sf_dir).collect()
    assert rows and all(0 < r.length <= packing.LENGTH for r in rows)
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
