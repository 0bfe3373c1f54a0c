import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from wavefold.llm import byte_bpe, decontaminate, queries, simhash, toxicity

SF001 = "/root/testdata/sf0.001"


def test_stages_take_effect_and_agree_with_run(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_level_bpe"]
    docs = first = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF001)
        if k < 4:
            assert out.dtypes == first.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = kept[name] = spark.read.parquet(str(tmp_path / name))
    chain = queries.fitted_toxicity(spark, first, SF001)
    toxic = {r.doc_id for r in toxicity.score(first, chain).filter(F.col("p_toxic") >= toxicity.THRESHOLD).collect()}
    ids = {n: [r.doc_id for r in d.select("doc_id").collect()] for n, d in kept.items()}
    assert set(ids["toxicity"]) == {r.doc_id for r in first.collect()} - toxic and toxic
    assert all(r.n_chars == len(r.text) for r in kept["line_dedup"].collect())
    near = simhash.near_duplicates(kept["line_dedup"]).collect()
    assert sorted(ids["simhash_near_dedup"]) == sorted({r.component_id for r in near})
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    clean = decontaminate.scan(kept["simhash_near_dedup"], bench).filter("n_hit = 0")
    assert sorted(ids["benchmark_decontamination"]) == sorted(r.doc_id for r in clean.collect())
    last = {r.doc_id: r for r in kept["byte_level_bpe"].collect()}
    assert sorted(last) == sorted(ids["benchmark_decontamination"])
    back = byte_bpe.decode(kept["byte_level_bpe"], public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    texts = {r.doc_id: r.text for r in kept["benchmark_decontamination"].collect()}
    assert {r.doc_id: r.text for r in back.collect()} == texts
    whole = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF001).collect()}
    assert whole == {d: (r.n_tokens, r.ids_sha256) for d, r in last.items()}


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        assert out.collect() == []
        if name != "byte_level_bpe":
            docs = out
