import corpus_pipeline
from tripcraft.llm import decontaminate
from tripcraft.llm.common import stored


def test_stages(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stored(stage(spark, docs, sf001), f"test-{name}")
        rows.append(out.count())
        if k < 4:
            assert out.columns == docs.columns
            docs = out
        if name == "simhash_near_dedup":
            assert 0 < rows[-1] < rows[-2] and out.select("doc_id").distinct().count() == rows[-1]
        if name == "benchmark_decontamination":
            found = decontaminate.search(out, spark.read.parquet(f"{sf001}/benchmark.parquet"))
            assert found.where("size(spans) > 0").count() == 0
            assert out.where("n_chars <> length(text)").count() == 0
    assert rows[-1] == rows[-2] and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_stages_on_edge_rows(spark, sf001):
    rows = [(None, None, None, None, None), (1, "", "en", "src1", 0), (2, "the cat and the dog", "en", "src1", 19),
            (2, "the cat and the dog", "en", "src1", 19), (3, "12 34", None, None, 5), (4, "und der hund ist nicht da", "de", "s", 25)]
    docs = spark.createDataFrame([(*r, "extra", 7) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, row string, tokens int")
    for frame in (docs, docs.limit(0)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stored(stage(spark, frame, sf001), f"edge-{name}")
            if k < 4:
                assert out.columns == docs.columns
                frame = out
        assert out.count() == frame.count()
