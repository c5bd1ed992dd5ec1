"""The pipeline against plain versions of its stages."""

import hashlib

import public_tokenizers
import sentencepiece
from plain import components, leaks

import corpus_pipeline
from viewlens.llm import language, quality_classifier
from viewlens.session import scratch_dir

SMALL = "/root/testdata/sf0.001"


def test_run_against_plain_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    score = quality_classifier.scorer(quality_classifier.fit(docs, labels, scratch_dir(spark, "t")))
    rows = [r for r, p in zip(rows, score([t for _, t in rows])[1], strict=True) if p]
    left = docs.where(docs["doc_id"].isin([i for i, _ in rows]))
    found = language.predictor(language.learn(left))([t for _, t in rows])
    rows = [r for r, lang, s in zip(rows, *found, strict=True) if lang != "und" and s >= 0.5]
    firsts = {i for i, _, least in components(rows, 5, 80) if i == least}
    rows = [r for r in rows if r[0] in firsts and not leaks(r[1], items)]

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    wanted = {}
    for doc_id, text in rows:
        ids = model.encode(text)
        wanted[doc_id] = (ids, len(ids), hashlib.sha256(model.decode(ids).encode()).hexdigest())
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"]: (r["piece_ids"], r["n_tokens"], r["decoded_sha256"]) for r in got} == wanted
    assert len(got) == len(wanted) > 100


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0)], docs.schema)
    for table in (docs.limit(0), odd):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SMALL)
            assert out.columns == docs.columns, name
            assert out.count() <= table.count()
        assert corpus_pipeline.STAGES[-1][1](spark, table, SMALL).count() == table.count()
