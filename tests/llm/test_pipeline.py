"""The stages against brute force on their own inputs, and the edges of the whole."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from plumbline.llm.queries import tokenizer_file
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as classes
from tests.test_oracle import SF

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage over part of sf0.001, with added edges, and the final rows."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    added = [(9001, None, "en", "x", 0), (9002, "", None, None, None), (9003, "12 34 !", "en", "x", 7), (9004, item, "en", "x", 1), (None, "words without an id of their own", "en", "x", 1), (9005, "Twice the same row here", "en", "x", 1)]
    docs = docs.union(spark.createDataFrame(added + [added[-1]], docs.schema))
    docs.write.parquet(f"{folder}/documents.parquet")
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], folder).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return folder, [x.collect() for x in out]


def pairs(rows):
    return sorted(((r.doc_id, r.text) for r in rows), key=str)


@pytest.mark.parametrize("chosen", [None, str(9 << 20)])
def test_rows_go_to_python_in_small_batches(stages, spark, chosen):
    """Whatever the texts' length, a task holds a batch of bounded bytes; a size that the session sets stays."""
    folder, _ = stages
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    long = spark.range(48, numPartitions=1).selectExpr("repeat('a word ', 100000) AS text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    try:
        spark.conf.unset(key)
        if chosen:
            spark.conf.set(key, chosen)
        corpus_pipeline.identify_language(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        most = max(r.n for r in long.mapInArrow(sizes, "n bigint").collect())
        assert spark.conf.get(key) == (chosen or str(corpus_pipeline.BATCH)) and most <= int(spark.conf.get(key)) + 800_000
    finally:
        spark.conf.unset(key)


def test_stages_keep_the_columns(stages, spark):
    _, rows = stages
    assert all(r[0].asDict().keys() == rows[0][0].asDict().keys() for r in rows[1:-1])


def test_language_drops_texts_without_letters(stages):
    _, (first, second, *_) = stages
    assert pairs(second) == pairs(r for r in first if r.text and any(map(str.isalpha, r.text)))


def test_toxicity_keeps_clean_labelled_documents(stages, spark):
    folder, (_, second, third, *_) = stages
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id for r in third}
    assert {r.doc_id for r in second if labels.get(r.doc_id) == 0} <= kept and set(pairs(third)) <= set(pairs(second))


def test_one_of_each_group_stays(stages):
    _, (_, _, third, fourth, *_) = stages
    docs = sorted(((r.doc_id, r.text) for r in third), key=str)
    want = {(d, t) for (d, t), (_, c, _) in zip(docs, classes(docs)) if d == c}
    assert set(pairs(fourth)) == want and len(fourth) == len(want)


def test_contaminated_documents_go(stages, spark):
    folder, (*_, fourth, fifth, _) = stages
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in fourth]
    want = [d for d, r in zip(docs, contaminated(docs, items)) if not r[-1]]
    assert pairs(fifth) == sorted(want, key=str) and 9004 not in {d for d, _ in want}


def test_encoding_matches_the_library(stages):
    _, (*_, fifth, last) = stages
    library = tokenizers.Tokenizer.from_file(tokenizer_file())
    want = []
    for r in fifth:
        ids = library.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256) for r in last), key=str) == sorted(want, key=str)


def test_run_over_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_applies_all_stages(rows):
    assert 0 < len(rows("pipeline")) < 1000
