"""The pipeline, stage by stage, against brute force over the smallest tables; registered queries."""

from pathlib import Path

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from inflecta.llm import bpe, quality
from tests.llm.test_joins import least_reachable, shingles
from tests.llm.test_lines_and_items import without_later_copies

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no tables here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    more = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "", None, "s", 0)], docs.schema)
    docs = docs.unionByName(more).unionByName(docs.where("doc_id = 3"))
    model = quality.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"), "quality")
    reader = quality.Indicators()
    kept = spark.createDataFrame(corpus_pipeline.quality_filter(spark, docs, SF_DIR).collect(), docs.schema)
    want = sorted((r.doc_id, r.text or "") for r in docs.collect() if model.score(reader.of(r.text)) >= 0.3)
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == want and kept.columns == corpus_pipeline.COLUMNS

    cut = spark.createDataFrame(corpus_pipeline.line_dedup(spark, kept, SF_DIR).collect(), docs.schema)
    order = sorted({(r.doc_id, r.text) for r in kept.collect() if r.text is not None})
    after = dict(zip([i for i, _ in order], without_later_copies([t for _, t in order], 50), strict=True))
    assert {r.doc_id: r.text for r in cut.collect() if r.text is not None} == after and cut.count() == kept.count()

    single = spark.createDataFrame(corpus_pipeline.near_duplicates(spark, cut, SF_DIR).collect(), docs.schema)
    texts = {r.doc_id: r.text for r in cut.collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(i, j) for i in sets for j in sets if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    reach = least_reachable(sets, links)
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i in sets if reach[i] == i)

    clean = spark.createDataFrame(corpus_pipeline.decontamination(spark, single, SF_DIR).collect(), docs.schema)
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaky = {r.doc_id for r in single.collect() if r.text and any(t in r.text for t in items)}
    assert {r.doc_id for r in single.collect()} - {r.doc_id for r in clean.collect()} == leaky

    tokens = corpus_pipeline.tokenization(spark, clean, SF_DIR).collect()
    encoder = bpe.Encoder(bpe.Merges(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))), public_tokenizers.PATTERN)
    for row in tokens:
        assert row.n_tokens == len(row.token_ids) == sum(map(len, encoder.ids([row.text])[0])) // 4
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]


def test_registered(spark):
    names = [n for n in contract.queries() if n.startswith("op") and n[2].isdigit()] + ["pipeline"]
    assert len(names) == 14
    con = duckdb.connect()
    (n,) = con.execute(f"SELECT count(*) FROM '{SF_DIR}/documents.parquet'").fetchone()
    for name in names:
        df = contract.queries()[name](spark, SF_DIR)
        assert df.columns
        if name in ("op1_toxicity", "op2_quality", "op3_line_dedup", "op5_byte_bpe", "op7_ngram_jaccard", "op9_token_counts", "op10_language_id"):
            assert df.count() == n, name
