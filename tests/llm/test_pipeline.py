import numpy as np
import pytest
from test_exact_dedup import want as exact
from test_minhash import plain as near
from test_packing import check

import corpus_pipeline
from siteledger.llm.decontaminate import tiles, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and gives, written and read again."""
    base, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{base}/{k}")
        left = spark.read.parquet(f"{base}/{k}")
        out.append((name, docs, left))
        docs = left
    return out


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_and_columns(stages):
    assert [n for n, *_ in stages] == ["language ID", "exact dedup", "near dedup", "decontamination", "packing"]
    for _, docs, left in stages[:-1]:
        assert left.columns == docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_id_keeps_clean_documents(stages):
    _, docs, left = stages[0]
    assert set(texts_of(left)) == {i for i, t in texts_of(docs).items() if t and any(c.isalpha() for c in t)}


def test_each_stage_against_a_plain_one(stages):
    _, docs, left = stages[1]
    own = texts_of(docs)
    assert set(texts_of(left)) == {int(k) for _, k, *_ in exact(sorted(own.items()))}
    _, docs, left = stages[2]
    assert set(texts_of(left)) == {i for i, _, _, kept in near(texts_of(docs).items(), 5, 80) if kept}
    _, docs, left = stages[3]
    items = [words(r["text"]) for r in docs.sparkSession.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for doc, text in texts_of(docs).items():
        found = words(text)
        hit = any(sum(n for *_, n in tiles(found, i)) >= 0.8 * len(i) for i in items if len(np.intersect1d(found, i)) >= 0.5 * len(np.unique(i)))
        assert hit == (doc not in texts_of(left)) if doc % 20 == 0 or hit else True
    _, docs, left = stages[4]
    assert check(left.collect(), texts_of(docs), 1024) > 0.95


def test_run_gives_the_rows_of_the_stages(spark, stages):
    key = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(key).collect())) == sorted(map(tuple, stages[-1][2].select(key).collect()))
