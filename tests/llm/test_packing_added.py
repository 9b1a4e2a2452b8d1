import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

import corpus_pipeline
from siteledger.llm.packing import Ids, default_vocabulary, pack
from siteledger.llm.queries import QUERIES

TOKENIZER = Tokenizer.from_file(path("byte_bpe_50k.json"))
END = "<|endoftext|>"
TEXTS = [END, f"a {END} b", f"{END}{END}", f"one two {END}three  four{END} ", f" {END}\n", f"x{END}y <|endoftext| > <|endoftext|", "<|ENDOFTEXT|>", f"<{END}>", f"  a  {END}  b  " * 50, ""]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_the_tokenizer_as_it_is(text):
    assert np.frombuffer(Ids(default_vocabulary(), added=True).of(text), "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_lengths_of_documents_with_added_tokens(frame):
    rows = pack(frame(list(enumerate(TEXTS))), window=64, added=True).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in rows} == {i: len(TOKENIZER.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(TEXTS)}


def test_query_and_stage_give_added_tokens_their_ids(spark, tmp_path):
    spark.createDataFrame([(1, f"a {END} b", "en", "s", 17)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [r["doc_tokens"] for r in QUERIES["op8_histogram_packing"](spark, str(tmp_path)).collect()] == [5]
    assert [r["doc_tokens"] for r in corpus_pipeline.packing(spark, docs, str(tmp_path)).collect()] == [5]
