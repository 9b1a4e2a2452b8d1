import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import compare, connect

from siteledger.llm import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op3": "doc_id held_out lang_pred score", "op4": "doc_id n_shingles component_id kept",
    "op5": "doc_id held_out n_tokens n_known train_tokens base_score score", "op6": "doc_id size text_crc32 law shard slot grown_shard",
    "op7": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op8": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op11": "doc_id n_words n_removed kept_sha256", "op12": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op13": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op9": "doc_id keep_id group_size kept text_sha256", "op10": "doc_id n_bytes n_removed n_spans kept_sha256",
}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    if name in ORACLE:
        problem, n, _ = compare(spark, connect(SF), QUERIES[name], ORACLE[name], SF)
        assert problem is None
    else:
        n = QUERIES[name](spark, SF).count()
    table = "embeddings" if name.startswith("op12_") else "documents"
    assert n >= spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize("name", QUERIES)
def test_columns(spark, name):
    want = COLUMNS.get(name.split("_")[0], "doc_id").split()
    assert QUERIES[name](spark, SF).columns[: len(want)] == want
