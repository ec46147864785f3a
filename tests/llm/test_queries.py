"""Every query of the subpackage on the smallest tables, next to its oracle where SQL has one."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import check_oracle  # noqa: E402
from rooftally.llm.queries import ORACLES, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op2_near_duplicates": {"doc_id", "n_shingles", "component_id", "kept"},
    "op3_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op4_line_dedup": {"doc_id", "n_lines", "n_removed_lines", "kept_md5"},
    "op5_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op6_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op7_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op8_nearest_neighbours": {"query_id", "rank", "vec_id", "score"},
    "op9_exact_top_k": {"query_id", "rank", "vec_id", "score"},
    "op10_word_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op11_personal_data": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op12_conversation_repair": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"},
    "op13_resampling": {"doc_id", "n_features", "weight", "score", "rank"},
}


def test_all_are_registered():
    import __spark_entry__

    assert set(QUERIES) == set(COLUMNS) and set(ORACLES) <= set(QUERIES)
    assert set(COLUMNS) | {"pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, monkeypatch, name):
    monkeypatch.setattr(check_oracle, "QUERIES", QUERIES)
    monkeypatch.setattr(check_oracle, "ORACLES", ORACLES)
    assert COLUMNS[name] <= set(QUERIES[name](spark, SF_DIR).columns)
    ok, message, _ = check_oracle.compare(spark, check_oracle.duck(SF_DIR), SF_DIR, name)
    assert ok, message
