"""What is registered, and the columns the contracts name."""

import pytest

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op2_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op4_line_dedup": "doc_id bigint, text string",
    "op5_nearest": "query_id bigint, rank int, vec_id bigint, score double",
    "op6_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op7_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op8_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op9_vector_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op10_token_rollups": "source string, lang string, version string, documents bigint, tokens bigint",
    "op11_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op12_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op13_conversation_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "pipeline": "doc_id bigint, piece int, sequence_id bigint, ids array<int>",
}


def test_all_are_registered():
    assert set(COLUMNS) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - {"pipeline"}))
def test_columns(spark, name):
    have = dict(entry_module.queries()[name](spark, FOLDER).dtypes)
    assert {c: k for c, k in (x.rsplit(" ", 1) for x in COLUMNS[name].split(", "))}.items() <= have.items()
