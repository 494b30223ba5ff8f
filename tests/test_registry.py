"""Registered queries against their SQL on the smallest tables.

A spread of queries by default; LECTERN_ALL=1 runs every one.
"""

import os
import re

import pytest

import __spark_entry__ as entry_module
from tests.check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "search", "search_batch", "search_stored_index", "sink_stats", "node_provenance", "eval_hit_at_k", "topk_cosine", "normalize_ref", "build_inverted_index", "internal_resolve",
    "top", "parallel_alignment", "lookup_verse", "verse_fathers", "todays_reading", "date_asof_forward", "page_to_nodes",
    "pending_heading_fold", "renumber_restarts", "contiguity", "scan_adjacency", "scan_cp1252", "export_bundle",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()) if os.environ.get("LECTERN_ALL") else SAMPLE)
def test_query_matches_sql(spark, con, name):
    df = entry_module.queries()[name](spark, FOLDER)
    assert compare(df, con, entry_module.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_query_has_sql():
    """All but those of the pipeline operators that SQL can't express."""
    without = set(entry_module.queries()) - set(entry_module.oracle_sql())
    assert not [n for n in without if not re.match(r"op[0-9]+_|pipeline$", n)]
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
