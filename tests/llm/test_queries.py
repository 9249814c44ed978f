"""The registered queries run over the smallest tables and keep the fixed columns."""

import pytest

from corpusloom.llm import queries

FOUND = {
    "p1_found": ["id", "language"], "p2_found": ["id", "line_no", "kind"], "p3_found": ["table_name", "item_key"], "p4_found": ["id_a", "id_b"], "p6_found": ["chunk_id_a", "chunk_id_b"],
    "p7_found": ["id", "kind"], "p8_found": ["doc_id"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id", "subject"],
}


@pytest.mark.parametrize("name", ["p2_found", "p3_found", "p4_found", "p4_versions", "p5_token_budget", "p6_found", "p6_clusters", "p7_found", "p8_found", "p9_found", "p10_found"])
def test_query(spark, data, name):
    df = queries.QUERIES[name](spark, data)
    assert name not in FOUND or df.columns == FOUND[name]
    rows = df.collect()
    assert len(rows) == len(set(rows))
