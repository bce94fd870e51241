"""Every registered text query over the smallest tables; those with SQL against it."""

import oracle
import pytest

from siltstone.llm import queries

COLUMNS = {
    "p3_found": ["tab", "row_key", "creator_pos"], "p4_found": ["seq_a", "seq_b"], "p6_found": ["kind", "name_a", "name_b"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id", "lang"],
    "p7_pack": ["doc_id", "piece", "container", "position", "size"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    if name in queries.ORACLE:
        columns, ours, theirs, n = oracle.differences(spark, oracle.connect(sf), queries.QUERIES[name], queries.ORACLE[name], sf)
        assert columns is None and not ours and not theirs and n
        return
    df = queries.QUERIES[name](spark, sf)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns)
    assert df.columns == COLUMNS.get(name, df.columns)
    if name in COLUMNS and name != "p7_pack":
        assert len(set(rows)) == len(rows)
