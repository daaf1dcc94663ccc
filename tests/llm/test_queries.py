import pytest

from brightledger.llm import queries

COLUMNS = {"p2_found": ["id", "canonical"], "p3_found": ["keep_id", "copy_id"], "p6_entities": ["field_name", "name", "entity"], "p6_found": ["field_name", "name_a", "name_b"], "p7_ids": ["doc_id", "ids"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id", "begin_pos", "end_pos"]}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, folder, name):
    df = queries.QUERIES[name](spark, folder)
    assert df.columns == COLUMNS[name]
    rows = df.collect()
    assert rows and (name == "p7_ids" or len({tuple(r) for r in rows}) == len(rows))
