"""The queries of the subpackage on the smallest tables, beside their SQL where they have one."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import check, connect

from lacquer.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")

COLUMNS = {
    "p1_found": ["result_id"], "p2_found": ["chunk_id", "stage"], "p3_found": ["id_a", "id_b"], "p4_found": ["pair_id", "zh_line", "vi_line"], "p5_found": ["chunk_id", "line_no"],
    "p6_ids": ["doc_id", "ids"], "p7_found": ["doc_id", "item_id"], "p8_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(name, spark):
    good, said = check(name, spark, connect(SF), SF)
    assert good, said


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(name, spark):
    assert queries.QUERIES[name](spark, SF).columns == COLUMNS[name]
