import pytest

from cartograin.llm.catalog import QUERIES
from cartograin.llm.oracle import ORACLE
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck.execute(ORACLE[name])) == []
