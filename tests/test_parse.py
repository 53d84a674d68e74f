import pytest

from tests.conftest import edges_of
from trisk.sources.items import parse_items


@pytest.mark.parametrize("line", ["0,1", " 0 , 1 ", "0,1,9"])
def test_good_lines(spark, line):
    assert [tuple(r) for r in edges_of(spark, "").union(
        edges_of(spark, "x").limit(0)).collect()] == []
    df = spark.createDataFrame([(line,)], "value string")
    from trisk.sources.edges import parse_edges
    assert [tuple(r) for r in parse_edges(df).collect()] == [(0, 1)]


@pytest.mark.parametrize("line", ["x,1", "", "7", "1_0,2"])
def test_bad_lines_fail(spark, line):
    from trisk.sources.edges import parse_edges
    df = spark.createDataFrame([(line,)], "value string")
    with pytest.raises(Exception):
        parse_edges(df).collect()


def test_items(spark):
    df = spark.createDataFrame([(" 12",), ("-3",)], "value string")
    assert [r.item for r in parse_items(df).collect()] == [12, -3]
    with pytest.raises(Exception):
        parse_items(spark.createDataFrame([("a",)], "value string")).collect()
