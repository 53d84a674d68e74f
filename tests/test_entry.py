import __spark_entry__ as E
from trisk.plans.catalog import QUERIES


def test_keys_have_oracles():
    assert set(E.oracle_sql()) >= set(QUERIES) <= set(E.queries())


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.raw_edges, r.edges, r.exact_triangles) == (18_000, 12_798, 22_649)
    assert abs(r.color_estimate - 22_649) / 22_649 < 0.2
