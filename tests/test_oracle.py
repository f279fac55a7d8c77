"""The correctness gate: every registered query against its DuckDB SQL (sf0.001 here; the
driver runs sf0.01, ``python tests/oracle_check.py`` does the same locally)."""

from conftest import SF_SMALL
from oracle_check import compare

import __spark_entry__ as E


def test_every_query_has_an_oracle():
    """All but the training-data operators, of which SQL can express some."""
    others = {n for n in E.queries() if n == "pipeline" or n.startswith("op")}
    assert set(E.queries()) - others == set(E.oracle_sql()) - others
    assert set(E.oracle_sql()) <= set(E.queries())


def test_queries_match_oracle(spark):
    res = compare(spark, SF_SMALL, list(E.oracle_sql()), verbose=False)
    bad = {n: r for n, r in res.items() if not r.get("match")}
    assert not bad, bad


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "MessageID" in df.columns
