import importlib.util

import __spark_entry__
import oracles


#: Ranks within a tolerance are no equal numbers: test_graph.py holds them against plain steps in SQL.
WITHOUT_SQL = {"pagerank_within"}


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_own_query_has_an_oracle():
    assert set(__spark_entry__._own_queries()) - WITHOUT_SQL == set(oracles.oracle_sql())


def test_queries_without_the_training_data_subpackage(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name == "sluice.llm" else real(name, *a))
    assert set(__spark_entry__.queries()) - WITHOUT_SQL == set(oracles.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) == set(oracles.oracle_sql())
