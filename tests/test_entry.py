"""The entry gives its own queries whatever the optional package lacks."""

import sys

import pytest

import __spark_entry__ as driver
from marquee.plans.oracle import ORACLE_SQL
from marquee.plans.queries import QUERIES


@pytest.mark.parametrize("missing", ["marquee.llm", "marquee.llm.queries", "tiktoken"])
def test_without_the_text_package_or_what_it_needs(monkeypatch, missing):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("marquee.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    assert set(driver.queries()) == set(QUERIES) and driver.oracle_sql() == ORACLE_SQL


def test_without_the_pipeline(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert "pipeline" not in driver.queries() and set(QUERIES) <= set(driver.queries())
