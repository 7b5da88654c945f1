"""The driver's entry: what is registered, and what a missing subpackage hides."""

import __spark_entry__ as entry


def test_only_the_subpackage_itself_may_be_missing():
    assert entry._there("gigframe.plans.registry")
    assert not entry._there("gigframe.no_such_package.queries")
    assert not entry._there("no_such_module")


def test_every_core_query_has_an_oracle():
    from gigframe.plans import registry
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.oracle_sql())
