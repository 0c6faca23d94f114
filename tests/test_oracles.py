"""Every registered query against its SQL, and the join-heavy ones again with hot keys forced apart."""

import pytest

from catalith import skew
from catalith.plans import catalogue

from .oracle import assert_same, database

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()
JOIN_HEAVY = [
    "compose_id", "array_reference", "anchor_reference", "commit_of_row", "mapping_choices", "apply_mapping",
    "apply_mapping_scalar", "code_lookup", "duplicate_keys", "duplicate_stem", "refs_resolve", "self_reference",
    "translate_expression", "first_wins_dedup", "unique_address", "unordered_pair_unique", "disambiguation_required",
    "once_per_parent", "orphan_references", "optional_reference", "case_hint", "expand_bare", "expand_schema_rename",
    "expand_exhaustive_map", "zero_expansion", "documented_exists", "suppress_cascade", "pair_codeployed",
    "nway_codeployed", "joins_in_venue", "connected_components", "linkable_tables",
]


@pytest.fixture(scope="module")
def db():
    return database()


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert_same(spark, db, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", JOIN_HEAVY)
def test_query_with_hot_keys_split(spark, db, name, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 2)
    assert_same(spark, db, QUERIES[name], SQL[name])
