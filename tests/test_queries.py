"""Every registered query against its SQL, and the plans that must stay narrow."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from marginalia.plans import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    line = compare(spark, con, FOLDER, name)
    assert line.startswith("ok"), line


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"lang", "type", "entities", "chars"}


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["tokenize", "token_features", "token_offsets", "bio_entities", "run_entities", "section_carry", "assertions",
     "cue_spans", "chunks", "line_chunks", "markup_text", "entity_records", "in_lexicon", "lexicon_labels"],
)
def test_documents_are_not_shuffled(spark, name):
    """Apart from the partition floor on this tiny input, the document side has no exchange."""
    text = plan(spark, name)
    branch = text.split("BroadcastExchange")[0]
    exchanges = [x for x in branch.splitlines() if "Exchange " in x and "RoundRobin" not in x]
    assert not exchanges, exchanges
    assert "Python" not in text


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<doc_id:bigint>" in plan(spark, "failed_docs")
    assert "PushedFilters: [StringEndsWith(url,.html)" in plan(spark, "key_filter").replace("IsNotNull(url), ", "")
