"""Each query against its SQL on the smallest tables."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from oracle import connect, difference

from __spark_entry__ import entry, queries
from tradelake.plans.oracles import ORACLES
from tradelake.plans.queries import QUERIES

WRITES_DAYS = ("silver_table_upsert", "ddl_tables", "daily_run")


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf, few_days, name):
    folder = few_days if name in WRITES_DAYS else sf
    result = QUERIES[name](spark, folder)
    assert difference(result, connect(folder), ORACLES[name]) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= queries().items()


@pytest.mark.parametrize("missing", ["tiktoken", "corpus_pipeline", "tradelake.llm"])
def test_queries_load_without_what_only_pipelines_need(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as e\n"
        "from tradelake.plans.queries import QUERIES\n"
        "assert e.queries().keys() == QUERIES.keys() == e.oracle_sql().keys()"
    )
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_entry(spark):
    result = entry(spark)
    assert result.columns[0] == "report_date"
    assert result.count() == 3918
