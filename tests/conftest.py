from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tradelake.session import get_session

    session = get_session(
        "tests",
        f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


@pytest.fixture
def lake(spark, tmp_path):
    from tradelake.plans.daily import Lake

    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def few_days(sf, tmp_path_factory) -> str:
    """The smallest tables with their ship dates folded into forty days, around 1998-07-01.

    For queries that write one file per day: local disks are slow at creating thousands of files.
    """
    import duckdb

    folder = tmp_path_factory.mktemp("few-days")
    for path in Path(sf).glob("*.parquet"):
        (folder / path.name).symlink_to(path)
    line = folder / "lineitem.parquet"
    line.unlink()
    duckdb.connect().execute(
        f"""COPY (SELECT * REPLACE (TIMESTAMP '1998-06-11' + to_days(CAST(epoch(l_shipdate) // 86400 % 40 AS INTEGER)) AS l_shipdate)
        FROM '{sf}/lineitem.parquet') TO '{line}' (FORMAT parquet)"""
    )
    return str(folder)
