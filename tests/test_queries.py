"""Every registered query against its SQL on the given tables."""

import os
import re
import subprocess
import sys

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()
OWN_TESTS = re.compile(r"op\d+_|pipeline$")  # compared elsewhere with more than SQL


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not OWN_TESTS.match(n)))
def test_query(spark, sf_dir, duck, name):
    assert name in SQL
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(duck, SQL[name])


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert rows[-1].resource_type == "total" and rows[-1]["count"] == sum(r["count"] for r in rows[:-1])


def test_registry_imports_without_a_session():
    code = "import __spark_entry__ as r; assert set(r.oracle_sql()) <= set(r.queries())"
    folder = os.path.dirname(os.path.abspath(registry.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=folder, check=True)
