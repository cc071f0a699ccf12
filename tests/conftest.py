import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TESTS = os.path.join(ROOT, "tests")
sys.path.insert(0, ROOT)
# Python workers import test helpers (the poll source's fake fetcher) by module name.
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, TESTS, os.environ.get("PYTHONPATH")) if p)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"
INGEST = dt.datetime(2026, 8, 12, 9, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from plantlake.session import build_session
    s = build_session("local[4]", "plantlake-tests", 8,
                      {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw(spark):
    from plantlake.sources.csv import load_enrichment
    return load_enrichment(spark, FIXTURES, INGEST)


@pytest.fixture(scope="session")
def fx(spark, raw):
    """Silver frames of the five-CSV fixture."""
    from plantlake.operators import silver
    return {name: fn(raw[f"{name}_raw"]) for name, fn in silver.SILVER_BUILDERS.items()}


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]
