"""Driver contract: entry, queries, oracle_sql."""

import duckdb

import __spark_entry__ as E
from conftest import SF_SMALL

STREAM_ONLY = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["plant_id", "asset_id", "asset_name", "criticality", "day_dt"]


def test_every_query_has_oracle():
    from plantlake.plans import oracle, registry
    q, o = registry.queries(), oracle.oracle_sql()
    assert set(q) - set(o) == STREAM_ONLY
    assert set(o) <= set(q)
    assert set(q) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_library_stands_alone(tmp_path):
    """A copy without the optional subpackage, but with the pipeline beside it, registers the other queries."""
    import os
    import shutil
    import subprocess
    import sys
    from plantlake.plans import registry
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(os.path.join(root, "plantlake"), tmp_path / "plantlake",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(root, name)):
            shutil.copy(os.path.join(root, name), tmp_path)
    code = "import __spark_entry__ as E; print(*sorted(E.queries())); print(*sorted(E.oracle_sql()))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}).stdout.splitlines()
    assert got[0].split() == sorted(registry.queries()) and set(got[1].split()) <= set(got[0].split())


def test_oracle_matches_on_small_data(spark):
    """A few queries end to end against DuckDB at sf0.001 (the full check runs at sf0.01)."""
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
    from check_oracle import digest, duck
    con = duck(SF_SMALL)
    q, o = E.queries(), E.oracle_sql()
    for name in ("tag_hourly", "health_daily", "oee_daily", "rca_evidence", "serving_shifts", "key_check"):
        sdf = q[name](spark, SF_SMALL)
        cur = con.execute(o[name])
        dcols = [d[0] for d in cur.description]
        hs, _ = digest(sdf.columns, [tuple(r) for r in sdf.collect()])
        hd, _ = digest(dcols, cur.fetchall())
        assert sorted(sdf.columns) == sorted(dcols) and hs == hd, name
