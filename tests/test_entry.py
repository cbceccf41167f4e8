import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p1_found", "p2_found", "p3_found", "p5_found", "p6_found", "p7_found"} <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test data")
def test_queries_equal_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS FROM '{SMALL}/{f}'")
    plain = lambda v: repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)
    for name, sql in entry.oracle_sql().items():
        df = entry.queries()[name](spark, SMALL)
        got = con.execute(sql)
        names = [c[0] for c in got.description]
        assert sorted(names) == sorted(df.columns), name
        want = sorted("|".join(plain(r[names.index(c)]) for c in sorted(names)) for r in got.fetchall())
        assert sorted("|".join(plain(r[c]) for c in sorted(names)) for r in df.collect()) == want, name


def test_imports_without_the_text_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"import sys, shutil; shutil.copytree({root!r}, {str(tmp_path / 'r')!r}, ignore=shutil.ignore_patterns('.git', 'llm', '__pycache__')); sys.path.insert(0, {str(tmp_path / 'r')!r}); import __spark_entry__ as e; print(sorted(n for n in e.queries() if n[0] == 'p' and n[1].isdigit()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert out.returncode == 0, out.stderr
    assert "p7_found" in out.stdout and "p4_found" not in out.stdout
