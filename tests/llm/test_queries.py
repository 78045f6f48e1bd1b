"""Every registered query that SQL can express against its DuckDB SQL, and
the queries' contract on whole tables."""

import duckdb
import pytest

import __spark_entry__ as E
from strata.llm import queries as Q
from tools.check import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF).toPandas()
    o = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns) and len(s) == len(o)
    assert digest(s) == digest(o)


def test_one_query_for_every_operator():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_the_rest_works_without_the_subpackage(tmp_path):
    """The entry imports and lists the other queries when the llm folders and
    the pipeline are left out, and other import errors still show."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path
    root = Path(__file__).parents[2]
    shutil.copytree(root / "strata", tmp_path / "strata", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(root / "tools", tmp_path / "tools", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') or k == 'pipeline' for k in q), len(e.oracle_sql()))"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    done = run()
    n, has, sql = done.stdout.split()
    assert int(n) == int(sql) > 60 and has == "False", done.stderr
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    assert "no_such_module" in run().stderr
