"""Driver contract: entry, queries and oracle SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# fast, SQL-checked queries run against DuckDB at sf0.001 here; the full set
# is checked by tools/check_oracle.py
SAMPLE = ["ctr_by_url", "join_url_stats", "page_vector", "user_profile_topn", "term_score", "train_feature",
          "keywords_content", "term_share", "eval_auc_roc", "eval_f_by_threshold", "chi2_stats",
          "seq_mean_vector", "clean_fields", "src_impression_parse"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["uid", "label", "sumclick", "sumshow", "ctr", "pnum", "pdef", "pbeau", "s_term_score"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    fix = lambda v: repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(v)
    return sorted(tuple(fix(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(dcols, res.fetchall())


def test_registry_imports_without_the_jars(tmp_path):
    """Importing the registry and building the oracle texts reads no file of the
    Spark installation: it works with an empty ``jars`` folder and no JVM."""
    import subprocess
    import sys
    code = ("import glob, zipfile\n"
            "glob.glob = lambda *a, **k: []\n"
            "def no(*a, **k): raise OSError('no archive')\n"
            "zipfile.ZipFile = no\n"
            "import __spark_entry__ as e\n"
            "print(len(e.queries()), len(e.oracle_sql()))\n")
    import os
    repo = os.path.dirname(os.path.abspath(E.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=repo, capture_output=True, text=True,
                         env=os.environ | {"SPARK_HOME": str(tmp_path)})
    assert out.returncode == 0, out.stderr
    n_queries, n_sql = map(int, out.stdout.split())
    assert n_queries >= 96 and n_sql >= 75


def test_stop_words_equal_the_library_list(spark):
    from pyspark.ml.feature import StopWordsRemover
    from feedlab.constants import ENGLISH_STOP_WORDS
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
