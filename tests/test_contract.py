"""The driver contract, and every query with SQL against DuckDB at the smallest scale."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from caretide import session
from checks.registry import TABLES
from tools.compare import compare

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["arrival_hour", "day_of_week", "visits", "high_acuity_share"]
    assert out.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 100


# One query per area; CARETIDE_QUERIES=all takes every one (as tools/compare.py does).
AREAS = (
    "clean_feed", "clean_visits", "clean_post_text", "corr_spearman", "daily_news", "dedup_by_id",
    "enrich_visits", "extract_listing", "lag_rolling_split_keys", "numeric_report", "read_tweets",
    "roc_curve", "score_sentiment", "stream_daily_counts", "temporal_features",
)
EVERY = os.environ.get("CARETIDE_QUERIES") == "all"


@pytest.mark.parametrize("name", sorted(ORACLES) if EVERY else AREAS)
def test_query_equals_sql(spark, duck, small, name):
    verdict = compare(spark, duck, name, small)
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize(
    "name", sorted(set(QUERIES) - set(ORACLES)) if EVERY else ("quality_report", "collect_news", "predict")
)
def test_query_without_sql_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert session.shared_folder(spark) == folder.rstrip("/")
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")


def test_cluster_without_shared_folder_is_refused():
    class Unset:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Unset(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_library_never_collects_tables():
    """Row collection is limited to the few places that read bounded summaries."""
    allowed = {"sequence.py": 1, "cleaning.py": 1, "hypothesis.py": 1, "evaluate.py": 1}
    for folder, _, files in os.walk(os.path.join(ROOT, "caretide")):
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(folder, f)).read()
                assert len(re.findall(r"\.collect\(\)", text)) <= allowed.get(f, 0), f
                assert "toPandas" not in text and "localCheckpoint" not in text and ".rdd.map" not in text
