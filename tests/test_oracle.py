"""Layer 2: every registered query with an oracle text equals DuckDB on sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    problems, _ = compare(df, con, ORACLE[name])
    assert not problems, problems


def test_every_query_has_oracle_or_is_model(spark):
    from basketry.plans import registry
    missing = set(registry.queries()) - set(ORACLE)
    assert missing <= {"kmeans_k_sweep", "kmeans_segments", "cluster_summary", "cluster_profile",
                       "pca_projection", "churn_model_metrics", "churn_scores",
                       "feature_importance", "segment_gen1", "churn_gen1_scores"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "rfm_segment" in df.columns
