"""Every registered query that SQL can express, against SQL on whole tables."""

import pytest

from annoweave.plans import queries as core, surface

from .conftest import DATA


def queries():
    return core.queries() | surface.queries()


def oracle_sql():
    return core.oracle_sql() | surface.oracle_sql()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(name, same_as_sql):
    same_as_sql(queries()[name], oracle_sql()[name])


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns[:4] == ["accession", "go_id", "term_count", "proteins"] and "final_score_Lumen-S_L0" in df.columns and df.count() > 0


def test_one_category_per_term_adds_up(spark):
    """Rows of the summary equal the ensemble export summed over categories."""
    from annoweave.operators import exports, summary

    raw = spark.createDataFrame([("a", f"t{i % 7}", "BP" if i % 7 < 3 else "MF", "m", i % 2, 0.1 * (i % 9), f"p{i}") for i in range(60)], "accession string, go_id string, category string, model_name string, layer_index long, reliability_index double, protein_id string")
    assert summary.term_stats(raw).count() == exports.topgo_ensemble(raw).count()


def test_k_monotone(spark):
    from annoweave.plans import pipeline

    t = pipeline.Tables.at(spark, DATA)
    n = [pipeline.hits(t, pipeline.Lookup(k=k)).count() for k in (1, 3, 5)]
    assert n == sorted(n)
