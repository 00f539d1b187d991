"""Small operators and session helpers."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from storelens.operators.summaries import attach_scalar, key_profile, min_mean_max, top_k
from storelens.plans.registry import QUERIES

from conftest import SF_SMALL, rows


def test_the_configured_master_holds():
    code = ("from storelens.session import get_session; s = get_session(); "
            "print('MASTER', s.sparkContext.master); s.stop()")
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell",
           "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "MASTER local[2]" in out.stdout


def test_a_renamed_column_is_refused(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.withColumnRenamed("o_totalprice", "price").write.parquet(str(tmp_path / "orders.parquet"))
    with pytest.raises(ValueError, match="o_totalprice"):
        QUERIES["above_average_payers"](spark, str(tmp_path))


def test_building_a_query_runs_no_job(spark):
    # jobs that some thread of this process starts under this group: none while plans are built
    spark.sparkContext.setJobGroup("building", "building")
    for key in QUERIES:
        QUERIES[key](spark, SF_SMALL).schema
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_top_k_directions_and_nulls(spark):
    df = spark.createDataFrame([("a", 3), ("b", None), ("c", 3), ("d", 1)], "k string, v long")
    assert [r.k for r in top_k(df, "v", 3, ["k"]).collect()] == ["a", "c", "d"]
    assert [r.k for r in top_k(df, "v", 2, ["k"], descending=False).collect()] == ["b", "d"]


def test_profiles(spark):
    df = spark.createDataFrame([(1, 10), (1, None), (2, 10), (None, 5)], "a long, b long")
    p = key_profile(df, "n", {"da": ["a"], "dab": ["a", "b"]}).first()
    assert tuple(p) == (4, 2, 2)
    m = min_mean_max(df.where("b IS NOT NULL"), "b", ("lo", "mid", "hi"), 1).first()
    assert tuple(m) == (5, 8.3, 10)
    one = df.agg(F.max("b").alias("mx"))
    assert rows(attach_scalar(df.where("a = 2"), one)) == [(2, 10, 10)]


def test_cli_writes_a_result(spark, tmp_path):
    import pyarrow.parquet as pq

    from storelens.__main__ import main
    from storelens.plans.registry import QUERIES

    out = tmp_path / "res"
    # the CLI reuses the active session; do not stop it from the test
    spark_stop = type(spark).stop
    type(spark).stop = lambda self: None
    try:
        assert main(["film_count_by_rental_group", "/root/testdata/sf0.001", "--out", str(out)]) == 0
    finally:
        type(spark).stop = spark_stop
    got = pq.read_table(str(out)).to_pandas()
    want = QUERIES["film_count_by_rental_group"](spark, "/root/testdata/sf0.001").toPandas()
    assert sorted(got["count_films"]) == sorted(want["count_films"])
