"""Plans: what reaches the scan, and that no join is a product of two tables."""

import os

import pytest

from pairlake.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
#: Joined with one row, or a stated set of query rows against all rows.
ONE_ROW = {
    "class_balance", "consistency_score", "cosine_topk", "query_seeds", "new_images", "image_upserts", "consent_records", "pair_rows", "quarantine_rows", "evaluation_report", "face_pairs",
}
#: These have run by the time there is a plan.
EAGER = {"stream_dedup", "stream_batches", "frontier_bfs", "synthetic_negatives"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(spark, name):
    return catalogue.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in catalogue.queries() if n not in EAGER])
def test_no_products(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert name in ONE_ROW or "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "dequeue_batch")
    assert "EqualTo(status,pending)" in text and "TakeOrderedAndProject" in text and "metadata" not in text
    text = plan(spark, "largest_image")
    assert "IsNotNull(width)" in text and "source_url" not in text
    text = plan(spark, "queue_stats")
    assert "ReadSchema: struct<status:string>" in text


def test_every_scored_picture_has_a_reason(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 100, 900, None, None, None), (2, 900, 900, None, nan, nan), (3, 900, 900, nan, None, 300.0), (4, 900, 900, inf, 0.1, 100.0),
        (5, 900, 900, 2e6, 0.9, nan), (6, 900, 900, -inf, nan, 100.0), (7, 900, 900, 90.0, 0.9, 10.0), (7, 900, 900, 90.0, 0.9, 10.0), (8, 900, 900, 100.0, 0.9, inf),
    ]
    df = spark.createDataFrame([(*r, "A") for r in rows], "id long, width int, height int, blur_score double, lighting_uniformity double, mean_brightness double, grade string")
    df.write.parquet(str(tmp_path / "quality_result.parquet"))
    got = {r.reason: r.n for r in catalogue.queries()["quality_reasons_all"](spark, str(tmp_path)).collect()}
    assert got == {"resolution_too_small": 1, "PASS": 2, "overexposed": 2, "lighting_uneven": 1, "blur_too_low": 1, "underexposed": 1}
    means = {r.metric: r["mean"] for r in catalogue.queries()["batch_mean_of_means_all"](spark, str(tmp_path)).collect()}
    assert means == {"blur_score": pytest.approx((2e6 + 90 + 100) / 3, abs=1e-4), "lighting_uniformity": pytest.approx(0.7), "mean_brightness": pytest.approx(127.5)}


@pytest.mark.parametrize("name", ["structural_signals", "structural_scores"])
def test_signs_of_a_page_meet_in_one_join(spark, name):
    # the driver holds the plan and makes it anew after each exchange
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") <= 3 and text.count("Join") == 1


@pytest.mark.parametrize("name", ["structural_signals", "structural_scores"])
def test_pages_are_not_sent_whole(spark, name):
    # by its files' size the small table would be broadcast; the elements' size isn't known from it
    key = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(key)
    spark.conf.set(key, "10m")
    try:
        text = plan(spark, name)
    finally:
        spark.conf.set(key, kept)
    assert "SortMergeJoin" in text and "Broadcast" not in text
