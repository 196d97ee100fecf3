"""Wording of states, feed age, band coverage, labels."""

import datetime

from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.operators import quality, states


def test_phrases_of_every_state(spark):
    schema = "entity_id int, observations int, history string, coverage1 string, reason1 string, coverage2 string, reason2 string, measurable int, gate string, signal string"
    no = "insufficient_source_coverage"
    rows = [
        (0, 6, "sufficient", "measurable", None, "measurable", None, 2, "eligible", "published"), (1, 2, "insufficient", "no_data", None, "source_not_measured", None, 0, "awaiting_observations", "not_published"),
        (2, 5, "sufficient", no, "cohort_z_unavailable", "measurable", None, 1, "awaiting_axis_coverage", "not_published"), (3, 5, "sufficient", "measurable", None, no, "source_returned_too_few", 1, "awaiting_axis_coverage", "not_published"),
        (4, 5, "sufficient", "measurable", None, no, None, 1, "awaiting_axis_coverage", "not_published"), (5, 5, "sufficient", "no_data", None, "source_not_measured", None, 0, "awaiting_axis_coverage", "not_published"),
        (6, 5, "sufficient", "measurable", None, "measurable", None, 2, "awaiting_cohort_floor", "not_published"), (7, 5, "sufficient", "measurable", None, "source_not_measured", None, 1, "awaiting_axis_coverage", "not_published"),
    ]
    got = {r["entity_id"]: r for r in states.phrases(spark.createDataFrame(rows, schema), F.lit("2001-w48")).collect()}
    assert got[0]["compact"] == "Rising" and got[0]["signal_phrase"] == "Rising signal published for 2001-w48." and got[0]["gate_phrase"] == "Convergence gate: evaluated weekly; Rising signal published for 2001-w48."
    assert got[1]["history"] == "History: 2 of 4 weekly observations." and got[1]["gate_phrase"] == got[1]["signal_phrase"] == "Gate: not computable — history 2 of 4 weekly observations"
    assert (got[1]["axis1"], got[1]["axis2"], got[1]["compact"]) == ("Development velocity axis: no observation data.", "Citation source: not measured.", "0 measurable axes")
    assert got[2]["axis1"] == "Development velocity axis: insufficient source coverage (cohort comparison unavailable)." and got[2]["axis_coverage"] == "Axis coverage: 1 measurable axis."
    assert [got[k]["gate_phrase"].removeprefix("Gate: not computable — ") for k in (2, 3, 4, 5, 6, 7)] == [
        "1 of 2 axes measurable (cohort comparison unavailable)", "1 of 2 axes measurable (source returned too few observations)", "1 of 2 axes measurable (coverage)", "0 of 2 axes measurable",
        "cohort below comparison floor", "1 of 2 axes measurable (unmeasured)",
    ]
    assert got[4]["axis2"] == "Citation axis: insufficient source coverage." and got[6]["history"] == "History: 5 weekly observations; minimum 4."


def test_feed_age(spark):
    now = datetime.datetime(2024, 1, 30, 12)
    ago = lambda days: now - datetime.timedelta(days=days)
    rows = [(0, False, None, None), (1, True, 503, ago(1)), (2, True, 200, None), (3, True, 200, ago(8)), (4, True, 200, ago(8.001)), (5, True, 200, ago(-2)), (6, True, 200, ago(3.9))]
    df = spark.createDataFrame(rows, "k int, reached boolean, status int, latest timestamp")
    got = {r["k"]: tuple(r["f"]) for r in df.select("k", states.feed_freshness(F.col("reached"), F.col("status"), F.col("latest"), F.lit(now)).alias("f")).collect()}
    assert got == {0: ("unknown", False, None), 1: ("stale", True, None), 2: ("stale", True, None), 3: ("ok", False, 8), 4: ("stale", True, 8), 5: ("ok", False, 0), 6: ("ok", False, 3)}


def test_band_coverage(spark):
    schema = "lo int, hi int, created string, done boolean, index_drift int, total int, collected int, at int"
    whole = [(0, 9, None, True, 0, 100, 100, 1), (0, 9, "", False, None, None, None, 2), (10, 19, "a", False, None, 50, 0, 1), (10, 19, "a", True, 1, 50, 49, 2), (10, 19, "b", True, 0, 1000, 1005, 1)]
    one = lambda rows, lo=0, hi=19: quality.band_coverage(spark.createDataFrame(rows, schema), lo, hi).first()
    got = one(whole)
    assert got["ok"] and (got["bands"], got["complete"], got["unresolved"], got["shortfall"], got["surplus"]) == (3, 3, 0, 1, 5)
    assert not one(whole, hi=29)["ok"] and not one(whole, lo=5)["whole_range"]
    assert one([*whole, (20, 29, "", False, 0, 1, 1, 1)], hi=29)["unresolved"] == 1
    assert one([*whole, (10, 19, "b", True, None, 1000, 1005, 3)])["without_drift"] == 1 and not one([*whole, (10, 19, "b", True, None, 1000, 1005, 3)])["ok"]
    assert one([*whole, (10, 19, "b", True, 0, 1000, 1006, 3)])["beyond"] == 1  # the newest attempt counts
    assert not one([])["ok"]


def test_labels_and_bounds(spark):
    df = spark.createDataFrame([("A — b—c", 5.0), (None, None), ("plain-name", -7.5)], "t string, v double")
    got = [tuple(r) for r in df.select(scalars.clean_label("t"), scalars.clamped("v", -3.0, 3.0), scalars.signed("v", 1, "n/a")).collect()]
    assert got == [("A, b, c", 3.0, "+5.0"), (None, None, "n/a"), ("plain-name", -3.0, "-7.5")]
