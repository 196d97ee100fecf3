"""Golden values of single operators."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions.stats import residualize, robust_z
from tidemark.operators import census, cohort, events, identity, manifests, panel, privacy, quality, series
from tidemark.operators.asof import asof_join, visible


def long(spark, values, entity="a"):
    return spark.createDataFrame([(entity, i, float(v)) for i, v in enumerate(values)], "entity_id string, pos long, value double")


@pytest.mark.parametrize(("values", "slope"), [([1, 3, 7, 15], math.log(2)), ([1, 2], None), ([5, 5, 5, 5], 0.0), ([0, 0, 0], 0.0)])
def test_log_slope(spark, values, slope):
    got = series.log_slope(long(spark, values), ["entity_id"]).first()["slope"]
    assert got == (None if slope is None else pytest.approx(slope, abs=1e-12))


def test_log_slope_clamps_negatives(spark):
    a, b = (series.log_slope(long(spark, v), ["entity_id"]).first()["slope"] for v in ([-5, -1, 0, 10], [0, 0, 0, 10]))
    assert a == pytest.approx(b)


def z(spark, values, **how):
    df = spark.createDataFrame([("c", i, float(v)) for i, v in enumerate(values)], "cohort string, i int, v double")
    return [r["z"] for r in robust_z(df, ["cohort"], "v", "z", **how).orderBy("i").collect()]


def test_robust_z(spark):
    assert z(spark, [5, 5, 5, 5, 5, 9]) == [0, 0, 0, 0, 0, 3]
    assert z(spark, [1, 2, 3, 100, 5])[:3] == pytest.approx([-2 / (1.4826 * 2), -1 / (1.4826 * 2), 0])
    assert z(spark, [1, 2, 3, 100, 5])[3] == 3
    assert z(spark, [1, 2, 3, 4]) == pytest.approx([(v - 2.5) / 1.4826 for v in (1, 2, 3, 4)])
    assert z(spark, [5, 5, 5, 9], floor=None) == [0, 0, 0, 0]


def test_residualize_small_group_is_unchanged(spark):
    df = spark.createDataFrame([("c", i, float(i), float(i * i)) for i in range(3)], "cohort string, i int, z double, s double")
    assert [r["o"] for r in residualize(df, ["cohort"], "z", "s", "o").orderBy("i").collect()] == [0, 1, 2]


@pytest.mark.parametrize(("years", "now", "status", "total"), [({2024: 5, 2025: 3, 2026: 1}, 2026, "insufficient", 9), ({2020: 1, 2021: 10, 2022: 20, 2023: 30, 2024: 7}, 2024, "present", 68), ({2021: 3, 2022: 6, 2023: 12, 2024: 99}, 2024, "present", 120)])
def test_yearly(spark, years, now, status, total):
    got = series.yearly_momentum(spark.createDataFrame([("a", y, n) for y, n in years.items()], "entity_id string, year long, n long"), now).first()
    assert (got["axis2_status"], got["axis2_total"]) == (status, total)
    if total == 68:
        want = series.log_slope(long(spark, [10, 20, 30]), ["entity_id"]).first()["slope"]
        assert got["axis2_slope"] == pytest.approx(want)


def test_second_order_signals(spark):
    rising = [round(4 + 0.8 * i + i % 3) for i in range(52)]
    flat = [10 + (1 if i % 2 else -1) for i in range(52)]
    step = [5 if i < 26 else 5 + 4 * (i - 26) for i in range(52)]
    sparse = [5 if i < 12 else 0 for i in range(52)]
    df = long(spark, rising, "rising").union(long(spark, flat, "flat")).union(long(spark, step, "step")).union(long(spark, sparse, "sparse")).union(long(spark, [1] * 7, "short")).union(long(spark, range(15), "fifteen"))
    change = {r["entity_id"]: r for r in series.changepoint(df).collect()}
    assert change["step"]["state"] == "changepoint" and 0 < change["step"]["split"] < 52
    assert change["flat"]["state"] == "none" and change["short"]["state"] == "reserved"
    swing = {r["entity_id"]: r for r in series.recency_swing(df).collect()}
    assert swing["rising"]["prior_window"] == 39 and swing["fifteen"]["prior_window"] == 2 and swing["short"]["reason"]
    assert swing["flat"]["label"] != "accelerating"
    noise = {r["entity_id"]: r for r in series.slope_to_noise(df).collect()}
    assert noise["rising"]["low"] < noise["rising"]["ratio"] < noise["rising"]["high"] and noise["rising"]["ratio"] > 0
    assert noise["sparse"]["reason"]


def gated(spark):
    weeks = {"rise": (1, 4.0), "watch": (2, 3.0), "inc": (40, -0.6), "track": (35, -1.0), "ctx": (30, -0.8)}
    yearly = {"rise": (5, 12, 28, 55, 110, 40), "watch": (95, 72, 50, 32, 16, 5), "inc": (45, 46, 44, 45, 44, 10), "track": (90, 68, 46, 30, 15, 4), "ctx": (85, 64, 44, 30, 16, 6)}
    reg = spark.createDataFrame([(e, "c", 1000, e == "inc") for e in weeks], "entity_id string, cohort string, size long, incumbent boolean")
    act = spark.createDataFrame([(e, i, max(0, round(b + g * i))) for e, (b, g) in weeks.items() for i in range(30)], "entity_id string, pos long, value long")
    cit = spark.createDataFrame([(e, 2015 + i, n) for e, ns in yearly.items() for i, n in enumerate(ns)], "entity_id string, year long, n long")
    return cohort.weekly_scores(reg, act, cit, 29, 2020, cohort.Methodology())


def test_gate(spark):
    rows = gated(spark).cache()
    assert {r["entity_id"]: r["status"] for r in rows.collect()} == {"rise": "rising", "watch": "watch", "inc": "calibration", "track": "tracked", "ctx": "tracked"}
    c = cohort.status_counts(rows).first()
    assert (c["rising"], c["watch"], c["calibration"], c["tracked"], c["axis2_present"]) == (1, 1, 1, 2, 5)
    assert {r["percentile"] for r in rows.collect()} >= {0, 100}


@pytest.mark.parametrize(("values", "share", "eligible"), [((100, 110, 121, 133), 0, 12), ((1000, 10, 1050, 1080), 1, 12), ((100, 5000, 102, 104), 1, 12), ((1000, 12, 9, 1020), 1, 12), ((1000, 400, 390, 395), 0, 12)])
def test_reversal_share(spark, values, share, eligible):
    df = spark.createDataFrame([("s", f"e{k}", f"2020-0{i + 1}", v + (k if values[0] == 100 and values[1] == 110 else 0)) for k in range(12) for i, v in enumerate(values)], "series string, entity string, snap string, value long")
    got = panel.reversal_share(df, math.log(2)).where("idx = 2").first()
    assert (got["share"], got["eligible"]) == (share, eligible)


def votes_of(spark, points, entities=6):
    df = spark.createDataFrame([(f"e{k}", f"2020-{i + 10}", v) for k in range(entities) for i, v in enumerate(points(k))], "entity string, snap string, value long")
    return panel.votes(df, spark.createDataFrame([(f"e{k}", "c") for k in range(entities)], "entity string, cohort string"))


def test_votes(spark):
    assert all(r["slope"] > 0 for r in votes_of(spark, lambda k: [100 + 10 * i for i in range(14)]).collect())
    assert not votes_of(spark, lambda k: [100 + i for i in range(13)]).count()
    odd = {r["entity"]: r for r in votes_of(spark, lambda k: [100] * 14 + [140] if k == 0 else [100 + 5 * i + k for i in range(15)]).collect()}
    assert odd["e0"]["unstable"] and not odd["e0"]["rising"] and not odd["e1"]["unstable"]


def test_asof_and_visibility(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("a", 7, "z")], "k string, rt int, v string")
    assert {(r["k"], r["t"]): r["v"] for r in asof_join(left, right, ["k"], "t", "rt", ["v"]).collect()} == {("a", 5): "y", ("a", 1): None, ("b", 9): None}
    seen = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("nonsense",), (None,)], "c string").select(visible("c", "2024-06-01").alias("v"))
    assert [r["v"] for r in seen.collect()] == [True, False, False]


def states(spark, rows):
    schema = "entity_id string, cohort string, incumbent boolean, rising boolean, convergent_axes array<string>, coverage1 string, coverage2 string, history string, observations int, gate string, signal string"
    return spark.createDataFrame(rows, schema)


ROW = ("c", False, False, [], "measurable", "measurable", "sufficient", 5, "eligible", "not_published")


def test_events(spark):
    same = states(spark, [("a", *ROW)])
    assert [r["event_kind"] for r in events.diff_events(same, same).collect()] == ["quiet_week"]
    assert [r["event_kind"] for r in events.diff_events(states(spark, []), same).collect()] == ["baseline_unavailable"]
    gone = events.diff_events(same, states(spark, [("b", *ROW)]), spark.createDataFrame([("a",)], "entity_id string"))
    assert {(r["entity_id"], r["event_kind"]) for r in gone.collect()} == {("a", "collection_failed"), ("b", "measurement_resumed")}
    lost = events.diff_events(states(spark, [("a", "c", False, False, ["axis1"], *ROW[4:])]), same)
    assert [(r["event_kind"], r["detail"]) for r in lost.collect()] == [("axis_threshold_lost", "axis1")]


def test_minutes_cap_keeps_the_added_cohort(spark):
    cur = states(spark, [(f"e{i:02d}", "new", *ROW[1:]) for i in range(60)])
    prev = states(spark, [("z", *ROW)])
    m = events.minutes(prev, cur, events.diff_events(prev, cur)).where("cohort = 'new'").collect()
    assert len(m) == 50 and "cohort_added" in {r["event_kind"] for r in m}
    assert sorted(r["entity_id"] for r in m if r["entity_id"]) == [f"e{i:02d}" for i in range(49)]


def test_merkle(spark):
    files = lambda rows: identity.merkle_root(identity.merkle_leaves(spark.createDataFrame(rows, "path string, content string")))
    a = files([("x", "1"), ("y", "2"), ("z", "3")])
    assert a == files([("z", "3"), ("x", "1"), ("y", "2")]) != files([("x", "1"), ("y", "2"), ("w", "3")])
    assert files([]) == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_shards_are_balanced(spark):
    got = identity.shards(spark.range(137).repartition(5), ["id"], 8).groupBy("shard").count().collect()
    assert sum(r["count"] for r in got) == 137 and {r["count"] for r in got} == {17, 18}


def test_completeness(spark):
    ids = lambda n: spark.range(n)
    assert quality.completeness(ids(20), ids(19), "id").first()["ok"]
    assert not quality.completeness(ids(20), ids(10), "id").first()["ok"]
    assert not quality.completeness(ids(20), ids(0), "id").first()["ok"]


def test_manifests():
    read = manifests.read_manifest
    assert read("requirements.txt", "Torch>=2.0 # x\n-r other\n\nnum_py") == (None, ["num-py", "torch"])
    assert read("pyproject.toml", '[project]\nname = "My.Tool"\ndependencies = ["jax>0"]') == ("my-tool", ["jax"])
    assert read("Cargo.toml", '[package]\nname="x"\n[dependencies]\nserde="1"\nown={path="../own"}') == ("x", ["serde"])
    assert read("package.json", "{bad") == read("package.json", "[1]") == read("go.mod", "module x") == (None, [])
    assert read("package.json", '{"name": "A_b", "dependencies": {"x": "1", "y": "file:../y", "z": 3}}') == ("a-b", ["x"])


def test_dependency_lines_come_from_their_section():
    line = manifests.dependency_line
    assert line("requirements.txt", "# torch\nnumpy>=1\npytorch==2\ntorch\n", "torch") == "torch"
    assert line("package.json", '{\n "devDependencies": {"a-b": "0"},\n "dependencies": {\n  "My_lib": "^1",\n  "a.b": "2"\n },\n "x": {"a-b": 1}}', "a-b") == '  "a.b": "2"'
    assert line("pyproject.toml", "[build-system]\nrequires=['torch']\n[project]\nname='x'\ndependencies = [\n 'numpy[extra]>1',  # ]\n 'torch >= 2',\n]\n[tool.x]\n", "torch") == " 'torch >= 2',"
    assert line("Cargo.toml", '[dev-dependencies]\nserde="1"\n[dependencies]\nserde_json = "1"\nserde = { version="1" }\n', "serde") == 'serde = { version="1" }'
    for file in ("requirements.txt", "package.json", "pyproject.toml", "Cargo.toml", "other"):
        with pytest.raises(ValueError, match="declares torch"):
            line(file, '{"scripts": {"torch": "x"}}' if file == "package.json" else "pytorch\n[x]\ntorch2 = '1'\n", "torch")


def test_window_terms_equal_brute_force(spark):
    import random

    r = random.Random(4)
    docs = [(k, "".join(r.choice(["tool ", "scum ", "Idiot, ", "toolbox ", "x" * 40 + " ", "a b ", "scummy "]) for _ in range(r.randint(0, 60)))) for k in range(40)]
    got = {(x["doc"], x["name"], x["term"].lower(), x["context"]) for x in privacy.window_terms(spark.createDataFrame(docs, "doc long, surface string"), ["tool"], ["scum", "idiot"], 120).collect()}
    want = set()
    for k, text in docs:
        spans = {w: [i for i in range(len(text)) if text[i : i + len(w)].lower() == w and not text[i - 1 : i].isalnum() and not text[i + len(w) : i + len(w) + 1].isalnum()] for w in ("tool", "scum", "idiot")}
        for a in spans["tool"]:
            lo, hi = max(0, a - 120), min(len(text), a + 4 + 120)
            # a term cut by the window's edge is judged as it stands there
            ctx = text[lo:hi]
            for w in ("scum", "idiot"):
                if any(ctx[i : i + len(w)].lower() == w and not ctx[i - 1 : i].isalnum() * (i > 0) and not ctx[i + len(w) : i + len(w) + 1].isalnum() for i in range(len(ctx))):
                    want.add((k, "tool", w, ctx))
    assert got == want and len(got) > 20


def test_window_terms_of_many_names(spark):
    """Ten thousand names, overlapping and nested ones, other letters' cases, names that are terms: equal to a pattern per name."""
    import random
    import re

    r = random.Random(5)
    words = ["tool", "tool-kit", "kit", "a.b", "scum", "İx", "größe", "x", "tools", "idiot", "deep idiot"]
    names = words[:8] + [f"name{k:05}" for k in range(10_000)]
    terms = ["scum", "idiot", "deep idiot", "x"]
    docs = [(k, "".join(r.choice([*words, "GRÖSSE", "GRÖßE", f"name{r.randrange(10_000):05}", "_tool", "Scum9"]) + r.choice([" ", "-", ", ", "", " "]) for _ in range(r.randint(0, 50)))) for k in range(60)]
    got = sorted((x["doc"], x["name"], x["term"], x["context"]) for x in privacy.window_terms(spark.createDataFrame([*docs, (None, None)], "doc long, surface string"), names, terms, 30).collect())
    want = []
    for k, text in docs:
        for n in names[:8] + [n for n in names[8:] if n in text.lower()]:
            for m in re.finditer(rf"(?<!\w){re.escape(n)}(?!\w)", text, re.I):
                lo = max(0, m.start() - 30)
                ctx = text[lo : m.end() + 30]
                for t in terms:
                    want += [(k, n, x.group(0), ctx) for x in re.finditer(rf"(?<!\w){re.escape(t)}(?!\w)", ctx, re.I) if (lo + x.start(), lo + x.end()) != m.span()]
    assert got == sorted(want) and len(got) > 200


def test_json_walk_has_one_plan_at_any_depth(spark):
    deep = "[" * 10_000
    rows = [(1, deep), (2, deep + "]" * 10_000), (3, "[" * 900 + '{"owner": 1}' + "]" * 900), (4, '{"a": [1.50, true, null, "x", [], {}], "b": {"a": -0}}'), (5, "[1, 2"), (6, '"s"')]
    df = spark.createDataFrame(rows, "k long, j string")
    plan = privacy.json_nodes(df, "k", "j")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan and "Exchange" not in plan
    got = [tuple(x) for x in privacy.json_nodes(df, "k", "j").where("k > 3").collect()]
    assert got == [
        (4, "$.a", "a", None, False), (4, "$.a[0]", None, "1.50", True), (4, "$.a[1]", None, "true", True), (4, "$.a[2]", None, None, True), (4, "$.a[3]", None, "x", True), (4, "$.a[4]", None, None, False),
        (4, "$.a[5]", None, None, False), (4, "$.b", "b", None, False), (4, "$.b.a", "a", "-0", True),
    ]
    assert [x["path"] for x in privacy.person_fields(df, "k", "j").collect()] == ["$" + "[0]" * 900 + ".owner"]


def test_json_nesting_and_person_keys(spark):
    rows = [(1, '{"a": {"b": [[{"owner": {"email": 1}}]]}}'), (2, '{"Owner": 1, "x": "{\\"login\\": [1]}"}'), (3, "{bad"), (4, None), (5, "7")]
    df = spark.createDataFrame(rows, "k long, j string")
    got = {(x["k"], x["path"]) for x in privacy.person_fields(df, "k", "j").collect()}
    assert got == {(1, "$.a.b[0][0].owner"), (1, "$.a.b[0][0].owner.email")}


def test_surface_of_markup(spark):
    from tidemark.functions import scalars

    pages = ["plain &amp; text", "<p>a&amp;b &amp;lt; &NBSP;c</p>", "<script>x<y</script>k<style>b</style>", "<b>1 < 2 &copy; & x</b>", "", None, "<i>&#39;q&quot;</i>\n\t z"]
    got = [x["s"] for x in spark.createDataFrame([(p,) for p in pages], "h string").select(scalars.html_surface("h").alias("s")).collect()]
    assert got == ["plain &amp; text", "a&b < c", "k", "1", "", None, "'q\" z"]
    twice = spark.createDataFrame([("<p>&amp;amp;lt;x a&amp;nbsp;b &amp;#39; &amp;quot;</p>",), ('<a title="<script>">x</script>\u00a0y\ufeff',)], "h string")
    assert [x["s"] for x in twice.select(scalars.html_surface("h").alias("s")).collect()] == ["&amp;lt;x a&nbsp;b ' \"", '<a title=" y']


def test_partition_verdicts(spark):
    """12 entities over six days: a reversal, a thin day, the last one."""
    rows = [("x", f"e{k}", d, 4 if d == 2 else 100) for k in range(12) for d in range(6) if not (d == 4 and k > 3)]
    df = spark.createDataFrame(rows, "series string, entity string, snap int, value long")
    got = {x["snap"]: x["status"] for x in panel.verdicts(df, math.log(2), 0.3, 0.9).collect()}
    assert got == {0: "CLEAN", 1: "CLEAN", 2: "SUSPECT_CORRUPT", 3: "CLEAN", 4: "INVALID_COVERAGE", 5: "PROVISIONAL"}
    assert {x["status"] for x in panel.verdicts(df, math.log(2), 0.3, 0.9, floor=20).where("snap <> 2").collect()} == {"INVALID_COVERAGE"}
    few = panel.verdicts(df.where("entity < 'e2'"), math.log(2), 0.3, 0.9).where("snap = 2").first()
    assert few["status"] == "CLEAN"  # fewer than ten entities accuse nobody
    assert [x["snap"] for x in panel.firings(df, math.log(2), 0.3).collect()] == [2]


def test_two_mentions_need_a_manifest(spark):
    schema = "name string, description string, topics array<string>, readme string, deps array<string>"
    rows = spark.createDataFrame([("a", "plain", [], "for model use", []), ("b", "plain", [], "for model use", ["torch"]), ("c", "a model server", [], "", []), ("d", "a course", ["x"], "for model use", ["torch"])], schema)
    got = census.classify(rows, census.words("model"), ["vision"], [], ["torch"], census.words("course"))
    assert {r["name"]: r["channel"] for r in got.collect()} == {"a": None, "b": "corroborated", "c": "storefront", "d": None}


def test_unknown_values_raise(spark):
    with pytest.raises(Exception, match="unknown value"):
        census.zero_filled(spark.createDataFrame([("odd",)], "c string"), "c", ["even"]).collect()
    with pytest.raises(Exception, match="no match"):
        census.require_match(spark.range(3), spark.range(2), "id").select(F.sum("id")).collect()
