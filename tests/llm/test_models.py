"""Toxicity, quality, language and page extraction: held-out accuracy, awkward rows; the pipeline against its parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty, labels
from tidemark.llm import html_extract, html_pages, language, quality, registry, toxicity
from tidemark.llm.boosting import BoostedTrees, Isotonic

SF = "/root/testdata/sf0.01"


def accuracy(spark, rows, label):
    got = rows.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").select("predicted", label).collect()
    return np.mean([r["predicted"] == r[label] for r in got])


def test_toxicity_held_out(spark):
    rows = registry.op3_toxicity(spark, SF)
    assert rows.count() == 1000 and accuracy(spark, rows, "toxic") > 0.93


def test_quality_held_out(spark):
    rows = registry.op5_quality(spark, SF)
    assert rows.count() == 1000 and accuracy(spark, rows, "quality") > 0.93


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = registry.op6_language(spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


@pytest.mark.parametrize("module", [toxicity, quality])
def test_scores_of_awkward_rows(spark, module):
    docs = awkward(spark).drop("score")
    for given in (labels(spark), labels(spark, [(i, int(i != 9), int(i == 7)) for i in (3, 4, 7, 9, 11, 12, 20, 21)])):
        model = module.fit(docs, given)
        got = module.score_documents(docs, model).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert not module.score_documents(empty(spark).drop("score"), module.fit(empty(spark), labels(spark))).count()


@pytest.mark.parametrize("mark", list("1@$*!#"))
def test_masked_words_depend_on_no_other_character(mark):
    lexicon = toxicity.Lexicon({"idiot": 2.0})
    at = toxicity.N_FEATURES - 5  # the rate of masked words
    plain, more = (toxicity.features(t, lexicon) for t in (f"you id{mark}ot", f"you id{mark}ot 5"))
    assert plain[at] == more[at] == pytest.approx(1 / 3)
    assert toxicity.features("you idiot", lexicon)[at] == 0


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = given.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    texts = [r["text"] for r in docs.limit(40).collect()]
    assert (toxicity.fit(docs, given).score(texts) == toxicity.fit(docs, other).score(texts)).all()


def test_language_awkward(spark):
    docs = awkward(spark)
    got = {r["doc_id"]: r for r in language.identify(docs, language.fit(docs, 5, 4)).collect()}
    assert got[4]["lang_pred"] == got[3]["lang_pred"] == got[9]["lang_pred"] == got[22]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in language.identify(docs, language.fit(empty(spark))).collect()} == {"und"}


def test_boosting_and_isotonic():
    r = np.random.default_rng(0)
    x = r.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = BoostedTrees().fit(x[:400], y[:400])
    assert ((m.raw(x[400:]) > 0) == y[400:]).mean() > 0.9
    iso = Isotonic().fit(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert (np.diff(iso.apply(np.linspace(0, 5, 30))) >= 0).all()


def test_nnpu_separates_with_positives_only():
    r = np.random.default_rng(1)
    pos, unl = r.normal(1.5, 1, (800, 3)), np.concatenate([r.normal(1.5, 1, (1400, 3)), r.normal(-2.5, 1, (600, 3))])
    net, prior = quality.fit_pu(pos, unl)
    assert abs(prior - 0.7) < 0.12
    assert ((net.raw(unl) > 0) == (np.arange(2000) < 1400)).mean() > 0.95


@pytest.fixture(scope="module")
def model():
    return html_extract.default_model()


def test_marginals_on_unseen_layouts(model):
    bad = total = 0
    for source, label in html_pages.labelled_pages(60, seed=77):
        nodes, _ = html_extract.parse(source)
        y = label(nodes)
        got = model.marginals(nodes)
        bad += sum((m >= 0.5) != bool(a) for m, a, n in zip(got, y, nodes, strict=True) if n.size)
        total += len(y)
    assert bad / total < 0.02


def test_messages_equal_enumeration(model):
    nodes, _ = html_extract.parse("<body><div class=ad><p>x</p></div><article><p>long text here</p><a href=x>y</a></article></body>")
    feats = html_extract.features(nodes, {})
    n = len(nodes)
    mass = np.zeros(n)
    total = 0.0
    for bits in range(2**n):
        y = [bits >> i & 1 for i in range(n)]
        w = np.exp(sum(sum(model.unary[f] for f in feats[i]) for i in range(n) if y[i]) + sum(model.pair[html_extract.kind(nodes[i].tag), y[nodes[i].parent], y[i]] for i in range(1, n)))
        total += w
        mass += w * np.array(y)
    assert model.marginals(nodes) == pytest.approx((mass / total).tolist())


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=/a>Menu</a></li></ul></nav>
<article><h1>Big &amp; Bold</h1><p><b>Lead   text goes here for a while<br>and on.<p>Second&nbsp;para with <i>in</i>line text and some more words.</p></article>
<div class="cookie-notice"><p>We use cookies on this site.</p></div><section class="comments"><h2>Comments</h2><p>Nice post, thank you very much!</p></section><footer>&copy; me</footer></body></html>"""


def test_page_text(spark, model):
    rows = spark.createDataFrame([(1, "u", PAGE, 5), (2, None, None, 5), (3, "u", "", 5), (4, "u", "plain < text & more", 5), (1, "u", PAGE, 5), (5, "u", "</div></p><p>x</b", 5), (None, "u", "<p>" * 3000 + "deep", 5)], "page_id long, url string, html string, text int")
    got = html_extract.extract_pages(rows, model).collect()
    texts = [r["text"] for r in got if r["page_id"] == 1]
    assert texts == ["Big & Bold Lead text goes here for a while and on. Second para with inline text and some more words."] * 2
    assert [(r["text"], r["n_chars"]) for r in got if r["page_id"] in (2, 3)] == [("", 0)] * 2
    assert len(got) == 7 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert not html_extract.extract_pages(rows.limit(0), model).count()


SAID = ["The committee met on Tuesday to discuss the new harbour plan and its costs for the town.", "Several members asked whether the budget had been checked by an outside auditor.",
        "A report from the engineers said that the old wall would need repairs within two years.", "Residents who spoke were mostly in favour, though some worried about noise."]
PS = "".join(f"<p>{x}</p>" for x in SAID)
MENU, FOOT = "<nav><a href=/>Home</a><a href=/n>News</a></nav>", "<footer>Copyright 2020 Town News</footer>"


@pytest.mark.parametrize("page", [
    f"<html><body><div>{PS}</div></body></html>", f"<html><body>{MENU}<div><h1>Plan</h1>{PS}</div>{FOOT}</body></html>", PS, "\n".join(SAID), f"<body>{PS}</body>", f"<body>{MENU}{PS}{FOOT}",
    "<body>" + "".join(f"<div>{x}</div>" for x in SAID) + "</body>", "<body>" + "<br><br>".join(SAID), f"<div id=wrapper><div id=page><div>{PS}</div></div></div>",
    f"<table><tr><td><a href=/>Home</a> <a href=/b>News</a></td><td><h2>Plan</h2>{PS}</td></tr></table>", f"<section><h2>Plan</h2>{PS}</section><aside><p>Read our other stories.</p></aside>",
])
def test_pages_written_by_hand(model, page):
    """Layouts that no training page was composed from."""
    got = model.text(page)
    assert all(x in got for x in SAID) and "Home" not in got and "Copyright" not in got and "other stories" not in got


def test_nothing_inside_an_article_is_dropped(model):
    got = model.text(f"<article>{PS}<p>It is <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here.</p><object data=a>Instead.</object></article>")
    assert got == " ".join(SAID) + " It is x=2 here. Instead."
    assert model.text("<html><body><article><p>Short note.</p></article></body></html>") == "Short note."


LINKS = "<ul><li><a href=/a>First document about harbours</a></li><li><a href=/b>Second report</a></li></ul>"


@pytest.mark.parametrize(("page", "want"), [
    (f"<article><p>{SAID[0]}</p>{LINKS}<p>{SAID[1]}</p></article>", f"{SAID[0]} First document about harbours Second report {SAID[1]}"),
    (f"<html><body>{MENU}<article><h1>Index of things</h1>{LINKS}</article>{FOOT}</body></html>", "Index of things First document about harbours Second report"),
    (f"<form><select><option>a</form><article>{PS}</article>", " ".join(SAID)),
    (f"<html><body>{MENU}<article>{PS}</article><form><select><option>a<option>b</select></form></body></html>", " ".join(SAID)),
    (f"<article><p>{SAID[0]}</p><canvas>Fallback words</canvas><noscript><p>Also said.</p></noscript></article>", f"{SAID[0]} Fallback words Also said."),
    (f"<body><noscript>Please enable JavaScript</noscript><article>{PS}</article></body>", " ".join(SAID)), ("<div>two words</div>", "two words"), ("<html><body><div>two words</div></body></html>", "two words"),
    (f"<nav>{LINKS}</nav><article>{PS}</article>", " ".join(SAID)),
])
def test_lists_of_links_selects_and_few_words(model, page, want):
    assert model.text(page) == want


@pytest.mark.parametrize("part", ["<div>|</span>", "<p><button>|<b>|<h1></h1>", "<a '", '<a "', "<p>", "<ul>|<li><b>", "<!--", "<", "&", "<a b='", "<div>|x|</div>"])
def test_a_megabyte_of_broken_markup_takes_seconds(model, part):
    import time

    parts = part.split("|")
    n = 1_000_000 // sum(map(len, parts))
    at = time.process_time()
    model.text("".join(p * n for p in parts) + ">")
    assert time.process_time() - at < 40


def test_given_pages(spark, model):
    """Every given page's article, cut out by its tags, equals the extracted text."""
    import html
    import re

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = r["html"][r["html"].index("<article>") + 9 : r["html"].rindex("</article>")]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", inner))
        assert model.text(r["html"]) == " ".join(html.unescape(plain).split())
