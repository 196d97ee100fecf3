"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learnt, not written down: words and word beginnings that mark toxic training texts, counted in the
tasks over the distinct texts of the labelled sample. A term is taken where it is over-represented in toxic texts by log odds
of ``ODDS`` and by more than chance: at most ``CHANCE`` of all terms are expected to do as well if labels were
independent of words. Features are densities of lexicon words and beginnings, their nearness to second-person words,
capitals, punctuation and obfuscation rates. Lexicons for training features come from the other half of the
sample, so trees see densities as they are on unseen texts; calibration is fitted on held-back halves too. Copies of a text
count once and are always in one half.

Bounds: at most ``rows`` labelled rows train the model (the smallest hashes of doc_id), which bounds the terms. Scoring
reads every whole text once and shuffles nothing.

Defined results: null text counts as empty and is scored like any other; labels of other rows than the training
fold are never read; equal texts with different labels count as toxic; with no toxic (or no clean) training rows the score
is the training share of toxic rows (0 with no labels at all); repeated rows score alike; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import BoostedTrees, Isotonic
from tidemark.llm.common import labelled_sample, materialize, score_texts

ODDS, CHANCE = 2.5, 100
ROWS = 20_000
HEADS = (4, 5)  # lengths of word beginnings
_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[^\W\d_]+[\d@$*!#]+[^\W\d_]+")
_MASKS = re.compile(r"[\d@$*!#]")
_RUN = re.compile(r"([^\W\d_])\1\1")
# fixed values: second-person words of the languages in common web text
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros os".split())
# fixed values: the usual look-alikes of letters
PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
NEAR = 5  # words


def terms(text: str) -> set[str]:
    """Words of at least three letters and word beginnings (marked ^) of a text."""
    words = {w for w in _WORD.findall(text.lower()) if len(w) > 2}
    return words | {"^" + w[:k] for w in words for k in HEADS if len(w) > k}


class Lexicon:
    def __init__(self, weights: dict[str, float]):
        self.words = {k: v for k, v in weights.items() if k[0] != "^"}
        self.heads = {k[1:]: v for k, v in weights.items() if k[0] == "^"}


def features(text: str, lex: Lexicon) -> list[float]:
    low = text.lower()
    words = _WORD.findall(low)
    n, chars = max(1, len(words)), max(1, len(text))
    kinds = set(words)
    found = kinds & lex.words.keys()
    heads = lex.heads.keys() & {w[:s] for w in kinds for s in HEADS} if lex.heads else set()
    headed = {w for w in kinds if w[:4] in heads or w[:5] in heads} if heads else set()
    best = max([lex.words[w] for w in found], default=0.0)
    hits = second = near = head_hits = 0
    marked = found | headed | (kinds & SECOND)
    if marked:
        last_you = last_hit = -(10**9)
        for i, w in [(i, w) for i, w in enumerate(words) if w in marked]:
            if w in SECOND:
                second += 1
                near += i - last_hit <= NEAR
                last_you = i
            if w in headed or w in found:
                head_hits += w in headed
                hits += w in found
                near += i - last_you <= NEAR
                last_hit = i
    masked = _MASKED.findall(low) if _MASKS.search(low) else []
    unmasked = sum(m.translate(PLAIN) in lex.words for m in masked)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    upper = int(((code >= 65) & (code <= 90)).sum()) + int(((code >= 0xC0) & (code <= 0xDE)).sum())
    bang, ask = text.count("!"), text.count("?")
    symbols = int(((code >= 33) & (code <= 47)).sum() + ((code >= 58) & (code <= 64)).sum() + ((code >= 91) & (code <= 96)).sum())
    return [
        np.log1p(len(words)), hits, hits / n, len(found), best, sum(lex.words[w] for w in found) / n,
        head_hits, head_hits / n, len(heads), max([lex.heads[h] for h in heads], default=0.0),
        second / n, near, near / n, upper / chars, bang / n, ask / n, symbols / chars,
        len(masked) / n, unmasked, len(_RUN.findall(low)) / n, len(kinds) / n, chars / n,
    ]


N_FEATURES = 22


class ToxicityModel:
    def __init__(self, lexicon: Lexicon, trees: BoostedTrees | None, calibration: Isotonic | None, base: float):
        self.lexicon, self.trees, self.calibration, self.base = lexicon, trees, calibration, base

    def score(self, texts: list[str]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.base)
        x = np.array([features(t, self.lexicon) for t in texts], float).reshape(-1, N_FEATURES)
        return self.calibration.apply(self.trees.raw(x))


def fit(docs: DataFrame, labels: DataFrame, held_mod: int = 5, held_at: int = 0, rows: int = ROWS) -> ToxicityModel:
    """Learn from labelled rows outside the held-out fold only."""
    chosen = labelled_sample(docs, labels, "toxic", held_mod, held_at, rows)
    sample = materialize(chosen.groupBy("text").agg(F.max("y").alias("y")).withColumn("half", F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)).cast("int")), "toxic-sample")
    seen = {(r["half"], r["y"]): r["n"] for r in sample.groupBy("half", "y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = (np.array([seen.get((h, y), 0) for h in (0, 1)]) for y in (1, 0))
    if not toxic.sum() or not clean.sum():
        return ToxicityModel(Lexicon({}), None, None, float(toxic.sum() > 0))

    def count(frames):
        import pandas as pd

        for pdf in frames:
            out: dict[str, list[int]] = {}
            for text, y, half in zip(pdf["text"], pdf["y"], pdf["half"], strict=True):
                for t in terms(text):
                    out.setdefault(t, [0, 0, 0, 0])[2 * half + y] += 1
            yield pd.DataFrame([(k, *v) for k, v in out.items()], columns=["term", "c0", "t0", "c1", "t1"])

    names = ["c0", "t0", "c1", "t1"]
    counted = sample.mapInPandas(count, "term string, c0 long, t0 long, c1 long, t1 long").groupBy("term").agg(*(F.sum(c).alias(c) for c in names))
    counted = materialize(counted.where("c0 + t0 + c1 + t1 > 1"), "toxic-terms")
    views = {(1,): "01", (0,): "10", (0, 1): "11"}  # halves -> whether each counts

    def both(y: str, halves) -> Column:
        return sum((F.col(f"{y}{h}") for h in halves), F.lit(0)).cast("double")

    kinds = counted.agg(*(F.count_if(both("t", v) + both("c", v) > 1).alias(n) for v, n in views.items())).first()
    marks = []
    for v, n in views.items():
        t, c, at, ac = both("t", v), both("c", v), float(toxic[list(v)].sum()), float(clean[list(v)].sum())
        share = max(at, 0.5) / max(at + ac, 1.0)
        odds = F.log((t + 0.5) / (at + 1)) - F.log((c + 0.5) / (ac + 1))
        # exp(-surprise) bounds the probability of as many toxic ones among a term's texts by chance
        part = lambda k, p: F.when(k > 0, k * F.log(k / ((t + c) * p))).otherwise(0.0)
        surprise = part(t, share) + part(c, 1 - share)
        marks.append(F.when((odds >= ODDS) & (surprise >= float(np.log(max(kinds[n], 1) / CHANCE))), odds).alias(n))
    found = counted.select("term", *marks).where("`01` IS NOT NULL OR `10` IS NOT NULL OR `11` IS NOT NULL").collect()

    def lexicon(n: str) -> Lexicon:
        return Lexicon({r["term"]: r[n] for r in found if r[n] is not None})

    other = [lexicon("01"), lexicon("10")]

    def extract(frames):
        import pandas as pd

        for pdf in frames:
            x = [features(t, other[h]) for t, h in zip(pdf["text"], pdf["half"], strict=True)]
            yield pd.DataFrame({"x": x, "y": pdf["y"].to_numpy(), "half": pdf["half"].to_numpy()})

    got = sample.mapInPandas(extract, "x array<double>, y int, half int").toPandas()  # at most ``rows`` rows of 22 numbers
    x, y, half = np.stack(got["x"].to_numpy()), got["y"].to_numpy(float), got["half"].to_numpy()
    order = np.lexsort((*x.T, y))
    x, y, half = x[order], y[order], half[order]
    raw = np.zeros(len(y))
    for h in (0, 1):
        a, b = half != h, half == h
        if a.any() and b.any():
            raw[b] = BoostedTrees().fit(x[a], y[a]).raw(x[b])
    return ToxicityModel(lexicon("11"), BoostedTrees().fit(x, y), Isotonic().fit(raw, y), 0.0)


def score_documents(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """Every row with its score; ``keep`` names the columns that stay beside it (default doc_id)."""
    return score_texts(docs, model, keep or ["doc_id"], out)
