"""Quality by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are training rows labelled quality 1; the unlabelled set is a sample of the whole table. A small
network over dense text features minimises ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` (sigmoid loss); when
the inner difference falls below zero the step goes against it instead. The class prior is estimated first, from
the unlabelled share above a score relative to the positives' share above it (its least over well-filled
thresholds), with a scorer trained on positives against unlabelled. Labels of quality 0 are never used.

Bounds: at most ``rows`` positives and ``rows`` unlabelled rows (the smallest hashes of doc_id). Scoring reads
every whole text once and shuffles nothing.

Defined results: null text counts as empty and is scored like any other; with no trusted positives every score is
0.5; repeated rows score alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import labelled_sample, score_texts, texts_of

ROWS = 12_000
_SYMBOLS = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")  # words of symbols only
_RUN = re.compile(r"([^\w\s])\1\1")
_SENTENCE = re.compile(r"[.!?](?:\s|$)")


def features(text: str) -> list[float]:
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    upper = float(((code >= 65) & (code <= 90)).sum() + ((code >= 0xC0) & (code <= 0xDE)).sum())
    lower = float(((code >= 97) & (code <= 122)).sum() + ((code >= 0xDF) & (code <= 0x24F)).sum())
    digits = float(((code >= 48) & (code <= 57)).sum())
    white = float((code <= 32).sum())
    other = chars - upper - lower - digits - white
    plain = text.count(".") + text.count(",")
    kinds = len(set(words))
    same = sum(map(str.__eq__, words, words[1:]))
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    m = max(1, len(lines))
    ends = sum(x[-1] in ".!?" for x in lines)
    bare = len(_SYMBOLS.findall(text))
    ending = sum(1 for x in words if not x[-1].isalnum() and x[-1] not in ".,;:")
    return [
        np.log1p(len(words)), kinds / n, np.log1p(kinds), same / n, upper / chars, upper / (upper + lower + 1), digits / chars,
        (other - plain) / chars, plain / n, bare / n, text.count("!") / n, ending / n, len(set(lines)) / m, ends / m,
        np.log1p(n / m), len(_SENTENCE.findall(text)) / n, (chars - white) / n, white / chars,
        len(_RUN.findall(text)) / n,
    ]


N_FEATURES = 19


class Scaler:
    """Rank-like scaling: robust centre and spread, then a smooth squash, so outliers keep their side but not their size."""

    def fit(self, x: np.ndarray) -> Scaler:
        self.centre = np.median(x, axis=0)
        spread = np.quantile(x, 0.9, axis=0) - np.quantile(x, 0.1, axis=0)
        self.spread = np.where(spread > 1e-9, spread, np.maximum(x.std(axis=0), 1e-3))
        return self

    def apply(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.spread
        return np.sign(z) * np.log1p(np.abs(z))


class Network:
    """One hidden layer with tanh units; Adam; all randomness from a fixed seed."""

    def __init__(self, inputs: int, hidden: int = 24, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = [r.normal(0, 1 / np.sqrt(inputs), (inputs, hidden)), np.zeros(hidden), r.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        self.m = [np.zeros_like(a) for a in self.p]
        self.v = [np.zeros_like(a) for a in self.p]
        self.t = 0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3][0]

    def step(self, x: np.ndarray, dz: np.ndarray, rate: float, decay: float = 1e-4) -> None:
        """One Adam step for the loss gradient ``dz`` at the outputs."""
        h = np.tanh(x @ self.p[0] + self.p[1])
        dh = np.outer(dz, self.p[2]) * (1 - h * h)
        grads = [x.T @ dh + decay * self.p[0], dh.sum(axis=0), h.T @ dz + decay * self.p[2], np.array([dz.sum()])]
        self.t += 1
        for i, g in enumerate(grads):
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.999 * self.v[i] + 0.001 * g * g
            self.p[i] = self.p[i] - rate * (self.m[i] / (1 - 0.9**self.t)) / (np.sqrt(self.v[i] / (1 - 0.999**self.t)) + 1e-8)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.3) -> float:
    """Least ratio of unlabelled to positive shares above a score, over thresholds that keep ``least`` of the positives.

    Both shares are taken at one standard error towards a larger ratio, so that few rows don't pull the minimum down.
    """
    cuts = np.quantile(positive, np.linspace(0, 1 - least, 60))
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    p = np.array([(positive >= c).mean() for c in cuts])
    u = u + np.sqrt(u * (1 - u) / len(unlabelled))
    p = np.maximum(p - np.sqrt(p * (1 - p) / len(positive)), 1e-9)
    return float(np.clip((u / p).min(), 0.05, 0.98))


def _membership(positive: np.ndarray, unlabelled: np.ndarray, steps: int, batch: int, r: np.random.Generator) -> Network:
    """Scorer of positives against unlabelled rows (logistic loss)."""
    net = Network(positive.shape[1], hidden=8)
    for _ in range(steps):
        x = np.concatenate([positive[r.integers(0, len(positive), batch)], unlabelled[r.integers(0, len(unlabelled), batch)]])
        net.step(x, (_sigmoid(net.raw(x)) - np.repeat([1.0, 0.0], batch)) / len(x), 0.01, 1e-3)
    return net


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, batch: int = 512, seed: int = 11):
    """(network, prior): the prior from scorers applied to rows they were not fitted on, then the non-negative risk under it."""
    r = np.random.default_rng(seed)
    steps = min(800, 100 + len(positive) // 4)
    p_half, u_half = r.permutation(len(positive)) % 2 == 0, r.permutation(len(unlabelled)) % 2 == 0
    guesses = []
    for side in (True, False):
        a, b, c, d = positive[p_half == side], unlabelled[u_half == side], positive[p_half != side], unlabelled[u_half != side]
        if min(map(len, (a, b, c, d))):
            first = _membership(a, b, steps // 2, batch, r)
            guesses.append(estimate_prior(first.raw(c), first.raw(d)))
    prior = float(np.mean(guesses)) if guesses else 0.5
    net = Network(positive.shape[1], seed=seed)
    for _ in range(steps):
        p, u = positive[r.integers(0, len(positive), batch)], unlabelled[r.integers(0, len(unlabelled), batch)]
        sp, su = _sigmoid(net.raw(p)), _sigmoid(net.raw(u))
        # sigmoid loss: l(z, +1) = s(-z), l(z, -1) = s(z)
        dp, du = sp * (1 - sp), su * (1 - su)
        if su.mean() - prior * sp.mean() >= 0:
            dz = np.concatenate([-2 * prior * dp, du]) / batch
        else:
            dz = np.concatenate([prior * dp, -du]) / batch
        net.step(np.concatenate([p, u]), dz, 0.01, 1e-3)
    return net, prior


class QualityModel:
    def __init__(self, scaler: Scaler | None, net: Network | None, prior: float):
        self.scaler, self.net, self.prior = scaler, net, prior

    def score(self, texts: list[str]) -> np.ndarray:
        if self.net is None or not texts:
            return np.full(len(texts), 0.5)
        x = np.array([features(t) for t in texts], float).reshape(-1, N_FEATURES)
        return _sigmoid(self.net.raw(self.scaler.apply(x)))


def _extract(rows: DataFrame) -> np.ndarray:
    def run(frames):
        import pandas as pd

        for pdf in frames:
            yield pd.DataFrame({"x": [features(t) for t in pdf["text"]]})

    got = rows.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "x array<double>").toPandas()
    x = np.stack(got["x"].to_numpy()) if len(got) else np.zeros((0, N_FEATURES))
    return x[np.lexsort(x.T)] if len(x) else x


def fit(docs: DataFrame, labels: DataFrame, held_mod: int = 4, held_at: int = 2, rows: int = ROWS) -> QualityModel:
    positive = _extract(labelled_sample(docs, labels.where("quality = 1"), "quality", held_mod, held_at, rows))
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id", F.lit("web")), "doc_id").limit(rows)
    unlabelled = _extract(texts_of(docs, ids))
    if not len(positive) or not len(unlabelled):
        return QualityModel(None, None, 0.5)
    scaler = Scaler().fit(positive)
    net, prior = fit_pu(scaler.apply(positive), scaler.apply(unlabelled))
    return QualityModel(scaler, net, prior)


def score_documents(docs: DataFrame, model: QualityModel, keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """Every row with its score; ``keep`` names the columns that stay beside it (default doc_id)."""
    return score_texts(docs, model, keep or ["doc_id"], out)
