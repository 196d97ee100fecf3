"""Language identification by compression: per-language zstandard raw-content dictionaries.

A language's dictionary is a bounded, hash-chosen sample of its training texts (``docs`` rows of at most ``chars``
characters each). A text is cut into blocks; every block is compressed with each dictionary at a fixed level, and its opening
of ``LEAD`` bytes once more in two other phases, because whole bytes are too coarse a measure of a few words. The language with
the smallest total wins. Texts and dictionaries are first brought to lower-case letters and spaces. The score is the winner's
share of a soft-min over sizes; a text whose margin to the runner-up is under ``margin`` of the smallest size is marked
``rejected`` while its nearest language is still given.

Defined results: null texts and texts without a letter (Unicode category L) give `und` with score 0; ties go to the language most frequent
in training, then to the first in alphabetical order; with no training rows every text is `und`; repeated rows give
repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fold, texts_of

DOCS, CHARS, BLOCK, LEAD, LEVEL, MARGIN = 120, 1500, 8192, 64, 3, 0.02
_OTHER = re.compile(r"[\W\d_]+")
_AGAIN = re.compile(r"\b(\w+)(?: \1\b)+")
SCHEMA = "doc_id long, lang_pred string, score double, margin double, rejected boolean"


def normal(text: str) -> bytes:
    """Lower case, letters and single spaces only, a word said many times running said once."""
    return _AGAIN.sub(r"\1", _OTHER.sub(" ", text.lower())).encode("utf-8", "surrogatepass")


def has_letter(text: str) -> bool:
    import regex

    return regex.search(r"\p{L}", text) is not None


class LanguageModel:
    """Raw dictionary bytes per language, most frequent language first."""

    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        self.dictionaries = dictionaries
        self._coders = None

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "_coders": None}

    def coders(self):
        if self._coders is None:
            import zstandard as zstd

            self._coders = []
            for _, raw in self.dictionaries:
                data = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(level=LEVEL)
                self._coders.append(zstd.ZstdCompressor(dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False))
        return self._coders

    def sizes(self, text: str) -> np.ndarray:
        raw = normal(text)
        lead = raw[:LEAD]
        blocks = [*(raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)), b" " + lead + b" ", lead + b"."]
        return np.array([sum(len(c.compress(b)) for b in blocks) for c in self.coders()], float)

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        if not text or not self.dictionaries or not has_letter(text):
            return "und", 0.0, 0.0, True
        s = self.sizes(text)
        k = int(s.argmin())
        rest = np.delete(s, k)
        gap = float((rest.min() - s[k]) / s[k]) if len(rest) else 1.0
        soft = np.exp(-(s - s[k]) / max(1.0, 0.02 * s[k]))
        return self.dictionaries[k][0], float(1 / soft.sum()), gap, gap < MARGIN


def fit(docs: DataFrame, held_mod: int = 5, held_at: int = 0) -> LanguageModel:
    """Learn from text and non-null lang of rows outside the held-out fold.

    The per-language choice is a top-``DOCS`` by hash; Spark limits each partition before it shuffles.
    """
    train = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), held_mod) != held_at))
    w = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = (
        train.select("lang", "doc_id", F.xxhash64("doc_id", F.lit("lang")).alias("h"))
        .withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= DOCS).select("doc_id", "lang", "rn")
    )
    # DOCS ids a language: bounded by the number of languages, so it is broadcast; texts are read in a second, narrow scan
    texts = texts_of(train, picked, ("doc_id", "lang")).select("lang", "rn", F.expr(f"substring(text, greatest(1, length(text) DIV 2 - {CHARS // 2}), {CHARS})").alias("text"))
    counts = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    chosen: dict[str, list] = {}
    for r in texts.collect():  # at most DOCS texts of CHARS characters a language
        chosen.setdefault(r["lang"], []).append((r["rn"], r["text"]))
    out = []
    for lang in sorted(chosen, key=lambda x: (-counts[x], x)):
        out.append((lang, b" ".join(normal(t) for _, t in sorted(chosen[lang]))))
    return LanguageModel(out)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            got = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
            lang, score, gap, rejected = zip(*got, strict=True) if got else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(gap, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "margin", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
