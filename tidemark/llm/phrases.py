"""Phrase collocation mining over a weighted de Bruijn graph of words.

Nodes are runs of four words, edges runs of five; a piece's edges overlap in four words. Every word of a piece sends the
longest gram that begins there: an edge, or near the piece's end the shorter rest (the piece-end correction). Summed
weights give all shorter counts without counting them in the text again: what flows out of a node plus the pieces that
end there is the node's own count, and so on down to two words. A phrase whose whole count flows on through one edge
(a unary path) is compacted into the longer phrase.

No phrase is more frequent than a part of it, so a piece is cut where a word, two neighbours or three cannot reach
``min_count``. Which ones can is told by bitmaps of fixed size (``BITS``), broadcast whatever the corpus' size; pairs and
triples are counted by hashes of ``HASH_BITS`` bits for that. A false yes costs work and changes nothing, as every count
that is returned comes from the summed weights or the word counts, keyed by the words themselves.

Words are what lies between spaces and tabs of a piece, pieces between ``.,;:!?`` and line breaks (0A-0D); A-Z are
lower-cased. Everything is counted by lang.

Defined results: null lang: ``und``; null and empty texts, and texts without words, add nothing; repeated rows count each
time; ids are not read; an empty table gives no rows; other columns are ignored. Ties in score go to the more frequent
phrase, then to the smaller one in UTF-8 byte order. Texts are read whole, in chunks that end between words.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

ORDER = 5  # words of an edge
BITS = 1 << 25  # of a bitmap: 4 MB
HASH_BITS = 40  # of the hashes under which pairs and triples are counted: a count is never too small
SLICE = 256  # rows whose texts a task holds as Python bytes at a time
CHUNK = 1 << 20  # bytes of text cut into words at a time
WORDS = 500_000  # distinct words a task holds before it sends them on
GRAMS = 1_000_000  # positions a task holds before it sends their sums on
HELD = 500_000  # grams a task holds before it sums them up, and twice as many as it keeps
SPLITS = 8  # of the table that one task reads when edges are laid: they repeat from split to split and are summed before they move
SALTS = 16
ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + ENDS + b"\t", bytes(range(97, 123)) + b"\n" * len(ENDS) + b" ")
_GAP = re.compile(rb"[ \n]")


def _texts(batches) -> Iterator[tuple[str, bytes]]:
    """(lang, texts joined by piece ends): lower-cased, every piece end a line feed, every gap spaces."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            by = defaultdict(list)
            part = batch.slice(at, SLICE)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                by[lang].append(text)
            for lang, texts in by.items():
                yield lang, b"\n".join(texts).translate(_TABLE)


def _chunks(blob: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(blob):
        stop = at + CHUNK
        gap = _GAP.search(blob, stop) if stop < len(blob) else None
        stop = gap.start() if gap else len(blob)
        yield blob[at:stop]
        at = stop


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of every word."""

    def run(batches):
        import pyarrow as pa

        seen: dict[str, Counter] = defaultdict(Counter)

        def send():
            for lang, found in seen.items():
                n = len(found)
                word = pa.array(list(found), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), word, pa.array(list(found.values()), pa.int64())], ["lang", "word", "f"])
            seen.clear()

        for lang, blob in _texts(batches):
            for chunk in _chunks(blob):
                seen[lang].update(chunk.split())
                if sum(map(len, seen.values())) > WORDS:
                    yield from send()
        yield from send()

    return _read(docs).mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def bitmap(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bit for each 64-bit ``h``; at most ``bits / 64`` numbers reach the driver."""
    at = F.col("h").bitwiseAND(F.lit(bits - 1))
    words = hashes.select(F.shiftright(at, 6).alias("word"), F.expr("shiftleft(1L, CAST(h & 63 AS INT))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bit").to_numpy().view(np.uint64)
    return out


def _among(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(bits) * 64 - 1)
    return ((bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two word hashes in their order."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(31))) & np.uint64((1 << HASH_BITS) - 1)


class _Codes(dict):
    """Words of one lang as a task's own numbers; 0 where a piece is cut, -1 between two spaces."""

    def __init__(self, lang: str, vocabulary: _Vocabulary):
        import xxhash

        super().__init__({b"": -1, b"\n": 0})
        self.vocabulary, self.lang, self.digest = vocabulary, lang, xxhash.xxh64_intdigest
        self.seed = self.digest(lang.encode(), 42)  # what xxhash64(lang, word) gives

    def __missing__(self, word: bytes) -> int:
        h = self.digest(word, self.seed)
        v = self.vocabulary
        at = h & v.mask
        if v.bits[at >> 6] >> (at & 63) & 1:
            self[word] = code = v.add(self.lang, word, h)
            return code
        v.rare += 1
        if v.rare > WORDS:
            v.forget()
        self[word] = 0
        return 0


class _Vocabulary:
    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits.tolist(), len(bits) * 64 - 1
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, _Codes] = {}
        self.rare = 0
        self.langs, self.words, self.hashes = [None], [None], [0]

    def add(self, lang: str, word: bytes, h: int) -> int:
        self.langs.append(lang)
        self.words.append(word)
        self.hashes.append(h)
        return len(self.words) - 1

    def forget(self) -> None:
        """Drop the words that are not frequent: they need no number."""
        for codes in self.codes.values():
            for w in [w for w, c in codes.items() if not c and w != b"\n"]:
                del codes[w]
        self.rare = 0

    def full(self) -> bool:
        return len(self.words) > WORDS

    def read(self, lang: str, blob: bytes) -> np.ndarray:
        if lang not in self.codes:
            self.codes[lang] = _Codes(lang, self)
        code, out = self.codes[lang].__getitem__, [np.zeros(1, np.int32)]
        for chunk in _chunks(blob):
            tokens = chunk.replace(b"\n", b" \n ").split(b" ")
            out.append(np.fromiter(map(code, tokens), np.int32, len(tokens)))
        found = np.concatenate([*out, np.zeros(1, np.int32)])
        return found[found >= 0]

    def grams(self, codes: np.ndarray, *often: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per gram of two words, and of one word more for each bitmap: (where it stands, its hash).

        A longer gram stands where the bitmap of its length less one has both of its parts.
        """
        at, h = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0)), np.array(self.hashes, np.uint64)
        found = [(at, _pair_hash(h[codes[at]], h[codes[at + 1]]))]
        for n, bits in enumerate(often, 2):
            ok = np.zeros(len(codes) + 1, bool)
            yes = _among(bits, found[-1][1])
            ok[at[yes]] = True
            both = yes & ok[at + 1]
            found.append((at[both], _pair_hash(found[-1][1][both], h[codes[at[both] + n]])))
            at = found[-1][0]
        return found


def gram_counts(docs: DataFrame, words: np.ndarray, *often: np.ndarray) -> DataFrame:
    """(h, f): how often pairs of maybe frequent words occur, by the pair's hash; with the bitmap of pairs, triples."""
    shared = docs.sparkSession.sparkContext.broadcast((words, *often))

    def run(batches):
        import pyarrow as pa

        words, *often = shared.value
        vocabulary, held, n = _Vocabulary(words), [], 0

        def send():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["h", "f"])

        for lang, blob in _texts(batches):
            found = vocabulary.grams(vocabulary.read(lang, blob), *often)[-1][1]
            held.append(found)
            n += len(found)
            if n > GRAMS:
                yield send()
                held, n = [], 0
            if vocabulary.full():
                vocabulary.clear()
        if n:
            yield send()

    return _read(docs).mapInArrow(run, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))


def edges(docs: DataFrame, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray) -> DataFrame:
    """(lang, w1 .. w5, f): summed weights of the longest gram at every word; of two words at least, null behind its end.

    A row with ``w5`` is an edge; the others are the piece-end corrections.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, pairs, triples))
    names = [f"w{i}" for i in range(1, ORDER + 1)]

    def run(batches):
        import pyarrow as pa

        words, pairs, triples = shared.value
        vocabulary, held, n = _Vocabulary(words), [], 0

        def summed():
            keys = [np.concatenate([x[i] for x in held]) for i in range(3)]  # two words each, the last one
            weight = np.concatenate([x[3] for x in held])
            order = np.lexsort(keys[::-1])
            keys = [k[order] for k in keys]
            at = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
            return *(k[at] for k in keys), np.add.reduceat(weight[order], at)

        def send():
            a, b, c, weight = summed()
            known = pa.array(vocabulary.words, pa.binary()).cast(pa.string())
            cut = (1 << 32) - 1
            columns = [a >> 32, a & cut, b >> 32, b & cut, c]
            for lo in range(0, len(a), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(vocabulary.langs, pa.string()).take(pa.array(columns[0][lo : lo + 50_000]))]
                    + [known.take(pa.array(c[lo : lo + 50_000])) for c in columns] + [pa.array(weight[lo : lo + 50_000])],
                    ["lang", *names, "f"],
                )

        for lang, blob in _texts(batches):
            codes = vocabulary.read(lang, blob)
            (two, h2), (three, h3) = vocabulary.grams(codes, pairs)
            at = two[_among(pairs, h2)]
            runs = np.zeros(len(codes) + ORDER, bool)  # where three words go on
            runs[three[_among(triples, h3)]] = True
            wide = np.concatenate([codes, np.zeros(ORDER, np.int32)]).astype(np.int64)
            gram, on = [wide[at], wide[at + 1]], np.ones(len(at), bool)
            for i in range(2, ORDER):
                on = on & runs[at + i - 2]
                gram.append(np.where(on, wide[at + i], 0))
            held.append((gram[0] << 32 | gram[1], gram[2] << 32 | gram[3], gram[4], np.ones(len(at), np.int64)))
            n += len(at)
            if n > HELD:
                held = [summed()]
                n = len(held[0][0])
            if n and (2 * n > HELD and len(held) == 1 or vocabulary.full()):
                yield from send()
                held, n = [], 0
            if vocabulary.full():
                vocabulary.clear()
        if n:
            yield from send()

    schema = ", ".join(f"{c} string" for c in ("lang", *names)) + ", f long"
    rows = _read(docs)
    return rows.coalesce(max(1, rows.rdd.getNumPartitions() // SPLITS)).mapInArrow(run, schema).groupBy("lang", *names).agg(F.sum("f").alias("f"))


def phrase_counts(graph: DataFrame, min_count: int) -> DataFrame:
    """(lang, phrase, k, f) of every phrase of two words or more with a count of ``min_count``, from the graph's weights."""
    names = [f"w{i}" for i in range(1, ORDER + 1)]
    level, out = graph.where(F.col(names[-1]).isNotNull()), []
    for k in range(ORDER, 1, -1):
        if k < ORDER:
            # flow out of the node over all edges, and the pieces that end in it
            ends = graph.where(F.col(names[k]).isNull() & F.col(names[k - 1]).isNotNull())
            flow = level.select("lang", *names[:k], "f").union(ends.select("lang", *names[:k], "f"))
            level = materialize(flow.groupBy("lang", *names[:k]).agg(F.sum("f").alias("f")), f"nodes{k}")
        out.append(level.where(F.col("f") >= min_count).select("lang", F.concat_ws(" ", *names[:k]).alias("phrase"), F.lit(k).alias("k"), "f"))
    found = out[0]
    for x in out[1:]:
        found = found.union(x)
    return found


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's ``top`` phrases of two to five words."""
    words = materialize(word_counts(docs), "words")
    frequent = words.where(F.col("f") >= min_count)
    in_words = bitmap(frequent.select(F.xxhash64("lang", "word").alias("h")))
    often = lambda grams: bitmap(grams.where(F.col("f") >= min_count).select("h"))
    in_pairs = often(gram_counts(docs, in_words))
    in_triples = often(gram_counts(docs, in_words, in_pairs))
    graph = materialize(edges(docs, in_words, in_pairs, in_triples), "edges")
    counts = materialize(phrase_counts(graph, min_count).union(frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), "f")), "counts")
    phrases = counts.where("k > 1")
    # unary paths: all occurrences go on through one longer phrase
    w = F.split("phrase", " ")
    inner = phrases.where("k > 2").select("lang", F.explode(F.array(F.array_join(F.slice(w, 1, F.col("k") - 1), " "), F.array_join(F.slice(w, 2, F.col("k") - 1), " "))).alias("phrase"), "f")
    through = inner.groupBy("lang", "phrase").agg(F.max("f").alias("through"))
    kept = phrases.join(through, ["lang", "phrase"], "left").where("through IS NULL OR through < f").select("lang", "phrase", "k", F.col("f").alias("a"))
    # every cut; parts that many phrases share are spread over salts
    cut = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"))
    cut = cut.withColumns({"left": F.array_join(F.slice(w, 1, F.col("cut")), " "), "right": F.array_join(F.slice(w, F.col("cut") + 1, F.col("k") - F.col("cut")), " ")})
    part = counts.select("lang", "phrase", "f", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    for side, count in (("left", "l"), ("right", "r")):
        cut = cut.join(part.select("lang", F.col("phrase").alias(side), F.col("f").alias(count), "salt"), ["lang", side, "salt"])
    total = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    scored = cut.join(total, "lang").select("lang", "phrase", "a", "cut", "l", "r", "n", (exact["a"] * exact["n"] * 1000).alias("_over"), (exact["l"] * exact["r"]).alias("_under"))
    lowest = (
        scored.withColumn("score", F.expr("_over div _under")).groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("low")).select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each salt first, so that a lang's last sort holds SALTS * top rows at most
    some = lowest.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top).drop("rank", "salt")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
