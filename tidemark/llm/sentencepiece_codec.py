"""SentencePiece models run by the ``tokenizers`` library.

The model's protobuf is read field by field; from it are rebuilt the normaliser (its character map, space removal,
dummy prefix and space marker), the piece table with its scores as a unigram or a merge model, and byte fallback.
A unit is a run of space markers with the word behind it: where no piece holds a marker behind another
character (checked when a model is loaded), cutting there changes no result, so each distinct unit is encoded once,
in multithreaded batches. Ids are the rebuilt model's. The SentencePiece library encodes each distinct unit as well, only to
verify: ``parity`` tells where it disagrees, and :func:`require_parity` raises there. (With unigram models that library sums scores
over a whole text in single precision, so pieces whose scores tie may fall otherwise there, by what stands before them.) Decoding runs the library's decoders
(space marker, byte fallback): once for every piece of the model, as texts of pieces only follow each other, and over each run
of byte pieces.

Memory: a worker's memo of units is emptied once it holds ``MEMO_BYTES``, whatever the units are.

Defined results: null text counts as empty (no ids); ids never include control pieces; any doc_id, repeated rows and
extra columns (whatever their names) pass through as they are; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: fixed values: piece types and model types of the SentencePiece model format
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MEMO_BYTES = 144 << 20  # of a worker's units
ENTRY = 200  # bytes of an entry beside its text and ids
_UNIT = re.compile(f"(?<=[^{MARK}])(?={MARK})")
_CODECS: dict[str, Codec] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _varint(b: bytes, i: int) -> tuple[int, int]:
    v = s = 0
    while True:
        c = b[i]
        i += 1
        v |= (c & 127) << s
        s += 7
        if c < 128:
            return v, i


def fields(b: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one protobuf message; length-delimited values stay bytes."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            v, i = _varint(b, i)
        elif kind == 2:
            n, i = _varint(b, i)
            v, i = b[i : i + n], i + n
        else:
            n = 8 if kind == 1 else 4
            v, i = b[i : i + n], i + n
        yield tag >> 3, v


class Model:
    """What encoding needs from a model file."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        normal: dict = {}
        for f, v in fields(data):
            if f == 1:
                piece, score, kind = "", 0.0, NORMAL
                for g, x in fields(v):
                    if g == 1:
                        piece = x.decode()
                    elif g == 2:
                        score = struct.unpack("<f", x)[0]
                    elif g == 3:
                        kind = x
                self.pieces.append((piece, score, kind))
            elif f == 2:
                trainer = dict(fields(v))
            elif f == 3:
                normal = dict(fields(v))
        self.type = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.suffix = bool(trainer.get(24, 0))
        self.charsmap = normal.get(2, b"")
        self.dummy_prefix = bool(normal.get(3, 1))
        self.trim = bool(normal.get(4, 1))
        self.escape = bool(normal.get(5, 1))
        self.unk = next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)
        self.cuttable = self.escape and not self.suffix and not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, k in self.pieces if k in (NORMAL, USER))

    def merges(self) -> list[tuple[str, str]]:
        """Pairs in merge order: by the score of what they make, then by the ids of the parts."""
        ids = {p: i for i, (p, _, k) in enumerate(self.pieces) if k in (NORMAL, USER)}
        out = []
        for p, score, k in self.pieces:
            if k != NORMAL or len(p) < 2:
                continue
            for c in range(1, len(p)):
                a, b = p[:c], p[c:]
                if a in ids and b in ids:
                    out.append((-score, ids[p], ids[a], ids[b], a, b))
        out.sort()
        return [(a, b) for *_, a, b in out]

    def tokenizer(self):
        from tokenizers import AddedToken, Tokenizer, models

        if self.type == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], unk_id=self.unk, byte_fallback=self.byte_fallback)
        else:
            vocab = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            model = models.BPE(vocab, self.merges(), unk_token=self.pieces[self.unk][0], fuse_unk=True, byte_fallback=self.byte_fallback)
        tok = Tokenizer(model)
        tok.add_tokens([AddedToken(p, normalized=False) for p, _, k in self.pieces if k == USER])
        return tok

    def normalize(self, text: str) -> str:
        if self.charsmap:
            from tokenizers.normalizers import Precompiled

            text = Precompiled(self.charsmap).normalize_str(text)
        if self.trim:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        mark = MARK if self.escape else " "
        text = text.replace(" ", mark)
        return mark + text if self.dummy_prefix else text


class Codec:
    def __init__(self, path: str, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece
        from tokenizers import decoders

        with open(path, "rb") as f:
            data = f.read()
        self.model = Model(data)
        self.tokenizer = self.model.tokenizer()
        unknown = self.model.pieces[self.model.unk][0]
        steps = [decoders.Replace(unknown, " ⁇ "), decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        self.tokenizer.decoder = decoders.Sequence([*(decoders.Replace(p, "") for p, _, k in self.model.pieces if k == CONTROL), *steps])
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.text_of = self.tokenizer.decode_batch([[i] for i in range(len(self.model.pieces))], skip_special_tokens=False)
        self.byte_ids = frozenset(i for i, (_, _, k) in enumerate(self.model.pieces) if k == BYTE)
        self.forget()

    def forget(self) -> Codec:
        self.units: dict[str, bytes] = {}
        self.unlike: set[str] = set()
        self.size = 0
        return self

    def _reference(self, unit: str) -> list[int]:
        """The SentencePiece library's ids of a unit: its own dummy prefix stands for the unit's first marker."""
        first = 1 if self.model.dummy_prefix else 0
        return self.library.encode(unit[first:].replace(MARK, " "))

    def _learn(self, units: list[str]) -> None:
        new = list(dict.fromkeys(units))
        for at in range(0, len(new), 4096):
            batch = new[at : at + 4096]
            for u, e in zip(batch, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False), strict=True):
                ids = e.ids
                if u != MARK and self._reference(u) != ids:
                    self.unlike.add(u)
                self.units[u] = raw = array("I", ids).tobytes()
                self.size += ENTRY + 2 * len(u) + len(raw)

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """(ids as little-endian unsigned 32-bit integers, whether the SentencePiece library gives the same)."""
        # emptied between batches only: what a batch needs is there when its ids are put together
        if self.size > MEMO_BYTES:
            self.units.clear()
            self.unlike.clear()
            self.size = 0
        cut = []
        for t in texts:
            x = self.model.normalize(t)
            cut.append([] if not x else _UNIT.split(x) if self.model.cuttable else [x])
        known = self.units
        missing = [u for units in cut for u in units if u not in known]
        if missing:
            self._learn(missing)
        get = known.__getitem__
        return [(b"".join(map(get, units)), not self.unlike or self.unlike.isdisjoint(units)) for units in cut]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.uint32).tolist()
        text_of = self.text_of
        if self.byte_ids.isdisjoint(ids):
            text = "".join([text_of[i] for i in ids])
        else:
            out = []
            for in_bytes, run in itertools.groupby(ids, self.byte_ids.__contains__):
                out += [self.tokenizer.decode(list(run), skip_special_tokens=False)] if in_bytes else [text_of[i] for i in run]
            text = "".join(out)
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


def codec(path: str) -> Codec:
    """One codec per worker process and model."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def require_parity(path: str, texts: list[str]) -> None:
    """Raise where the rebuilt model and the SentencePiece library give other ids for a whole text."""
    c = codec(path)
    for text, (ids, _) in zip(texts, c.encode_batch(texts), strict=True):
        want = c.library.encode(text)
        if array("I", ids).tolist() != want:
            raise ValueError(f"the rebuilt model and the library disagree on {text[:80]!r}")


def encode_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Every row with ``ids`` (array of integers) and ``parity``; columns that had these names are replaced."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("ids", "parity")]
    rows = docs.select(F.struct(*kept).alias("row"), F.coalesce(text_col, F.lit("")).alias("text"))

    def run(batches):
        import pyarrow as pa

        c = codec(path)
        for batch in batches:
            got = c.encode_batch(batch.column(1).to_pylist())
            ends = np.cumsum([0, *(len(i) // 4 for i, _ in got)])
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join([i for i, _ in got]), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array([p for _, p in got], pa.bool_())], ["row", "ids", "parity"])

    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("parity", T.BooleanType())])
    return rows.mapInArrow(run, schema).select("row.*", "ids", "parity")


def decode_documents(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Every row with ``decoded``, the text of its ids (null: empty)."""
    kept = [F.col(f"`{c}`") for c in rows.columns if c != "decoded"]
    packed = rows.select(F.struct(*kept).alias("row"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))

    def run(batches):
        import pyarrow as pa

        c = codec(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.decode(i) for i in batch.column(1).to_pylist()], pa.string())], ["row", "decoded"])

    schema = T.StructType([packed.schema["row"], T.StructField("decoded", T.StringType())])
    return packed.mapInArrow(run, schema).select("row.*", "decoded")


def codec_report(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip, parity): whole texts encoded, decoded and compared in one pass."""

    def run(batches):
        import pyarrow as pa

        c = codec(path)
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                for doc_id, t, (ids, parity) in zip(part.column(0).to_pylist(), texts, c.encode_batch(texts), strict=True):
                    rows.append((doc_id, len(ids) // 4, zlib.crc32(ids), c.decode(np.frombuffer(ids, "<u4")) == t, parity))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types, strict=True)], ["doc_id", "n_tokens", "ids_crc32", "round_trip", "parity"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean, parity boolean"
    )
