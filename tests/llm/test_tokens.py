"""SentencePiece codec, packing, token files."""

import functools
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, awkward, empty
from tidemark.llm import packing, sentencepiece_codec, token_orc
from tidemark.llm.token_encoder import TokenEncoder, default_path

TEXTS = [t or "" for _, t, _ in AWKWARD] + ["a  b", " lead", "trail ", "x's it'll ' '", "a\n \n b\n\nc", "<|endoftext|> x", "don't   stop", "\xa0 nbsp\xa0x", "é. È! ß?", "a.b,c; d:", "..."]


@functools.cache
def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


@pytest.fixture(scope="module")
def library():
    t = _library()
    return lambda x: t.encode(x, add_special_tokens=False).ids


def test_encoder_equals_the_library(library):
    for memo, chunk in ((None, None), (1500, None), (None, 40), (0, 8)):
        enc = TokenEncoder(default_path(), memo, chunk)
        for x in TEXTS * 2:
            assert enc.encode_text(x) == library(x), (x, memo, chunk)


def test_encoder_on_whole_columns(library):
    import pyarrow as pa

    texts = TEXTS * 3
    for chunk in (8, 200, 1 << 20):
        at = 0
        for first, ids, counts in TokenEncoder(default_path(), chunk=chunk).encode(pa.array(texts)):
            assert first == at
            for n in counts.tolist():
                assert ids[:n].tolist() == library(texts[at])
                ids, at = ids[n:], at + 1
        assert at == len(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\x0b\x1c\x85\xa0\u2003ab'sé日1.,!|<>_") | st.characters(exclude_categories=["Cs"]), max_size=30), max_size=4), st.sampled_from([4, 30, 1 << 20]))
def test_encoder_on_any_text(texts, chunk):
    import pyarrow as pa

    lib = _library()
    got = [i for _, ids, _ in TokenEncoder(default_path(), 4000, chunk).encode(pa.array(texts, pa.string())) for i in ids.tolist()]
    assert got == [i for t in texts for i in lib.encode(t, add_special_tokens=False).ids]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\n'sé1_^`~") | st.sampled_from("abÉñ.,!*&$#%'\"-"), max_size=40), max_size=4), st.sampled_from([4, 30, 1 << 20]))
def test_encoder_on_lines_and_marks(texts, chunk):
    test_encoder_on_any_text.hypothesis.inner_test(texts, chunk)


def test_line_breaks_and_marks_are_cut_once(library, monkeypatch):
    """Op8: a word, line break, word or a word with any ASCII marks is not searched for pre-tokens by itself."""
    import pyarrow as pa

    enc, searched = TokenEncoder(default_path()), []
    findall = enc.model.findall
    monkeypatch.setattr(enc.model, "findall", lambda text: searched.append(text) or findall(text))
    words = [a + b for a in "abcdefghij" for b in "klmnopqrst"]
    texts = [" ".join(f"{x}.\n{y.title()}{mark} {y}{mark}" for x, y in zip(words, words[k:] + words[:k], strict=True)) for k, mark in enumerate(["***", "&&&", ".%", "'"])]
    (_, ids, counts), = enc.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in library(t)] and counts.tolist() == [len(library(t)) for t in texts]
    assert len(searched) <= len(texts), searched[:9]  # the first words alone


def test_memo_of_many_words_is_bounded_in_bytes(library):
    enc = TokenEncoder(default_path(), 40_000)
    letters = "abcdefghijklmnopqrst"
    for k in letters:
        text = " ".join(k + a + b + "y" * (len(letters) * letters.index(a) // 4) for a in letters for b in letters)
        assert enc.encode_text(text) == library(text)
        assert enc.pieces.size <= 20_000 and max(map(len, enc.pieces), default=0) <= 64


def test_memo_is_bounded_in_bytes():
    enc = TokenEncoder(default_path(), 100_000)
    for k in range(40):
        enc.encode_text(" ".join([f"w{k}x{j}" + "y" * (j % 90) for j in range(200)]))
        assert enc.pieces.size <= 50_000 and max(map(len, enc.pieces), default=0) <= 64


def test_sentencepiece_parity_and_round_trip():
    import sentencepiece

    path = sentencepiece_codec.default_path()
    codec, lib = sentencepiece_codec.Codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for x, (ids, parity) in zip(TEXTS, codec.encode_batch(TEXTS), strict=True):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == lib.encode(x), x
        assert codec.decode(ids) == x
        assert parity


def field(n, v):
    """One protobuf field: a small integer or bytes."""
    if isinstance(v, int):
        return bytes([n << 3, v])
    v = v if isinstance(v, bytes) else v.encode()
    size, out = len(v), bytearray()
    while True:
        out.append(size & 127 | (128 if size > 127 else 0))
        size >>= 7
        if not size:
            return bytes([n << 3 | 2, *out]) + v


def test_unigram_model_of_32000_pieces(tmp_path):
    import math
    import struct

    import sentencepiece

    with open(sentencepiece_codec.default_path(), "rb") as f:
        merge = sentencepiece_codec.Model(f.read())
    # the given pieces as a unigram model: scores fall with the rank, so that whole words win
    rows = [(p, -math.log(i + 2.5) - 3 if k == sentencepiece_codec.NORMAL else 0.0, k) for i, (p, _, k) in enumerate(merge.pieces)]
    data = b"".join(field(1, field(1, p) + bytes([2 << 3 | 5]) + struct.pack("<f", x) + field(3, k)) for p, x, k in rows)
    data += field(2, field(3, sentencepiece_codec.UNIGRAM) + bytes([0x98, 0x02, 1])) + field(3, field(3, 1) + field(4, 0) + field(5, 1))
    path = tmp_path / "unigram.model"
    path.write_bytes(data)
    codec, lib = sentencepiece_codec.Codec(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    assert codec.model.type == sentencepiece_codec.UNIGRAM and codec.model.byte_fallback and codec.model.cuttable
    import pyarrow.parquet as pq

    # words of letters: the library's single-precision sums decide exact ties, such as ** * and * **, by what stands before them
    words = dict.fromkeys(x for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist() for x in (t or "").split() if x.isalpha())
    texts = [*TEXTS, *list(words)[:6000]]
    for x, (ids, parity) in zip(texts, codec.encode_batch(texts), strict=True):
        ids = np.frombuffer(ids, "<u4").tolist()
        same = parity and ids == lib.encode(x) and codec.decode(ids) == lib.decode(ids) == x
        assert same, x[:100]
    sentencepiece_codec.require_parity(str(path), texts)


def test_parity_fails_loudly(monkeypatch):
    path = sentencepiece_codec.default_path()
    texts = ["one two", "three"]
    sentencepiece_codec.require_parity(path, texts)
    c = sentencepiece_codec.codec(path)
    monkeypatch.setattr(c, "library", type("Other", (), {"encode": staticmethod(lambda t: [5])})())
    assert [p for _, p in c.forget().encode_batch(texts)] == [False, False]
    with pytest.raises(ValueError):
        sentencepiece_codec.require_parity(path, texts)
    monkeypatch.undo()
    c.forget()


def test_unit_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "MEMO_BYTES", 20_000)
    c = sentencepiece_codec.Codec(sentencepiece_codec.default_path())
    for k in range(20):
        (ids, ok), = c.encode_batch([" ".join(f"w{k}x{j}" for j in range(50))])
        assert ok and c.size < 60_000 and c.decode(np.frombuffer(ids, "<u4")).startswith(f"w{k}x0")


def test_unigram_models_are_rebuilt():
    import struct

    def piece(p, score, kind=1):
        return field(1, field(1, p) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + field(3, kind))

    data = b"".join([piece("<unk>", 0, 2), piece("▁a", -1), piece("b", -2), piece("▁ab", -2.5), piece("c", -3), piece("▁", -4)]) + field(2, field(3, 1)) + field(3, field(3, 1) + field(4, 1) + field(5, 1))
    m = sentencepiece_codec.Model(data)
    assert m.type == sentencepiece_codec.UNIGRAM and m.cuttable and m.normalize("  a   b ") == "▁a▁b"
    assert m.tokenizer().encode("▁abc", add_special_tokens=False).ids == [3, 4]


def test_codec_report_and_interface(spark):
    path = sentencepiece_codec.default_path()
    got = sentencepiece_codec.codec_report(awkward(spark), path).collect()
    assert len(got) == len(AWKWARD) and all(r["round_trip"] and r["parity"] for r in got)
    docs = awkward(spark).withColumn("_text", F.lit("mine")).withColumn("row", F.lit(3)).withColumn("parity", F.lit("x"))
    rows = sentencepiece_codec.encode_documents(docs, path)
    assert {(r["_text"], r["row"]) for r in rows.collect()} == {("mine", 3)}
    back = sentencepiece_codec.decode_documents(rows, path).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    assert not sentencepiece_codec.codec_report(empty(spark), path).count()


def check_pieces(docs, pieces, library, room=2048):
    want = defaultdict(list)
    for d, t, *_ in docs:
        want[d].append([*library(t or ""), 1])
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_seq[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]].append(p)
    for spans in by_seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at and n > 0
            at += n
        assert at <= room
    for d, lists in want.items():
        if len(lists) > 1:
            continue  # repeated ids: checked by their number of tokens below
        at = 0
        for p in sorted(by_doc[d], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(lists[0])
            assert p["ids_crc32"] == zlib.crc32(array("I", lists[0][at : at + p["length"]]).tobytes())
            at += p["length"]
        assert at == len(lists[0])
    total = sum(len(x) for lists in want.values() for x in lists)
    assert sum(p["length"] for p in pieces) == total
    return total, len(by_seq)


def test_packing_awkward(spark, library):
    check_pieces(AWKWARD, packing.pack_documents(awkward(spark), default_path()).collect(), library)
    assert not packing.pack_documents(empty(spark), default_path()).count()


def test_packing_fills_sequences(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for window in (2_000_000, 5_000):
        total, sequences = check_pieces(rows, packing.pack_documents(docs.coalesce(1), default_path(), window_tokens=window).collect(), library)
        assert sequences == -(-total // 2048)


def test_place_goes_to_the_cheapest_sequence_with_room():
    placed, left = packing.place([(0, 0, 6), (1, 0, 4), (2, 0, 4), (3, 0, 3)], 10, 2, 1.0, 0.1)
    assert not left and {(i, s) for i, _, _, s, _ in placed} == {(0, 0), (1, 1), (2, 1), (3, 0)}
    placed, left = packing.place([(0, 0, 9), (1, 0, 9), (2, 0, 4)], 10, 2, 1.0, 0.1)
    assert sum(n for _, _, n, _, _ in placed) == 20 and left == [(2, 2, 2)]


def test_place_looks_at_every_sequence():
    r = np.random.default_rng(2)
    items = [(i, 0, int(n)) for i, n in enumerate(r.integers(1, 60, 300))]
    count = sum(n for *_, n in items) // 64 + 3
    placed, left = packing.place(items, 64, count, 1.0, 0.5)
    used, cost = [0] * count, [0.0] * count
    for _, _, n, s, at in placed:
        fits = [x for x in range(count) if 64 - used[x] >= n]
        assert at == used[s] and cost[s] == min(cost[x] for x in fits)  # a cut piece fits as well: it fills what is left
        used[s], cost[s] = used[s] + n, cost[s] + n + 0.5 * n * n
    assert not left


def test_token_files(spark, library, tmp_path):
    docs = awkward(spark)
    path = str(tmp_path / "orc")
    token_orc.write_token_orc(docs, path, default_path())
    got = sorted(token_orc.positions(token_orc.read_token_orc(spark, path)).collect(), key=lambda r: r["start"])
    keyed = sorted(AWKWARD, key=lambda x: (x[0] is not None, x[0] or 0))
    at = 0
    for r, (d, t, _) in zip(got, keyed, strict=True):
        ids = [*library(t or ""), 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, at, len(ids), zlib.crc32(array("I", ids).tobytes()))
        at += len(ids)
    one = token_orc.read_token_orc(spark, path, [20])
    assert [r["doc_id"] for r in one.collect()] == [20]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,20)]" in plan or "PushedFilters: [In(doc_id, [20])]" in plan, plan
    none = str(tmp_path / "none")
    token_orc.write_token_orc(empty(spark), none, default_path())
    assert not token_orc.positions(token_orc.read_token_orc(spark, none)).count()


def test_footers_of_token_files(spark, tmp_path):
    """Integers run-length encoded (version 2), row indexes, Bloom filters on doc_id and on nothing else; ranges that do not overlap."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("a few words of text").alias("text"))
    path = tmp_path / "orc"
    token_orc.write_token_orc(docs, str(path), default_path())
    jvm = spark._jvm
    conf, orc = spark._jsc.hadoopConfiguration(), jvm.org.apache.orc.OrcFile
    ranges, columns = [], ["", *[c.split()[0] for c in token_orc.FILE_SCHEMA.split(", ")], "element"]
    files = sorted(path.glob("*.orc"))
    assert len(files) > 1
    for f in files:
        reader = orc.createReader(jvm.org.apache.hadoop.fs.Path(str(f)), orc.readerOptions(conf))
        assert reader.getRowIndexStride() == 1000
        stats = reader.getStatistics()[1]
        ranges.append((stats.getMinimum(), stats.getMaximum()))
        rows = reader.rows()
        for stripe in reader.getStripes():
            footer = rows.readStripeFooter(stripe)
            assert all(e.getKind().toString() == "DIRECT_V2" for e in list(footer.getColumnsList())[1:])
            kinds = {(columns[x.getColumn()], x.getKind().toString()) for x in footer.getStreamsList()}
            assert {c for c, k in kinds if k == "BLOOM_FILTER_UTF8"} == {"doc_id"}
            assert {c for c, k in kinds if k == "ROW_INDEX"} == set(columns)
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False)) and sum(b - a + 1 for a, b in ranges) == 30_000
