"""Fingerprints, SimHash components, audio alignment: against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import AWKWARD, awkward, empty
from tidemark.llm import audio, fingerprint, simhash
from tidemark.llm.components import connected_components


def slow_simhash(text):
    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\n", b" ").replace(b"\r", b" ").replace(b"\t", b" ").split(b" ") if w]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def check(rows, got):
    prints = [slow_simhash(t) for _, t in rows]
    root = slow_components(prints)
    least = {r: min([d for (d, _), x in zip(rows, root, strict=True) if x == r and d is not None], default=None) for r in set(root)}
    want = sorted(((d, f"{p:016x}", least[r]) for (d, _), p, r in zip(rows, prints, root, strict=True)), key=repr)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=repr) == want


def test_simhash_awkward(spark):
    check([(d, t) for d, t, _ in AWKWARD], simhash.near_duplicates(awkward(spark)).collect())
    assert not simhash.near_duplicates(empty(spark)).count()


def test_simhash_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    check([(r["doc_id"], r["text"]) for r in docs.collect()], simhash.near_duplicates(docs).collect())


@pytest.mark.parametrize("seed", range(3))
def test_trie_links_dense_clusters(seed):
    r = np.random.default_rng(seed)
    base = r.integers(0, 2**64, 6, dtype=np.uint64)
    noise = [np.bitwise_xor.reduce(np.uint64(1) << r.integers(0, 64, (300, k)).astype(np.uint64), axis=1) for k in (1, 2, 3, 4)]
    v = np.unique(np.concatenate([base, *(r.choice(base, 300) ^ n for n in noise)]))
    a, b = simhash.trie_links(v, np.zeros(len(v), int), 63, 4)
    assert (np.bitwise_count(v[a] ^ v[b]) <= 4).all() and len(a) < len(v)
    forest = simhash._Forest(len(v))
    forest.link(a, b)
    want = simhash._Forest(len(v))
    i, j = np.triu_indices(len(v), 1)
    near = np.bitwise_count(v[i] ^ v[j]) <= 4
    want.link(i[near], j[near])
    assert (forest.root == want.root).all()


@pytest.mark.parametrize("hot", [5, 60])
def test_large_groups_are_dealt_again(spark, hot):
    r = np.random.default_rng(9)
    base = r.integers(0, 2**63, 3)
    low = [int(x) for b in base for x in {int(b) ^ int(n) for n in (np.int64(1) << r.integers(0, 20, 150)) ^ (np.int64(1) << r.integers(0, 60, 150)) ^ (np.int64(1) << r.integers(0, 60, 150))}]
    fps = sorted(set(low))
    nodes = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "node long, fp long")
    got = [(x["u"], x["v"]) for x in simhash.links(nodes, 4, hot).collect()]
    v = np.array(fps, np.int64).view(np.uint64)
    i, j = np.triu_indices(len(v), 1)
    near = np.bitwise_count(v[i] ^ v[j]) <= 4
    want, have = simhash._Forest(len(v)), simhash._Forest(len(v))
    want.link(i[near], j[near])
    a, b = np.array(got).T
    assert (np.bitwise_count(v[a] ^ v[b]) <= 4).all()
    have.link(a, b)
    assert (have.root == want.root).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 102), (102, 101)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 104)}, **{i: 200 for i in range(200, 230)}}


def test_fingerprint_is_a_homomorphism():
    a, b, c = "one two three four", "a second paragraph of words", "third"
    whole = fingerprint.vector(f"{a}\n{b}\n{c}")
    assert fingerprint.to_hex(whole) == fingerprint.to_hex(fingerprint.vector(f"{c}\n\n  {a}\n{b} "))
    built = fingerprint.insert(fingerprint.insert(fingerprint.vector(c), fingerprint.vector(a)), fingerprint.vector(b))
    assert fingerprint.to_hex(built) == fingerprint.to_hex(whole)
    assert fingerprint.to_hex(fingerprint.delete(whole, fingerprint.vector(b))) == fingerprint.to_hex(fingerprint.vector(f"{a}\n{c}"))


def test_fingerprint_slices_long_paragraphs(monkeypatch):
    text = "".join(chr(97 + i * 7 % 26) for i in range(3_000_000))
    lanes = fingerprint._windows(np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64))
    assert (fingerprint.vector(text)[1] == lanes.astype(np.uint32)).all()


@pytest.mark.parametrize("bucket_rows", [1, 3, 1000])
def test_edited_likeness(spark, bucket_rows):
    got = fingerprint.edited_likeness(awkward(spark), bucket_rows).collect()
    rows = sorted(AWKWARD, key=lambda x: (x[0] is None, -(x[0] or 0)))
    want = []
    for i, (d, t, _) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        want.append((d, len(t), hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest(), fingerprint.to_hex(fingerprint.vector(t))))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert not fingerprint.edited_likeness(empty(spark)).count()


def test_likeness_separates_edits_from_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = fingerprint.edited_likeness(docs).where("n_chars > 400").collect()
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.85


def slow_likeness(a, b):
    """Cosine of the counts of all windows of all paragraphs."""
    from collections import Counter

    def windows(t):
        out = Counter()
        for p in filter(None, (x.strip() for x in t.split("\n"))):
            out.update(p[i : i + fingerprint.GRAM] for i in range(len(p)))
        return out

    x, y = windows(a), windows(b)
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return sum(v * y[k] for k, v in x.items()) / norm if norm else float(x == y)


def test_likeness_of_long_repetitive_texts():
    f = fingerprint.vector
    assert fingerprint.likeness(f("a" * 32_770), f("a" * 32_790)) > 0.999
    assert fingerprint.likeness(f("ab" * 50_000), f("ab" * 90_000)) > 0.999
    assert fingerprint.likeness(f("ab" * 50_000), f("xy" * 50_000)) < 0.2


def test_likeness_equals_brute_force_within_its_error(spark):
    rows = fingerprint.edited_likeness(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    after = {d: order[(i + 1) % len(order)] for i, d in enumerate(order)}
    off = []
    for r in rows:
        mine, following = texts[r["doc_id"]], texts[after[r["doc_id"]]]
        off.append(r["near_next"] - slow_likeness(mine, following))
        off.append(r["near_edited"] - slow_likeness(mine, fingerprint.edited(mine, following)))
    assert np.sqrt(np.mean(np.square(off))) < 0.08 and np.max(np.abs(off)) < 0.35


def tone(notes, rate=audio.RATE):
    t = np.arange(rate // 4) / rate
    wave = np.concatenate([np.sin(2 * np.pi * 220 * 2 ** (n / 12) * t) for n in notes])
    return (128 + 100 * wave).astype(np.uint8).tobytes()


def slow_align(a, b):
    """(votes, offset) by counting, for every offset, the distinct integers that agree."""
    found = {}
    for i, x in enumerate(a.tolist()):
        for j, y in enumerate(b.tolist()):
            if x == y:
                found.setdefault(i - j, set()).add(x)
    votes = max(map(len, found.values()), default=0)
    return votes, min((o for o, v in found.items() if len(v) == votes), key=lambda o: (abs(o), o), default=0)


def slow_run(a, b, offset):
    """(bit error, length) of the stretch of least summed excess error, over all stretches."""
    wrong = {j: bin(int(a[j + offset]) ^ int(b[j])).count("1") / 32 for j in range(len(b)) if 0 <= j + offset < len(a)}
    js, best = sorted(wrong), (1e-12, 1.0, 0)
    for x in range(len(js)):
        gain = 0.0
        for y in range(x, len(js)):
            gain += audio.EXPECTED - wrong[js[y]]
            if gain > best[0] + 1e-12:
                best = (gain, sum(wrong[js[k]] for k in range(x, y + 1)) / (y + 1 - x), y + 1 - x)
    return best[1:]


@pytest.mark.parametrize("seed", range(4))
def test_audio_votes_and_runs_equal_brute_force(seed):
    r = np.random.default_rng(seed)
    a, b = r.integers(0, 5, 60).astype(np.uint32), r.integers(0, 9, 45).astype(np.uint32)
    a[20:35] = r.integers(0, 2**32, 15)
    b[5:20] = a[20:35] ^ (np.uint32(1) << r.integers(0, 32, 15).astype(np.uint32)) * (r.random(15) < 0.4)
    offset, votes, error, run, steps = audio.align(a, b)
    assert (votes, offset) == slow_align(a, b)
    want = slow_run(a, b, offset)
    assert error == pytest.approx(want[0]) and run == want[1]
    agree = {j for j in range(len(b)) if 0 <= j + offset < len(a) and a[j + offset] == b[j]}
    assert steps == sum(j + 1 in agree and b[j] != b[j + 1] for j in agree)


def test_audio_alignment(spark):
    r = np.random.default_rng(3)
    song, other = r.integers(0, 24, 40).tolist(), r.integers(0, 24, 40).tolist()
    a, b, c = tone(song), tone(song[8:]), tone(other)
    quiet = bytes([128]) * 40_000
    # 500 and 600 share only a passage of two long recordings, off the frame grid; silence joins nothing
    d, e = quiet + tone(other[:20])[:40_000], tone(song[:6])[77:] + tone(other[:20])[:40_000] + quiet
    rows = [(100, a), (2, b), (300, c), (400, a), (500, d), (6, e), (700, b""), (8, None), (900, quiet), (10, quiet + b"x"), (None, c), (100, a)]
    docs = spark.createDataFrame([(i, x, 1, [2]) for i, x in rows], "doc_id long, pcm binary, votes int, prints array<int>")
    got = audio.align_recordings(docs).collect()
    links = {(x["doc_id"], x["ref_id"]) for x in got}
    assert sum(x["doc_id"] == 100 for x in got) == 2 * len({k for k in links if k[0] == 100})
    assert {(100, 2), (400, 2), (500, 6)} <= links and not any(900 in k and None not in k for k in links)
    one = next(x for x in got if (x["doc_id"], x["ref_id"]) == (100, 2))
    assert abs(one["offset"] - 8 * (audio.RATE // 4) / audio.HOP) <= 1 and one["bit_error"] < 0.1 and one["votes"] >= 20 and one["members"] == 3 and one["class_id"] == 100
    assert next(x for x in got if x["doc_id"] == 700)["members"] == 2 and (700, None) in links
    # against all pairs
    prints = {i: audio.fingerprint(x or b"") for i, x in rows}
    classes = {i: audio.print_hash(prints[i], x or b"") for i, x in rows}
    for i, x in dict(rows).items():
        if i is not None and i % 100 == 0:
            for j, y in prints.items():
                if j is not None and classes[j] != classes[i]:
                    want = audio.matches(*audio.best_phase(audio.phases_of(x or b""), y)[1:5])
                    least = min(k for k in prints if k is not None and classes[k] == classes[j])
                    assert want == ((i, least) in links), (i, j)
    assert not audio.align_recordings(docs.limit(0)).count()


def test_audio_search_on_documents_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    every = audio.align_recordings(audio.text_recordings(docs), held=audio.HELD)
    got = {(r["doc_id"], r["ref_id"], r["offset"], r["votes"]) for r in every.where("ref_id IS NOT NULL").collect()}
    rows = {r["doc_id"]: audio.rendered((r["text"] or "").encode(), audio.HELD) for r in docs.collect()}
    prints, least = {}, {}
    for d in sorted(rows):
        prints[d] = audio.fingerprint(rows[d])
        least.setdefault(audio.print_hash(prints[d], rows[d]), d)
    assert np.mean([len(p) >= audio.LEAST_RUN for p in prints.values()]) > 0.75 and all(len(p) for d, p in prints.items() if rows[d])
    want = set()
    for q in (d for d in rows if d % 100 == 0):
        phases = audio.phases_of(rows[q])
        for k, d in least.items():
            if k != audio.print_hash(prints[q], rows[q]):
                found = audio.best_phase(phases, prints[d])
                if audio.matches(*found[1:5]):
                    want.add((q, d, found[0], found[1]))
    assert got == want and len(want) >= 3


def test_short_recordings_are_classes_by_their_samples(spark):
    rows = [(100, b"ab"), (2, b"ab"), (3, b"ac"), (4, b""), (5, None), (200, bytes(range(256)) * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, pcm binary")
    got = {r["doc_id"]: r for r in audio.fingerprint_recordings(docs, query="true").collect()}
    assert [len(got[k]["prints"]) for k in (100, 2, 3, 4, 5, 200)] == [1, 1, 1, 0, 0, 1]
    assert got[100]["print_hash"] == got[2]["print_hash"] != got[3]["print_hash"] and got[4]["print_hash"] == got[5]["print_hash"] != got[3]["print_hash"]
    members = {r["doc_id"]: (r["members"], r["class_id"], r["ref_id"]) for r in audio.align_recordings(docs).collect()}
    assert members == {100: (2, 2, None), 200: (1, 200, None)}


@pytest.mark.parametrize(("noise", "held", "length"), [(0, 1, 6000), (1, 1, 6000), (2, 1, 6000), (0, 8, 1200), (1, 8, 1200)])
def test_audio_recall_of_planted_passages(noise, held, length):
    """Passages off the frame grid, with noise of up to so many levels on every sample; the rule of neighbouring steps against the plainer one."""
    r = np.random.default_rng(1)
    import pyarrow.parquet as pq

    texts = [x.encode() for x in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist() if x and len(x) > 9000]

    def sound(x):
        wave = np.frombuffer(audio.rendered(x, held), np.uint8).astype(int)
        return np.clip(wave + r.integers(-noise, noise + 1, len(wave)), 0, 255).astype(np.uint8).tobytes()

    plain, found, wrong = [], [], []
    for _ in range(40):
        i, j, k = r.choice(len(texts), 3, replace=False)
        at = int(r.integers(0, len(texts[i]) - length))
        host = sound(texts[j][: int(r.integers(100, 5000))] + texts[i][at : at + length] + texts[k][: int(r.integers(0, 3000))])
        phases, prints = audio.phases_of(audio.rendered(texts[i], held)), audio.fingerprint(host)
        found.append(audio.matches(*audio.best_phase(phases, prints)[1:5]))
        plain.append(any(v >= audio.VOTES and run >= audio.LEAST_RUN and error <= audio.MAX_ERROR for _, v, error, run, _ in (audio.align(p, prints) for p in phases)))
        wrong.append(audio.matches(*audio.best_phase(phases, audio.fingerprint(audio.rendered(texts[k], held)))[1:5]))
    print(noise, held, np.mean(found), np.mean(plain), np.mean(wrong))
    assert np.mean(found) >= 0.9 and sum(found) >= 0.9 * sum(plain) and np.mean(wrong) <= 0.05


def test_audio_links_are_counted_on_one_row_a_query_whatever_the_blocks(spark, monkeypatch):
    """Near copies: each of twelve queries, four of them equal, matches all the others. Rows are as many as queries, and no link is lost."""
    r = np.random.default_rng(5)
    song = tone(r.integers(0, 24, 40).tolist())
    near = [tone(r.integers(0, 24, 2 + k).tolist()) + song for k in range(9)]
    rows = [(100 * k, near[min(k, 8)]) for k in range(12)] + [(k + 1, near[k]) for k in range(9)] + [(50, tone(r.integers(0, 24, 40).tolist())), (1200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, pcm binary")
    pairs = {}
    for x in audio.align_recordings(docs).collect():
        pairs.setdefault(x["doc_id"], []).append(x)
    for held in (audio.QUERY_INTS, 500):
        monkeypatch.setattr(audio, "QUERY_INTS", held)
        got = audio.count_links(docs).collect()
        assert len(got) == 13 == len(pairs)
        for x in got:
            mine = [y for y in pairs[x["doc_id"]] if y["votes"] is not None]
            assert (x["links"], x["linked"]) == (len(mine), sum(y["ref_members"] for y in mine))
            if mine:
                best = min(mine, key=lambda y: (-y["votes"], y["bit_error"], y["ref_id"]))
                assert all(x[c] == best[c] for c in ("ref_id", "ref_members", "offset", "votes", "bit_error", "run", "phase"))
            else:
                assert x["doc_id"] == 1200 and x["links_hash"] == 0 and x["ref_id"] is None
        assert sum(x["links"] for x in got if x["doc_id"] < 1200) == sum(y["votes"] is not None for x in pairs.values() for y in x) >= 12 * 8
        assert len({x["links_hash"] for x in got if x["doc_id"] in (800, 900, 1000, 1100)}) == 1


def test_audio_search_moves_a_class_once_a_block(spark, monkeypatch):
    """What is dealt follows recordings and blocks, not the pairs that match: ten times the near copies, ten times the rows."""
    def dealt(n):
        docs = spark.createDataFrame([(100 * k, [[k, 1, 2, 3, 4, 5, 6, 7, 8]] * 4, [k, 1, 2, 3, 4, 5, 6, 7, 8]) for k in range(n)], "id long, phases array<array<int>>, prints array<int>")
        classes = docs.selectExpr("string(id) AS print_hash", "id AS class_id", "1L AS members", "prints", "9L AS n")
        return audio._dealt(classes, docs.selectExpr("string(id) AS print_hash", "phases", "36L AS n"))

    monkeypatch.setattr(audio, "QUERY_INTS", 400)
    few, many = dealt(10), dealt(100)
    assert few.count() == 10 * 4 + 10 * 1  # a query goes to four slices, a class to one block
    assert many.count() == 100 * 4 + 100 * 9  # to nine blocks
    cells = many.groupBy("cell").agg({"side": "min"}).collect()
    assert len(cells) == 36 and all(x["min(side)"] == 0 for x in cells)
