"""Exact encoding of whole columns of texts with a ``tokenizers`` byte-level BPE file.

A byte-level BPE pre-tokenizer always cuts between a non-space character and a single space that precedes another
non-space character, and on both sides of a line break between two such characters. Texts are cut at those places only,
so each distinct word of a chunk of texts is encoded once by the file's model and the ids are laid out again by position:
the result equals encoding the whole text. A text is first split at the file's added tokens, whose ids are emitted as they
are, as the library does by default.

Memory is bounded in bytes whatever the words are: a chunk holds at most ``CHUNK`` bytes of text (a longer text is cut into
chunks of its own), the memo that carries words from chunk to chunk counts its bytes, takes no long words, and belongs to
one partition: nothing stays in a worker but the model.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

CHUNK = 4 << 20  # bytes of text encoded at a time
MEMO_BYTES = 48 << 20  # of both generations of a partition's memo
MEMO_WORD = 64  # longest word that a memo keeps
ENTRY = 200  # bytes of a memo's entry beside its word and ids: two objects and their slots
# two white-space characters in a row (a superset of what any pattern engine calls white space)
_WIDE = r"[\s\x0b\x1c-\x1f\x{85}\pZ]{2}"
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
# words of a pre-token of letters (Latin ones, so that every version of Unicode agrees) and one of ASCII marks behind them
_LETTERS = r"^(?P<line>\n?)(?P<core>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+)(?P<mark>[!-/:-@\[-`{-~]*)$"

_MODELS: dict[str, Model] = {}


def _byte_alphabet() -> dict[int, str]:
    """Byte (as a Latin-1 character) -> the printable character that byte-level models write for it."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every (start, length), one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def strings(values) -> list[str]:
    """An Arrow string array as a list, without a scalar for each."""
    return values.to_numpy(zero_copy_only=False).tolist()


class Model:
    """What a worker keeps of a tokenizer file: the bare model, its pattern and its added tokens."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        added = whole.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError(f"added tokens of {path} take more than their own text")
        self.added = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split
        self.tokenize = whole.model.tokenize
        self.findall = regex.compile(public_tokenizers.PATTERN).findall
        self.alphabet = _byte_alphabet()
        self.shown = np.array([ord(self.alphabet.get(b, chr(b))) for b in range(256)], "<u2")

    def piece(self, piece: str) -> bytes:
        """Ids of one pre-token."""
        if piece.isascii() and piece.isprintable():
            piece = piece.replace(" ", self.alphabet[32])
        else:
            piece = piece.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenize(piece)]).tobytes()

    def pieces_of(self, pieces: list[str]) -> list[bytes]:
        """Ids of every one of many pre-tokens without line breaks, which are put into the byte alphabet together."""
        if not pieces:
            return []
        shown = self.shown[np.frombuffer("\n".join(pieces).encode(), np.uint8)].tobytes().decode("utf-16-le").split(self.alphabet[10])
        return [array("I", [t.id for t in found]).tobytes() for found in map(self.tokenize, shown)]


class Memo(dict):
    """Pre-tokens and their ids of one partition: two generations, together at most ``limit`` bytes."""

    def __init__(self, make, limit: int | None = None):
        super().__init__()
        self.make, self.half = make, (MEMO_BYTES if limit is None else limit) // 2
        self.old: dict[str, bytes] = {}
        self.size = 0

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        self.keep(key, ids)
        return ids

    def keep(self, key: str, ids: bytes) -> None:
        if len(key) <= MEMO_WORD:
            self.size += ENTRY + len(key) + len(ids)
            if self.size > self.half:
                self.old, self.size = dict(self), ENTRY + len(key) + len(ids)
                self.clear()
            self[key] = ids

    def many(self, keys: list[str], make) -> list[bytes]:
        """Ids of distinct keys; ``make`` gets all unknown ones at once."""
        found = list(map(self.get, keys))
        lost = [i for i, ids in enumerate(found) if ids is None]
        names = [keys[i] for i in lost]
        lost_ids = list(map(self.old.get, names))
        new = [i for i, ids in enumerate(lost_ids) if ids is None]
        for i, ids in zip(new, make([names[i] for i in new]), strict=True):
            lost_ids[i] = ids
        for i, ids in zip(lost, lost_ids, strict=True):
            found[i] = ids
        size = sum(map(len, names)) + sum(map(len, lost_ids)) + ENTRY * len(names)
        if self.size + size <= self.half and max(map(len, names), default=0) <= MEMO_WORD:
            self.size += size
            self.update(zip(names, lost_ids, strict=True))
        else:
            for key, ids in zip(names, lost_ids, strict=True):
                self.keep(key, ids)
        return found


class TokenEncoder:
    """Encodes the texts of one partition."""

    def __init__(self, path: str, memo_bytes: int | None = None, chunk: int | None = None):
        if path not in _MODELS:
            _MODELS[path] = Model(path)
        self.model, self.chunk = _MODELS[path], CHUNK if chunk is None else chunk
        self.pieces = Memo(self.model.piece, memo_bytes)

    def _text(self, text: str) -> bytes:
        return b"".join([self.pieces[p] for p in self.model.findall(text)])

    def _segments(self, texts):
        """(segments, number of segments of each text or None, {segment: ids of an added token})."""
        import pyarrow as pa
        import pyarrow.compute as pc

        marked = np.zeros(len(texts), bool)
        for token in self.model.added:
            marked |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not marked.any():
            return texts, None, {}
        out, counts, fixed = [], [], {}
        for text, cut in zip(texts.to_pylist(), marked.tolist(), strict=True):
            parts = self.model.split(text) if cut else [text]
            fixed.update({len(out) + i: self.model.added[p] for i, p in enumerate(parts) if i % 2})
            out += parts
            counts.append(len(parts))
        return pa.array(out, pa.string()), np.array(counts), fixed

    def _encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each) of a string array without nulls."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        segments, per_text, fixed = self._segments(texts)
        wide = pc.match_substring_regex(segments, _WIDE).to_numpy(zero_copy_only=False)
        plain = pc.split_pattern(pc.replace_substring(segments.filter(pa.array(~wide)), "\n", " \n"), " ")
        cut = [[x[0], *(w[1:] for w in x[1:])] for x in map(_SAFE_CUT.split, segments.filter(pa.array(wide)).to_pylist())]
        words = pa.concat_arrays([plain.flatten(), pa.array([w for x in cut for w in x], pa.string())])
        counts = np.concatenate([np.diff(plain.offsets.to_numpy()).astype(np.int64), np.array([len(x) for x in cut], np.int64)])
        if wide.any():  # words back into the order of the segments
            place = np.argsort(np.concatenate([np.flatnonzero(~wide), np.flatnonzero(wide)]))
            words, counts = words.take(pa.array(ragged((np.cumsum(counts) - counts)[place], counts[place]))), counts[place]
        kinds = words.dictionary_encode()
        first = np.cumsum(counts) - counts
        heads = [fixed.get(i) or self._text(h) for i, h in enumerate(strings(words.take(pa.array(first))))]
        values, sizes = self._table(kinds.dictionary, heads)
        code = kinds.indices.to_numpy().copy()
        code[first] = len(kinds.dictionary) + np.arange(len(first))
        of_word = sizes[code]
        ids = values[ragged((np.cumsum(sizes) - sizes)[code], of_word)]
        tokens = np.add.reduceat(of_word, first)
        if per_text is not None:
            tokens = np.add.reduceat(tokens, np.cumsum(per_text) - per_text)
        return ids, tokens

    def _table(self, words, heads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of every one of ``words`` behind a space or its own line break, then of ``heads``."""
        import pyarrow as pa
        import pyarrow.compute as pc

        # a line break, letters and marks are pre-tokens of their own: each distinct one is encoded once
        parts = pc.extract_regex(words, _LETTERS)
        easy = pc.is_valid(parts)
        hard = [self._text(w if w.startswith("\n") else " " + w) for w in strings(words.filter(pc.invert(easy)))]
        parts = parts.filter(easy)
        line = pc.equal(parts.field("line"), "\n")
        core = pc.binary_join_element_wise(pc.if_else(line, "", " "), parts.field("core"), "").dictionary_encode()
        mark = parts.field("mark").dictionary_encode()
        pieces = self.pieces
        cores = pieces.many(strings(core.dictionary), self.model.pieces_of)
        table = [*cores, *[pieces[m] if m else b"" for m in strings(mark.dictionary)], *hard, *heads, b"", pieces["\n"]]
        n_core, n_mark, none = len(core.dictionary), len(mark.dictionary), len(table) - 2
        of_word = np.full((len(words) + len(heads), 3), none)
        easy = easy.to_numpy(zero_copy_only=False)
        place = np.flatnonzero(easy)
        of_word[place, 0] = none + line.to_numpy(zero_copy_only=False)
        of_word[place, 1], of_word[place, 2] = core.indices.to_numpy(), n_core + mark.indices.to_numpy()
        of_word[np.flatnonzero(~easy), 1] = n_core + n_mark + np.arange(len(hard))
        of_word[len(words) :, 1] = n_core + n_mark + len(hard) + np.arange(len(heads))
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        starts = np.cumsum(sizes) - sizes
        each = of_word.ravel()
        return np.frombuffer(b"".join(table), "<u4")[ragged(starts[each], sizes[each])], sizes[of_word].sum(axis=1)

    def _long(self, text: str) -> np.ndarray:
        """Ids of a text of more than a chunk, a chunk at a time."""
        import pyarrow as pa

        out = []
        for i, part in enumerate(self.model.split(text)):
            at = 0
            while at < len(part):
                stop = min(len(part), at + self.chunk // 4)
                while stop < len(part):  # the next place where a text may be cut
                    stop = part.find(" ", stop)
                    if stop < 0 or stop + 1 == len(part):
                        stop = len(part)
                    elif part[stop - 1].isspace() or part[stop + 1].isspace():
                        stop += 1
                    else:
                        break
                out.append(np.frombuffer(self.model.added[part], "<u4") if i % 2 else self._encode(pa.array([part[at:stop]], pa.string()))[0])
                at = stop
        return np.concatenate(out)

    def encode(self, texts) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, number of ids of each row) for runs of rows of a string array without nulls."""
        import pyarrow.compute as pc

        size = pc.binary_length(texts).to_numpy()
        at = 0
        while at < len(size):
            stop = at + max(1, int(np.searchsorted(np.cumsum(size[at : at + 10_000]), self.chunk, "right")))
            if size[at] > self.chunk:
                ids = self._long(texts[at].as_py())
                yield at, ids, np.array([len(ids)])
            else:
                yield at, *self._encode(texts.slice(at, stop - at))
            at = stop

    def encode_text(self, text: str) -> list[int]:
        import pyarrow as pa

        return [i for _, ids, _ in self.encode(pa.array([text], pa.string())) for i in ids.tolist()]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
