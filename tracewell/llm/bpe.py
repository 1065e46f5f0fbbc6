"""Byte-level BPE by backtracking, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary gives, for every byte of a piece, the longest token that starts there. The encoder
walks from left to right with these tokens and accepts one only if it is *compatible* with the token before it, that is if byte-pair
merging of both strings together would leave the two tokens as they are. Where no token fits, it goes back and tries the next
shorter prefix; a position found to lead nowhere is marked, so that no work is done twice and the time stays linear.

Texts are first cut at the special tokens and by the vocabulary's own pattern, as the ``tokenizers`` library does. The results of
frequent pieces are kept in a table of bounded size.

Defined results: a null text counts as empty and has no ids; an empty text has no ids. Further columns of the input are ignored.
Rows are taken as they come: repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pattern of the vocabulary's pre-tokeniser (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer pieces are encoded anew each time; a worker keeps at most so many pieces, and as many words between spaces.
KEPT_LENGTH, KEPT_PIECES = 48, 300_000
_NEVER = 1 << 62


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes stand for themselves, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """The ids of a vocabulary file's tokens, which are in the order of the merges, and those of its special ones."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = _byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}, special


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = _byte_letters()
        size = max(max(vocab.values()), *(t["id"] for t in spec["added_tokens"]), 0) + 1
        self.tokens: list[bytes] = [b""] * size
        for word, i in vocab.items():
            self.tokens[i] = bytes(letters[c] for c in word)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for word, i in self.special.items():
            self.tokens[i] = word.encode()
        self._find_special = regex.compile("|".join(regex.escape(w) for w in sorted(self.special, key=len, reverse=True))) if self.special else None
        self._find = regex.compile(PATTERN).findall

        self._pair: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        for m in merges:
            left, right = m.split(" ") if isinstance(m, str) else m
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self._pair[a, b] = c
            self._parts.setdefault(c, (a, b))
        self._by_bytes = by_bytes = {self.tokens[i]: i for i in vocab.values()}
        self._length = [len(t) for t in self.tokens]
        self._automaton = ahocorasick.Automaton()
        for word, i in by_bytes.items():
            self._automaton.add_word(word.decode("latin-1"), i)
        self._automaton.make_automaton()
        self._shorter = [-1] * size
        for word, i in by_bytes.items():
            self._shorter[i] = next((by_bytes[word[:n]] for n in range(len(word) - 1, 0, -1) if word[:n] in by_bytes), -1)
        self._compatible: dict[int, bool] = {}
        self._kept: dict[str, tuple[bytes, str]] = {}
        self._words: dict[str, tuple[bytes, str]] = {}
        self._beside_space = regex.compile(r" \s|\s ").search
        self._blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.tokens])]).astype(np.int64)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at the left (0) or right (1) end of the token while it is merged: each part, and the token it goes into."""
        out, into = [(token, _NEVER)], token
        while (parts := self._parts.get(into)) is not None:
            out.append((parts[side], into))
            into = parts[side]
        return out

    def compatible(self, left: int, right: int) -> bool:
        """True if merging the bytes of both gives these two tokens: no merge across the seam comes before the parts are used up.

        Ids are in the order of the merges. Of equal merges the leftmost comes first, hence < on the left and <= on the right.
        """
        ends, pair = self._edge(right, 0), self._pair
        for a, a_until in self._edge(left, 1):
            for b, b_until in ends:
                m = pair.get((a, b))
                if m is not None and m < a_until and m <= b_until:
                    return False
        return True

    def piece(self, raw: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self._by_bytes.get(raw)
        if whole is not None:
            return [whole]
        n = len(raw)
        longest = [0] * n
        length, shorter, table = self._length, self._shorter, self._compatible
        for end, i in self._automaton.iter(raw.decode("latin-1")):
            longest[end - length[i] + 1] = i  # matches come by their end, so the longest is written last
        out: list[int] = []
        dead = bytearray(n + 1)
        at, now = 0, longest[0] if n else -1
        while at < n:
            end = at + length[now]
            fits = not dead[end]
            if fits and out:
                key = out[-1] << 20 | now
                fits = table.get(key)
                if fits is None:
                    if len(table) > 1_000_000:
                        table.clear()
                    fits = table[key] = self.compatible(out[-1], now)
            if fits:
                out.append(now)
                at = end
                if at < n:
                    now = longest[at]
            elif shorter[now] >= 0:
                now = shorter[now]
            else:
                dead[at] = 1
                now = out.pop()
                at -= length[now]
        return out

    def _new(self, piece: str) -> tuple[bytes, str]:
        ids = self.piece(piece.encode("utf-8", "surrogatepass"))
        got = array("I", ids).tobytes(), ",".join(map(str, ids))
        if len(piece) <= KEPT_LENGTH and len(self._kept) < KEPT_PIECES:
            self._kept[piece] = got
        return got

    def _word(self, word: str) -> tuple[bytes, str]:
        """A word with the space before it. No piece goes across a lone space, for it can only begin with one."""
        kept, new = self._kept, self._new
        parts = [kept.get(p) or new(p) for p in self._find(" " + word)]
        got = parts[0] if len(parts) == 1 else (b"".join([p[0] for p in parts]), ",".join([p[1] for p in parts]))
        if len(word) <= KEPT_LENGTH and len(self._words) < KEPT_PIECES:
            self._words[word] = got
        return got

    def _ordinary(self, text: str) -> list[tuple[bytes, str]]:
        kept, new = self._kept, self._new
        if not text or self._beside_space(text):
            return [kept.get(p) or new(p) for p in self._find(text)]
        first, *rest = text.split(" ")
        words, word = self._words, self._word
        return [kept.get(p) or new(p) for p in self._find(first)] + [words.get(w) or word(w) for w in rest]

    def pieces(self, text: str) -> list[tuple[bytes, str]]:
        """The ids of a text by piece: as little-endian 32-bit numbers, and as decimals joined by commas."""
        if not any(w in text for w in self.special):
            return self._ordinary(text)
        out, at = [], 0
        for m in self._find_special.finditer(text):
            i = self.special[m[0]]
            out += [*self._ordinary(text[at : m.start()]), (array("I", [i]).tobytes(), str(i))]
            at = m.end()
        return out + self._ordinary(text[at:])

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join([p[0] for p in self.pieces(text or "")]), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """Bytes of all ids at once, by their places in one table of bytes; what isn't UTF-8 becomes U+FFFD."""
        if not len(ids):
            return ""
        start = self._offsets[ids]
        length = self._offsets[ids.astype(np.int64) + 1] - start
        before = np.cumsum(length) - length
        where = np.repeat(start - before, length)
        where += np.arange(len(where))
        return self._blob[where].tobytes().decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each worker and vocabulary."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids = [c.encode(t).astype(np.int32) for t in part.column(1).to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))], names=[id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode_documents(ids: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of arrays of ids; a null array gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.decode(np.array(x or [], np.uint32)) for x in part.column(1).to_pylist()], pa.string())], names=[id_col, "text"])

    return ids.select(id_col, F.col(ids_col)).mapInArrow(run, f"{id_col} {ids.schema[id_col].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes each text, decodes the ids, and digests both without writing them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            n, by_ids, by_text = [], [], []
            for x in b.column(1):
                parts = c.pieces(x.as_py() or "")
                ids = np.frombuffer(b"".join([p[0] for p in parts]), "<u4")
                n.append(len(ids))
                by_ids.append(hashlib.sha256(",".join([p[1] for p in parts]).encode()).hexdigest())
                by_text.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
