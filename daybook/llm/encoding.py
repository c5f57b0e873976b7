"""Token ids of a batch of texts, each distinct piece encoded once.

Where the tokenizer's own file has the rules ``BY_PIECES`` (normaliser, cutting,
no dropout), a text's ids are its pieces' ids in a row.  A batch is then cut where
these rules surely cut, the distinct chunks are looked up or given to the
tokenizers library, and the ids are gathered with numpy.  Texts with a special
token's string, and any other tokenizer, go to the library whole.  All ways give
exactly the library's ids.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from daybook.llm.common import remembered
from daybook.llm.words import Words, split_words, text_buffer

#: Chunks that a worker remembers, and the bytes of a chunk that it remembers at most.
MEMORY, LONGEST = 400_000, 64

#: Rules (fixed values of such a file) that drop white space, lower the case and cut
#: contractions, runs of letters, single numbers and runs of anything else.
BY_PIECES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
#: Kinds of bytes: white space, letters, figures, apostrophe, other marks; the rest is
#: left uncut (controls and most of what lies beyond ASCII).
_BLANK, _LETTER, _FIGURE, _APOSTROPHE, _MARK, _OTHER = range(6)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _MARK
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _BLANK
_KIND[48:58] = _FIGURE
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[39] = _APOSTROPHE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Whether the rules cut between two kinds in any case.
_CUT = np.zeros((6, 6), bool)
_CUT[_LETTER, [_FIGURE, _APOSTROPHE, _MARK]] = _CUT[_FIGURE, [_LETTER, _FIGURE, _APOSTROPHE, _MARK]] = True
_CUT[_MARK, [_LETTER, _FIGURE]] = True
_CUT[_BLANK] = True
_CUT[:, _BLANK] = True
_CUT[_BLANK, _BLANK] = False


def chunks(texts: pa.Array) -> Words:
    """The texts cut where ``BY_PIECES`` cuts them for certain, in lower case as
    far as ASCII goes."""
    buf, off = text_buffer(texts)
    if len(buf) == 0:
        return split_words(texts)
    buf = _LOWER[buf]
    kind = _KIND[buf]
    lead = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7))  # Latin-1's letters
    kind[lead] = kind[lead + 1] = _LETTER
    cut = _CUT[kind[:-1], kind[1:]]
    edge = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(buf))]
    cut[edge - 1] = True
    at = np.concatenate([np.zeros(1, np.int64), np.flatnonzero(cut) + 1])
    end = np.append(at[1:], len(buf))
    black = kind[at] != _BLANK
    at, end = at[black], end[black]
    return Words(buf, at, end, np.searchsorted(at, off))


def same_words(w: Words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words ``i`` and ``j`` have the same bytes, pair by pair."""
    same = (w.end[i] - w.start[i]) == (w.end[j] - w.start[j])
    padded = np.concatenate([w.buf, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    which = np.flatnonzero(same & (i != j))
    left, a, b = (w.end[i] - w.start[i])[which], w.start[i][which], w.start[j][which]
    for far in np.flatnonzero(left > 64):
        same[which[far]] = (w.buf[a[far]:a[far] + left[far]] == w.buf[b[far]:b[far] + left[far]]).all()
    near = left <= 64
    which, left, a, b = which[near], left[near], a[near], b[near]
    while len(which):
        short = np.uint64(8) * np.minimum(8 - np.minimum(left, 8), 7).astype(np.uint64)
        differ = ((eight[a] ^ eight[b]) & (np.uint64(0xFFFFFFFFFFFFFFFF) >> short)) != 0
        same[which[differ]] = False
        more = (left > 8) & ~differ
        which, left, a, b = which[more], left[more] - 8, a[more] + 8, b[more] + 8
    return same


def word_codes(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """A code for each word, equal for equal words only, and the first word of
    each code.  Words meet by hash and are then compared byte by byte."""
    if len(w) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.asarray(pa.array(w.hashes()).dictionary_encode().indices).astype(np.int64)
    first = np.zeros(codes.max() + 1, np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    if not same_words(w, np.arange(len(codes)), first[codes]).all():  # two words of one hash
        raw, seen = w.buf.tobytes(), {}
        codes = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(w.start.tolist(), w.end.tolist(), strict=True)])
        first = np.zeros(len(seen), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return codes, first


def by_pieces(tokenizer: str) -> bool:
    """Whether a tokenizer file has the rules ``BY_PIECES``."""
    with open(tokenizer, encoding="utf-8") as f:
        rules = json.load(f)
    model = rules["model"]
    return (all(rules.get(k) == v for k, v in BY_PIECES.items()) and model["type"] == "BPE" and not model.get("dropout")
            and all(t["special"] and not t["normalized"] and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                    for t in rules.get("added_tokens", [])))


def id_type(tokenizer: str, end_id: int) -> str:
    """The narrowest little-endian unsigned type for a tokenizer's ids and ``end_id``."""
    from tokenizers import Tokenizer

    most = max([end_id, *Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values()])
    return "<u2" if most < 1 << 16 else "<u4"


class Encoder:
    """Ids of texts by one tokenizer file, as arrays of ``dtype``."""

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.dtype, self.by_pieces = Tokenizer.from_file(path), dtype, by_pieces(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}

    def library(self, texts: list[str]) -> list[bytes]:
        """Each text's ids by the tokenizers library."""
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _new(self, chunks: list[str]) -> list[bytes]:
        """Each chunk's ids: all go to the library as one text, parted by blanks."""
        begin = np.cumsum([0, *(len(x) + 1 for x in chunks)])
        got = self.tokenizer.encode(" ".join(chunks), add_special_tokens=False)
        ids = np.array(got.ids, self.dtype)
        cut = np.searchsorted(np.array(got.offsets, np.int64).reshape(-1, 2)[:, 0], begin).tolist()
        return [ids[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]

    def _of_chunks(self, chunks: list[bytes]) -> list[bytes]:
        if len(self.known) > MEMORY:
            self.known.clear()
        got = [self.known.get(x) for x in chunks]
        new = [i for i, x in enumerate(got) if x is None]
        for i, ids in zip(new, self._new([chunks[i].decode() for i in new]), strict=True):
            got[i] = ids
            if len(chunks[i]) <= LONGEST:
                self.known[chunks[i]] = ids
        return got

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        w = chunks(texts)
        codes, first = word_codes(w)
        raw = w.buf.tobytes()
        got = self._of_chunks([raw[a:b] for a, b in zip(w.start[first].tolist(), w.end[first].tolist(), strict=True)])
        flat = np.frombuffer(b"".join(got), self.dtype)
        n = np.array([len(x) // flat.itemsize for x in got], np.int64)
        begin = np.cumsum(n) - n
        each = n[codes]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(each)])
        out = np.empty(ends[-1], self.dtype)
        for a in range(0, len(codes), 1 << 18):  # bounds the index arrays
            b = min(len(codes), a + (1 << 18))
            shift = np.repeat(begin[codes[a:b]] - ends[a:b], each[a:b])
            out[ends[a]:ends[b]] = flat[shift + np.arange(ends[a], ends[b])]
        return out, ends[w.ptr]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (one more at the end)."""
        whole = np.ones(len(texts), bool)
        if self.by_pieces:
            whole[:] = False
            for s in self.special:
                whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
            if not whole.any():
                return self._pieces(texts)
        got = iter(self.library(texts.filter(pa.array(whole)).to_pylist()))
        ids, ptr = self._pieces(texts.filter(pa.array(~whole)))
        rest = iter(zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True))
        parts = [np.frombuffer(next(got), self.dtype) if x else ids[slice(*next(rest))] for x in whole]
        return np.concatenate([np.zeros(0, self.dtype), *parts]), np.cumsum([0, *map(len, parts)])


def encoder(path: str, dtype: str) -> Encoder:
    """The worker's encoder for a tokenizer file (``map_arrow(memory='tokenizers')`` keeps it)."""
    known = remembered("tokenizers")
    if (path, dtype) not in known:
        known[path, dtype] = Encoder(path, dtype)
    return known[path, dtype]
