"""Words of a batch of texts as numpy arrays, without a Python object per word.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r, which
in UTF-8 is the same as a run of such characters.
"""

from __future__ import annotations

import hashlib
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Case and punctuation of ASCII folded: letters to lower case, digits and bytes
#: beyond ASCII kept, everything else parts words.  For other texts see ``folded``.
FOLD = np.zeros(256, np.uint8)
FOLD[128:] = np.arange(128, 256)
FOLD[48:58] = np.arange(48, 58)
FOLD[97:123] = FOLD[65:91] = np.arange(97, 123)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Two odd bases for hashes of word sequences.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's final step: spreads every bit of a 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """``start[i]:end[i]`` is word i in ``buf``; text t has words ``ptr[t]:ptr[t+1]``."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    ptr: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        size = self.end - self.start
        h = mix(size.astype(np.uint64) * _GOLD)
        padded = np.concatenate([self.buf, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        left, at, which = size, self.start, np.arange(len(size))
        far = np.flatnonzero(size > 64)
        if len(far):
            keep = size <= 64
            left, at, which = left[keep], at[keep], which[keep]
        while len(which):
            x = eight[at]
            short = np.uint64(8) * np.minimum(8 - np.minimum(left, 8), 7).astype(np.uint64)
            x = x & (np.uint64(0xFFFFFFFFFFFFFFFF) >> short)
            h[which] = mix((h[which] + _GOLD) ^ x)
            more = left > 8
            left, at, which = left[more] - 8, at[more] + 8, which[more]
        for i in far:
            d = hashlib.blake2b(self.buf[self.start[i]:self.end[i]].tobytes(), digest_size=8).digest()
            h[i] = np.frombuffer(d, "<u8")[0]
        return h


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each begins (one more at the end)."""
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = 8 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else 4
    off = np.frombuffer(texts.buffers()[1], f"<i{width}")[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return buf, off - off[0]


#: Beyond ASCII, in this order: characters without width go, line and sentence
#: ends become ASCII ones, other punctuation, symbols and blanks part words, and
#: in scripts written without blanks each letter, with its marks, is a word.
_BEYOND = (
    (r"[\x{AD}\x{200C}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{2069}\x{FEFF}]+", ""),
    (r"[\x{85}\x{2028}\x{2029}]", "\n"),
    (r"[\x{2026}\x{3002}\x{FF01}\x{FF0E}\x{FF1A}\x{FF1B}\x{FF1F}\x{FF61}]", ". "),
    (r"[^\x00-\x7F\pL\pM\pN]+", " "),
    (r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]\pM*)", r" \1 "),
)


def folded(texts: pa.Array) -> pa.Array:
    """The texts with case and punctuation beyond ASCII folded (canonical caseless
    form), for ``split_words(..., FOLD)``; ASCII texts as they are."""
    if not (text_buffer(texts)[0] & 0x80).any():
        return texts
    out = pa.array([t if t is None or t.isascii() else unicodedata.normalize("NFC", unicodedata.normalize("NFD", t).casefold())
                    for t in texts.to_pylist()], pa.large_string())
    for pattern, by in _BEYOND:
        out = pc.replace_substring_regex(out, pattern, by)
    return out


def split_words(texts: pa.Array, table: np.ndarray | None = None) -> Words:
    """``table``: a byte for each byte, 0 where words part (plain white space
    otherwise), for instance to lower-case and to part at punctuation."""
    buf, off = text_buffer(texts)
    if table is not None:
        buf = table[buf]
    black = buf != 0 if table is not None else ~_SPACE[buf]
    first, last = black.copy(), black.copy()
    first[1:] &= ~black[:-1]
    last[:-1] &= ~black[1:]
    cut = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(buf))]
    first[cut] = black[cut]
    last[cut - 1] = black[cut - 1]
    start = np.flatnonzero(first)
    return Words(buf, start, np.flatnonzero(last) + 1, np.searchsorted(start, off))


def rolling(h: np.ndarray, k: int, base: int = BASES[0]) -> np.ndarray:
    """Karp-Rabin hash of each run of ``k`` values: position i has the run that
    begins there; built by doubling, so log(k) passes."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    n = len(h) - k + 1
    power, span, piece = pow(base, 1, 1 << 64), 1, h
    out, done, bits = None, 0, k
    while True:
        if bits & 1:
            part = piece[done:done + n]
            out = part.copy() if out is None else out * np.uint64(power) + part
            done += span
        bits >>= 1
        if not bits:
            return mix(out ^ np.uint64(k))
        piece = piece[:len(piece) - span] * np.uint64(power) + piece[span:]
        power, span = pow(power, 2, 1 << 64), span * 2


def in_one_text(w: Words, k: int) -> np.ndarray:
    """Which runs of ``k`` words stay in one text."""
    n = max(0, len(w) - k + 1)
    ok = np.ones(n, bool)
    for cut in w.ptr[1:-1]:
        ok[max(0, cut - k + 1):cut] = False
    return ok


def span_hashes(h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each run ``h[lo:hi]``, from prefix sums."""
    out = []
    for base in BASES:
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(h), base, np.uint64)]))
        inverse = np.cumprod(np.concatenate(
            [np.ones(1, np.uint64), np.full(len(h), pow(base, -1, 1 << 64), np.uint64)]))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:-1])])
        out.append(mix((sums[hi] - sums[lo]) * inverse[lo] ^ mix((hi - lo).astype(np.uint64))))
    return out[0], out[1]
