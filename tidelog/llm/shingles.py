"""Word and shingle hashes of whole texts, vectorized.

Words are runs of bytes other than white space (0x20, 0x09 to 0x0D) of the UTF-8
text with A-Z lower-cased. A word's hash is a polynomial modulo 2^64 over its
bytes, taken from running sums, then mixed with its length.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np

from .common import of_this_process

#: Bytes hashed at a time (longer only for a single word that is longer).
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Separators of tokens: every ASCII byte but letters and digits; what is beyond
#: ASCII and no letter, mark or digit is made a space before.
_NOT_TOKEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Texts of nothing but ASCII and Latin letters need no look at code points.
_BEYOND_LATIN = re.compile("[^\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\u024f]")
#: Scripts written without spaces: Thai, Lao, Myanmar, Khmer, Tai, Balinese, Javanese,
#: Han, kana, Bopomofo, Yi, Tangut, Khitan, Nushu.
_UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007),
    (0x3021, 0x3029), (0x3031, 0x303C), (0x3040, 0x30FF), (0x3105, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF),
    (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18D8F), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
)
_BREAK, _RUN, _ALONE, _MARK = range(4)

def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    held = of_this_process("powers")
    if len(held.get("of_base", ())) < n:
        for name, base in (("of_base", _BASE), ("of_inverse", _BASE_INVERSE)):
            steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            steps[0] = 1
            held[name] = np.multiply.accumulate(steps)
    return held["of_base"], held["of_inverse"]


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_chunk(data: np.ndarray, separators: np.ndarray) -> np.ndarray:
    word = ~separators[data]
    edges = np.diff(np.concatenate(([False], word, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word, in order."""
    return _hashes(text.encode("utf-8", "surrogatepass").lower(), _SPACE)


def _kinds() -> np.ndarray:
    """Of every code point: whether it breaks tokens, runs on in one, is one of its
    own (digits aside, in unspaced scripts), or is a mark on the one before."""
    held = of_this_process("code_points")
    if "kinds" not in held:
        of_category = {"L": _RUN, "N": _RUN, "M": _MARK}
        kinds = np.fromiter((of_category.get(unicodedata.category(chr(c))[0], _BREAK) for c in range(0x110000)), np.uint8, 0x110000)
        for first, last in _UNSPACED:
            part = kinds[first : last + 1]
            part[[k == _RUN and unicodedata.category(chr(first + i)) != "Nd" for i, k in enumerate(part)]] = _ALONE
        held["kinds"] = kinds
    return held["kinds"]


def _set_apart(text: str) -> str:
    """``text`` with a space for each break and before each token of its own."""
    kinds, parts, before = _kinds(), [], _BREAK
    for at in range(0, len(text), CHUNK):
        points = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = kinds[points]
        # A mark takes the kind of what it stands on.
        on = np.maximum.accumulate(np.where(kind != _MARK, np.arange(1, len(kind) + 1), 0))
        base = np.concatenate(([before], kind))[on]
        split = (kind == _ALONE) | ((kind == _RUN) & (np.concatenate(([before], base[:-1])) == _ALONE))
        spaced = np.insert(np.where(kind == _BREAK, np.uint32(32), points), np.flatnonzero(split), np.uint32(32))
        parts.append(spaced.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"))
        before = int(base[-1])
    return "".join(parts)


def token_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per token, in order: lower-case runs of letters, marks and
    digits; in scripts written without spaces each letter with its marks."""
    text = text.lower()
    if _BEYOND_LATIN.search(text):
        text = _set_apart(text)
    return _hashes(text.encode("utf-8", "surrogatepass"), _NOT_TOKEN)


def _hashes(text: bytes, separators: np.ndarray) -> np.ndarray:
    data = np.frombuffer(text, dtype=np.uint8)
    parts, at = [], 0
    while at < len(data):
        end = at + CHUNK
        while end < len(data) and not separators[data[end]]:
            ahead = np.flatnonzero(separators[data[end : end + CHUNK]])
            end += int(ahead[0]) if len(ahead) else CHUNK
        parts.append(_hash_chunk(data[at:end], separators))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words; a shorter sequence gives none."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    h = words[:count]
    for i in range(1, n):
        h = mix(h * np.uint64(0xA0761D6478BD642F) + words[i : i + count])
    return h


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct shingles; a text of fewer words has one, its whole
    sequence; a text without words has none."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words
    return np.unique(ngram_hashes(words, min(n, len(words))))
