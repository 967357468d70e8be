"""Word segmentation over a lattice of dictionary words (T1).

Each run of letters and digits is cut into the words of a dictionary with
frequencies whose costs, 1000 * ln(all / frequency) rounded, add up to the least; a
letter that no word covers costs ``UNKNOWN`` more than the rarest word could, and
letters of that kind that follow one another are one word. Of equally cheap paths to
a place, the one with the longer last word is taken.

The dictionary is a trie of flat arrays: its edges are sorted numbers (node, letter),
the place of an edge is the node that it leads to. A batch's distinct runs are laid
end to end; all places look up their next letter together, then all runs go on by one
letter together. Steps in Python grow with the longest run of a batch, not with its
text. A closure carries the arrays, some 20 bytes a node: the dictionary is one that
fits a task (``MAX_WORDS``), whatever the texts are.

Defined results: a null text gives null, a text without runs an empty array; words of
the dictionary that are empty, null, beyond ``MAX_LENGTH`` letters or of a frequency
below 1 do not count; a word that is listed more than once counts with the sum.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A run of letters and digits, the opposite of functions.text.WORD_SEPARATOR.
RUN = r"[\p{L}\p{N}]+"
# What a letter outside all words costs beyond a word that occurs once.
UNKNOWN = 5000
# A dictionary of more words is refused: it would not fit the tasks' closures.
MAX_WORDS = 2_000_000
# Code points of distinct runs that are searched together (a longer run goes alone).
LETTERS_AT_ONCE = 1 << 16
# Distinct runs that are Python strings at a time.
RUNS_AT_ONCE = 1 << 14
# Rows of a batch that are put together at a time.
ROWS_AT_ONCE = 1 << 11
# Bits that a letter takes of an edge, and that a word's length and the mark of an
# unknown letter take of a path's rank.
_LETTER_BITS, _LENGTH_BITS = 21, 17
# Longer words do not count.
MAX_LENGTH = (1 << _LENGTH_BITS - 1) - 1


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


class Lattice:
    """The dictionary's trie, and the cheapest paths of runs through it."""

    def __init__(self, words: Iterable[tuple[str, int]]) -> None:
        counts: Counter[str] = Counter()
        for word, n in words:
            if word and len(word) <= MAX_LENGTH and n is not None and n > 0:
                counts[word] += int(n)
        if len(counts) > MAX_WORDS:
            raise ValueError(f"a dictionary of {len(counts)} words is beyond {MAX_WORDS}")
        total = counts.total()
        self.unknown = math.floor(1000 * math.log(max(total, 1)) + 0.5) + UNKNOWN
        listed = list(counts)
        lengths = np.array([len(w) for w in listed], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)))
        letters = _letters("".join(listed))
        costs = [math.floor(1000 * math.log(total / counts[w]) + 0.5) for w in listed]
        self.longest = int(lengths.max(initial=0))
        # Level by level: a node is the place of its edge among the sorted edges, plus
        # one. Nodes of a level are numbered after those before, so all edges are sorted.
        edges, node, made = [], np.zeros(len(listed), np.int64), 0
        left = np.arange(len(listed))
        for depth in range(self.longest):
            left = left[lengths[left] > depth]
            level, at = np.unique(node[left] << _LETTER_BITS | letters[starts[left] + depth], return_inverse=True)
            node[left] = made + 1 + at
            made += len(level)
            edges.append(level)
        self.edges = np.concatenate([*edges, np.zeros(0, np.int64)])
        self.cost = np.full(made + 1, -1, np.int64)
        self.cost[node] = costs

    def _words(self, letters: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(starts, length, costs) of the dictionary's words in the letters; ``ends``
        says for each letter where its run ends."""
        at, node = np.arange(len(letters)), np.zeros(len(letters), np.int64)
        for length in range(1, self.longest + 1):
            inside = at + length <= ends[at]
            at, node = at[inside], node[inside]
            edge = node << _LETTER_BITS | letters[at + length - 1]
            place = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            met = self.edges[place] == edge
            at, node = at[met], place[met] + 1
            word = self.cost[node] >= 0
            yield at[word], length, self.cost[node[word]]

    def segment(self, runs: list[str]) -> list[list[str]]:
        """The words of each (not empty) run."""
        out: list[list[str]] = []
        part: list[str] = []
        size = 0
        for run in runs:
            if part and size + len(run) > LETTERS_AT_ONCE:
                out += self._segment(part)
                part, size = [], 0
            part.append(run)
            size += len(run)
        return out + self._segment(part) if part else out

    def _segment(self, runs: list[str]) -> list[list[str]]:
        text = "".join(runs)
        sizes = np.array([len(r) for r in runs], np.int64)
        begins = np.cumsum(sizes) - sizes
        letters, first = _letters(text), np.repeat(begins, sizes)
        found = list(self._words(letters, np.repeat(begins + sizes, sizes)))
        everywhere = np.arange(len(text))
        start = np.concatenate([everywhere, *(s for s, _, _ in found)])
        length = np.concatenate([np.ones(len(text), np.int64), *(np.full(len(s), n, np.int64) for s, n, _ in found)])
        # A cost, then the longer word, then words before unknown letters, as one number.
        rank = np.concatenate([np.full(len(text), self.unknown, np.int64), *(c for _, _, c in found)]) << _LENGTH_BITS
        rank += (MAX_LENGTH - length << 1) + (np.arange(len(start)) < len(text))
        # Places between letters, each run with one more than it has letters. All words
        # that end at the same distance from their run's beginning are one step.
        run_of = np.repeat(np.arange(len(runs)), sizes)
        source = start + run_of[start]
        target = source + length
        step = start + length - first[start]
        order = np.argsort(step, kind="stable")
        source, target, rank, step = source[order], target[order], rank[order], step[order]
        cuts = np.searchsorted(step, np.arange(1, int(sizes.max()) + 2))
        least = np.full(len(text) + len(runs), np.iinfo(np.int64).max, np.int64)
        paid = np.zeros(len(least), np.int64)
        for a, b in zip(cuts, cuts[1:]):
            to = target[a:b]
            np.minimum.at(least, to, paid[source[a:b]] + rank[a:b])
            paid[to] = least[to] >> _LENGTH_BITS << _LENGTH_BITS
        # Back from all ends together; a place is kept if a word ends there.
        back = MAX_LENGTH - (least >> 1 & MAX_LENGTH)
        kept = np.zeros(len(least), bool)
        begin = begins + np.arange(len(runs))
        at, floor = begin + sizes, begin
        while len(at):
            kept[at] = True
            at = at - back[at]
            on = at > floor
            at, floor = at[on], floor[on]
        places = np.flatnonzero(kept)
        unknown = (least[places] & 1).astype(bool)
        run = np.searchsorted(begin, places, side="right") - 1
        joined = unknown[:-1] & unknown[1:] & (run[:-1] == run[1:])
        whole = ~np.concatenate([joined, [False]])
        run = run[whole]
        ends = places[whole] - run
        out: list[list[str]] = [[] for _ in runs]
        last = 0
        for r, end in zip(run.tolist(), ends.tolist()):
            out[r].append(text[last:end])
            last = end
        return out


def lattice_segmenter(dictionary: Iterable[tuple[str, int]]):
    """A segmenter (text column -> array of words) for ``keywords.keywords`` out of
    (word, frequency) pairs."""
    lattice = Lattice(dictionary)

    def some(batch: pa.Array) -> pa.Array:
        # Only distinct runs become Python strings, some at a time; rows are put together
        # out of their words by places.
        coded = batch.flatten().dictionary_encode()
        kind = pa.list_(pa.string())
        parts = [pa.array(lattice.segment(coded.dictionary.slice(at, RUNS_AT_ONCE).to_pylist()), kind) for at in range(0, len(coded.dictionary), RUNS_AT_ONCE)]
        words = pa.concat_arrays([pa.array([], kind), *parts]).take(coded.indices)
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64))))
        runs = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64))))
        return pa.ListArray.from_arrays(pa.array(ends[runs], pa.int32()), words.flatten(), mask=batch.is_null())

    def cut(batch: pa.Array) -> pa.Array:
        none = pa.array([], pa.list_(pa.string()))
        return pa.concat_arrays([none, *(some(batch.slice(at, ROWS_AT_ONCE)) for at in range(0, len(batch), ROWS_AT_ONCE))])

    # Named types: annotations of this module are strings.
    cut.__annotations__ = {"batch": pa.Array, "return": pa.Array}
    cut_runs = F.arrow_udf(cut, "array<string>")

    def segmenter(text: Column) -> Column:
        return cut_runs(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)))

    return segmenter


def count_dictionary(texts: DataFrame, col: str, min_len: int, max_len: int, size: int) -> list[tuple[str, int]]:
    """The ``size`` most frequent runs of ``min_len`` to ``max_len`` letters, ties by
    the word: a dictionary for texts like these. The one result is drawn to the driver,
    so ``size`` is at most MAX_WORDS."""
    if size > MAX_WORDS:
        raise ValueError(f"at most {MAX_WORDS} words")
    words = texts.select(F.explode(F.regexp_extract_all(F.col(col), F.lit(RUN), F.lit(0))).alias("word"))
    counts = words.where(F.length("word").between(min_len, max_len)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [(r["word"], r["n"]) for r in counts.orderBy(F.desc("n"), "word").limit(size).collect()]
