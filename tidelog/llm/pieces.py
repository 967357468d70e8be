"""SentencePiece encoding and decoding by unigram Viterbi.

The pieces and their log scores come from a given model file. They lie in a
double-array trie over UTF-8 bytes; the best segmentation of a text is the path
of the largest sum of scores. A character that no piece covers goes on as its
bytes (byte fallback), at the price of an unknown one. Spaces are written as the
marker U+2581, with one before the text; decoding turns them back. A U+2581 in
the text itself goes on as bytes, so decoding gives back every text exactly.

No piece holds a marker behind another character, nor a line break (checked when
the model is read), so texts fall apart into words before the search. The new words
of a batch are searched all at once: every place of every word goes down the trie in
step with the others, on numpy arrays, and the best paths to all places of one
distance from their word's start are found together. Answers are remembered, for a
bounded number of words; those not asked for lately are forgotten first.

Defined results: null text counts as empty; an empty text has no ids. Repeated
rows are encoded alike; extra columns pass through ``with_pieces``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .common import map_batches, of_this_process

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: By how much an unknown character is worse than the worst piece.
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 100_000
#: Characters of texts that are encoded together.
CHARS_AT_ONCE = 1 << 20
#: Words of more bytes are searched one by one.
LONG_WORD = 256
#: Stand-ins for a line's end and for a marker in the text itself: no word holds "\n".
LINE_END, OWN_MARK = "\n", "\n" + MARK


_SURELY = float("-inf")


@dataclass
class Trie:
    """base/check/value arrays: the child of node s by byte c is t = base[s] + c
    + 1 if check[t] == s; value[t] is a piece's id or -1."""

    base: list[int]
    check: list[int]
    value: list[int]

    @staticmethod
    def build(keys: dict[bytes, int]) -> "Trie":
        root: dict = {}
        for key, number in keys.items():
            node = root
            for byte in key:
                node = node.setdefault(byte, {})
            node[-1] = number
        size = 1 << 12
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        first_free, next_fit = 257, 0
        queue = [(0, root)]
        for at, node in queue:
            value[at] = node.get(-1, -1)
            children = sorted(c for c in node if c >= 0)
            if not children:
                base[at] = -1
                continue
            while first_free < size and check[first_free] != -1:
                first_free += 1
            # Nodes of one child fill the gaps; others go on from the last fit,
            # so that building takes linear time.
            b = first_free - children[0] - 1 if len(children) == 1 else next_fit
            while True:
                if b + 257 >= size:
                    for array, fill in ((base, 0), (check, -1), (value, -1)):
                        array.extend([fill] * size)
                    size *= 2
                if all(check[b + c + 1] == -1 for c in children):
                    break
                b += 1
            base[at] = b
            if len(children) > 1:
                next_fit = b
            for c in children:
                check[b + c + 1] = at
                queue.append((b + c + 1, node[c]))
        return Trie(base, check, value)


@dataclass
class Answers:
    """The ids of words, one after another: those of the word in row i are
    ids[starts[i] : starts[i] + counts[i]]."""

    rows: dict[str, int]
    ids: np.ndarray
    counts: np.ndarray

    @staticmethod
    def none() -> "Answers":
        return Answers({}, np.zeros(0, np.int32), np.zeros(0, np.int64))

    def taken(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of the given rows, in their order."""
        starts = np.cumsum(self.counts) - self.counts
        counts = self.counts[rows]
        before = np.cumsum(counts) - counts
        return self.ids[np.repeat(starts[rows] - before, counts) + np.arange(int(counts.sum()))], counts

    def add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.rows.update(zip(words, range(len(self.rows), len(self.rows) + len(words))))
        self.ids, self.counts = np.concatenate((self.ids, ids.astype(np.int32))), np.concatenate((self.counts, counts))


@dataclass
class Pieces:
    trie: Trie
    scores: list[float]
    texts: list[bytes]  # what a piece decodes to, markers as spaces
    byte_ids: list[int]
    unknown_score: float
    name: str
    recent: "Answers" = field(default_factory=lambda: Answers.none(), repr=False)
    older: "Answers" = field(default_factory=lambda: Answers.none(), repr=False)

    def search(self, data: bytes) -> list[int]:
        """The best path over the pieces of ``data``; of equal ones the path
        whose last piece starts first."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        n = len(data)
        best, back, piece = [_SURELY] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            so_far = best[i]
            if so_far == _SURELY:
                continue
            first = data[i]
            width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            single, node = False, 0
            for j in range(i, n):
                child = base[node] + data[j] + 1
                if base[node] < 0 or check[child] != node:
                    break
                node = child
                number = value[node]
                if number >= 0:
                    score = so_far + scores[number]
                    if score > best[j + 1]:
                        best[j + 1], back[j + 1], piece[j + 1] = score, i, number
                    single = single or j + 1 - i == width
            if not single and so_far + self.unknown_score > best[i + width]:
                best[i + width], back[i + width], piece[i + width] = so_far + self.unknown_score, i, -1
        out: list[int] = []
        while n:
            start = back[n]
            if piece[n] >= 0:
                out.append(piece[n])
            else:
                out += [self.byte_ids[b] for b in reversed(data[start:n])]
            n = start
        out.reverse()
        return out

    def edges(self, flat: np.ndarray, word_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all pieces in the words whose bytes are ``flat``,
        and with piece -1 the characters that are no piece themselves."""
        base, check, value = self._arrays()
        first = flat
        width = np.where(first < 0x80, 1, np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4)))
        single = (first & 0xC0) == 0x80  # bytes inside a character begin nothing
        starts, ends, pieces = [], [], []
        start = np.flatnonzero(~single)
        at, node = start, np.zeros(len(start), np.int64)
        while len(start):
            child = base[node] + flat[at] + 1
            known = (base[node] >= 0) & (check[child] == node)
            start, at, node = start[known], at[known] + 1, child[known]
            piece = value[node]
            hit = piece >= 0
            starts.append(start[hit])
            ends.append(at[hit])
            pieces.append(piece[hit])
            single[start[hit & (at - start == width[start])]] = True
            on = at < word_end[start]
            start, at, node = start[on], at[on], node[on]
        unknown = np.flatnonzero(~single)
        return np.concatenate([*starts, unknown]), np.concatenate([*ends, unknown + width[unknown]]), np.concatenate([*pieces, np.full(len(unknown), -1)])

    def _arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The trie as numpy arrays, made once in a process."""
        held = of_this_process("piece_arrays")
        if self.name not in held:
            held[self.name] = tuple(np.array(a, dtype=np.int64) for a in (self.trie.base, self.trie.check, self.trie.value))
        return held[self.name]

    def search_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """What ``search`` finds for each of the words, found together: all ids, one
        word after another, and how many each word has."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        start, end, piece = self.edges(flat, offsets[1:][word])
        scores = np.where(piece >= 0, np.array(self.scores)[piece], self.unknown_score)
        # A word of n bytes has n + 1 places, so places are numbered apart from bytes.
        own = word[start]
        distance = end - offsets[own]
        order = np.lexsort((start, end, distance))
        start, piece, scores, distance = start[order] + own[order], piece[order], scores[order], distance[order]
        end = end[order] + own[order]
        best = np.full(len(flat) + len(words), _SURELY)
        best[offsets[:-1] + np.arange(len(words))] = 0.0
        back, by = np.zeros(len(best), np.int64), np.full(len(best), -1, np.int64)
        bounds = np.searchsorted(distance, np.arange(1, (int(lengths.max()) if len(words) else 0) + 2))
        for low, high in zip(bounds, bounds[1:]):
            if low == high:
                continue
            to = end[low:high]
            first = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
            so_far = best[start[low:high]] + scores[low:high]
            most = np.maximum.reduceat(so_far, first)
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, high - low)))
            winners = np.flatnonzero(so_far == most[group])
            winners = winners[np.concatenate(([True], np.diff(group[winners]) > 0))]  # of equal ones the earliest start
            best[to[first]], back[to[first]], by[to[first]] = most, start[low:high][winners], piece[low:high][winners]
        return self._paths(flat, offsets, back, by)

    def _paths(self, flat: np.ndarray, offsets: np.ndarray, back: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best paths of all words, followed back from their ends in step."""
        n = len(offsets) - 1
        word, first = np.arange(n), offsets[:-1] + np.arange(n)
        at = offsets[1:] + word
        word = word[at > first]
        at = at[word]
        taken = []
        while len(word):
            start = back[at]
            taken.append((word, by[at], start - word, at - start))
            on = start > first[word]
            word, at = word[on], start[on]
        if not taken:
            return np.zeros(0, np.int64), np.zeros(n, np.int64)
        steps = np.zeros(n, np.int64)
        for w, *_ in taken:
            steps[w] += 1
        # A word's step k, counted from its end, is k places before its last one.
        last = np.cumsum(steps) - 1
        piece, byte, count = (np.zeros(int(steps.sum()), np.int64) for _ in range(3))
        owner = np.repeat(np.arange(n), steps)
        for k, (w, p, b, width) in enumerate(taken):
            piece[last[w] - k], byte[last[w] - k], count[last[w] - k] = p, b, np.where(p >= 0, 1, width)
        which = np.repeat(np.arange(len(piece)), count)
        k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        ids = np.where(piece[which] >= 0, piece[which], np.array(self.byte_ids)[flat[np.minimum(byte[which] + k, len(flat) - 1)]])
        return ids, np.bincount(owner, weights=count, minlength=n).astype(np.int64)

    def words(self, text: str) -> list[str]:
        """The text's words, each with the markers before it, and stand-ins."""
        out: list[str] = []
        if not text:
            return out
        for n, part in enumerate(text.split(MARK)):
            if n:
                out.append(OWN_MARK)
            for line_number, line in enumerate(part.split("\n")):
                if line_number:
                    out.append(LINE_END)
                marks = 0 if line_number or n else 1  # one marker stands before the text
                for word_number, word in enumerate(line.split(" ")):
                    marks += word_number > 0
                    if word:
                        out.append(MARK * marks + word)
                        marks = 0
                if marks:
                    out.append(MARK * marks)
        return out

    def _learn(self, wanted: set[str]) -> None:
        """Afterwards ``recent`` holds all these words, of which the new are searched."""
        if len(self.recent.rows) >= CACHE_WORDS // 2:
            self.recent, self.older = Answers.none(), self.recent
        missing = [w for w in wanted if w not in self.recent.rows]
        again = [w for w in missing if w in self.older.rows]
        self.recent.add(again, *self.older.taken(np.array([self.older.rows[w] for w in again], dtype=np.int64)))
        fixed = {LINE_END: [self.byte_ids[10]], OWN_MARK: [self.byte_ids[b] for b in MARK.encode()]}
        short, short_data = [], []
        for word in missing:
            if word in self.older.rows:
                continue
            data = word.encode("utf-8")
            if word in fixed or len(data) > LONG_WORD:
                ids = fixed.get(word) or self.search(data)
                self.recent.add([word], np.array(ids), np.array([len(ids)]))
            else:
                short.append(word)
                short_data.append(data)
        self.recent.add(short, *self.search_all(short_data))

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after another, and how many each has; texts
        of CHARS_AT_ONCE characters go together."""
        found, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        group: list[list[str]] = []
        size = 0
        for n, text in enumerate(texts):
            group.append(self.words(text))
            size += len(text)
            if size >= CHARS_AT_ONCE or n == len(texts) - 1:
                self._learn(set(chain.from_iterable(group)))
                rows = np.fromiter(map(self.recent.rows.__getitem__, chain.from_iterable(group)), np.int64)
                ids, lengths = self.recent.taken(rows)
                upto = np.concatenate(([0], np.cumsum(lengths)))
                ends = np.cumsum([len(words) for words in group])
                found.append(ids)
                counts.append(np.diff(np.concatenate(([0], upto[ends]))))
                group, size = [], 0
        return np.concatenate(found), np.concatenate(counts)

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        texts = self.texts
        text = b"".join([texts[i] for i in ids]).decode("utf-8")
        return text[1:] if text else text


@lru_cache(maxsize=4)
def load(path: str = MODEL_PATH) -> Pieces:
    """Pieces, scores and kinds of a model file. The model must have byte pieces
    and must not hold pieces that would tie words together."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    keys: dict[bytes, int] = {}
    scores, texts, byte_ids = [], [], [-1] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        scores.append(model.get_score(i))
        if model.is_byte(i):
            byte = int(piece[3:5], 16)
            byte_ids[byte] = i
            texts.append(bytes([byte]))
            continue
        texts.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(MARK, " ").encode("utf-8"))
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if re.search(f"[^{MARK}]{MARK}", piece) or "\n" in piece:
                raise ValueError(f"piece {i} reaches over a word's end")
            keys[piece.encode("utf-8")] = i
    if min(byte_ids) < 0:
        raise ValueError("the model has no byte pieces")
    return Pieces(Trie.build(keys), scores, texts, byte_ids, min(scores[i] for i in keys.values()) - UNKNOWN_PENALTY, f"{path}:{len(scores)}")


def _shared(pieces: Pieces) -> Pieces:
    """The copy that this Python process already has, with the words it knows:
    tasks that run one after another in a worker share it."""
    return of_this_process("pieces").setdefault(pieces.name, pieces)


def with_pieces(documents: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """``documents`` with ids (array of int), n_tokens and round_trip (decoding
    gave the text back). Columns of these names are replaced."""
    pieces = load(path)
    df = documents.drop("ids", "n_tokens", "round_trip")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = _shared(pieces)
        texts = [t or "" for t in batch.column("text").to_pylist()]
        flat, lengths = own.encode_all(texts)
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        exact = [own.decode(flat[a:b].tolist()) == text for a, b, text in zip(offsets, offsets[1:], texts)]
        arrays = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
        counts = pa.array(lengths, pa.int64())
        return pa.RecordBatch.from_arrays([*batch.columns, arrays, counts, pa.array(exact, pa.bool_())], names=[*batch.schema.names, "ids", "n_tokens", "round_trip"])

    schema = T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])
    return map_batches(df, run, schema)
