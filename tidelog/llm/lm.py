"""Language-model scores from a weighted backoff automaton.

The model is a smoothed bigram model over words. As an automaton: one state per
word (its history), a start state, and a state without history. A state has an
arc for every bigram seen in training, weighted log10((1 - l) c(h,w)/c(h) +
l P(w)), and a failure arc to the state without history, weighted log10(l),
where every known word and the class of unknown words have an arc of weight
log10 P(w). A text is read once from left to right; the state after a word is
that word's, and the weights passed are added up.

P discounts every word's count by D and gives what it takes to the unknown
class. The failure weight l(h) = c(h)^-a falls with the history's count; a is
fitted so that l predicts, over all histories, as many new bigrams as training
had bigrams seen once. D comes from the counts of counts. Counts and statistics
are over all training documents.

No model is broadcast or gathered. Documents are dealt into blocks of bounded
size. Each block asks for the total counts of its own n-grams: sorted hashes,
delta-coded, go to the parts of the hash space; each part adds up the blocks'
counts and answers every block in the order it asked. So a block gets just the
part of the automaton that its texts can reach.

Defined results: null text counts as empty and is scored as its end alone. Rows
without an id are held out. Without training documents all scores are 0. Extra
columns are ignored. Repeated rows are scored, and counted, one by one.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize
from .shingles import mix, word_hashes

END, START = np.uint64(0x5E5E5E5E5E5E5E5E), np.uint64(0xA1A1A1A1A1A1A1A1)
CHARS_PER_BLOCK = 16_000_000
CHARS_PER_PART = 8_000_000
LEAST_PARTS = 32
EXPONENTS = np.linspace(0.01, 0.99, 99)


def pack(values: np.ndarray) -> bytes:
    """Bytes of equal weight lie together, so that small values cost little."""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1) if len(values) else b""


def unpack(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


@dataclass
class Tokens:
    """The tokens of a block's texts, one text after another."""

    words: np.ndarray
    histories: np.ndarray
    owner: np.ndarray  # index of the text

    @staticmethod
    def read(texts: list[str | None]) -> "Tokens":
        parts = [np.append(word_hashes(t), END) if t else np.array([END], np.uint64) for t in texts]
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        histories = np.empty_like(words)
        histories[1:] = words[:-1]
        histories[np.cumsum(lengths) - lengths] = START
        return Tokens(words, histories, np.repeat(np.arange(len(parts)), lengths))

    def bigrams(self) -> np.ndarray:
        return mix(self.histories * np.uint64(0xA0761D6478BD642F) + self.words)


def _asked(keys: np.ndarray, counted: np.ndarray, bits: int) -> list[tuple[int, bytes, bytes]]:
    """(part, keys, counts): distinct keys by the part their top bits name."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    counts = np.bincount(inverse, counted, len(distinct)).astype(np.uint32)
    edges = np.searchsorted(distinct >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    return [(p, pack(np.diff(distinct[a:b], prepend=np.uint64(0))), pack(counts[a:b])) for p, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]


def _ask(table: pa.Table, bits: int) -> pa.Table:
    """One block's questions."""
    out: list[tuple] = []
    if table.num_rows:
        tokens = Tokens.read(table.column("text").to_pylist())
        learned = np.array(table.column("learn").to_pylist(), dtype=np.float64)[tokens.owner]
        block = table.column("block")[0].as_py()
        for order, keys in ((1, tokens.words), (2, tokens.bigrams())):
            out += [(order, part, block, k, c) for part, k, c in _asked(keys, learned, bits)]
    columns = list(zip(*out)) or [()] * 5
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("order", "part", "block", "keys", "counts"), columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))})


def _answer(table: pa.Table) -> pa.Table:
    """One part's answers, one row per question, and on the first of them the
    statistics of the part: tokens, types, types seen once and twice, and for
    each exponent a the sum of c^(1-a)."""
    order, part = table.column("order")[0].as_py(), table.column("part")[0].as_py()
    asked = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in table.column("keys").to_pylist()]
    counts = np.concatenate([unpack(c, np.uint32) for c in table.column("counts").to_pylist()])
    distinct, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(inverse, counts, len(distinct)).astype(np.uint64)
    edges = np.cumsum([0, *(len(a) for a in asked)])
    answers = [pack(total[inverse[a:b]]) for a, b in zip(edges, edges[1:])]
    seen = total[total > 0].astype(np.float64)
    histories = total[(total > 0) & (distinct != END)].astype(np.float64)
    sums = [float(np.power(histories, 1 - a).sum()) for a in EXPONENTS] if order == 1 else []
    rest = len(answers) - 1
    return pa.table(
        {
            "order": pa.array([order] * len(answers), pa.int32()),
            "part": pa.array([part] * len(answers), pa.int32()),
            "block": table.column("block").combine_chunks().cast(pa.int32()),
            "answer": pa.array(answers, pa.binary()),
            "tokens": pa.array([int(seen.sum())] + [0] * rest, pa.int64()),
            "types": pa.array([len(seen)] + [0] * rest, pa.int64()),
            "once": pa.array([int((seen == 1).sum())] + [0] * rest, pa.int64()),
            "twice": pa.array([int((seen == 2).sum())] + [0] * rest, pa.int64()),
            "sums": pa.array([sums] + [[]] * rest, pa.list_(pa.float64())),
        }
    )


@dataclass(frozen=True)
class Statistics:
    tokens: int
    types: int
    discount: float
    exponent: float
    documents: int


@dataclass
class Automaton:
    """The part of the model that a block needs. Words and bigrams are given by
    place in the block's sorted distinct hashes."""

    word_weight: np.ndarray  # log10 P of each word
    word_count: np.ndarray
    arc_count: np.ndarray
    statistics: Statistics

    def failure(self, history_count: np.ndarray) -> np.ndarray:
        """l of each state; a history never seen is the state without history."""
        return np.where(history_count > 0, np.power(np.maximum(history_count, 1.0), -self.statistics.exponent), 1.0)

    def traverse(self, word: np.ndarray, history_count: np.ndarray, arc: np.ndarray) -> np.ndarray:
        """The weight passed at each token: its arc's if the state has one, else
        the failure arc's and the word's own."""
        share = self.failure(history_count)
        below = self.word_weight[word]
        taken = self.arc_count[arc]
        seen = (taken > 0) & (history_count > 0)
        own = (1 - share) * taken / np.maximum(history_count, 1.0) + share * np.power(10.0, below)
        return np.where(seen, np.log10(np.maximum(own, 1e-300)), np.log10(share) + below)


def _score(texts: pa.Table, answers: pa.Table, statistics: Statistics) -> pa.Table:
    n = texts.num_rows
    tokens = Tokens.read(texts.column("text").to_pylist()) if n else Tokens(*[np.zeros(0, np.uint64)] * 3)
    held: dict[int, np.ndarray] = {}
    rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("order", "part", "answer"))))
    for order in (1, 2):
        held[order] = np.concatenate([np.zeros(0, np.uint64), *(unpack(a, np.uint64) for o, _, a in rows if o == order)]).astype(np.float64)
    sums = [np.zeros(0)] * 4
    if n:
        distinct, word = np.unique(tokens.words, return_inverse=True)
        count = held[1]
        size, types = statistics.tokens, statistics.types
        unknown = statistics.discount * types / size if size else 1.0
        weight = np.log10(np.where(count > 0, (count - statistics.discount) / max(size, 1), unknown))
        arc = np.unique(tokens.bigrams(), return_inverse=True)[1]
        started = tokens.histories == START
        place = np.minimum(np.searchsorted(distinct, tokens.histories), len(distinct) - 1)
        history_count = np.where(started, statistics.documents, count[place])
        passed = Automaton(weight, count, held[2], statistics).traverse(word, history_count, arc)
        base = np.log10((count + 1) / (size + types + 1))
        sums = [np.bincount(tokens.owner, x, n) for x in (np.ones(len(word)), count[word] > 0, base[word], passed)]
    return pa.table(
        {
            "doc_id": texts.column("doc_id").combine_chunks().cast(pa.int64()),
            "held_out": pa.array([not x for x in texts.column("learn").to_pylist()], pa.bool_()),
            "n_tokens": pa.array(sums[0].astype(np.int64)),
            "n_known": pa.array(sums[1].astype(np.int64)),
            "train_tokens": pa.array([statistics.tokens] * n, pa.int64()),
            "base_score": pa.array(sums[2], pa.float64()),
            "score": pa.array(sums[3], pa.float64()),
        }
    )


def score(documents: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row; the model learns from rows that are not held out."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (~held_out).alias("learn"))
    totals = rows.agg(F.sum(F.length("text")).alias("chars"), F.count_if("learn").alias("documents")).first()
    chars = totals["chars"] or 0
    blocks = max(LEAST_PARTS, -(-chars // CHARS_PER_BLOCK))
    bits = math.ceil(math.log2(max(LEAST_PARTS, chars / CHARS_PER_PART)))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    asked = dealt.groupBy("block").applyInArrow(lambda t: _ask(t, bits), "order int, part int, block int, keys binary, counts binary")
    answered = materialize(asked.groupBy("order", "part").applyInArrow(_answer, "order int, part int, block int, answer binary, tokens long, types long, once long, twice long, sums array<double>"))
    found = {r["order"]: r for r in answered.groupBy("order").agg(*[F.sum(c).alias(c) for c in ("tokens", "types", "once", "twice")]).collect()}
    words, bigrams = found.get(1), found.get(2)
    exponent = 0.5
    if words is not None and words["tokens"]:
        novel = {r["at"]: r["total"] for r in answered.where("order = 1").select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("total")).collect()}
        expected = np.array([novel[i] + totals["documents"] ** (1 - a) for i, a in enumerate(EXPONENTS)])
        exponent = float(EXPONENTS[np.abs(expected - bigrams["once"]).argmin()])
    once, twice = (words["once"], words["twice"]) if words is not None else (0, 0)
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5
    statistics = Statistics(words["tokens"] if words is not None else 0, words["types"] if words is not None else 0, discount, exponent, totals["documents"])
    answers = answered.select("block", "order", "part", "answer")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda t, a: _score(t, a, statistics), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
