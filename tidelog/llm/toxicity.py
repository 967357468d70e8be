"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores p = sigmoid(bias + the sum
of its words' weights); the document scores by noisy-or, 1 - prod(1 - p), over its likeliest sentence and all
others from a learned floor on: below it, p counts as 0, so that clean sentences
do not add up however long a text is. Only
document labels are known: the gradient of the document's likelihood is what
teaches the sentence scorer, which then points at the offending sentences. A
word's weight is the sum of the weights of its features, the word itself and
its first 3 to 6 letters, so that forms never seen share what their stem has.

Defined results: null and empty texts, and texts without a word, have no
sentence and score 0. Without any usable label every text scores 0. Only labels
0 and 1 count; several labels of one document (repeated rows of either table)
are reduced to the largest. Extra columns of the inputs are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import hash_below, map_batches

#: A word, or what ends a sentence.
TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
ENDS = frozenset(".!?\n")
PREFIXES = (3, 4, 5, 6)
#: Learned from about this many labelled rows of each class (whole texts).
ROWS_PER_CLASS = {1: 3000, 0: 5000}
#: A feature counts if it is in so many sampled documents.
MIN_DOCUMENTS = 4
#: A sentence this likely is reported, and always the likeliest of a rejected text.
OFFENDING = 0.5
CACHE_WORDS = 100_000
#: The floor lies below the likeliest sentence of all but this share of toxic texts,
FLOOR_MISSES = 0.05
#: and so high that a clean text of so many sentences gets no more than this.
LONG, LONG_COST = 100_000, 0.1


#: Features are hashed into so many weights.
WEIGHTS = 1 << 20


def word_features(word: str) -> list[int]:
    names = {word + "$", *(word[:n] for n in PREFIXES if len(word) >= n)}
    return sorted(zlib.crc32(f.encode("utf-8", "surrogatepass")) & (WEIGHTS - 1) for f in names)


def sentences(text: str) -> list[list[str]]:
    """Lower-case words by sentence; sentences without a word are left out."""
    out: list[list[str]] = []
    now: list[str] = []
    for token in TOKEN.findall(text.lower()):
        if token in ENDS:
            if now:
                out.append(now)
                now = []
        else:
            now.append(token)
    return [*out, now] if now else out


@dataclass
class Model:
    weights: np.ndarray  # one per hashed feature
    bias: float
    floor: float = -math.inf  # logit under which a sentence counts as clean
    cache: dict[str, float] = field(default_factory=dict, repr=False)

    def word(self, word: str) -> float:
        known = self.cache.get(word)
        if known is None:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            known = self.cache[word] = float(sum(self.weights[f] for f in word_features(word)))
        return known

    def logits(self, text: str) -> list[float]:
        """The logit of every sentence, in order."""
        out, total, words = [], self.bias, 0
        cached = self.cache.get
        for token in TOKEN.findall(text.lower()):
            if token in ENDS:
                if words:
                    out.append(total)
                    total, words = self.bias, 0
            else:
                weight = cached(token)
                total += self.word(token) if weight is None else weight
                words += 1
        return [*out, total] if words else out

    def score(self, text: str | None) -> float:
        """1 - prod(1 - p): log(1 - sigmoid(z)) is -log1p(exp(z))."""
        logits = self.logits(text) if text else []
        if not logits:
            return 0.0
        counted = [z for z in logits if z >= self.floor] or [max(logits)]
        return -math.expm1(-sum(max(z, 0.0) + math.log1p(math.exp(-abs(z))) for z in counted))

    def offending(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of the sentences that make the text toxic:
        code points of the original text, end exclusive."""
        found, start, end, total = [], -1, -1, self.bias

        def close() -> None:
            found.append((start, end, 1 / (1 + math.exp(-max(-700.0, min(700.0, total))))))

        for m in TOKEN.finditer(text):
            token = m.group().lower()
            if token in ENDS:
                if start >= 0:
                    close()
                start, total = -1, self.bias
            else:
                start = m.start() if start < 0 else start
                end = m.end()
                total += self.word(token)
        if start >= 0:
            close()
        least = min(OFFENDING, max((p for *_, p in found), default=1.0))
        return [s for s in found if s[2] >= least]


def learned_floor(z: np.ndarray, of_bag: np.ndarray, labels: np.ndarray) -> float:
    """From the logits of the sampled sentences. Never above OFFENDING: a sentence
    that offends by itself always counts."""
    likeliest = np.full(len(labels), -np.inf)
    np.maximum.at(likeliest, of_bag, z)
    clean = np.sort(z[labels[of_bag] == 0])[::-1]
    cost = np.cumsum(np.logaddexp(0, clean)) * (LONG / len(clean))
    over = np.flatnonzero(cost > LONG_COST)
    least = np.nextafter(clean[over[0]], np.inf) if len(over) else -np.inf
    return float(min(math.log(OFFENDING / (1 - OFFENDING)), max(least, np.quantile(likeliest[labels == 1], FLOOR_MISSES))))


def fit(bags: list[tuple[np.ndarray, np.ndarray]], words: list[str], labels: np.ndarray, weights: np.ndarray, steps: int = 120, l2: float = 1e-5) -> Model:
    """bags: for each document its words, as indexes into ``words``, and the
    lengths of its sentences. Arrays throughout: the driver holds a few numbers
    per sampled word."""
    of_feature = array("i")
    counts = array("i")
    for w in words:
        features = word_features(w)
        of_feature.extend(features)
        counts.append(len(features))
    of_feature, counts = np.array(of_feature, dtype=np.int32), np.array(counts, dtype=np.int32)
    starts = np.cumsum(counts) - counts
    in_documents = np.zeros(WEIGHTS, np.int32)
    for bag in bags:
        held = np.unique(bag[0])
        in_documents[np.unique(np.concatenate([of_feature[starts[i] : starts[i] + counts[i]] for i in held]))] += 1
    of_word = np.repeat(np.arange(len(words), dtype=np.int32), counts)
    common = in_documents[of_feature] >= MIN_DOCUMENTS
    of_word, of_feature = of_word[common], of_feature[common]
    used, of_feature = np.unique(of_feature, return_inverse=True)
    flat = np.concatenate([b[0] for b in bags])
    lengths = np.concatenate([b[1] for b in bags])
    of_sentence = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    of_bag = np.repeat(np.arange(len(bags), dtype=np.int32), [len(b[1]) for b in bags])
    theta, bias = np.zeros(len(used)), -5.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    share = weights / weights.sum()
    for t in range(1, steps + 1):
        per_word = np.bincount(of_word, theta[of_feature], len(words))
        z = bias + np.bincount(of_sentence, per_word[flat], len(lengths))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.bincount(of_bag, np.logaddexp(0, z), len(bags))  # -log of the chance that no sentence offends
        # d loglik / dz = p * (1 - p_doc) / p_doc for a toxic bag, -p for a clean one
        odds = np.where(labels == 1, 1 / np.expm1(np.clip(clean, 1e-6, 30)), -1.0)
        pull = p * (odds * share)[of_bag]
        by_word = np.bincount(flat, pull[of_sentence], len(words))
        g = np.append(-np.bincount(of_feature, by_word[of_word], len(used)) + l2 * theta, -pull.sum())
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        theta -= step[:-1]
        bias -= step[-1]
    learned = np.zeros(WEIGHTS, np.float32)
    learned[used] = theta
    per_word = np.bincount(of_word, theta[of_feature], len(words))
    z = bias + np.bincount(of_sentence, per_word[flat], len(lengths))
    return Model(learned, float(bias), learned_floor(z, of_bag, labels))


def train(documents: DataFrame, labels: DataFrame, trainable: Column, rows_per_class: dict[int, int] | None = None) -> Model | None:
    """Fit on a hash sample of about ``rows_per_class`` labelled texts, weighted
    back to the classes' true shares; None without labels of both classes."""
    bound = rows_per_class or ROWS_PER_CLASS
    marks = labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1) & trainable).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    share = {k: min(1.0, bound[k] / n) for k, n in sizes.items()}
    sample = marks.where(hash_below(F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]), "doc_id", salt="toxicity"))
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull())

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        bags = ["\n".join(" ".join(s) for s in sentences(t)) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(bags, pa.string())], names=["doc_id", "toxic", "words"])

    # The sample is bounded by the parameter, so its side of the join may be sent around.
    joined = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")
    number: dict[str, int] = {}
    rows = []
    for r in map_batches(joined, words, "doc_id long, toxic int, words string").toLocalIterator():
        if r["words"]:
            found = [line.split(" ") for line in r["words"].split("\n")]
            ids = np.fromiter((number.setdefault(w, len(number)) for line in found for w in line), dtype=np.int32)
            rows.append((r["doc_id"], r["toxic"], (ids, np.array([len(line) for line in found], dtype=np.int32))))
    if len({r[1] for r in rows}) < 2:
        return None
    y = np.array([r[1] for r in rows])
    return fit([r[2] for r in rows], list(number), y, np.where(y == 1, 1 / share[1], 1 / share[0]))


def score(documents: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, score, predicted, offending (array of start, end, score)."""
    df = documents.select(*keep, F.col("text").alias("__text"))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, found = [], []
        for text in batch.column("__text").to_pylist():
            p = model.score(text) if model is not None and text else 0.0
            scores.append(p)
            found.append([dict(zip(("start", "end", "score"), s)) for s in model.offending(text)] if p >= 0.5 else [])
        kept = [batch.column(c) for c in keep]
        return pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64()), pa.array([int(p >= 0.5) for p in scores], pa.int32()), pa.array(found, spans)], names=[*keep, "score", "predicted", "offending"])

    types = dict(df.dtypes)
    return map_batches(df, run, ", ".join(f"`{c}` {types[c]}" for c in keep) + ", score double, predicted int, offending array<struct<start:int,end:int,score:double>>")
