"""Language identification by error-correcting output codes.

Every language gets a codeword of +1/-1 bits: all 2^(K-1)-1 splits of the K
languages while K is small, else random codewords far apart. One logistic
classifier over hashed character n-grams predicts each bit. A text goes to the
codeword with the smallest weighted logistic loss; a narrow lead is flagged.

Defined results: null text or a text without any letter gets ``und`` with score
0 and no ambiguity flag; so does every row if nothing can be learned (no
labelled row). With one learned language every lettered text gets it with score
1. Repeated rows are scored alike, each in its own row. Extra columns of the
input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import hash_below, map_batches, of_this_process

UNDETERMINED = "und"
BITS_OF_TABLE = 13
DIM = 1 << BITS_OF_TABLE
#: Characters hashed at a time: memory for a text does not grow with it.
CHUNK = 1 << 20
#: Learned from about this many rows of each language (whole texts).
ROWS_PER_LANGUAGE = 500
MAX_EXHAUSTIVE = 6
AMBIGUOUS_LEAD = 0.2


def _letter_table() -> np.ndarray:
    held = of_this_process("letters")
    if "letters" not in held:
        held["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return held["letters"]


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed 1-, 2- and 3-grams of letters (lower case, every run
    of other characters as one space); None if there is no letter."""
    counts = np.zeros(DIM, dtype=np.int64)
    seen = False
    for at in range(0, len(text), CHUNK):
        points = np.frombuffer(text[at : at + CHUNK].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letter = _letter_table()[points]
        if not letter.any():
            continue
        seen = True
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        c = np.where(letter, points, np.uint32(32))[keep].astype(np.uint32)
        c = np.concatenate((np.array([32], dtype=np.uint32), c))
        two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA6B)
        three = two[:-1] * np.uint32(0xC2B2AE35) + c[2:]
        for grams, odd in ((c, 0x27D4EB2F), (two, 0x165667B1), (three, 0x9E3779B1)):
            mixed = grams * np.uint32(odd)
            mixed ^= mixed >> np.uint32(15)
            counts += np.bincount((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS_OF_TABLE), minlength=DIM)
    return counts if seen else None


def frequencies(counts: np.ndarray) -> np.ndarray:
    return (counts / counts.sum()).astype(np.float32)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """K rows of +1/-1: exhaustive up to ``MAX_EXHAUSTIVE`` languages, else the
    random matrix with the largest least distance of 50 drawn ones."""
    if k == 1:
        return np.ones((1, 1), dtype=int)
    if k <= MAX_EXHAUSTIVE:
        splits = np.arange(2 ** (k - 1) - 1)
        rows = [np.where((splits >> row) & 1, 1, -1) for row in range(k - 1)]
        return np.stack([*rows, np.ones_like(splits)])
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(k)))
    best, reach = None, -1
    for _ in range(50):
        m = rng.choice([-1, 1], size=(k, bits))
        if np.any(np.abs(m.sum(0)) == k):
            continue
        apart = int(min((m[i] != m[j]).sum() for i in range(k) for j in range(i)))
        if apart > reach:
            best, reach = m, apart
    return best


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray  # K x B
    weights: np.ndarray  # DIM x B
    bias: np.ndarray  # B
    trust: np.ndarray  # K x B, each row has mean 1

    def decode(self, x: np.ndarray) -> tuple[int, float, float]:
        """Best language, its probability, and its lead over the second."""
        margins = x @ self.weights + self.bias
        losses = (self.trust * np.logaddexp(0, -self.code * margins)).sum(1)
        p = np.exp(losses.min() - losses)
        p /= p.sum()
        order = np.argsort(-p, kind="stable")
        lead = p[order[0]] - (p[order[1]] if len(p) > 1 else 0.0)
        return int(order[0]), float(p[order[0]]), float(lead)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 150, l2: float = 1e-3) -> Model:
    """Train the bit classifiers together by full-batch Adam on standardized
    n-gram frequencies; all rows of a language weigh the same in total."""
    k = len(languages)
    code = codewords(k)
    scale = x.std(0)
    scale[scale < 1e-7] = np.inf
    z = (x / scale).astype(np.float32)
    target = code[y].astype(np.float32)
    share = (1.0 / np.bincount(y, minlength=k)[y]).astype(np.float32)[:, None] / k
    w, b = np.zeros((DIM, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    first, second = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for t in range(1, steps + 1):
        pull = -target * share / (1 + np.exp(np.clip(target * (z @ w + b), -30, 30)))
        for i, (p, g) in enumerate(((w, z.T @ pull + l2 * w), (b, pull.sum(0)))):
            first[i] += 0.1 * (g - first[i])
            second[i] += 0.01 * (g * g - second[i])
            p -= 0.02 * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.99**t)) + 1e-8)
    right = (np.sign(z @ w + b) == target).astype(np.float64)
    trust = np.stack([right[y == i].mean(0) for i in range(k)]) + 1e-3
    return Model(tuple(languages), code, (w / scale[:, None]).astype(np.float64), b.astype(np.float64), trust / trust.mean(1, keepdims=True))


def train(documents: DataFrame, trainable: Column, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """Fit on a hash sample of about ``rows_per_language`` labelled rows of each
    language; None if there is no labelled row. Only n-gram counts of the
    sampled rows reach the driver."""
    rows = documents.select("doc_id", "text", "lang").where(trainable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(v) for name, n in sizes.items() for v in (name, min(1.0, rows_per_language / n))])
    sample = rows.where(hash_below(share[F.col("lang")], "doc_id", salt="language"))

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], []]
        for doc_id, text, lang in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lang"))):
            if (counts := ngram_counts(text)) is not None:
                at = np.flatnonzero(counts)
                for column, value in zip(out, (doc_id, lang, at.astype("<u2").tobytes(), counts[at].astype("<u4").tobytes())):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())], names=["doc_id", "lang", "at", "n"])

    found = sorted(map_batches(sample, features, "doc_id long, lang string, at binary, n binary").collect(), key=lambda r: (r["doc_id"], r["lang"], r["at"]))
    if not found:
        return None
    languages = sorted({r["lang"] for r in found})
    x = np.zeros((len(found), DIM), np.float32)
    for row, r in zip(x, found):
        n = np.frombuffer(r["n"], "<u4").astype(np.float64)
        row[np.frombuffer(r["at"], "<u2")] = n / n.sum()
    return fit(x, np.array([languages.index(r["lang"]) for r in found]), languages)


def identify(documents: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred, score, ambiguous for every whole text."""
    df = documents.select(*keep, F.col("text").alias("__text"))

    def predict(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores, flags = [], [], []
        for text in batch.column("__text").to_pylist():
            counts = ngram_counts(text) if text and model is not None else None
            if counts is None:
                best, score, lead = UNDETERMINED, 0.0, 1.0
            else:
                at, score, lead = model.decode(frequencies(counts))
                best = model.languages[at]
            names.append(best)
            scores.append(score)
            flags.append(lead < AMBIGUOUS_LEAD)
        kept = [batch.column(c) for c in keep]
        return pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())], names=[*keep, "lang_pred", "score", "ambiguous"])

    types = dict(df.dtypes)
    return map_batches(df, predict, ", ".join(f"`{c}` {types[c]}" for c in keep) + ", lang_pred string, score double, ambiguous boolean")
