"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples and unlabelled text, both from rows that are not held out, train a
logistic classifier over the presence of hashed words and beginnings of words. The risk is the class-prior-corrected
estimate  pi E_P[l(+)] + max(0, E_U[l(-)] - pi E_P[l(-)]): where the estimate of the
negative part drops below zero, the step goes against it, as in Kiryo et al. (2017). The
class prior pi is the share of confirmed rows among all labelled training rows, counted over
the whole table.

The fit sees at most ``positives`` and ``unlabelled`` documents, as arrays of word hashes, chosen
by a hash of the id, and weighs at most ``features`` of these hashes; a document whose id is
repeated counts as often as it occurs. Every document is scored over its whole text.

Defined cases: a null text is the empty text, scored by the bias alone; a document with a
null id is scored and counts by crc32 of the empty text; null labels are unlabelled; without
any confirmed row every score is 0; repeated rows are all returned; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import content, held_out, labelled_sample, slices

#: Documents that the classifier is fitted on, at most.
POSITIVES, UNLABELLED = 4_000, 8_000
#: Words that the classifier weighs, at most: those that tell confirmed from unlabelled text best.
FEATURES = 1_024
THRESHOLD = 0.3

#: Bytes of the beginnings of words.
LENGTHS = (4, 5, 6, 7, 8)

_SPLIT = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def word_hashes(text: bytes) -> list[int]:
    """64-bit hashes of what marks a text: its distinct words, the beginnings of these words
    (4 to 8 bytes), and that 2 or 4 distinct words or more share a beginning.

    Words are lower-cased and cut at what is no letter or digit.
    """
    words = set(text.decode().lower().encode().translate(_SPLIT).split())
    counts = Counter([w[:n] for n in LENGTHS for w in words if len(w) >= n])
    marks = [w + b"$" for w in words]
    marks += counts
    marks += [p + b"+" for p, k in counts.items() if k > 1]
    marks += [p + b"*" for p, k in counts.items() if k > 3]
    return list(map(xxhash.xxh64_intdigest, marks))


@dataclass
class Linear:
    """Weights by word hash."""

    index: dict[int, int]
    weight: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        get = self.index.get
        rows = [[k for h in word_hashes(t) if (k := get(h)) is not None] for t in texts]
        at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        hit = self.weight[np.array([k for r in rows for k in r], np.int64)]
        z = self.bias + np.bincount(at, hit, len(rows))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _select(pos: list[np.ndarray], unl: list[np.ndarray], most: int) -> np.ndarray:
    """The hashes with the largest likelihood ratio between confirmed and unlabelled text."""
    hp, cp = np.unique(np.concatenate(pos), return_counts=True)
    hu, cu = np.unique(np.concatenate(unl), return_counts=True) if unl else (hp[:0], cp[:0])
    hp, cp = hp[cp >= 3], cp[cp >= 3]
    a = cp.astype(float)
    at = np.searchsorted(hu, hp)
    b = np.where((at < len(hu)) & (hu[np.minimum(at, max(0, len(hu) - 1))] == hp) if len(hu) else False, cu[np.minimum(at, max(0, len(hu) - 1))] if len(hu) else 0, 0).astype(float)
    p, q = (a + 0.5) / (len(pos) + 1), (b + 0.5) / (len(unl) + 1)
    m = (a + b + 0.5) / (len(pos) + len(unl) + 1)
    gain = len(pos) * (p * np.log(p / m) + (1 - p) * np.log((1 - p) / (1 - m))) + len(unl) * (q * np.log(q / m) + (1 - q) * np.log((1 - q) / (1 - m)))
    order = np.lexsort((hp, -gain))
    return hp[order[gain[order] > 8][:most]]


def fit_nnpu(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, most: int = FEATURES, steps: int = 400, rate: float = 0.1, l2: float = 1e-3, beta: float = 0.0, gamma: float = 1.0) -> Linear:
    """Full-batch Adam on the non-negative risk; deterministic."""
    if not pos:
        return Linear({}, np.zeros(0), -40.0)
    prior = min(max(prior, 1e-3), 0.999)
    chosen = _select(pos, unl, most)
    index = {int(h): k for k, h in enumerate(chosen.tolist())}

    def csr(docs):
        rows = [[index[h] for h in d.tolist() if h in index] for d in docs]
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([k for r in rows for k in r], np.int64), len(rows)

    width = len(chosen)
    (pr, pc, np_), (ur, uc, nu) = csr(pos), csr(unl)
    theta, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def back(r, c, d):  # gradient of sum(d_i z_i)
        return np.append(np.bincount(c, d[r], width), d.sum())

    for t in range(1, steps + 1):
        zp = np.bincount(pr, theta[pc], np_) + theta[-1]
        zu = np.bincount(ur, theta[uc], nu) + theta[-1]
        plus = prior * back(pr, pc, -sig(-zp) / np_)
        minus_p = prior * back(pr, pc, sig(zp) / np_)
        minus_u = back(ur, uc, sig(zu) / nu) if nu else 0 * plus
        risk = (np.logaddexp(0, zu).mean() if nu else 0.0) - prior * np.logaddexp(0, zp).mean()
        grad = plus + minus_u - minus_p if risk >= -beta else -gamma * (minus_u - minus_p)
        grad[:-1] += l2 * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return Linear(index, theta[:-1], float(theta[-1]))


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 512):
        rows = [np.array(word_hashes(x), np.uint64).view(np.int64) for x in b.column(0).to_pylist()]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))], ["h"])


def _collect(sample: DataFrame) -> list[np.ndarray]:
    got = sample.select(content("__text")).mapInArrow(_hash_rows, "h array<bigint>").toArrow().column("h").combine_chunks()
    flat, offsets = got.flatten().to_numpy().view(np.uint64), got.offsets.to_numpy()
    rows = [np.sort(flat[a:z]) for a, z in zip(offsets[:-1] - offsets[0], offsets[1:] - offsets[0], strict=True)]
    return sorted(rows, key=lambda r: r.tobytes())  # the same model whatever order the rows come in


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES) -> Linear:
    """A classifier from the label rows that ``learn_from`` admits and from unlabelled text."""
    labels = labels.select(id_col, F.col(label).cast("int").alias("__label")).filter(learn_from)
    texts = docs.select(id_col, F.col(text_col).alias("__text"))
    prior = labels.agg(F.avg("__label")).first()[0] or 0.0
    pos = _collect(labelled_sample(texts, labels.filter("__label = 1").select(id_col).distinct(), F.lit(True), positives, id_col))
    unl = _collect(labelled_sample(texts, texts.select(id_col).filter(learn_from).distinct(), F.lit(True), unlabelled, id_col))
    return fit_nnpu(pos, unl, float(prior), features)


def score(docs: DataFrame, model: Linear, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 512):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(b.column(1).to_pylist()))], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), content(text_col).alias("text")).mapInArrow(run, "doc_id bigint, score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, mod: int = 4, rest: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted); held-out rows are never learnt from."""
    model = fit(docs, labels, ~held_out(F.col("doc_id"), mod, rest))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), mod, rest).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
