"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics read the whole text and nothing else. The trees are fitted on the driver
from the statistics, not the texts, of at most ``rows`` labelled documents, and go to the
tasks as a few arrays; every document is scored by vectorised traversal.

Defined cases: a null text is the empty text, whose statistics are zeros and which is scored
like any other; documents with a null id are scored and count by crc32 of the empty text;
labels that are null are not learnt from; without any labelled row the score is 0.5;
repeated rows are all returned; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import content, held_out, labelled_sample, slices

#: Labelled documents that the trees are fitted on, at most.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3

STATISTICS = (
    "bytes", "words", "lines", "word_length", "word_length_spread", "upper", "digit", "blank", "stop_marks", "other_marks", "bars",
    "bangs", "symbols", "wide", "distinct_words", "distinct_pairs", "commonest_word", "adjacent_repeats", "distinct_lines",
    "commonest_line", "distinct_sentences", "commonest_sentence", "ends_with_mark", "capital_words", "longest_word", "words_a_line",
)

_UPPER, _DIGIT, _BLANK, _STOP, _BAR, _BANG, _SYMBOL, _MARK, _WIDE = range(1, 10)
_KIND = np.zeros(256, np.uint8)
_KIND[65:91], _KIND[48:58], _KIND[128:] = _UPPER, _DIGIT, _WIDE
for _kind, _bytes in ((_MARK, b"\"'()[]{}<>/\\:;-_=+~`^"), (_BLANK, b" \t\n\r\x0b\x0c"), (_STOP, b".,?"), (_BAR, b"|"), (_BANG, b"!"), (_SYMBOL, b"#$%&*@")):
    _KIND[list(_bytes)] = _kind


def statistics(text: bytes) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=10) / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x]
    sentences = [x for x in text.replace(b"!", b".").replace(b"\n", b" ").split(b". ") if x]
    counts, by_line, by_sentence = Counter(words), Counter(lines), Counter(sentences)
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        float(np.log1p(len(lines))),
        float(lengths.mean()),
        float(lengths.std()),
        *(float(kinds[k]) for k in (_UPPER, _DIGIT, _BLANK, _STOP, _MARK, _BAR, _BANG, _SYMBOL, _WIDE)),
        len(counts) / n,
        len(set(zip(words, words[1:], strict=False))) / max(1, n - 1),
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        len(by_line) / len(lines),
        max(by_line.values()) / len(lines),
        len(by_sentence) / len(sentences) if sentences else 0.0,
        max(by_sentence.values()) / len(sentences) if sentences else 0.0,
        sum(map(bytes.endswith, words, [(b".", b",", b"!", b"?", b";", b":")] * n)) / n,
        sum(map(bytes.istitle, words)) / n,
        float(lengths.max()),
        n / max(1, len(lines)),
    ]


def _rows(b: pa.RecordBatch) -> np.ndarray:
    return np.array([statistics(x) for x in b.column(1).to_pylist()], np.float64).reshape(-1, len(STATISTICS))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 512):
        x = _rows(b)
        values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(STATISTICS)), pa.int32()), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([b.column(2), values], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, label: str = "quality", rows: int = TRAIN_ROWS, text_col: str = "text") -> boosting.Forest:
    """Trees from the label rows that ``learn_from`` (over the labels' columns) admits."""
    labels = labels.select("doc_id", F.col(label).cast("int").alias("__label"))
    sample = labelled_sample(docs.select("doc_id", F.col(text_col).alias("__text")), labels, learn_from & F.col("__label").isNotNull(), rows)
    got = sample.select(F.lit(0), content("__text"), "__label").mapInArrow(_statistics, "label int, x array<double>").toArrow()
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(STATISTICS))
    y = got.column("label").to_numpy()
    order = np.lexsort((*x.T, y))  # the same trees whatever order the rows come in
    return boosting.fit(x[order], y[order].astype(float))


def score(docs: DataFrame, forest: boosting.Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): the probability of label 1 for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 512):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(forest.probability(_rows(b)))], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), content(text_col).alias("text")).mapInArrow(run, "doc_id bigint, score double")


def filter_quality(docs: DataFrame, forest: boosting.Forest, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents that the trees don't reject, whole rows with all their columns."""
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 512):
            texts = [(x or "").encode() for x in b.column(at).to_pylist()]
            x = np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(STATISTICS))
            yield b.filter(pa.array(forest.probability(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted); rows that are held out are never learnt from."""
    forest = fit(docs, labels, ~held_out(F.col("doc_id"), mod, rest))
    return score(docs, forest).select("doc_id", held_out(F.col("doc_id"), mod, rest).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
