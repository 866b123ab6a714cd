"""A quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts come from one pass in numpy. Trees are grown on a bounded sample of labelled rows, from histograms of
binned statistics, and flattened into arrays of features, cuts and children, over which all rows of a batch walk at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import texts

FIT_ROWS = 20_000
BINS = 64
CHUNK = 1 << 20

FEATURES = (
    "bytes", "words", "word_length", "distinct_words", "top_word", "lines", "line_length", "distinct_lines", "upper", "digit", "space",
    "stop_mark", "comma", "exclaim", "symbol", "other_mark", "non_ascii", "entropy", "short_words", "long_words", "capital_words", "word_pairs",
    "squeezed", "repeated_next",
)


def classes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, space, full stop, comma, exclamation, symbol, other mark, other."""
    out = np.full(256, 9, np.int64)
    for b in range(128):
        c = chr(b)
        out[b] = (0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c.isspace() else 4 if c in ".?" else 5 if c in ",;:" else 6 if c == "!"
                  else 7 if c in "#$%&*@^~|<>{}[]_=+\\/" else 8)
    return out


BYTE_CLASS = classes()


def squeezed(text: bytes) -> int:
    """Compressed size of a whole text, of which a chunk at a time is held in compressed form."""
    packer = zlib.compressobj(1)
    return sum(len(packer.compress(text[k : k + CHUNK])) for k in range(0, len(text), CHUNK)) + len(packer.flush())


def statistics(text: bytes) -> list[float]:
    """One row of FEATURES; zeros for an empty text."""
    words = text.split()
    if not words:
        return [float(len(text))] + [0.0] * (len(FEATURES) - 1)
    n, m = len(text), len(words)
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(BYTE_CLASS, weights=histogram, minlength=10) / n
    shares = histogram[histogram > 0] / n
    lengths = np.fromiter(map(len, words), np.int64, m)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = text.split(b"\n")
    pairs = len(set(zip(words, words[1:]))) / max(m - 1, 1)
    return [
        np.log1p(n), np.log1p(m), lengths.mean(), len(counts) / m, max(counts.values()) / m, np.log1p(len(lines)), np.log1p(n / len(lines)), len(set(lines)) / len(lines),
        kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], kinds[7], kinds[8], kinds[9], float(-(shares * np.log2(shares)).sum()),
        float((lengths <= 3).mean()), float((lengths >= 12).mean()), sum(65 <= w[0] <= 90 for w in words) / m, pairs,
        squeezed(text) / n, sum(a == b for a, b in zip(words, words[1:])) / max(m - 1, 1),
    ]


@dataclass
class Trees:
    """Boosted trees in flat arrays; node 0 of each tree is its root, and a leaf is its own child."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, least: float = 5.0, shrink: float = 1.0) -> Trees:
    """Boosts trees on the logistic loss; cuts are taken at bin edges (quantiles of each statistic)."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]) if n else np.zeros((0, width), np.int64)
    share = min(max(y.mean() if n else 0.5, 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    total = np.full(n, start)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def node(v: float) -> int:
        k = len(value)
        feature.append(0)
        cut.append(np.inf)
        left.append(k)
        right.append(k)
        value.append(v)
        return k

    for _ in range(trees if n and 0 < y.mean() < 1 else 0):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        roots.append(node(0.0))
        level = [(roots[-1], np.arange(n))]
        step = np.zeros(n)
        for d in range(depth + 1):
            following = []
            for at, rows in level:
                gs, hs = g[rows].sum(), h[rows].sum()
                value[at] = rate * gs / (hs + shrink)
                step[rows] = value[at]
                if d == depth or len(rows) < 2 * least:
                    continue
                code = binned[rows] + np.arange(width) * BINS
                flat, times = code.ravel(), np.repeat(np.column_stack((g[rows], h[rows], np.ones(len(rows)))), width, axis=0)
                sums = [np.bincount(flat, weights=times[:, k], minlength=width * BINS).reshape(width, BINS).cumsum(axis=1) for k in range(3)]
                gl, hl, nl = sums
                gain = gl**2 / (hl + shrink) + (gs - gl) ** 2 / (hs - hl + shrink) - gs**2 / (hs + shrink)
                gain[(nl < least) | (len(rows) - nl < least)] = 0
                f, b = np.unravel_index(gain.argmax(), gain.shape)
                if gain[f, b] <= 1e-6 or b >= len(edges[f]):
                    continue
                goes = binned[rows, f] <= b
                feature[at], cut[at], left[at], right[at] = int(f), float(edges[f][b]), node(0.0), node(0.0)
                following += [(left[at], rows[goes]), (right[at], rows[~goes])]
            level = following
        total += step
    arrays = [np.array(a, k) for a, k in ((feature, np.int64), (cut, float), (left, np.int64), (right, np.int64), (value, float), (roots, np.int64))]
    return Trees(*arrays, start, depth)


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    fit_rows: int = FIT_ROWS, threshold: float = 0.7,
) -> tuple[DataFrame, Trees]:
    """``(doc_id, held_out, score, predicted)`` for each row, and the trees.

    Rows whose crc32 of the id as text leaves 2 when divided by 4 are held out: their labels are never seen. The trees are grown on about ``fit_rows`` of the
    other labelled rows, chosen by a hash of the id. Only the text is an input. Null and empty texts are scored from zeros. A null id is
    scored, has no label and is not held out. A document with several labels takes part with each. Without labels of both kinds, scores are the labels' mean (0.5 without any).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = [statistics(t) for t in texts(part)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.list_(pa.float64()))], names=["doc_id", "x"])

    measured = stage(rows.mapInArrow(measure, "doc_id long, x array<double>"), "statistics")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    seen = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("doc_id is not null and y is not null").filter(~held)
    share = min(1.0, fit_rows / max(seen.count(), 1))
    seen = seen.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    sample = measured.join(seen, "doc_id").select("doc_id", "x", "y").orderBy("doc_id", "y").collect()  # about fit_rows rows at most
    x = np.array([r["x"] for r in sample], float).reshape(len(sample), len(FEATURES))
    trees = grow(x, np.array([r["y"] for r in sample], float))

    def predict(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            score = trees.score(np.array(part.column("x").to_pylist(), float).reshape(part.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    scored = measured.mapInArrow(predict, "doc_id long, score double")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")), trees
