"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are fitted on a bounded sample of labelled documents and flattened into
arrays; scoring walks all trees of a batch of documents with numpy. The score
uses statistics of the whole text only.

Defined results: a null text counts as empty; an empty text has all-zero
statistics and is scored like any other; equal texts get equal scores; without
any labelled row, or with one class only, every score is the smoothed share of
label 1 (0.5 for none). Input columns are kept as they are.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows that the classifier is fitted on.
SAMPLE_ROWS = 20_000

_BYTE_CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": b"0123456789",
    "space": b" \t\n\x0b\x0c\r",
    "symbol": b"#*$%&|<>",
    "other_mark": b"\"'()/:;@[]^_`{}~\\+-=",
    "exclaim": b"!",
    "question": b"?",
    "stop": b".",
    "comma": b",",
    "bar": b"|",
    "control": bytes([*range(9), *range(14, 32), 127]),
    "high": bytes(range(128, 256)),
}
_CLASS_OF_BYTE = np.zeros((256, len(_BYTE_CLASSES)))
for _i, _bytes in enumerate(_BYTE_CLASSES.values()):
    _CLASS_OF_BYTE[list(_bytes), _i] = 1

N_FEATURES = len(_BYTE_CLASSES) + 16


def document_statistics(text):
    """Statistics of one whole text as a vector of ``N_FEATURES`` numbers."""
    raw = (text or "").encode("utf-8")
    out = np.zeros(N_FEATURES, np.float64)
    words = raw.split()
    if not words:
        return out
    n, size = len(words), len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    classes = counts @ _CLASS_OF_BYTE
    shares = counts[counts > 0] / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    frequency = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    out[: len(_BYTE_CLASSES)] = classes / size
    out[len(_BYTE_CLASSES) :] = (
        np.log1p(n),
        np.log1p(size),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        (lengths <= 3).mean(),
        classes[0] / max(1.0, classes[0] + classes[1]),
        len(frequency) / n,
        max(frequency.values()) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        np.log1p(len(lines)),
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        -(shares * np.log2(shares)).sum(),
        classes[8] / n,
        (classes[4] + classes[6]) / n,
    )
    return out


def _batch_statistics(texts: pa.Array) -> np.ndarray:
    out = np.zeros((len(texts), N_FEATURES))
    for i in range(len(texts)):
        out[i] = document_statistics(texts[i].as_py())
    return out


@dataclass
class Trees:
    """Complete binary trees as arrays: node ``i`` has the children ``2i+1`` and ``2i+2``."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x):
        """Probability of label 1 for each row of ``x``; walks all trees at once, level by level."""
        trees = len(self.feature)
        if not trees or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        out = np.empty(len(x))
        tree = np.arange(trees)
        for start in range(0, len(x), 2048):
            part = x[start : start + 2048]
            row = np.arange(len(part))[:, None]
            node = np.zeros((len(part), trees), np.int64)
            for _ in range(self.depth):
                right = part[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            out[start : start + 2048] = self.base + self.value[tree, node].sum(1)
        return 1 / (1 + np.exp(-out))


def fit_trees(x, y, trees=80, depth=4, rate=0.1, bins=64, ridge=1.0, least_rows=20) -> Trees:
    """Boost trees on the logistic loss; splits are searched on histograms of gradients over quantile bins."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2)
    inner, total = 2**depth - 1, 2 ** (depth + 1) - 1
    base = float(np.log(share / (1 - share)))
    feature = np.zeros((trees, total), np.int64)
    threshold = np.full((trees, total), np.inf)
    value = np.zeros((trees, total))
    if n == 0 or y.min() == y.max():
        return Trees(base, feature[:0], threshold[:0], value[:0], depth)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            slot = node - first
            best = np.full(width, 1e-6)
            pick = [None] * width
            g = np.bincount(slot, gradient, width)
            h = np.bincount(slot, weight, width)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                k = len(e) + 1
                at = slot * k + binned[:, f]
                shape = (width, k)
                gl = np.bincount(at, gradient, width * k).reshape(shape).cumsum(1)[:, :-1]
                hl = np.bincount(at, weight, width * k).reshape(shape).cumsum(1)[:, :-1]
                cl = np.bincount(at, minlength=width * k).reshape(shape).cumsum(1)
                gr, hr, cr = g[:, None] - gl, h[:, None] - hl, cl[:, -1:] - cl[:, :-1]
                cl = cl[:, :-1]
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (g**2 / (h + ridge))[:, None]
                gain[(cl < least_rows) | (cr < least_rows)] = 0
                at_best = gain.argmax(1)
                for s in np.flatnonzero(gain.max(1) > best):
                    best[s], pick[s] = gain[s, at_best[s]], (f, at_best[s])
            right = np.zeros(n, bool)
            for s, found in enumerate(pick):
                if found:
                    f, b = found
                    feature[t, first + s], threshold[t, first + s] = f, edges[f][b]
                    here = slot == s
                    right[here] = binned[here, f] > b
            node = 2 * node + 1 + right
        leaf = node - inner
        steps = -np.bincount(leaf, gradient, 2**depth) / (np.bincount(leaf, weight, 2**depth) + ridge)
        value[t, inner:] = rate * steps
        margin += value[t, node]
    return Trees(base, feature, threshold, value, depth)


def train(documents: DataFrame, labels: DataFrame, sample_rows=SAMPLE_ROWS, **settings) -> Trees:
    """Fit on at most ``sample_rows`` labelled documents, chosen by a hash of ``doc_id``.

    ``documents`` needs ``doc_id, text``; ``labels`` needs ``doc_id, quality``.
    Rows without a label or id teach nothing. Only the sample's ids are
    broadcast and only its statistics reach the driver, so both stay bounded.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("y")).dropna()
    share = min(1.0, 0.9 * sample_rows / max(1, known.count()))
    cut = int(share * 2**20)
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**20)) < cut).limit(sample_rows)

    @F.arrow_udf("array<double>")
    def statistics(texts: pa.Array) -> pa.Array:
        return pa.array(list(_batch_statistics(texts)), pa.list_(pa.float64()))

    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .limit(sample_rows)
        .select("y", statistics("text").alias("x"))
        .collect()
    )
    rows = sorted((list(r.x), r.y) for r in rows)
    x = np.array([r[0] for r in rows], np.float64).reshape(-1, N_FEATURES)
    return fit_trees(x, np.array([r[1] for r in rows], np.float64), **settings)


def quality_score(text: Column, model: Trees) -> Column:
    """Score of each whole text: the probability of label 1."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(_batch_statistics(texts)))

    return score(text)
