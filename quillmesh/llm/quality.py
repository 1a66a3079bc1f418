"""Quality of documents: boosted trees over statistics of the text.

One pass takes the statistics of every whole text. Trees are learned on a
bounded sample of labelled documents by the driver, from binned values, and
flattened into arrays of nodes, which score batches by walking all rows down a
tree at once. Chosen features are monotonic: their splits keep the worse side
no better than the other one, and bounds go down to the leaves.

Defined cases: a null or blank text has no words and fails the base rule;
without labels of both kinds the base rule decides alone; a document labelled
twice counts by its lower label; repeated rows are judged each; an empty table
gives no rows. Columns other than doc_id, text and the labels' quality are not
looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..sources.scratch import keep
from .common import about

LABELLED = 8000  # documents that trees are learned from, about
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATS = 50  # percent of words in repeated windows
KEEP_FROM = 0.5
_BLANKS = b" \t\n\r\x0b\x0c"
_TRAILING = bytes(range(0x80, 0xC0))

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Features by name; +1: more is never worse, -1: never better, 0: free.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbols_per_word": -1, "dup_lines_per_word": -1, "repeat_share": -1,
}


def text_stats(text: str) -> tuple:
    """The counts of STATS of one text."""
    raw = text.encode()
    words = raw.split()
    chars = len(raw.translate(None, _TRAILING + _BLANKS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.split(None, 1)]
    return (len(words), chars, symbols, len(lines) - len(set(lines)), _repeated_words(words))


def _repeated_words(words: list) -> int:
    """Words in windows of three words that come twice or more in the text."""
    if len(words) < 4:
        return 0
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) > 2_000_000:  # the products below would overflow
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(known) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    again = np.zeros(len(windows), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k:k + len(again)] |= again
    return int(covered.sum())


def document_stats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) per document."""
    schema = docs.select("doc_id", *(F.lit(0).cast("bigint").alias(c) for c in STATS)).schema

    def count(batches):
        for batch in batches:
            rows = [text_stats(text.as_py() or "") for text in batch.column("text")]
            numbers = np.array(rows, dtype=np.int64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(numbers[:, i]) for i in range(len(STATS)))],
                names=["doc_id", *STATS])

    return docs.select("doc_id", "text").mapInArrow(count, schema)


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATS * F.col("n_words"))


def features(stats: np.ndarray) -> np.ndarray:
    """FEATURES of rows of STATS."""
    words, chars, symbols, lines, repeats = stats.T.astype(float)
    each = np.maximum(words, 1.0)
    return np.column_stack([np.log1p(words), chars / each, symbols / each, lines / each, repeats / each])


class Trees:
    """Trees of one depth as arrays [tree, node]: feature, threshold, value.

    Node i has the children 2 i + 1 (at most the threshold) and 2 i + 2.
    """

    def __init__(self, feature, threshold, value, start: float, depth: int):
        self.feature, self.threshold, self.value = feature, threshold, value
        self.start, self.depth = start, depth

    def odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.odds(x)))


def boost(x: np.ndarray, y: np.ndarray, monotonic, trees: int = 60, depth: int = 3, rate: float = 0.2,
          least: float = 5.0, l2: float = 1.0, bins: int = 64) -> Trees:
    """Trees for the logistic loss of labels 0 and 1, by Newton steps."""
    nodes = 2 ** (depth + 1) - 1
    feature = np.zeros((trees, nodes), dtype=np.int64)
    threshold = np.full((trees, nodes), np.inf)
    value = np.zeros((trees, nodes))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)])
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    odds = np.full(len(y), start)
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-odds))
        grad, hess = p - y, p * (1 - p) + 1e-6
        node = np.zeros(len(y), dtype=np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for i in range(nodes // 2):
            rows = np.flatnonzero(node == i)
            low, high = bounds[i]
            best = _best_split(binned[rows], grad[rows], hess[rows], cuts, monotonic, low, high, least, l2)
            if best is None:  # all rows go left, with the same bounds
                bounds[2 * i + 1] = bounds[2 * i + 2] = (low, high)
                node[rows] = 2 * i + 1
                continue
            f, cut, left, right = best
            feature[t, i], threshold[t, i] = f, cuts[f][cut]
            node[rows] = np.where(binned[rows, f] <= cut, 2 * i + 1, 2 * i + 2)
            bounds[2 * i + 1] = bounds[2 * i + 2] = (low, high)
            middle = (left + right) / 2
            if monotonic[f] > 0:
                bounds[2 * i + 1], bounds[2 * i + 2] = (low, middle), (middle, high)
            elif monotonic[f] < 0:
                bounds[2 * i + 1], bounds[2 * i + 2] = (middle, high), (low, middle)
        for i in range(nodes // 2, nodes):
            rows = node == i
            raw = -grad[rows].sum() / (hess[rows].sum() + l2)
            value[t, i] = rate * float(np.clip(raw, *bounds[i]))
        odds += value[t, node]
    return Trees(feature, threshold, value, start, depth)


def _best_split(binned, grad, hess, cuts, monotonic, low, high, least, l2):
    """(feature, cut, left value, right value) of the greatest gain, or None."""
    best, found = 1e-6, None
    for f, cut in enumerate(cuts):
        if not len(cut):
            continue
        g = np.cumsum(np.bincount(binned[:, f], grad, len(cut) + 1))
        h = np.cumsum(np.bincount(binned[:, f], hess, len(cut) + 1))
        n = np.cumsum(np.bincount(binned[:, f], minlength=len(cut) + 1))
        gl, hl, gr, hr = g[:-1], h[:-1], g[-1] - g[:-1], h[-1] - h[:-1]
        left = np.clip(-gl / (hl + l2), low, high)
        right = np.clip(-gr / (hr + l2), low, high)
        gain = -(gl * left + (hl + l2) * left ** 2 / 2) - (gr * right + (hr + l2) * right ** 2 / 2)
        whole = np.clip(-g[-1] / (h[-1] + l2), low, high)
        gain += g[-1] * whole + (h[-1] + l2) * whole ** 2 / 2
        fair = (n[:-1] >= least) & (n[-1] - n[:-1] >= least)
        if monotonic[f]:
            fair &= monotonic[f] * (right - left) >= 0
        gain = np.where(fair, gain, -np.inf)
        at = int(gain.argmax())
        if gain[at] > best:
            best, found = gain[at], (f, at, float(left[at]), float(right[at]))
    return found


def learn(stats: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Trees | None:
    """Trees for quality = 1, or None without labels of both kinds."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").cast("int").alias("quality"))
    # About ``labelled`` rows, so their number is bounded by that parameter.
    sample = lookup_join(stats, about(known, labelled), "doc_id").toPandas()
    sample = sample.sort_values(["doc_id", *STATS])
    y = (sample["quality"].to_numpy() > 0).astype(float)
    if not 0 < y.sum() < len(y):
        return None
    return boost(features(sample[list(STATS)].to_numpy()), y, list(FEATURES.values()))


def judged(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(doc_id, STATS, base_failed, score, kept) per document."""
    stats = keep(document_stats(docs), "stats")
    trees = learn(stats, labels, labelled)
    rows = stats.withColumn("base_failed", base_failed())
    schema = rows.withColumn("score", F.lit(0.0)).schema

    def score(batches):
        for batch in batches:
            numbers = np.column_stack([batch.column(c).to_numpy() for c in STATS])
            p = np.ones(len(numbers)) if trees is None else trees.probability(features(numbers))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=schema.names)

    verdict = ~F.col("base_failed") & (F.col("score") >= KEEP_FROM)
    return rows.mapInArrow(score, schema).withColumn("kept", verdict)
