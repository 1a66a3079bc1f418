"""Toxicity of a text whose bad words may be disguised.

Disguised tokens (1d10t, i.d.i.o.t, s t u p i d, looooser) are read as noisy
spellings: every character stands for itself, for letters it looks like, or
for nothing. The likeliest letters under a character model of all documents
are found by the Viterbi algorithm over that lattice, whose cost grows with the
length of the token alone, so tokens and runs of any length are read whole. A
token of letters, two of them doubled, or without any letter, counts as it
stands and as it is read. The restored words and
their beginnings are weighed by a logistic regression learned from labels.

The character model is a trigram model over the counts of all words of all
documents. Weights are learned from a bounded sample of labelled documents
outside the held-out fold.

Defined cases: a null or empty text scores what no words score; without labels
every score is 0; a document labelled twice counts by its higher label; very
long texts count whole; repeated rows are scored each; an empty table gives no
rows. Columns other than doc_id, text and the labels' toxic are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from .common import about, fold_of
from .ftrl import train

FOLDS, HELD_OUT = 5, 0
LABELLED = 6000  # documents that weights are learned from, about
DIMS = 1 << 18
SYMBOLS = 64
_MEMO = 400_000  # tokens remembered by a task
_REMEMBERED = 256  # characters of the longest token that is remembered

# Letters that a character may stand for.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
_ENDS = ".,;:?\"'()[]{}<>»«“”„…*#%&-_=~/\\"
_SPACED = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")
_REPEATED = re.compile(r"(.)\1\1")
_DOUBLED = re.compile(r"(.)\1")
_COST_LOOK, _COST_DROP, _COST_SKIP, _COST_BREAK = 1.0, 0.5, 9.0, 0.5


def symbol(letter: str) -> int:
    """0 for a word's border, 1-26 for a-z, more for other letters."""
    code = ord(letter)
    if 97 <= code <= 122:
        return code - 96
    return 27 + code % (SYMBOLS - 27)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): lower-case words of letters only, over all documents.

    Not those with a letter three times in a row: they would teach the model
    that long runs are likely.
    """
    def count(batches):
        held = Counter()
        for batch in batches:
            for text in batch.column("text"):
                held.update((text.as_py() or "").lower().split())
            if len(held) > _MEMO:
                yield _counted(held)
                held = Counter()
        yield _counted(held)

    return docs.select("text").mapInArrow(count, "word STRING, n BIGINT").groupBy("word").agg(
        F.sum("n").alias("n"))


def _counted(held: Counter):
    words = Counter()
    for token, n in held.items():
        word = token.strip(_ENDS)
        if word.isalpha() and not _REPEATED.search(word):
            words[word] += n
    return pa.RecordBatch.from_arrays(
        [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])


def character_model(counts: DataFrame) -> np.ndarray:
    """Logarithms of P(c | a, b) by [a, b, c]; SYMBOLS ** 3 numbers for any corpus."""
    def fold(batches):
        total = np.zeros(SYMBOLS ** 3)
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                a = b = 0
                for letter in word:
                    c = symbol(letter)
                    total[(a * SYMBOLS + b) * SYMBOLS + c] += n
                    a, b = b, c
                total[(a * SYMBOLS + b) * SYMBOLS] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    parts = counts.mapInArrow(fold, "at BIGINT, n DOUBLE").groupBy("at").agg(F.sum("n").alias("n"))
    found = parts.toPandas()
    three = np.zeros(SYMBOLS ** 3)
    three[found["at"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=float)
    three = three.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two = three.sum(axis=0)
    one = two.sum(axis=0) + 1.0
    p = one / one.sum()
    p = (two + 20.0 * p) / (two.sum(axis=1, keepdims=True) + 20.0)
    p = (three + 20.0 * p[None]) / (three.sum(axis=2, keepdims=True) + 20.0)
    return np.log(p).astype(np.float32)


def restore(token: str, model: list) -> str:
    """The likeliest words that ``token``, in lower case, disguises.

    ``model`` is flat. A state is the last two letters, so there are no more
    than SYMBOLS ** 2 of them; each holds its score and its last letter, linked
    to those before.
    """
    beams = {0: (0.0, None)}
    last = ""
    for char in token:
        options = []
        if char.isalpha():
            options.append((char, symbol(char), 0.0))
            if char == last:
                options.append(("", 0, _COST_DROP))
        elif char == " ":
            options += [("", 0, _COST_DROP), (" ", 0, _COST_BREAK)]
        else:
            options += [(letter, symbol(letter), _COST_LOOK) for letter in LOOKS.get(char, "")]
            options.append(("", 0, _COST_SKIP if char in LOOKS else _COST_DROP))
        last, new = char, {}
        for state, (score, letters) in beams.items():
            for letter, code, cost in options:
                if not letter:
                    to, gain, held = state, score - cost, letters
                else:
                    at = state * SYMBOLS + code
                    to, gain = (at % SYMBOLS ** 2 if code else 0), score + model[at] - cost
                    held = (letter, letters)
                if to not in new or new[to][0] < gain:
                    new[to] = (gain, held)
        beams = new
    _, letters = max(((score + model[state * SYMBOLS], held) for state, (score, held) in beams.items()),
                     key=lambda end: end[0])
    out = []
    while letters:
        letter, letters = letters
        out.append(letter)
    return "".join(reversed(out)).strip()


class Features(dict):
    """Feature ids of a lower-case token, worked out once per token."""

    def __init__(self, model: np.ndarray):
        self.model = model.ravel().tolist()

    def __missing__(self, token: str) -> tuple:
        if len(self) >= _MEMO:
            self.clear()
        found = self._ids(token)
        if len(token) <= _REMEMBERED:
            self[token] = found
        return found

    def _ids(self, token: str) -> tuple:
        word = token.strip(_ENDS)
        found = set()
        if word.isalpha() and not _REPEATED.search(word):
            found.add(word)
            if _DOUBLED.search(word):
                found.update(restore(word, self.model).split())
        else:
            if not any(map(str.isalpha, word)):
                found.update(word.split())
            if any(c.isalpha() or c in LOOKS for c in word):
                found.update(restore(word, self.model).split())
        return tuple({i for w in found for i in word_ids(w)})


def word_ids(word: str) -> list:
    parts = [word, *(f"^{word[:n]}" for n in (4, 5, 6) if len(word) > n)]
    return [zlib.crc32(p.encode()) % DIMS for p in parts]


def tokens_of(text: str) -> set:
    """Distinct lower-case tokens; a run of single characters is one more."""
    low = text.lower()
    tokens = set(low.split())
    tokens.update(_SPACED.findall(low))
    return tokens


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, labelled: int = LABELLED) -> tuple | None:
    """(weights, bias) of two classes, or None without labels of both."""
    known = labels.where(F.col("toxic").isNotNull() & (fold_of(F.col("doc_id"), FOLDS) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # About ``labelled`` rows, so their number is bounded by that parameter.
    chosen = lookup_join(docs.select("doc_id", "text"), about(known, labelled), "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        features = Features(shared.value)
        for batch in batches:
            packed = []
            for text in batch.column("text"):
                counts = Counter(i for t in tokens_of(text.as_py() or "") for i in features[t])
                packed.append(np.array(list(counts.items()), dtype="<i4").reshape(-1, 2).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.string()), batch.column("toxic"),
                 pa.array(packed, pa.binary())], names=["doc_id", "toxic", "packed"])

    sample = chosen.mapInArrow(rows, "doc_id STRING, toxic INT, packed BINARY").collect()
    sample.sort(key=lambda r: (r.doc_id, bytes(r.packed)))
    y = np.array([r.toxic for r in sample], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        return None
    x = []
    for r in sample:
        pairs = np.frombuffer(r.packed, dtype="<i4").reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0])]
        x.append((pairs[:, 0].copy(), np.minimum(pairs[:, 1], 3).astype(np.float32)))
    del sample
    return train(x, (y > 0).astype(np.int64), 2, DIMS, alpha=0.5, l1=2.0, l2=0.1, epochs=6)


class TokenScores(dict):
    """What a token adds to the log-odds of toxic."""

    def __init__(self, features: Features, weights: dict):
        self.features, self.weights = features, weights

    def __missing__(self, token: str) -> float:
        if len(self) >= _MEMO:
            self.clear()
        get = self.weights.get
        found = sum(get(i, 0.0) for i in self.features._ids(token))
        if len(token) <= _REMEMBERED:
            self[token] = found
        return found


def scored(docs: DataFrame, labels: DataFrame, name: str = "score", labelled: int = LABELLED) -> DataFrame:
    """The documents with one more column, their score from 0 to 1."""
    if name in docs.columns:
        raise ValueError(f"the documents have a column {name} already")
    model = character_model(word_counts(docs))
    learned = learn(docs, labels, model, labelled)
    if learned is None:
        return docs.withColumn(name, F.lit(0.0))
    weights, bias = learned
    odds = weights[:, 1] - weights[:, 0]
    used = {int(i): float(odds[i]) for i in np.flatnonzero(odds)}
    shared = docs.sparkSession.sparkContext.broadcast((model, used, float(bias[1] - bias[0])))
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def score(batches):
        model, used, start = shared.value
        worth = TokenScores(Features(model), used)
        for batch in batches:
            odds = np.array([start + sum(sorted(map(worth.__getitem__, tokens_of(text.as_py() or ""))))
                             for text in batch.column("text")])
            scores = 1.0 / (1.0 + np.exp(-np.clip(odds, -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=schema.names)

    return docs.mapInArrow(score, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document."""
    held_out = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored(docs.select("doc_id", "text"), labels, **options).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
