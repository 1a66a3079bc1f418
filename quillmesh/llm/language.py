"""Language of a text: logistic regression on TF-IDF of character n-grams.

Runs of one to three characters are hashed; a text is the relative counts of
them times the inverse document frequency. Document frequencies come from all
texts that may be learned from, weights from a bounded sample of them by
language, with an elastic net. A part of the sample is held back to find the
temperature that makes scores probabilities.

Defined cases: a null text, or one without any letter, is ``und`` with score 0;
so is every text if there is nothing to learn from; very long texts count
whole; repeated rows are scored each; an empty table gives no rows. Columns
other than doc_id, text and lang are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of
from .ftrl import softmax, temperature, train

DIMS = 1 << 16
FOLDS, HELD_OUT = 4, 2
PER_LANGUAGE = 600  # texts that weights are learned from, about
_SCALE = 32.0
_SPAN = 1 << 20  # characters worked on at once
_UNKNOWN = "und"


def grams(text: str):
    """Hashed n-grams of a text, a part at a time; parts overlap by two characters."""
    low = " " + text.lower() + " "
    for at in range(0, len(low), _SPAN):
        c = np.frombuffer(low[at:at + _SPAN + 2].encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        one = c * np.uint64(0x9E3779B97F4A7C15)
        two = one[:-1] * np.uint64(0xD1342543DE82EF95) + one[1:]
        three = two[:-1] * np.uint64(0xD1342543DE82EF95) + one[2:]
        most = min(_SPAN, len(low) - at)
        parts = (one[:most], two[:most], three[:most])
        yield np.concatenate([(p * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48) for p in parts])


def _counts(text: str) -> np.ndarray:
    total = np.zeros(DIMS, dtype=np.int64)
    for ids in grams(text):
        total += np.bincount(ids.astype(np.int64), minlength=DIMS)
    return total


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> dict | None:
    """The model: languages, a table of DIMS rows of weights, bias and temperature."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                       & (fold_of(F.col("doc_id"), FOLDS) != HELD_OUT))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)

    def frequencies(batches):
        total, seen = np.zeros(DIMS, dtype=np.int64), np.zeros(DIMS, dtype=bool)
        for batch in batches:
            for text in batch.column("text"):
                seen[:] = False
                for ids in grams(text.as_py()):
                    seen[ids] = True
                total += seen
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    sums = known.select("text").mapInArrow(frequencies, "gram BIGINT, n BIGINT")
    found = sums.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(DIMS)
    seen[found["gram"].to_numpy(dtype=np.int64)] = found["n"].to_numpy()
    idf = np.log((1 + sum(counts.values())) / (1 + seen)) + 1e-3

    part = 1 << 30
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(part))
    shares = F.create_map(*(F.lit(x) for lang in languages
                            for x in (lang, min(part, int(per_language / counts[lang] * part)))))
    chosen = known.where(place < shares[F.col("lang")])

    def rows(batches):
        for batch in batches:
            at, values = [], []
            for text in batch.column("text"):
                total = _counts(text.as_py())
                ids = np.flatnonzero(total)
                at.append(ids.astype("<u2").tobytes())
                values.append((total[ids] / total.sum()).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.string()), batch.column("lang"), pa.array(at, pa.binary()),
                 pa.array(values, pa.binary())], names=["doc_id", "lang", "at", "values"])

    sample = chosen.select("doc_id", "lang", "text").mapInArrow(
        rows, "doc_id STRING, lang STRING, at BINARY, values BINARY").collect()
    sample.sort(key=lambda r: (r.doc_id, r.lang, bytes(r["at"]), bytes(r["values"])))
    x = []
    for r in sample:
        at = np.frombuffer(r["at"], dtype="<u2")
        x.append((at, (np.frombuffer(r["values"], dtype="<f4") * idf[at] * _SCALE).astype(np.float32)))
    y = np.array([languages.index(r.lang) for r in sample], dtype=np.int64)
    back = np.arange(len(y)) % 5 == 4
    weights, bias = train([r for r, b in zip(x, back) if not b], y[~back], len(languages), DIMS,
                          l1=0.02, l2=0.02, epochs=6)
    logits = np.array([v @ weights[at] + bias for (at, v), b in zip(x, back) if b])
    return {
        "languages": languages,
        "table": (weights * idf[:, None] * _SCALE).astype(np.float32),
        "bias": bias,
        "temperature": temperature(logits, y[back]) if back.any() else 1.0,
    }


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT,
                                            F.lit(False)).alias("held_out"), "text")
    schema = rows.select("doc_id", "held_out", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def score(batches):
        m = shared.value
        for batch in batches:
            names, scores = [], []
            for text in batch.column("text"):
                text = text.as_py()
                if m is None or text is None or not _has_letter(text):
                    names.append(_UNKNOWN)
                    scores.append(0.0)
                    continue
                total, n = np.zeros(len(m["languages"])), 0
                for ids in grams(text):
                    total += m["table"].take(ids.astype(np.int64), axis=0).sum(axis=0, dtype=np.float64)
                    n += len(ids)
                p = softmax((total / n + m["bias"]) / m["temperature"])
                names.append(m["languages"][int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(score, schema)
