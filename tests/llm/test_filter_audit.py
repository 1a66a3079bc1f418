import itertools
import re
from collections import defaultdict

import numpy as np
import pytest

from quillmesh.llm import filter_audit

SCHEMA = "doc_id BIGINT, lang STRING, text STRING, row INT, part INT, fails STRING, held STRING, good INT"
LABELS = "doc_id BIGINT, quality INT, toxic INT, range STRING"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "x", "y", 3) for row in rows], SCHEMA).repartition(3)


def brute(docs, labels):
    first = {}
    for doc_id, _, text in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    marks = {
        name: {doc for doc, *marks in labels if marks[at] == 1 and doc is not None}
        for at, name in enumerate(("good", "toxic"))}
    parts = defaultdict(list)
    for doc_id, lang, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "".join(
            name for name, failed in zip("ABCDE", (
                len(words) < 200, 100 * len(set(words)) < 50 * len(words),
                100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search("[#$%&*|]", text)),
                doc_id is not None and first[text] < doc_id)) if failed)
        parts[lang or ""].append((fails, doc_id in marks["good"], doc_id in marks["toxic"]))
    rows = set()
    for part, held in parts.items():
        shapley = defaultdict(int)
        steps = []
        for order in itertools.permutations("ABCDE"):
            left = held
            for step, name in enumerate(order, 1):
                gone = [h for h in left if name in h[0]]
                left = [h for h in left if name not in h[0]]
                shapley[name] += len(gone)
                steps.append((
                    part, "".join(order), step, len(left), len(gone), sum(name in h[0] for h in held) - len(gone),
                    sum(h[0] == name for h in held), sum(h[1] for h in gone), sum(h[2] for h in gone), name))
        rows |= {(*step[:-1], shapley[step[-1]]) for step in steps}
    return rows


def made(seed, n=150):
    rng = np.random.default_rng(seed)
    docs = []
    for doc_id in range(n):
        words = [f"w{rng.integers(60 if rng.random() < 0.5 else 400)}" for _ in range(rng.integers(0, 450))]
        text = " ".join(w.upper() if rng.random() < 0.05 else w for w in words) + rng.choice(["", "", "#", "%|"])
        docs.append((doc_id, [None, "", "en", "de"][rng.integers(4)], text))
    copies = [(int(d) + n, lang, text) for d, lang, text in docs[::7]]
    docs += copies + [copies[0], (None, "en", docs[0][2]), (9001, "fr", None), (9000, "fr", ""), (9000, "fr", "a b")]
    labels = [(int(d), int(rng.integers(2)), int(rng.integers(2))) for d in rng.integers(0, n + 40, 120)]
    return docs, labels + [(None, 1, 1), (3, None, 1)]


@pytest.mark.parametrize("size", [1 << 16, 8])
def test_audit_equals_brute_force(spark, monkeypatch, size):
    docs, labels = made(3)
    monkeypatch.setattr(filter_audit, "RANGE", size)
    monkeypatch.setattr(filter_audit, "STRETCH", max(2, size >> 4))
    marks = spark.createDataFrame([(*row, "x") for row in labels], LABELS)
    got = filter_audit.audit(frame(spark, docs), marks)
    assert {tuple(row) for row in got.collect()} == brute(docs, labels)


def test_merges():
    rng = np.random.default_rng(9)
    for spread in (10, 1000, 10 ** 7):
        lists = [np.unique(rng.integers(0, spread, rng.integers(0, 300))) for _ in range(4)]
        assert filter_audit.union(lists).tolist() == sorted(set().union(*map(set, map(np.ndarray.tolist, lists))))
        a, b = lists[:2]
        assert filter_audit.difference(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))
        for bound in (0, spread // 3, spread):
            assert filter_audit.gallop(a, 0, bound) == int(np.searchsorted(a, bound))


def test_empty_table(spark):
    assert filter_audit.audit(frame(spark, []), spark.createDataFrame([], LABELS)).collect() == []
