import re
from collections import defaultdict

import numpy as np
import pytest

from quillmesh.llm import ngram_join

SCHEMA = "doc_id BIGINT, text STRING, row INT, key STRING, name INT, size INT, id INT, tree INT, root STRING"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", 2, 3, 4, 5, "y") for row in rows], SCHEMA).repartition(3)


def set_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset(" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def brute(docs):
    """Rows in any order: (doc_id, size, least doc_id reachable)."""
    sets = [set_of(text) for _, text in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc_id, _) in enumerate(docs):
        known = [d for d in (least[find(i)], doc_id) if d is not None]
        least[find(i)] = min(known) if known else None
    return sorted(((d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def made(seed):
    """Copies with changed words, cut ends, chains, one large group, one shared passage, short texts."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(3000)}"
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(40):
        texts.append([word() for _ in range(int(np.exp(rng.uniform(0, 6.3))))])
    for base in texts[:40]:
        for _ in range(3):
            changed = list(base)
            for _ in range(rng.integers(0, 1 + len(base) // 25)):
                changed[rng.integers(len(changed))] = word()
            texts.append(changed[:len(changed) - int(rng.integers(0, 1 + len(changed) // 8))] or [word()])
    long = [word() for _ in range(120)]
    for at in range(40):
        texts.append(long[at:] + [f"v{k}" for k in range(at)])  # a chain, ever further from its start
    template = [word() for _ in range(200)]
    for _ in range(60):
        copy = list(template)
        copy[rng.integers(200)] = word()
        texts.append(copy)
    texts += [passage + [word() for _ in range(rng.integers(10, 60))] for _ in range(30)]
    docs = [(int(d), " ".join(t)) for d, t in zip(rng.permutation(len(texts)), texts)]
    docs += [(9000, None), (9001, ""), (9002, " \n"), (9003, "One Two"), (9004, "one\ttwo"), (9005, "one"),
             (9006, "é É x"), (9007, "É é x"), (9008, docs[5][1].upper()), (9009, "x " * 400), (9010, "x x x x"),
             (None, docs[6][1]), (None, "all alone here"), (4, docs[9][1]), (9011, docs[7][1]), (9011, docs[7][1])]
    return docs


@pytest.mark.parametrize("leaf, seed", [(256, 1), (4, 2)])
def test_classes_equal_brute_force(spark, leaf, seed):
    docs = made(seed)
    got = ngram_join.ngram_classes(frame(spark, docs), leaf=leaf).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)


def test_alike_sets_share_a_tree():
    """All pairs at the edge, also where sizes fall into two classes or groups are empty."""
    classes, rng = ngram_join.Classes(85), np.random.default_rng(4)
    for size in [*range(1, 60), *rng.integers(60, 3000, 150).tolist()]:
        for both in {int(classes.shared(size, size)), size}:
            for more in {size, int(100 * size / 85)}:
                both = max(both, int(classes.shared(size, more)))
                if both > min(size, more):
                    continue
                held = rng.integers(0, 1 << 63, size + more, dtype=np.uint64)
                a, b = np.sort(held[:size]), np.sort(np.concatenate([held[:both], held[size:size + more - both]]))
                assert 100 * both >= 85 * (size + more - both)
                trees = [{(k, t) for k in classes.of(len(x)) for t in classes.trees(x, k).tolist()} for x in (a, b)]
                home = {classes.of(len(x))[0] for x in (a, b)}
                met = {k for k, _ in trees[0] & trees[1]}
                assert met & home
                for k in met:
                    assert np.minimum(classes.point(a, k), classes.point(b, k)).sum() >= both


def test_points_prune_unrelated_sets(spark):
    rng = np.random.default_rng(6)
    held = [np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64)) for _ in range(60)]
    classes = ngram_join.Classes(85)
    points = [classes.point(h, classes.of(500)[0]) for h in held]
    passed = sum(np.minimum(x, y).sum() >= classes.shared(500, 500) for x in points for y in points)
    assert passed == len(held)


def test_empty_table(spark):
    assert ngram_join.ngram_classes(frame(spark, [])).collect() == []
