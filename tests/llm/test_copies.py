from collections import Counter

import numpy as np
import pytest
import xxhash

from quillmesh.llm import components, simhash, substrings

SCHEMA = "doc_id BIGINT, text STRING, fp STRING, rank INT"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)


def brute_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(names, linked):
    parent = {n: n for n in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in names:
        for b in names:
            if a < b and linked(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {n: root(n) for n in names}


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (250, 2))] + [(0, i) for i in range(500, 560)]
    links += [(i, i + 1) for i in range(1000, 1060)]
    pairs = {frozenset(x) for x in links if x[0] != x[1]}
    names = sorted({x for pair in pairs for x in pair})
    want = roots_of(names, lambda a, b: frozenset((a, b)) in pairs)
    got = components.components(spark.createDataFrame(links, "a BIGINT, b BIGINT"))
    assert {r.id: r.root for r in got.collect()} == want
    assert components.components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


@pytest.mark.parametrize("tile", [2048, 3])
def test_simhash_classes(spark, tables, tile):
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()]
    rows += [(9000, None), (9001, ""), (9002, "One Two"), (9003, "one  two"), (9004, "é É x y"), (5, rows[9][1]),
             (9005, rows[3][1]), (9005, rows[3][1])]
    got = simhash.simhash_classes(frame(spark, rows), tile=tile).collect()
    assert len(got) == len(rows)
    fps = sorted({brute_fingerprint(t) for _, t in rows})
    roots = roots_of(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, t in rows:
        root = roots[brute_fingerprint(t)]
        least[root] = min(least.get(root, i), i)
    want = sorted((i, brute_fingerprint(t).to_bytes(8, "big"), least[roots[brute_fingerprint(t)]]) for i, t in rows)
    assert sorted((r.doc_id, bytes(r.fp), r.component_id) for r in got) == want
    assert simhash.simhash_classes(frame(spark, [])).count() == 0


def test_one_document_of_each_class_stays(spark, tables):
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()]
    rows += [(9000, None), (9001, ""), (9002, "One Two"), (9003, "one  two"), (9005, rows[3][1]), (9005, rows[3][1])]
    classes = {r.component_id for r in simhash.simhash_classes(frame(spark, rows)).collect()}
    got = simhash.deduplicated(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "fp", "rank"]
    assert sorted(r.doc_id for r in got.collect()) == sorted(classes)


def test_near_copies_go_and_others_stay(spark):
    rng = np.random.default_rng(6)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for _ in range(40):
        words = list(rng.choice(vocabulary, 300))
        for k in range(3):
            copy = list(words)
            if k:
                copy[int(rng.integers(300))] = "other"
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n, rows[0][1]), (n, rows[0][1])]
    got = simhash.deduplicated(frame(spark, rows), **simhash.NEAR)
    assert got.columns == ["doc_id", "text", "fp", "rank"]
    assert sorted(r.doc_id for r in got.collect()) == list(range(0, 120, 3))


def jaccard(x, y):
    x, y = ({tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in (x, y))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("tile", [2048, 5])
def test_near_copies_are_verified(spark, tile):
    # (n - 10) shared of n + 10 shingles, and so on: an index just under or over what is wanted.
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows, want = [], []
    for near in [0.65, 0.7, 0.75, 0.79, 0.8, 0.81, 0.85] * 8:
        words = list(rng.choice(vocabulary, 364))
        fresh = round(360 * (1 - near) / (1 + near) + (0.49 if near < 0.8 else -0.49))
        other = words[:364 - fresh] + [f"x{rng.integers(10 ** 9)}" for _ in range(fresh)]
        x, y = " ".join(words), " ".join(other)
        assert abs(jaccard(x, y) - near) < 0.005 and (jaccard(x, y) >= 0.8) == (near >= 0.8)
        rows += [(len(rows), x), (len(rows) + 1, y)]
        want += [len(rows) - 2] + [len(rows) - 1] * (near < 0.8)
    # One fingerprint, but sets that share one of three shingles.
    rows += [(900, "a " * 40 + "b"), (901, "a " * 40 + "c"), (902, None), (903, " "), (904, "One two"), (905, "one  two")]
    want += [900, 901, 902, 904]
    got = simhash.deduplicated(frame(spark, rows), tile=tile, **simhash.NEAR)
    assert sorted(r.doc_id for r in got.collect()) == want


def test_repeated_starts():
    rng = np.random.default_rng(0)
    for _ in range(60):
        base = bytes(rng.integers(97, 100, 300).astype("u1"))
        texts = []
        for _ in range(6):
            a, b = sorted(rng.integers(0, 300, 2))
            texts.append(base[a:b] + bytes(rng.integers(97, 100, rng.integers(0, 40)).astype("u1")))
        n = int(rng.integers(3, 30))
        counts = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
        want = [[i for i in range(len(t) - n + 1) if counts[t[i:i + n]] > 1] for t in texts]
        assert [x.tolist() for x in substrings.repeated_starts(texts, n)] == want


@pytest.mark.parametrize("length, gram, many", [(400, 64, 2000), (60, 16, 2000), (60, 16, 1)])
def test_repeats_against_brute_force(spark, tables, length, gram, many):
    rows = [(r.doc_id, r.text) for r in tables("documents").limit(120).collect()]
    rows += [(9000, None), (9001, "x" * (length - 1)), (9002, "ab" * 500), (9003, "é" * 300), (9004, "z" * length),
             (9005, rows[7][1]), (9005, rows[7][1]), (5, rows[8][1])]
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    want = []
    for (doc_id, _), t in zip(rows, texts):
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if counts[t[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((doc_id, len(t), int(gone.sum()), runs, bytes(np.frombuffer(t, "u1")[~gone])))
    got = substrings.without_repeats(frame(spark, rows), length, gram, many).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(want)
    assert substrings.without_repeats(frame(spark, []), length, gram, many).count() == 0
