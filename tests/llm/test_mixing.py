import re
from collections import defaultdict

import pytest

from quillmesh.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id BIGINT, text STRING, source STRING, size INT, block STRING"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 7, "x") for row in rows], SCHEMA)


def targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, stop sources at their caps, share the excess, again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = {}
    while True:
        rest = sum(sizes.values()) - sum(capped.values())
        open_weight = sum(w for s, w in weight.items() if s not in capped)
        found = {s: rest * w / open_weight for s, w in weight.items() if s not in capped}
        above = [s for s in found if found[s] > most * sizes[s]]
        if not above:
            return found | capped
        capped |= {s: float(most * sizes[s]) for s in above}


@pytest.fixture
def rows():
    out = [(i, " ".join(["w"] * (i % 37)), f"s{i % 3}" if i % 3 else "hot") for i in range(900)]
    out += [(1000 + i, "a b\tc\n d", None) for i in range(20)]
    out += [(2000, None, "tiny"), (2001, "", "tiny"), (2002, "one", "tiny"), (2003, " \n", "empty")]
    return out + [(5, "same row", "s2")] * 3


def test_targets_and_taken_words(spark, rows):
    got = mixing.taken_words(mixing.mix(frame(spark, rows), block_words=64)).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = targets(sizes)
    taken = defaultdict(int)
    source_of = {doc_id: source for doc_id, _, source in rows if doc_id != 5}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        if r.doc_id != 5:
            assert r.source_size == sizes[source_of[r.doc_id]]
            assert r.target == pytest.approx(want[source_of[r.doc_id]])
        taken[r.target, r.source_size] += r.taken
    for (target, _), n in taken.items():
        assert abs(n - target) <= 1


def test_reruns_agree_and_slots_interleave(spark, rows):
    docs = frame(spark, rows)
    runs = [sorted(map(tuple, mixing.taken_words(mixing.mix(docs.repartition(n))).collect()), key=str)
            for n in (2, 5)]
    assert runs[0] == runs[1]
    slots = [r.source_key for r in mixing.mix(docs, block_words=16).pieces.orderBy("slot").collect()]
    first = slots[: len(slots) // 4]
    assert set(first) >= {"=s1", "=s2", "=hot"}


def test_empty_and_wordless(spark):
    assert mixing.taken_words(mixing.mix(frame(spark, []))).count() == 0
    got = mixing.taken_words(mixing.mix(frame(spark, [(1, None, None), (2, "", "a")]))).collect()
    assert {(r["size"], r.target, r.taken) for r in got} == {(0, 0.0, 0)}


def test_mixed_documents(spark, rows):
    docs = frame(spark, rows)
    got = mixing.mixed_documents(docs, block_words=64)
    assert got.columns == docs.columns
    taken = {r.target: 0 for r in mixing.taken_words(mixing.mix(docs)).collect()}
    assert sum(len(WORD.findall(r.text)) for r in got.collect()) == pytest.approx(sum(taken), rel=0.05)
