import random

import pytest

from quillmesh.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a):
        new = [i + 1]
        for j, d in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (c != d)))
        row = new
    return row[-1]


def changed(line, rng, most, letters="abcé "):
    chars = list(line)
    for _ in range(rng.randint(0, most)):
        at, kind = rng.randrange(len(chars) + 1), rng.randrange(3)
        if kind == 0:
            chars.insert(at, rng.choice(letters))
        elif chars and kind == 1:
            chars.pop(at % len(chars))
        elif chars:
            chars[at % len(chars)] = rng.choice(letters)
    return "".join(chars)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_distance_segments_and_signs(edits):
    rng = random.Random(edits)
    for _ in range(4000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = changed(a, rng, 6, "abc")
        true = distance(a, b)
        assert ld.edit_distance(a, b, edits) == min(true, edits + 1)
        if true <= edits:
            short, long = sorted((a, b), key=len)
            own = {(len(s), i, s[p:p + n]) for s in (short,) for i, (p, n) in enumerate(ld.segments(len(s), edits))}
            parts = {(n, i, long[p:p + size]) for n, i, p, size in ld.probes(len(long), edits)}
            parts |= {(len(long), i, long[p:p + n]) for i, (p, n) in enumerate(ld.segments(len(long), edits))}
            assert own & parts
            apart = bin((ld._signs(a) ^ ld._signs(b)) & (1 << 64) - 1).count("1")
            assert apart <= 4 * edits


@pytest.mark.parametrize("hot_lines", [20_000, 10])
def test_against_brute_force(spark, hot_lines):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.randint(10, 60))) for _ in range(30)]
    docs = [(i, "\n".join(changed(rng.choice(base), rng, 4) for _ in range(rng.randint(1, 6)))) for i in range(80)]
    docs += [(500, None), (501, ""), (None, base[0] + "\n" + base[1]), (3, docs[3][1])]
    frame = spark.createDataFrame([(i, t, len(t or ""), 1) for i, t in docs],
                                  "doc_id BIGINT, text STRING, n_chars BIGINT, line INT").repartition(3)
    lines = sorted({x for _, t in docs if t for x in t.split("\n") if len(x) >= ld.MIN_CHARS})
    parent, links = {x: x for x in lines}, dict.fromkeys(lines, 0)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[i + 1:]:
            if abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2:
                parent[root(a)] = root(b)
                links[a] += 1
                links[b] += 1
    first = {}
    for doc_id, text in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        for at, line in enumerate((text or "").split("\n")):
            if line in parent:
                first.setdefault(root(line), (doc_id, at))
    for r in ld.without_repeats(frame, hot_lines=hot_lines).collect():
        text = next(t for i, t in docs if i == r.doc_id)
        if text is None:
            assert r.text is None and r.n_chars == 0
            continue
        kept = [x for at, x in enumerate(text.split("\n")) if x not in parent or first[root(x)] == (r.doc_id, at)]
        assert r.text == "\n".join(kept) and r.n_chars == len(r.text)
    counts = sorted((r.doc_id or -1, r.n_lines, r.n_links) for r in ld.line_report(frame, hot_lines=hot_lines).collect())
    want = []
    for doc_id, text in docs:
        own = [x for x in (text or "").split("\n") if x in parent]
        want.append((doc_id or -1, len(own), sum(links[x] for x in own)))
    assert counts == sorted(want)


def test_short_lines_by_hash(spark):
    docs = [(1, "Share\n\n}\nRead more\n  "), (2, "Share\n\nShore\n}\n  \nRead more"), (3, "\n}\nown"), (4, None)]
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.text for r in ld.without_repeats(frame, exact_from=1).collect()}
    assert got == {1: docs[0][1], 2: "\nShore\n  ", 3: "\nown", 4: None}
    report = {r.doc_id: (r.n_lines, r.n_removed, r.n_links) for r in ld.line_report(frame, exact_from=1).collect()}
    assert report == {1: (3, 0, 0), 2: (4, 3, 0), 3: (2, 1, 0), 4: (0, 0, 0)}


def test_cells_of_a_hot_segment_are_bounded(spark):
    rng = random.Random(11)
    lines = [rng.getrandbits(63) for _ in range(3000)]
    rows = spark.createDataFrame([(7, x) for x in lines] + [(8, lines[0])], "key BIGINT, line BIGINT")
    hot = spark.createDataFrame([(7, 30)], "key BIGINT, parts BIGINT")
    cells = {}
    for r in ld.dealt(rows, hot).collect():
        cells.setdefault((r.key, r.cell), []).append(r.line)
    assert cells.pop((8, -1)) == [lines[0]]
    assert max(map(len, cells.values())) < 2 * 3000 / 30 * 1.4
    homes = {}
    for (_, cell), held in cells.items():
        for x in held:
            homes.setdefault(x, set()).add(cell)
    assert all(homes[a] & homes[b] for a in lines[:100] for b in lines)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert ld.without_repeats(docs).count() == 0
    assert ld.line_report(docs).count() == 0
