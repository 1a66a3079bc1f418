"""The stages of the pipeline against plain versions, on documents with names that the stages use themselves."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from quillmesh.llm import toxicity
from test_copies import brute_fingerprint

SF_DIR = "/root/testdata/sf0.001"
INNER = ["uid", "_place", "_key", "_gone", "_rows", "_times", "_toxicity", "row", "_hot", "_salt", "at", "line",
         "_nth", "_copies", "_copy", "place", "size", "a", "b", "id", "root", "fp", "first", "_id"]


@pytest.fixture(scope="module")
def docs(spark, tables):
    """Some documents, edited copies of them, repeated rows, texts without words; every column has a value of its own."""
    rng = np.random.default_rng(4)
    plain = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in tables("documents").limit(150).collect()]
    rows = list(plain)
    for i, (_, text, lang, source, _) in enumerate(plain[:40]):
        words = text.split(" ")
        words[int(rng.integers(len(words)))] = f"changed{i}"
        rows.append((100_000 + i, " ".join(words), lang, source, len(" ".join(words))))
    rows += [(200_000, None, None, None, None), (200_001, "", "en", None, 0), (200_002, " \n\n", "en", "web", 3),
             (None, "without an id\nline", "en", "web", 18), plain[3], plain[3]]
    rows += [(200_003, "one line of more than twenty characters\nshort\nshort", "en", "web", 51),
             (200_004, "one line of more than twenty charakters\nother\nshort", "en", "web", 51)]
    made = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    for at, name in enumerate(INNER):
        made = made.withColumn(name, F.concat_ws("/", F.lit(at), "doc_id"))
    return made.repartition(3)


def check_columns(found, docs):
    assert found.columns == docs.columns
    rows = found.collect()
    for r in rows:
        for at, name in enumerate(INNER):
            assert r[name] == (f"{at}/{r.doc_id}" if r.doc_id is not None else str(at))
    return rows


def plain_edits(x, y, most):
    if abs(len(x) - len(y)) > most:
        return most + 1
    last = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        row = [i]
        for j, d in enumerate(y, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
        if min(row) > most:
            return most + 1
        last = row
    return last[-1]


def classes_of(names, links):
    parent = {n: n for n in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    return {n: root(n) for n in names}


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def test_toxic_documents_go(spark, tables, docs):
    got = check_columns(pipeline.drop_toxic(spark, docs, SF_DIR), docs)
    scores = toxicity.toxicity_scores(docs.select("doc_id", "text"), tables("labels"))
    want = [(r.doc_id, r.text) for r in scores.join(docs.select("doc_id", "text").distinct(), [
        "doc_id"]).where("predicted = 0").collect()]
    want += [(None, "without an id\nline")]
    assert by_id((r.doc_id, r.text) for r in got) == by_id(want)


def test_repeated_lines_go(spark, docs):
    got = check_columns(pipeline.drop_repeated_lines(spark, docs, SF_DIR), docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = list(dict.fromkeys(by_id(rows)))  # rows alike in id and text are one
    lines = {line for _, t in texts for line in (t or "").split("\n") if line.strip()}
    long = [line for line in lines if len(line) >= 24]
    bags = [Counter(line) for line in long]
    links = [(x, y) for i, x in enumerate(long) for j, y in enumerate(long[:i])
             if abs(len(x) - len(y)) <= 2 and (bags[i] - bags[j]).total() <= 2 and plain_edits(x, y, 2) <= 2]
    classes = classes_of(lines, links)
    assert len(set(classes.values())) < len(lines)
    seen, want = set(), {}
    for key in texts:
        left = []
        for line in (key[1] or "").split("\n"):
            if line in classes:
                if classes[line] in seen:
                    continue
                seen.add(classes[line])
            left.append(line)
        want[key] = None if key[1] is None else "\n".join(left)
    assert by_id((r.doc_id, r.text) for r in got) == by_id((i, want[i, t]) for i, t in rows)
    kept = {(r.doc_id, r.text, r.n_chars) for r in got if r.text is not None}
    assert all(n == len(t) for _, t, n in kept)


def test_one_of_near_copies_stays(spark, docs):
    got = check_columns(pipeline.drop_near_copies(spark, docs, SF_DIR), docs)
    texts = by_id({(r.doc_id, r.text) for r in docs.collect()})

    fps = [brute_fingerprint(t) for _, t in texts]
    links = [(i, j) for i, x in enumerate(fps) for j, y in enumerate(fps[:i]) if (x ^ y).bit_count() <= 2]
    classes = classes_of(range(len(texts)), links)
    first = {}
    for i, key in enumerate(texts):
        first.setdefault(classes[i], key)
    assert by_id((r.doc_id, r.text) for r in got) == by_id(first.values())


def test_sources_are_mixed(spark, docs):
    got = check_columns(pipeline.mix_sources(spark, docs, SF_DIR), docs)
    times = Counter((r.doc_id, r.text) for r in got)
    rows = Counter((r.doc_id, r.text) for r in docs.collect())
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").split())
    for r in got:
        taken[r.source] += len(r.text.split())
    assert all(n <= 3 * rows[key] for key, n in times.items())
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None]
    total, weight = sum(sizes.values()), {s: 1 + i % 3 for i, s in enumerate(names)}
    capped = {}
    while True:
        share = (total - sum(capped.values())) / sum(w for s, w in weight.items() if s not in capped)
        above = [s for s, w in weight.items() if s not in capped and share * w > 3 * sizes[s]]
        if not above:
            break
        capped |= {s: 3 * sizes[s] for s in above}
    longest = max(len((r.text or "").split()) for r in docs.collect())
    for s in names:
        assert abs(taken[s] - capped.get(s, share * weight[s])) <= longest


def test_pieces_fill_sequences(spark, docs):
    got = pipeline.pack_sequences(spark, docs, SF_DIR).collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(r.doc_id for r in docs.collect())
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024


def test_whole_run(spark):
    rows = pipeline.run(spark, SF_DIR).collect()
    assert rows and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert all(0 <= r.ids_crc32 < 1 << 32 for r in rows)
