import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillmesh.llm import packing

PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=40), st.integers(1, 20))
@settings(max_examples=60, deadline=None)
def test_plan_uses_up_the_lengths(counts, groups):
    plan = packing.packing_plan(counts, 64, groups)
    used = Counter()
    for lengths, times in plan:
        assert sum(lengths) <= 64
        for length in lengths:
            used[length] += times
    assert used == Counter(counts)


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(6.3, 1, 50_000).astype(int) + 1, 1024)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    used = sum(times for _, times in packing.packing_plan(counts, 1024))
    assert used <= 1.01 * lengths.sum() / 1024 + 1


TEXTS = ["", " ", "a" * 5000, " " * 3000 + "x", "x <|endoftext|> y", "é \r\n\t ab  \n\n c", "don't 12²½ 😀", "\x85 q"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_tokenizers(text):
    assert list(packing.Encoder()(text)) == PLAIN.encode(text, add_special_tokens=False).ids


def test_pieces_and_places(spark):
    texts = TEXTS + [None, "long words here " * 2000, "same", "same"]
    rows = [(i if i != 11 else 10, text, 1, "s") for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, length INT, offset STRING")
    got = packing.pack(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, text, *_ in rows:
        ids = PLAIN.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        if doc_id == 10:
            assert len(pieces) == 2 and {p.piece for p in pieces} == {0}
            continue
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        at = 0
        for p in pieces:
            assert p.start == at and (p.length == 1024 or p.piece == 0)
            part = np.array(ids[at:at + p.length], dtype="<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id BIGINT, text STRING")).count() == 0
