import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quillmesh.llm import conversations

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, conv STRING, position INT"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA).repartition(3)


def spoil(rows):
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        for _ in range(0 if fate == 0 else 2 if fate == 3 else 1):
            yield conv, turn, role, text


def faults_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]+", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                      else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def cheapest(rows, faults):
    """All edits in the order of (cost, initials): the first that ends well wins."""
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if at == len(rows) and last in ("", "a"):
            return cost, audit, out
        if (at, last) in done:
            continue
        done.add((at, last))
        fits = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for role in ("user", "assistant"):
            if role[0] in fits:
                heapq.heappush(heap, (cost + 2, audit + "I", at, role[0], (*out, f"{role}:")))
        if at == len(rows):
            continue
        _, own, text = rows[at]
        heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, out))
        if faults[at] in ("blank", "duplicate"):
            continue
        more = faults[at] == "truncated"
        for role, edit, price in ((own, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
            if role[:1] in tuple(fits) and role:
                step = (cost + price + more, audit + edit, at + 1, role[0], (*out, f"{role}:{text}"))
                heapq.heappush(heap, step)


def brute(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in spoil(rows):
        groups[conv].append((turn, role, text))
    want = {}
    for conv in {row[0] for row in rows}:
        held = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = faults_of(held)
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(held, held[1:])]
        cost, audit, out = cheapest(held, faults)
        want[conv] = (
            gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())
    return want


def made(seed, convs=60, most=14, roles=("user", "assistant", "system", "tool", "", None)):
    rng = np.random.default_rng(seed)
    texts = ["Yes.", "No!", "cut off", " \t", "", None, "So?  ", "é.", "a:b", "x\ny."]
    rows = []
    for conv in range(convs):
        for turn in rng.permutation(int(rng.integers(1, most))):
            weights = np.array([4, 4, 1, 0.3, 0.3, 0.3][:len(roles)])
            role = roles[rng.choice(len(roles), p=weights / weights.sum())]
            text = texts[rng.integers(len(texts))] if rng.random() < 0.5 else f"Word {rng.integers(99)}."
            rows.append((conv, int(turn) * int(rng.integers(1, 3) if turn == 5 else 1), role, text))
    # One row to a turn but for copies, which come as the row itself.
    single = {(r[0], r[1]): r for r in rows}
    return list(single.values())


def got(spark, rows, **options):
    found = conversations.report(frame(spark, rows), **options).collect()
    assert len(found) == len({row[0] for row in rows})
    return {row.conv_id: tuple(row)[1:] for row in found}


@pytest.mark.parametrize("chunk", [4096, 3])
def test_report_equals_search(spark, chunk):
    rows = made(5)
    rows += [(None, None, "user", "Hello."), (None, 1, "assistant", None), (None, 2, None, "Hm."),
             (900, 3, "user", "Twice."), (900, 3, "user", "Twice."), (901, None, "assistant", "x.")]
    assert got(spark, rows, chunk=chunk) == brute(rows)


@pytest.mark.parametrize("roles", [("user",), ("tool",), ("user", "assistant", "system")])
def test_long_conversations_settle(spark, roles):
    """Rows of one role keep guessed vectors apart, so every chunk has to be run again."""
    rng = np.random.default_rng(1)
    rows = [(1, t, roles[rng.integers(len(roles))], f"{t}" + "."[:t % 3]) for t in range(90)]
    rows += [(2, t, "user", "") for t in range(40)]
    assert got(spark, rows, chunk=4) == brute(rows)


def test_mended_turns(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 2, "assistant", "Hi."), (1, 3, "assistant", "Hi."), (1, 5, "user", "So?")]
    repair = conversations.Repair(frame(spark, rows))
    turns = [tuple(t) for t in repair.turns.orderBy("position", "place").select("edit", "role", "text").collect()]
    audit = repair.audits.first()
    assert "".join(edit for edit, _, _ in turns) == audit.audit.replace("D", "")
    assert [role[0] for _, role, _ in turns] in (list("suaua"), list("sua"))
    assert (audit.conv_id, audit.cost) == (1, 2 + 3 + 2)


def test_empty_table(spark):
    assert conversations.report(frame(spark, [])).collect() == []


def test_whole_table(spark, tables):
    rows = tables("conversations")
    want = brute([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    found = conversations.report(rows).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == want
