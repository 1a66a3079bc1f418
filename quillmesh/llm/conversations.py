"""Broken conversations, and the cheapest edits that mend their order of roles.

A mended conversation is empty, or one system turn at most and then user and
assistant in turn. Keeping a turn costs 0 (1 if its text is cut off), giving it
the other role 2 more, deleting it 3, an inserted turn without text 2. Blank and
repeated turns have to go. Of the cheapest edits those are taken whose initials,
in order, come first in ASCII.

Costs run backwards (Viterbi) over four states: nothing yet, after system, after
user, after assistant. A conversation is cut into chunks of turns that all run
at once: but for the last, a chunk starts from a guessed vector of costs. A
fix-up pass runs chunks again whose neighbour came out otherwise than guessed,
side by side with their first run, only until the two vectors differ by a
constant: what is left then costs more or less by it. Pass k mends 2^k
neighbours one after the other, so even a conversation where vectors never
meet takes passes as the logarithm of its chunks. The true vector behind each
turn then tells its edit from the state before; a chunk maps the state it is
entered in to the state it is left in, and these maps are put together in
doubling steps. No task holds more of a conversation than a few chunks of turns
without their texts; texts are joined to the edits afterwards.

Defined cases: a null role or text is one space; turns of a null conv_id are a
conversation of their own. Rows go by turn, null first, rows of one turn by role
and a hash of the text; equal rows are copies of the first. A conversation
without rows has counts, cost and edits of nothing. An empty table gives no
rows. Columns other than conv_id, turn, role and text are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..sources.scratch import keep
from .common import before

CHUNK = 4096
_BLANKS = " \t\n\x0b\x0c\r"
_INITIALS = "sua"  # any other is class 3
_KEPT, _CUT_OFF, _MUST_GO = range(3)
_END = (0, 4, 2, 0)  # the cost of ending in each state
_INSERTED = (2, 2, 3, 2)  # the state after an inserted or rerolled turn
_TAKEN = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None,) * 4)
_ROLE = {2: "user", 3: "assistant"}


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with every fifth row or so broken, told by a checksum.

    crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2
    takes its ``.!?`` away, 3 repeats it, 4 makes it the user's.
    """
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fate = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return (
        turns.withColumn("_fate", fate).where("_fate <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("_fate") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.translate(text, ".!?", ""))
            .otherwise(text).alias("text"),
            F.explode(F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
            .alias("_copy"))
        .drop("_copy")
    )


class Repair:
    """The repair of all conversations of a (conv_id, turn, role, text) table.

    ``turns`` is (conv_id, position, place, edit, role, text): the rows that stay, in
    the order of (position, place), with the edit K, R or I that gave them.
    ``audits`` is (conv_id, cost, audit) and ``faults`` (conv_id, gaps, blank,
    duplicate, truncated, illegal); a conversation without rows is in none of them.
    """

    def __init__(self, rows: DataFrame, chunk: int = CHUNK):
        named = keep(_named(rows), "turns")
        placed = _placed(named)
        chunks, illegal = _chunks(placed, chunk)
        traced = keep(_traced(chunks), "traced")
        pieces = traced.groupBy("conv").agg(
            F.sum("cost").alias("cost"),
            F.array_join(F.sort_array(F.collect_list(F.struct("chunk", "audit")))["audit"], "").alias("audit"))
        # ``conv`` is the id as text, and never null.
        kind = rows.schema["conv_id"].dataType
        conv_id = F.when(F.col("conv") != " ", F.expr("substr(conv, 2)").cast(kind)).alias("conv_id")
        self.audits = pieces.select(conv_id, "conv", "cost", "audit")
        self.faults = _faults(placed).join(illegal, "conv").select(conv_id, "*")
        self.turns = _mended(traced, named).select(conv_id, "*")


def report(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per conv_id of ``turns``: faults of its damaged rows, cost, audit and digest of their repair."""
    repair = Repair(damaged(turns), chunk)
    found = repair.faults.drop("conv_id").join(repair.audits.drop("conv_id"), "conv")
    found = found.join(digests(repair.turns), "conv", "left")
    every = turns.select("conv_id").distinct().withColumn("conv", _conv())
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, "conv", "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of the ``role:text`` lines of each conversation, hashed as they stream by."""
    def hashed(batches):
        now, digest = None, None
        for batch in batches:
            found = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
                line = f"{role}:{text}".encode()
                if conv == now:
                    digest.update(b"\n" + line)
                    continue
                if digest:
                    found.append((now, digest.hexdigest()))
                now, digest = conv, hashlib.sha256(line)
            yield _batch(found, ("conv", "sha256"))
        if digest:
            yield _batch([(now, digest.hexdigest())], ("conv", "sha256"))

    dealt = turns.select("conv", "position", "place", "role", "text").repartition("conv")
    return dealt.sortWithinPartitions("conv", "position", "place").mapInArrow(
        hashed, "conv STRING, sha256 STRING")


def _batch(rows: list, names: tuple):
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=list(names))


def _conv() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(" "))


def _named(rows: DataFrame) -> DataFrame:
    """Rows with names: ``id`` of equal rows, ``said`` of equal role and text in a conversation."""
    role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = rows.select("conv_id", _conv().alias("conv"), "turn", role, text)
    said = F.concat_ws(":", F.length("conv"), "conv", F.length("role"), "role", "text")
    turn = F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    ended = F.rtrim("text", F.lit(_BLANKS))
    cut_off = ~F.right(ended, F.lit(1)).isin(".", "!", "?")
    return rows.withColumn("said", F.md5(said)).select(
        "*", F.md5(F.concat_ws(":", "said", turn)).alias("id"),
        (ended == "").alias("is_blank"), cut_off.alias("cut_off"))


def _placed(named: DataFrame) -> DataFrame:
    """A row for each set of equal rows, with its place, its fault and its initial, without the text."""
    same = named.groupBy("id", "conv", "turn", "role", "said", "is_blank", "cut_off").agg(F.count("*").alias("n"))
    same = keep(same, "same")
    moment = F.struct(F.col("turn").isNotNull(), "turn")
    first = same.groupBy("said").agg(F.min(moment).alias("_first"), F.count("*").alias("_rows"))
    first = keep(first.where("_rows > 1"), "first")
    rows = lookup_join(same, first.select("said", "_first"), "said", "left", counts=first.select("said", "_rows"))
    again = F.coalesce(F.col("_first") < moment, F.lit(False))
    initial = F.instr(F.lit(_INITIALS), F.left("role", F.lit(1)))
    rows = rows.select(
        "conv", "turn", "role", "id", "n", "is_blank",
        (~F.col("is_blank") & again).alias("again"),
        (~F.col("is_blank") & ~again & F.col("cut_off")).alias("cut_off"),
        F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1).alias("initial"))
    # Ranges of (conversation, turn): a long conversation is ranked by many tasks.
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("id")]
    rows = keep(rows.repartitionByRange("conv", *order).withColumn("_range", F.spark_partition_id()), "ranged")
    return keep(before(rows, ["conv"], F.col("_range"), order, F.lit(1), "position").drop("_range"), "placed")


def _faults(placed: DataFrame) -> DataFrame:
    # Two steps, so that no task counts the turns of a long conversation alone.
    turns = placed.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("is_blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("again"), F.col("n")).when(~F.col("is_blank"), F.col("n") - 1).otherwise(0))
        .alias("duplicate"),
        F.sum(F.col("cut_off").cast("int")).alias("truncated"))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))


def _chunks(placed: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(conv, chunk, turns, codes, start, left, cost, last), and (conv, illegal)."""
    fault = F.when(F.col("is_blank") | F.col("again"), _MUST_GO).when(F.col("cut_off"), _CUT_OFF).otherwise(_KEPT)
    turn = F.struct("position", (F.col("initial") * 3 + fault).cast("int").alias("code"), "n", "id")
    packed = placed.groupBy("conv", F.expr(f"position div {size}").alias("chunk")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))
    last = placed.groupBy("conv").agg(F.expr(f"max(position) div {size}").alias("last"))
    packed = packed.join(last, "conv").withColumn("last", F.col("last") == F.col("chunk"))
    schema = ("conv STRING, chunk BIGINT, last BOOLEAN, codes BINARY, copies BIGINT, illegal BIGINT, head INT, "
              "tail INT, start ARRAY<INT>, left ARRAY<INT>, cost BIGINT")

    def guessed(batches):
        run = Run()
        for batch in batches:
            out = []
            for row in batch.select(["conv", "chunk", "last", "turns"]).to_pylist():
                codes = bytes(t["code"] for t in row["turns"])
                copies = sum(t["n"] for t in row["turns"]) - len(codes)
                initials = [code // 3 for code in codes]
                illegal = copies + sum(map(_illegal, initials, initials[1:]))
                left, cost = run.back(codes, _END)
                out.append((row["conv"], row["chunk"], row["last"], codes, copies, illegal, initials[0],
                            initials[-1], _END, left, cost))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=arrow)

    names = [c.split()[0] for c in schema.split(", ")]
    ints, longs = pa.int32(), pa.int64()
    arrow = pa.schema(list(zip(names, [pa.string(), longs, pa.bool_(), pa.binary(), longs, longs, ints, ints,
                                       pa.list_(ints), pa.list_(ints), longs])))
    packed = keep(packed, "packed")
    chunks = keep(packed.mapInArrow(guessed, schema), "chunks")
    edge = chunks.select("conv", (F.col("chunk") + 1).alias("chunk"), F.col("tail").alias("_tail"))
    pair = F.array_contains(F.array(*map(F.lit, _LEGAL)), F.col("_tail") * 4 + F.col("head"))
    illegal = chunks.join(edge, ["conv", "chunk"], "left").groupBy("conv").agg(
        F.sum(F.col("illegal") + F.coalesce((~pair).cast("int"), F.lit(0))).alias("illegal"))
    settled = _settled(chunks.drop("illegal", "head", "tail"))
    return packed.select("conv", "chunk", "turns").join(settled, ["conv", "chunk"]), illegal


_LEGAL = (0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1)  # su, ua, au


def _illegal(a: int, b: int) -> bool:
    return a * 4 + b not in _LEGAL


class Run:
    """Steps over turns, remembered: there are few vectors of costs less their least."""

    def __init__(self):
        self._steps, self._edits = {}, {}

    def step(self, after: tuple, code: int) -> tuple:
        """(vector, cost): least costs from before a turn on, as a vector with least 0 and what it is less by."""
        found = self._steps.get((after, code))
        if found is None:
            raw = [min(cost for _, cost, _ in self._choices(after, code, state)) for state in range(4)]
            user, assistant = min(raw[2], 2 + raw[3]), min(raw[3], 2 + raw[2])
            costs = (min(raw[0], 2 + user), min(raw[1], 2 + user), user, assistant)
            found = self._steps[after, code] = tuple(c - min(costs) for c in costs), min(costs)
        return found

    def back(self, codes: bytes, after: tuple) -> tuple:
        """(vector, cost) before the first turn."""
        total = 0
        for code in reversed(codes):
            after, cost = self.step(after, code)
            total += cost
        return after, total

    def fixed(self, codes: bytes, after: tuple, guess: tuple, left: tuple, cost: int) -> tuple:
        """As ``back``, given what came out for a guess: ends where the two differ by a constant only."""
        total = guessed = 0
        for code in reversed(codes):
            if after == guess:
                return left, total - guessed + cost
            (after, own), (guess, other) = self.step(after, code), self.step(guess, code)
            total, guessed = total + own, guessed + other
        return after, total

    def edits(self, after: tuple, code: int, state: int) -> tuple:
        """(initials, state): the first edits in ASCII among the cheapest of a turn."""
        found = self._edits.get((after, code, state))
        if found is None:
            costs, least = self.step(after, code)
            initials, now = "", state
            while not found:
                choices = {edit: (cost, to) for edit, cost, to in self._choices(after, code, now)}
                choices["I"] = 2 + costs[_INSERTED[now]] + least, None
                edit = min(e for e, (cost, _) in choices.items() if cost == costs[now] + least)
                initials += edit
                if edit == "I":
                    now = _INSERTED[now]
                else:
                    found = initials, choices[edit][1]
            self._edits[after, code, state] = found
        return found

    @staticmethod
    def _choices(after: tuple, code: int, state: int) -> list:
        """(edit, cost from here to the end, state after it), without inserted turns."""
        initial, fault = divmod(code, 3)
        choices = [("D", 3 + after[state], state)]
        if fault != _MUST_GO:
            taken, other = _TAKEN[initial][state], _INSERTED[state]
            if taken is not None:
                choices.append(("K", fault + after[taken], taken))
            choices.append(("R", 2 + fault + after[other], other))
        return choices


def _settled(chunks: DataFrame) -> DataFrame:
    """The same rows, run from the true vector behind each chunk."""
    whole = chunks.where("last and chunk = 0")
    rows = keep(chunks.where("not (last and chunk = 0)"), "open")
    schema = rows.schema
    reach = 0
    while True:
        behind = rows.select("conv", (F.col("chunk") - 1).alias("chunk"), F.col("left").alias("_true"))
        rows = rows.join(behind, ["conv", "chunk"], "left").withColumn(
            "_true", F.when(F.col("last"), F.col("start")).otherwise(F.col("_true")))
        rows = keep(rows, "guesses")
        if not rows.where("_true <> start").limit(1).count():
            return whole.unionByName(rows.drop("_true"))
        group = F.shiftright("chunk", reach).alias("_group")
        dealt = rows.withColumn("_group", group).repartition("conv", "_group").sortWithinPartitions(
            "conv", "_group", F.desc("chunk"))
        rows = keep(dealt.mapInArrow(_fix_up(schema), schema), "fixed")
        reach += 1


def _fix_up(schema):
    names = schema.names

    def fix_up(batches):
        run, now, carried = Run(), None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["conv"], row["_group"]) != now:
                    now, carried = (row["conv"], row["_group"]), tuple(row["_true"])
                start, left = tuple(row["start"]), tuple(row["left"])
                if carried != start:
                    left, row["cost"] = run.fixed(row["codes"], carried, start, left, row["cost"])
                    row["start"], row["left"] = carried, left
                carried = left
                out.append({c: row[c] for c in names})
            yield pa.RecordBatch.from_pylist(out, schema=batch.select(names).schema)

    return fix_up


def _entered(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, entered): the state in which every chunk but a first one is entered."""
    def mapped(batches):
        run = Run()
        for batch in batches:
            exits = []
            for row in batch.to_pylist():
                states = list(range(4))
                for code, after in _with_vectors(run, row["codes"], tuple(row["start"])):
                    states = [run.edits(after, code, state)[1] for state in states]
                exits.append(states)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv", "chunk")), pa.array(exits, pa.list_(pa.int32()))],
                names=["conv", "chunk", "exits"])

    most = chunks.agg(F.max("chunk")).first()[0] or 0
    maps = keep(chunks.select("conv", "chunk", "codes", "start").mapInArrow(
        mapped, "conv STRING, chunk BIGINT, exits ARRAY<INT>"), "maps")
    step = 1
    while step <= most:
        earlier = maps.select("conv", (F.col("chunk") + step).alias("chunk"), F.col("exits").alias("_earlier"))
        through = F.expr("transform(_earlier, s -> exits[s])")
        maps = keep(maps.join(earlier, ["conv", "chunk"], "left").select(
            "conv", "chunk", F.coalesce(through, "exits").alias("exits")), "maps")
        step *= 2
    return maps.select("conv", (F.col("chunk") + 1).alias("chunk"), F.col("exits")[0].alias("entered"))


def _with_vectors(run: Run, codes: bytes, after: tuple):
    """(code, vector behind it) of each turn, in order."""
    vectors = []
    for code in reversed(codes):
        vectors.append(after)
        after, _ = run.step(after, code)
    return zip(codes, reversed(vectors))


def _traced(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, cost, audit, edits) with the edits of all turns that stay."""
    several = chunks.where("not (last and chunk = 0)")
    entered = chunks.join(_entered(several), ["conv", "chunk"], "left")
    schema = ("conv STRING, chunk BIGINT, cost BIGINT, audit STRING, "
              "edits ARRAY<STRUCT<position: BIGINT, place: INT, edit: STRING, id: STRING, role: STRING>>")
    edit_type = pa.list_(pa.struct([("position", pa.int64()), ("place", pa.int32()), ("edit", pa.string()),
                                    ("id", pa.string()), ("role", pa.string())]))

    def traced(batches):
        run = Run()
        for batch in batches:
            audits, costs, edits = [], [], []
            for row in batch.to_pylist():
                state = row["entered"] or 0
                cost = row["cost"] + 3 * row["copies"] + (row["left"][0] if row["chunk"] == 0 else 0)
                audit, done, place = [], [], 0
                steps = _with_vectors(run, row["codes"], tuple(row["start"]))
                for turn, (code, after) in zip(row["turns"], steps):
                    initials, left = run.edits(after, code, state)
                    place = 0
                    for edit in initials[:-1]:
                        state = _INSERTED[state]
                        done.append((turn["position"], place, edit, None, _ROLE[state]))
                        place += 1
                    if initials[-1] != "D":
                        role = _ROLE[left] if initials[-1] == "R" else None
                        done.append((turn["position"], place, initials[-1], turn["id"], role))
                    state = left
                    audit.append(initials + "D" * (turn["n"] - 1))
                while row["last"] and state in (1, 2):
                    state, place = _INSERTED[state], place + 1
                    done.append((turn["position"], place, "I", None, _ROLE[state]))
                    audit.append("I")
                audits.append("".join(audit))
                costs.append(cost)
                edits.append([dict(zip(("position", "place", "edit", "id", "role"), e)) for e in done])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv", "chunk")), pa.array(costs, pa.int64()),
                 pa.array(audits, pa.string()), pa.array(edits, edit_type)],
                names=["conv", "chunk", "cost", "audit", "edits"])

    return entered.mapInArrow(traced, schema)


def _mended(traced: DataFrame, named: DataFrame) -> DataFrame:
    """(conv, position, place, edit, role, text) of the turns that stay and those put in."""
    edits = traced.select("conv", F.explode("edits").alias("e")).select("conv", "e.*")
    texts = named.groupBy("id").agg(F.first("role").alias("own"), F.first("text").alias("text"))
    order = ["conv", "position", "place", "edit"]
    stay = edits.where("id IS NOT NULL").join(texts, "id")
    return stay.select(*order, F.coalesce("role", "own").alias("role"), "text").unionByName(
        edits.where("id IS NULL").select(*order, "role", F.lit("").alias("text")))
