"""Personal data by patterns, and by contexts that the found data suggest.

Base patterns find e-mail addresses, IP addresses, card and phone numbers.
These seed a graph of lexical patterns and instances. An instance is a run of
neighbouring numbers, or an address whose @ may be spelled in brackets, that
could be of a kind by its form: a phone number has 7 to 15 digits, a card 14 to
19 that pass Luhn, an IP address four parts up to 255, whatever parts them. Its
patterns are the word before it, the two words before it, the word after it and
its shape, each on its own, so a context that seeds taught meets forms that no
base pattern knows, and a form found so is looked for in other contexts.

In turns, a pattern is as good as the share of its instances, of every kind and
of none, that are personal data of one kind, so common words that come before
all sorts of numbers tell nothing; and an instance as likely as one of its good patterns is right. Neither
hears its own voice: what a pattern told an instance is left out of what the
instance tells the pattern. Instances with a good pattern, and likely at last,
are found.

Only DataFrame functions are used. Positions are code points: the pieces that
a split leaves and the matches between them add up, per text and kind.

Defined cases: a null text is empty; a text without matches has counts 0 and
empty spans; very long texts are searched whole, by patterns that never run
over a word twice; repeated rows are searched each, and equal instances in
equal contexts teach once; an empty table gives no rows. Columns other than
doc_id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..sources.scratch import keep

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
GOOD_PATTERN = 0.7
HEARD_PATTERN = 0.5  # below, a pattern tells its instances nothing
SEEDS = 3  # instances of a kind that a good pattern has, at least
LIKELY = 0.7

_BLANK = r"\x20\x09-\x0D"
# What a pattern matches is fixed. Runs are possessive, and start only where no
# run goes on, so that long runs cost no more than their length.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_IN_BRACKETS = r"[\[({<]\x20?[A-Za-z@.]{1,4}\x20?[\])}>]"
_JOINT = rf"\x20?{_IN_BRACKETS}\x20?"
# Runs that may hold an unknown form of a kind: numbers that neighbour each
# other, and names joined by an @ or by a short word in brackets.
CANDIDATES = {
    "number": r"(?<![A-Za-z0-9@._/+-])[+(\[]{0,2}[0-9](?:[\x20()\[\]./_-]{0,3}[0-9])*+",
    "address": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
               rf"(?:@|{_JOINT})[A-Za-z0-9-]++(?:(?:\.|{_JOINT})[A-Za-z0-9-]++)*+",
}
_GUARDS = {"email": "@", "address": rf"@|{_IN_BRACKETS}"}
_WORDS_BEFORE = rf"(?:([^{_BLANK}]+)[{_BLANK}]+)?([^{_BLANK}]+)[{_BLANK}]*$"
_WORD_AFTER = rf"^[{_BLANK}]*([^{_BLANK}]+)"
_NEAR = 64  # characters beside an instance that hold its context


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(match, r"\."), lambda p: (F.length(part(p)) <= 3) & (
            F.coalesce(F.try_to_number(F.lpad(part(p), 3, "0"), F.lit("999")), F.lit(999)) <= 255))
    n = F.length(_digits(match))
    if kind == "phone":
        return n.between(10, 15)
    return n.between(14, 19) & _luhn(_digits(match))


def _luhn(digits: Column) -> Column:
    places = F.split(F.reverse(F.right(digits, F.lit(19))), "")
    worth = F.transform(places, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(worth, F.lit(0), lambda a, b: a + b) % 10 == 0


def scanned(docs: DataFrame) -> DataFrame:
    """(row, doc_id, <kind>, <candidate>): arrays of what matched and what came before it.

    An entry holds the match, the length of the text since the last one, and
    for candidates the text close to it on both sides; null where nothing
    matched. row is unique.
    """
    text = F.col("_text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    patterns = PATTERNS | CANDIDATES

    def matches(name):
        found = F.regexp_extract_all("_text", F.lit(patterns[name]), F.lit(0))
        if name in _GUARDS:
            found = F.when(text.rlike(_GUARDS[name]), found).otherwise(F.array().cast("array<string>"))
        return found.alias(name)

    def entries(name):
        pieces = F.split("_text", patterns[name], -1)
        lengths = F.transform(F.slice(pieces, F.lit(1), F.size(name)), F.length).alias("before")
        parts = [F.col(name).alias("match"), lengths]
        if name in CANDIDATES:
            left = F.transform(pieces, lambda p: F.right(p, F.lit(_NEAR)))
            right = F.transform(pieces, lambda p: F.left(p, F.lit(_NEAR)))
            parts += [F.slice(left, F.lit(1), F.size(name)).alias("left"),
                      F.slice(right, F.lit(2), F.size(name)).alias("right")]
        return F.when(F.size(name) > 0, F.arrays_zip(*parts)).alias(name)

    found = rows.select("doc_id", "_text", *map(matches, patterns)).select("doc_id", *map(entries, patterns))
    return keep(found.withColumn("row", F.monotonically_increasing_id()), "matches")


def _placed(scan: DataFrame, kind: str) -> DataFrame:
    """One row per match with its start and end."""
    each = scan.where(F.col(kind).isNotNull()).select("row", F.posexplode(kind).alias("at", "entry"))
    to_here = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("entry.before") + F.length("entry.match")).over(to_here)
    placed = each.select("row", "entry.*", end.alias("end"))
    return placed.withColumn("start", F.col("end") - F.length("match")).drop("before")


def base_spans(scan: DataFrame) -> DataFrame:
    """(row, kind, start, end); kind is a number in the order of KINDS."""
    parts = [
        _placed(scan, kind).where(_valid(kind, F.col("match"))).select(
            "row", F.lit(i).alias("kind"), "start", "end")
        for i, kind in enumerate(KINDS)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _could_be(name: str, match: Column) -> list:
    """The kinds, as numbers, that a candidate could be by its form alone; null for others."""
    if name == "address":
        return [F.lit(KINDS.index("email"))]
    digits = _digits(match)
    n = F.length(digits)
    parts = F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))
    # Parts that are too long become 999.
    four = (F.size(parts) == 4) & F.forall(parts, lambda p: F.coalesce(
        F.try_to_number(F.lpad(F.regexp_replace(p, "^0+", ""), 3, "0"), F.lit("999")), F.lit(999)) <= 255)
    four = four & F.forall(parts, lambda p: F.length(p) <= 3)
    dotted = match.rlike(r"^[0-9]+(?:\.[0-9]+){3}$")
    kinds = {"ip": four, "card": n.between(14, 19) & _luhn(digits), "phone": n.between(7, 15) & ~dotted}
    return [F.when(fits, F.lit(KINDS.index(kind))) for kind, fits in kinds.items()]


def candidates(scan: DataFrame, spans: DataFrame) -> DataFrame:
    """(row, start, end, could, kind, instance, nodes): candidates and the kind of what they overlap.

    One row per kind that a candidate could be, could is null for none. Candidates take their places
    among the spans of their text; the furthest end of the spans that begin
    before the end of a candidate tells whether one overlaps it.
    """
    listed = None
    for name in CANDIDATES:
        # A number that letters follow is part of a longer name.
        placed = _placed(scan, name).where(~F.col("right").rlike("^[A-Za-z0-9@]"))
        could = F.array_compact(F.array(*_could_be(name, F.col("match"))))
        placed = placed.withColumn("could", could).select(
            "row", "start", "end", (F.col("end") - 1).alias("place"), "could",
            F.lower("match").alias("instance"), _nodes(name).alias("nodes"))
        listed = placed if listed is None else listed.unionByName(placed)
    marks = spans.select("row", F.col("start").alias("place"), F.struct(F.col("end"), F.col("kind")).alias("span"))
    order = Window.partitionBy("row").orderBy("place", F.col("span").isNull())
    furthest = F.max("span").over(order.rowsBetween(Window.unboundedPreceding, 0))
    both = listed.unionByName(marks, allowMissingColumns=True).withColumn("furthest", furthest)
    return both.where("instance IS NOT NULL").select(
        "row", "start", "end", F.explode_outer("could").alias("could"),
        F.when(F.col("furthest.end") > F.col("start"), F.col("furthest.kind")).alias("kind"),
        "instance", "nodes")


def _nodes(name: str) -> Column:
    """The patterns of a candidate: words before, word after, shape; none where there is none."""
    def word(text, pattern, group):
        bare = F.regexp_replace(F.lower(F.regexp_extract(text, pattern, group)), r"[^\p{L}\p{N}]+", "")
        return F.regexp_replace(bare, "[0-9]+", "9")

    last = word("left", _WORDS_BEFORE, 2)
    nodes = {"before": last, "two": F.concat_ws(" ", F.nullif(word("left", _WORDS_BEFORE, 1), F.lit("")), last),
             "after": word("right", _WORD_AFTER, 1), "shape": _shape(name)}
    return F.array_compact(F.array(*(
        F.when((node != "") if part != "two" else F.contains(node, F.lit(" ")),
               F.concat(F.lit(f"{part} "), node)) for part, node in nodes.items())))


def _shape(name: str) -> Column:
    """Digits as 9, up to 32 characters; what joins an address from its first name on."""
    if name == "number":
        return F.left(F.regexp_replace("match", "[0-9]", "9"), F.lit(32))
    host = F.regexp_replace(F.lower("match"), r"^[a-z0-9._%+-]+", "")
    joints = F.regexp_extract_all(host, F.lit(rf"[@.]|{_IN_BRACKETS}"), F.lit(0))
    return F.array_join(F.array_distinct(joints), " ")


def _of_kind(name: str) -> Column:
    return F.concat_ws(" ", F.col("could").cast("string"), F.col(name))


def pattern_graph(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, instance, seed, other), and (pattern, all): the instances of each pattern.

    A node is a pattern of one kind, and an instance there of that kind; seed
    marks those that overlap a base span of the kind, other those of another.
    """
    each = keep(found.select(F.explode("nodes").alias("pattern"), "could", "kind", "instance").groupBy(
        "pattern", "instance", "could").agg(
            F.max(F.coalesce(F.col("kind") == F.col("could"), F.lit(False))).alias("seed"),
            F.max(F.coalesce(F.col("kind") != F.col("could"), F.lit(False))).alias("other")), "edges")
    sizes = each.groupBy("pattern", "instance").agg(F.lit(1)).groupBy("pattern").agg(F.count("*").alias("all"))
    edges = each.where("could IS NOT NULL").select(
        _of_kind("pattern").alias("node"), _of_kind("instance").alias("instance"), "seed", "other")
    return edges, keep(sizes, "sizes")


def weighed(edges: DataFrame, sizes: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(node, score) of the patterns that are heard, (instance, belief) of instances.

    Every round weighs patterns by their instances and instances by their
    patterns, and is written out.
    """
    scores = edges.select("node", F.lit(0.0).alias("score")).limit(0)
    for turn in range(rounds + 1):
        told = lookup_join(edges, scores, "node", "left").withColumn(
            "miss", F.log1p(-F.coalesce("score", F.lit(0.0)))).drop("score")
        told = keep(told, "told")
        totals = keep(told.groupBy("instance").agg(
            F.sum("miss").alias("all_miss"), F.max("seed").alias("_seed"), F.max("other").alias("_other")), "totals")

        def belief(miss):
            return F.when(F.col("_seed"), 1.0).when(F.col("_other"), 0.0).otherwise(1 - F.exp(miss))

        if turn == rounds:
            return scores, totals.select("instance", F.round(belief(F.col("all_miss")), 9).alias("belief"))
        back = lookup_join(told.select("node", "instance", "miss"), totals, "instance")
        own = back.groupBy("node").agg(F.sum(belief(F.col("all_miss") - F.col("miss"))).alias("n"))
        # At most a row per kind and pattern on either side.
        own = own.withColumn("pattern", F.expr("substring(node, 3)"))
        own = own.join(sizes, "pattern")
        scores = keep(own.select("node", F.round(F.least(F.col("n") / (F.col("all") + 0.5), F.lit(1 - 1e-6)), 9).alias("score")).where(
            (F.col("n") >= SEEDS - 1e-9) & (F.col("score") >= HEARD_PATTERN)), "scores")


def discovered(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(row, kind, start, end): likely candidates, with a good pattern, off every base span.

    Of several kinds the likeliest counts, the first of equals.
    """
    scores, beliefs = weighed(*pattern_graph(found), rounds)
    fresh = found.where("kind IS NULL AND could IS NOT NULL").withColumn("instance", _of_kind("instance"))
    likely = keep(beliefs.where(f"belief >= {LIKELY}"), "likely")
    fresh = lookup_join(fresh, likely, "instance").select(
        "row", "start", "end", "could", "belief", F.explode("nodes").alias("node"))
    good = keep(scores.where(f"score >= {GOOD_PATTERN}").select("node"), "good")
    fresh = fresh.withColumn("node", F.concat_ws(" ", F.col("could").cast("string"), "node"))
    fresh = lookup_join(fresh, good, "node")
    best = F.max(F.struct("belief", (-F.col("could")).alias("_kind"))).alias("best")
    return fresh.groupBy("row", "start", "end").agg(best).select(
        "row", (-F.col("best._kind")).alias("kind"), "start", "end")


def find_personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans) per document.

    Counts are of base spans; both lists hold kind:start:end in order.
    """
    scan = scanned(docs)
    spans = keep(base_spans(scan), "spans")
    fresh = discovered(keep(candidates(scan, spans), "candidates"), rounds)

    every = spans.withColumn("base", F.lit(True)).unionByName(
        fresh.withColumn("base", F.lit(False)))
    names = F.array(*map(F.lit, KINDS))
    item = F.struct("start", "kind", "end")
    lists = every.groupBy("row").agg(
        *(F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
        F.sort_array(F.collect_list(F.when(F.col("base"), item))).alias("base_spans"),
        F.sort_array(F.collect_list(item)).alias("spans"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return scan.select("row", "doc_id").join(lists, "row", "left").select(
        "doc_id", *(F.coalesce(f"n_{kind}", F.lit(0)).cast("bigint").alias(f"n_{kind}") for kind in KINDS),
        F.coalesce(joined(F.col("base_spans")), F.lit("")).alias("base_spans"),
        F.coalesce(joined(F.col("spans")), F.lit("")).alias("spans"))
