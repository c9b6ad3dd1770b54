"""Secrets in texts: known shapes, and strings that look random.

Patterns find assignments to telling names, access keys and long hexadecimal runs. Beyond
them, strings of 20 characters and more are scanned with a window of 20: as it moves on by
a character, the counts of the one that enters and the one that leaves change, and with
them the sum of ``c * log2(c)`` from which the window's Shannon entropy follows. Counts are
kept as digits of a few numbers, so a move costs the same whatever the alphabet.

A window is random where its entropy is at least what 95 in 100 random windows of its
class reach; the class is the narrowest that has all its characters. A string with a
random window is a span. The allow-list suppresses what it explains and no more: windows
without a digit that have as many vowels as words do, and stand-ins such as ``example``,
at which a string is cut before it is scanned.

Defined results: a null text is empty. Rows that repeat an id are separate documents.
Spans of different kinds may overlap. Other columns are ignored. Everything is column
functions; a text is read where it lies and nothing is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from roadcast.llm.spans import listed, matches, of_kind

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
# Bits a character that most random windows of a class reach (fixed values, simulated; the
# tests measure what they find).
THRESHOLDS = {
    "digits": 2.6, "hex": 3.0, "letters of one case": 3.25, "base32": 3.44, "one case and digits": 3.5,
    "letters": 3.6, "letters and digits": 3.75, "any": 3.75,
}
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/=_-"
# Classes follow from which of these groups a window has; their counts are digits, too.
_GROUPS = ("234567", "0189", "ae", "bcdf", "iou", "ghjklmnpqrstvwxyz", "AE", "BCDF", "IOU", "GHJKLMNPQRSTVWXYZ", "+/=_-")
_VOWELS = (2, 4, 6, 8)
WORDLIKE = 6  # windows without a digit and with more vowels are taken for words
_BITS, _PER_NUMBER = 5, 12  # a count is at most 20

_NAMES = r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = _NAMES + r"""["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]++"""
ASSIGNED = "^" + _NAMES + r"""["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
# Shorter runs cannot pass, and hold no longer ones.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}+"

# Stand-ins, which explain themselves but not what is around them.
STAND_IN = r"(?i)example|sample|dummy|placeholder|changeme|x{6,}|0{8,}|12345678|abcdefgh"


def _log_counts() -> Column:
    """``c * log2(c)`` at position c + 1, for every count a window can hold."""
    return F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])


def _digit(number: Column, place: Column) -> Column:
    shifted = F.call_function("shiftright", number, (place * _BITS).cast("int"))
    return shifted.bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")


def _unit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place * _BITS).cast("int"))


def _random(entropy: Column, groups: Column) -> Column:
    """Whether a window with these counts of groups is random."""

    def has(*which: int) -> Column:
        mask = sum(((1 << _BITS) - 1) << (_BITS * g) for g in which)
        return groups.bitwiseAND(F.lit(mask).cast("long")) != 0

    lower, upper, digits, signs = has(2, 3, 4, 5), has(6, 7, 8, 9), has(0, 1), has(10)
    t = THRESHOLDS
    one_case = F.when(~has(4, 5, 8, 9), t["hex"]).when(~digits, t["letters of one case"])
    one_case = one_case.when(~lower & ~has(1), t["base32"]).otherwise(t["one case and digits"])
    mixed = F.when(digits, t["letters and digits"]).otherwise(t["letters"])
    needed = F.when(signs, t["any"]).when(lower & upper, mixed).when(lower | upper, one_case).otherwise(t["digits"])
    vowels = sum((_digit(groups, F.lit(g)) for g in _VOWELS), F.lit(0))
    return (F.round(entropy, 9) >= needed) & (digits | (vowels <= WORDLIKE))


def _scan(value: Column) -> Column:
    """What the window saw on its way over a string: ``best``, its highest entropy, and
    ``random``, whether one of its places was."""
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    gone = F.concat(F.array_repeat(F.lit(0), WINDOW), codes)
    moves = F.zip_with(
        codes,
        F.slice(gone, F.lit(1), F.size(codes)),
        lambda new, old: F.struct((new - 1).alias("new"), (old - 1).alias("old")),
    )
    table = _log_counts()
    group_of = F.array(*[F.lit(next(g for g, own in enumerate(_GROUPS) if c in own)) for c in ALPHABET])
    numbers = -(-len(ALPHABET) // _PER_NUMBER)

    def weigh(count: Column) -> Column:
        return F.get(table, count)

    def number_of(code: Column) -> Column:
        return F.floor(code / _PER_NUMBER).cast("int")

    def count(counts: Column, code: Column) -> Column:
        return _digit(F.get(counts, number_of(code)), code % _PER_NUMBER)

    def move(state: Column, m: Column) -> Column:
        counts, enters, leaves = state["counts"], m["new"], m["old"]
        full, same = leaves >= 0, enters == leaves
        changed = F.transform(
            counts,
            lambda x, i: x
            + F.when(number_of(enters) == i, _unit(enters % _PER_NUMBER)).otherwise(0)
            - F.when(full & (number_of(leaves) == i), _unit(leaves % _PER_NUMBER)).otherwise(0),
        )
        added = weigh(count(counts, enters) + 1) - weigh(count(counts, enters))
        taken = F.when(full, weigh(count(counts, leaves)) - weigh(count(counts, leaves) - 1)).otherwise(0.0)
        total = F.when(same, state["total"]).otherwise(state["total"] + added - taken)
        left = F.when(full, _unit(F.get(group_of, leaves))).otherwise(0)
        groups = state["groups"] + _unit(F.get(group_of, enters)) - left
        seen = state["seen"] + 1
        entropy = math.log2(WINDOW) - total / WINDOW
        whole = seen >= WINDOW
        return F.struct(
            F.when(same, counts).otherwise(changed).alias("counts"),
            groups.alias("groups"),
            total.alias("total"),
            seen.alias("seen"),
            F.when(whole, F.greatest(state["best"], entropy)).otherwise(state["best"]).alias("best"),
            (state["random"] | (whole & _random(entropy, groups))).alias("random"),
        )

    begin = F.struct(
        F.array_repeat(F.lit(0).cast("long"), numbers).alias("counts"),
        F.lit(0).cast("long").alias("groups"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("seen"),
        F.lit(0.0).alias("best"),
        F.lit(False).alias("random"),
    )
    return F.aggregate(moves, begin, move, lambda s: F.struct(s["best"].alias("best"), s["random"].alias("random")))


def highest_entropy(value: Column) -> Column:
    """The largest Shannon entropy of a window of the string, in bits a character."""
    return _scan(value)["best"]


def _looks_random(value: Column) -> Column:
    parts = F.filter(F.split(value, STAND_IN), lambda p: F.char_length(p) >= WINDOW)
    return F.exists(parts, lambda p: _scan(p)["random"])


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id``, ``base``, the known shapes, and ``random``, other
    strings of high entropy, both ``array<struct<kind, start, end, value>>``."""
    text = F.col("text")
    assigned = F.filter(
        matches(text, ASSIGN, "assign"),
        lambda s: F.char_length(F.regexp_extract(s["value"], ASSIGNED, 1)) >= 6,
    )
    known = F.concat(
        assigned, matches(text, ACCESS, "access", needs="AKIA"), matches(text, HEX, "hex")
    )
    candidates = F.filter(matches(text, CANDIDATE, "entropy"), lambda s: _looks_random(s["value"]))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.select("doc_id", known.alias("base"), candidates.alias("random"))


def _in_order(spans: Column) -> Column:
    """By start, then kind as listed."""
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("at"), F.element_at(rank, s["kind"]).alias("rank"), s["kind"], s["start"], s["end"]
        ),
    )
    return F.array_sort(keyed)


def report(found: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the known shapes, and all spans written out."""
    base = F.col("base")
    return found.select(
        "doc_id",
        *[of_kind(base, k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(_in_order(base)), 256).alias("base_sha256"),
        listed(_in_order(F.concat("base", "random"))).alias("spans"),
    )
