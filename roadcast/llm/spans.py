"""Places of pattern matches, with column functions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EMPTY = "cast(array() as array<struct<kind: string, start: int, end: int, value: string>>)"


def matches(text: Column, pattern: str, kind: str, needs: str | None = None) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<kind, start, end, value>>`` in
    characters, end exclusive. ``pattern`` never matches nothing. Texts without the
    string ``needs`` are not searched.

    Matches and what lies between them come from the same scan rules, so their lengths
    add up to places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(
        found,
        F.slice(between, 1, F.greatest(F.size(found), F.lit(0))),
        lambda m, gap: F.struct(m.alias("value"), F.char_length(gap).alias("gap")),
    )

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.char_length(pair["value"])
        own = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["value"].alias("value")
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(own)).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.expr(_EMPTY).alias("out"))
    placed = F.aggregate(pairs, begin, add, lambda state: state["out"])
    return placed if needs is None else F.when(text.contains(needs), placed).otherwise(F.expr(_EMPTY))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
