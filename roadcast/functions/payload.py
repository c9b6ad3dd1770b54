"""Payload text as one JSON object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_OPTIONS = {"allowSingleQuotes": "false"}


def _objects(body: str, schema: str) -> Column:
    """The body and a marker behind it as an array of JSON objects. The parser stops at
    the end of the first value, so both are put in brackets; a body that closes the
    bracket itself leaves the marker out. The marker is a digest of the body, which no
    body holds."""
    wrapped = F.concat(F.lit("["), F.col(body), F.lit(',{"__end":"'), F.md5(body), F.lit('"}]'))
    return F.from_json(wrapped, f"ARRAY<STRUCT<{schema.strip()}, __end: STRING>>", _OPTIONS)


def _is_whole(objects: Column, body: str) -> Column:
    """Whether there is one object in front of the marker."""
    return (
        (F.size(objects) == 2)
        & F.get(objects, F.lit(0)).isNotNull()
        & F.get(objects, F.lit(1))["__end"].eqNullSafe(F.md5(body))
    )


def with_document(
    landed: DataFrame,
    schema: str,
    of_shape: Column,
    otherwise: Column,
    name: str,
    body: str = "body",
    fine: str | None = None,
) -> DataFrame:
    """Add ``name``: ``of_shape``, an expression over ``_doc``, the body parsed by the
    struct ``schema``, where the whole body is one JSON object with nothing of another
    type in it; else ``otherwise``, which may take the body apart with more care. Which
    of the two it was is told by a column ``fine``, if named."""
    document = F.concat(F.lit('{"v":['), F.col(body), F.lit(',{"__end":"'), F.md5(body), F.lit('"}]}'))
    kind = f"STRUCT<v: ARRAY<STRUCT<{schema.strip()}, __end: STRING>>, _bad: STRING>"
    parsed = F.from_json(document, kind, _OPTIONS | {"columnNameOfCorruptRecord": "_bad"})
    objects = F.col("_parsed.v")
    whole = F.col("_parsed._bad").isNull() & _is_whole(objects, body)
    of_doc = (
        landed.withColumn("_parsed", parsed)
        .withColumn("_doc", F.when(whole, F.get(objects, F.lit(0))))
        .withColumn(name, F.when(F.col("_doc").isNotNull(), of_shape).otherwise(otherwise))
    )
    if fine:
        of_doc = of_doc.withColumn(fine, F.col("_doc").isNotNull())
    return of_doc.drop("_parsed", "_doc")


def object_in(body: str, schema: str) -> Column:
    """The body by the struct ``schema`` where it is one JSON object, else null."""
    found = F.transform(
        F.array(_objects(body, schema)),
        lambda o: F.when(_is_whole(o, body), F.get(o, F.lit(0))),
    )
    return F.get(found, F.lit(0))


def objects_in(texts: Column, parse) -> Column:
    """An array of texts as one of parsed objects, null where a text is no object."""
    return F.transform(texts, lambda t: F.when(looks_like_object(t), parse(t)))


def is_object(body: str = "body") -> Column:
    """Whether the whole body is exactly one JSON object."""
    # Bound to a name within the expression, so that it is parsed once.
    found = F.transform(F.array(_objects(body, "any: STRING")), lambda o: _is_whole(o, body))
    return F.coalesce(F.get(found, F.lit(0)), F.lit(False))


def looks_like_object(text: Column) -> Column:
    """Whether text cut out of a parsed payload was an object there."""
    return F.coalesce(text.startswith("{"), F.lit(False))


def has_gaps(found: Column, shape: Sequence[tuple[str, bool]]) -> Column:
    """Whether an array on the way down a parsed struct of the ``shape`` has a null item,
    the one fault that a document with nothing of another type can have."""
    if not shape:
        return F.lit(False)
    (name, many), rest = shape[0], shape[1:]
    child = found[name]
    deeper = F.exists(child, lambda x: x.isNull() | has_gaps(x, rest)) if many else has_gaps(child, rest)
    return F.coalesce(deeper, F.lit(False))


def shape_faults(text: Column, shape: Sequence[tuple[str, bool]]) -> Column:
    """What is of the wrong shape on the way down an object, as
    ``array<struct<reason, body>>``. ``shape`` names the fields and tells whether each
    holds an array of objects. Absent and null fields are no fault."""
    if not shape:
        return F.expr("cast(array() as array<struct<reason: string, body: string>>)")
    (name, many), rest = shape[0], shape[1:]

    def fault(reason: str, found: Column) -> Column:
        return F.array(F.struct(F.lit(reason).alias("reason"), found.alias("body")))

    def in_item(item: Column) -> Column:
        wrong = fault(f"an item of {name} is not an object", F.coalesce(item, F.lit("null")))
        return F.when(looks_like_object(item), shape_faults(item, rest)).otherwise(wrong)

    def below(child: Column) -> Column:
        if many:
            deeper = F.flatten(F.transform(F.from_json(child, "ARRAY<STRING>"), in_item))
        else:
            deeper = shape_faults(child, rest)
        kind = "an array" if many else "an object"
        return (
            F.when(child.isNull(), shape_faults(child, ()))
            .when(child.startswith("[" if many else "{"), deeper)
            .otherwise(fault(f"{name} is not {kind}", child))
        )

    child = F.from_json(text, f"{name} STRING", _OPTIONS)[name]
    return F.flatten(F.transform(F.array(child), below))
