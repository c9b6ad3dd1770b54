"""Values that stand for many columns' rows evenly, told from all rows.

Rows are first added up per distinct value of a column, in one pass. The values are stored
in ranges, within which rows are counted on top of the totals of the ranges below, so no
task sees all values of a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from roadcast.session import remove_path, scratch_path

STORED = "column INT, value DOUBLE, rows BIGINT, part INT"


def steps_of(df: DataFrame, columns: Sequence[str], most: int) -> dict[str, list[float]]:
    """For each column, a double without NaN, at most ``most`` of its values, in order, each
    for about as many rows; all of its values where they are no more. A value with more rows
    than half such a step has one of its own, and the other rows share what is left. Nulls
    are left out."""
    spark = df.sparkSession
    path = scratch_path(spark, "values")
    cells = F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).alias("value")) for i, c in enumerate(columns)])
    counted = df.select(F.inline(cells)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("rows"))
    try:
        counted.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id()).write.parquet(path)
        return _steps(spark.read.schema(STORED).parquet(path), columns, most)
    finally:
        remove_path(spark, path)


def _steps(stored: DataFrame, columns: Sequence[str], most: int) -> dict[str, list[float]]:
    # A row per column.
    sizes = stored.groupBy("column").agg(F.sum("rows").alias("rows"), F.count("*").alias("values")).collect()
    few = [r["column"] for r in sizes if r["values"] <= most]
    many = {r["column"]: r["rows"] for r in sizes if r["values"] > most}
    steps: dict[int, list[float]] = {i: [] for i in range(len(columns))}
    for r in stored.where(F.col("column").isin(few)).select("column", "value").collect():
        steps[r["column"]].append(r["value"])
    if many:
        grid = _at(_ranked(stored), {i: (n, range(1, 2 * most), 2 * most) for i, n in many.items()})
        heavy = {i: {a: n for (a, n), (b, _) in zip(found, found[1:]) if a == b} for i, found in grid.items()}
        for i, found in grid.items():
            steps[i] = [value for value, _ in found[::2]]
        rest = {i: (many[i] - sum(found.values()), most - len(found)) for i, found in heavy.items() if found}
        if rest:
            known = [(i, value) for i in rest for value in heavy[i]]
            known = stored.sparkSession.createDataFrame(known, "column INT, value DOUBLE")
            others = stored.where(F.col("column").isin(list(rest))).join(F.broadcast(known), ["column", "value"], "left_anti")
            found = _at(_ranked(others), {i: (n, range(1, 2 * k, 2), 2 * k) for i, (n, k) in rest.items()})
            steps |= {i: [*heavy[i], *(value for value, _ in found[i])] for i in rest}
    return {c: sorted(set(steps[i])) for i, c in enumerate(columns)}


def _ranked(stored: DataFrame) -> DataFrame:
    """With ``upto``, how many of the column's rows are not above the value."""
    ranges = stored.groupBy("column", "part").agg(F.min("value").alias("first"), F.sum("rows").alias("rows"))
    below = Window.partitionBy("column").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    below = ranges.select("column", "part", F.coalesce(F.sum("rows").over(below), F.lit(0)).alias("below"))
    within = F.sum("rows").over(Window.partitionBy("column", "part").orderBy("value"))
    # As many ranges as tasks wrote, for each column.
    return stored.withColumn("upto", within).join(F.broadcast(below), ["column", "part"]).withColumn(
        "upto", F.col("upto") + F.col("below")
    )


def _at(ranked: DataFrame, shares: dict[int, tuple[int, Sequence[int], int]]) -> dict[int, list[tuple[float, int]]]:
    """The values, with their rows, at shares of a column's rows: at the first row that so
    many do not exceed. Of each column is told how many rows it has, the shares, and what
    they are parts of."""
    spark = ranked.sparkSession
    scales = spark.createDataFrame([(i, n, of) for i, (n, _, of) in shares.items()], "column INT, n BIGINT, of BIGINT")
    asked = [(i, k, -(-share * n // of)) for i, (n, own, of) in shares.items() for k, share in enumerate(own)]
    asked = spark.createDataFrame(asked, "column INT, k INT, nth BIGINT")
    # Few values reach a further share than the one below, and only these are compared.
    upto, under = F.col("upto"), F.col("upto") - F.col("rows")
    scaled = ranked.join(F.broadcast(scales), "column")
    near = scaled.where(F.expr("upto * of div n > (upto - rows) * of div n"))
    hit = (F.col("nth") <= upto) & (F.col("nth") > under)
    found = near.join(F.broadcast(asked), "column").where(hit).select("column", "k", "value", "rows").collect()
    at = {(r["column"], r.k): (r["value"], r["rows"]) for r in found}
    return {i: [at[i, k] for k in range(len(own))] for i, (_, own, _) in shares.items()}
