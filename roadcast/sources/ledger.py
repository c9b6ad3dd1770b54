"""Which landed files have been taken in, so that a run reads only what is new.

The ledger has a row per file version taken in: ``source, file, size, modified``, how many
``payloads`` it had and how many things in them were ``rejected``, the ``outcome`` and the
``run``. A file is new while the ledger has none of its path, length and modification time.

Rows are added once everything of a run is stored. A run that dies before reads the same
files again, and stores the same rows under the same keys: nothing is counted twice. The
name of a run is made of its files, so what it writes by name is written over, too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadcast.session import path_exists, scratch_path
from roadcast.sources.landing import landed_file

SCHEMA = (
    "source STRING, file STRING, size BIGINT, modified TIMESTAMP, payloads BIGINT, rejected BIGINT, "
    "outcome STRING, run STRING"
)
# So many files are named one by one when they are read; of more, those in their span of
# modification times are opened and the others' lines dropped.
MOST_NAMED = 10_000
_FILE = ["file", "size", "modified"]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


@dataclass(frozen=True)
class Intake:
    """The files of a source that a run takes in."""

    ledger: str
    source: str
    files: DataFrame
    count: int
    run: str

    def only(self) -> Column:
        """The condition under which a read opens just these files."""
        if self.count <= MOST_NAMED:
            return F.col("_metadata.file_path").isin([r.file for r in self.files.select("file").collect()])
        span = self.files.agg(F.min("modified").alias("a"), F.max("modified").alias("b")).first()
        return F.col("_metadata.file_modification_time").between(span.a, span.b)

    def of(self, landed: DataFrame) -> DataFrame:
        """The payloads that came in these files."""
        if self.count <= MOST_NAMED:
            return landed
        asked = self.files.select(F.col("file").alias("_file"))
        return landed.join(asked, landed_file() == F.col("_file"), "left_semi")

    def record(self, parsed: DataFrame) -> None:
        """Enter the files, with what became of their payloads."""
        found = parsed.groupBy(landed_file().alias("file")).agg(
            F.count("*").alias("payloads"), F.sum(F.size("_faults")).alias("rejected")
        )
        none, rejected = F.col("payloads").isNull(), F.coalesce("rejected", F.lit(0))
        outcome = F.when(none, "empty").when(rejected > 0, "with rejects").otherwise("stored")
        rows = self.files.join(found, "file", "left").select(
            *_FILE,
            F.coalesce("payloads", F.lit(0)).alias("payloads"),
            rejected.alias("rejected"),
            outcome.alias("outcome"),
        )
        # Each run writes a folder of its own, so sources can be entered side by side.
        place = f"{self.ledger}/source={self.source}/run={self.run}"
        rows.hint("rebalance").write.mode("overwrite").parquet(place)


def new_files(spark: SparkSession, ledger: str, source: str, path: str) -> Intake:
    """What lies in a landing folder and is not in the ledger. Files are listed, none is
    opened."""
    listed = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
    known = read_ledger(spark, ledger).where(F.col("source") == source).select(*_FILE)
    copy = scratch_path(spark, f"{source}-intake")
    listed.join(known, _FILE, "left_anti").write.parquet(copy)
    files = spark.read.schema("file STRING, size BIGINT, modified TIMESTAMP").parquet(copy)
    of_file = F.xxhash64(*_FILE)
    told = files.agg(F.count("*").alias("n"), F.bit_xor(of_file).alias("x")).first()
    return Intake(ledger, source, files, told.n, f"{source}-{told.n}-{(told.x or 0) & (2**64 - 1):016x}")
