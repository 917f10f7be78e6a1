"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(columns: list[str], base: str) -> str:
    """A column name that clashes with none of ``columns`` (Spark compares names without case)."""
    taken, name = {c.lower() for c in columns}, base
    while name.lower() in taken:
        name = "_" + name
    return name


BATCH_ROWS = 1000    # texts may be long: as many rows at once bound a Python worker's memory


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package (``--py-files`` does the same at submission) and small batches.

    The archive is staged on the driver only; Spark hands it to the executors.
    """
    sc, batch = spark.sparkContext, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch)) <= BATCH_ROWS:
        spark.conf.set(batch, BATCH_ROWS)
    if getattr(sc, "_package_shipped", None) == __package__:
        return
    root = pathlib.Path(__file__).resolve().parents[1]
    staged = pathlib.Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(staged, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(staged))
    sc._package_shipped = __package__


def low_hash(pick: Column, share: float) -> Column:
    """True for about ``share`` of the values of a 64-bit hash, always the same ones."""
    return F.lit(True) if share >= 1 else pick < F.lit(int(share * 2.0 ** 64) - 2 ** 63)
