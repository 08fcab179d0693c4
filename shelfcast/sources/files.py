"""Folder inventory and result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """Files below ``folder`` with the (case-sensitive) extension: path, stem, size.

    File contents are never read: only the listing columns are selected.
    """
    name = F.element_at(F.split("path", "/"), -1)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{extension}")
        .load(folder)
    )
    return files.select(
        "path",
        "length",
        F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"),
        F.regexp_extract(name, r"\.([^.]*)$", 1).alias("extension"),
    )


def write_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a result table as CSV with a header, or parquet."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        # Keep blank text as it is; Spark would trim it on writing.
        keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(header=True, **keep).csv(path)
    else:
        writer.format(fmt).save(path)
