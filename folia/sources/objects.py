"""Listing of stored objects."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from folia.functions.naming import is_control, is_pdf, iso_utc
from folia.schemas import LISTING


def list_objects(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Objects below ``root`` whose names start with ``prefix``; contents are not read.

    Only the folder that the prefix names is listed. A prefix without objects gives none.
    """
    folder = prefix.rpartition("/")[0]
    options = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    start = f"{root.rstrip('/')}/{folder}" if folder else root
    try:
        found = options.load(start)
    except AnalysisException as missing:
        if not folder or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    base = root.split("://", 1)[-1].rstrip("/") + "/"
    listing = found.select(
        F.col("path").alias("uri"),
        F.substr("path", F.locate(base, F.col("path")) + len(base)).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("updated"),
    )
    return under_prefix(listing, prefix)


def under_prefix(listing: DataFrame, prefix: str = "") -> DataFrame:
    return listing.where(F.col("name").startswith(prefix))


def pdfs(listing: DataFrame) -> DataFrame:
    return listing.where(is_pdf(F.col("name")))


def without_control_files(listing: DataFrame) -> DataFrame:
    return listing.where(~is_control(F.col("name")))


def file_info(listing: DataFrame) -> DataFrame:
    """The columns handed to a scheduled run, with defaults for missing values."""
    return listing.select(
        F.col("uri").alias("gcs_uri"),
        F.col("name").alias("filename"),
        F.coalesce("size", F.lit(0)).alias("size"),
        F.coalesce(iso_utc(F.col("updated")), F.lit("")).alias("updated"),
    )
