"""Sources: file listings, binary-file scans, ground-truth JSON, batch scans (SRC1-6)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from folio.operators.intake import path_keys
from folio.schemas import GROUND_TRUTH, MANIFEST

# <root>/<volume>/<day_id>/<name>.<ext>
LISTING_RE = r"/([^/]+)/([^/]+)/([^/]+)\.([A-Za-z0-9]+)$"


def _binary(spark: SparkSession, root: str, glob: str | None) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root)


def scan_files(spark: SparkSession, root: str, glob: str = "*.pdf") -> DataFrame:
    """SRC1: PDFs under ``root`` (recursive) as (path, length, filename, folder_id).
    Only path and length are selected, so the file contents are never read."""
    df = _binary(spark, root, glob).select("path", "length")
    return path_keys(df)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """SRC5: every file under ``root`` as (volume, day_id, filename, ext, size);
    ``ext`` is lower-cased so suffix tests are case-insensitive; a missing
    folder is an empty listing, not an error."""
    try:
        df = _binary(spark, root, None).select("path", "length")
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex) or "does not exist" in str(ex):
            return spark.createDataFrame([], MANIFEST)
        raise
    p = F.col("path")
    return df.select(F.regexp_extract(p, LISTING_RE, 1).alias("volume"),
                     F.regexp_extract(p, LISTING_RE, 2).alias("day_id"),
                     F.regexp_extract(p, LISTING_RE, 3).alias("filename"),
                     F.lower(F.regexp_extract(p, LISTING_RE, 4)).alias("ext"),
                     F.col("length").alias("size"))


def pdf_stems(listing: DataFrame, volume: str) -> DataFrame:
    return listing.where((F.col("volume") == volume) & (F.col("ext") == "pdf")).select("day_id", "filename")


def json_stems(listing: DataFrame, volume: str) -> DataFrame:
    return listing.where((F.col("volume") == volume) & (F.col("ext") == "json")).select("day_id", "filename")


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: ground-truth JSON files (one object per file) with an explicit schema;
    the key is the file stem, taken from the file metadata column."""
    df = spark.read.schema(GROUND_TRUTH).option("multiLine", "true").json(path)
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    return df.select("*", stem.alias("file_stem"))


def batch(df: DataFrame, day_id: str) -> DataFrame:
    """SRC2: one batch; on a table partitioned by day_id this prunes partitions."""
    return df.where(F.col("day_id") == day_id)


def params_df(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """SRC6: a small parameter relation (explicit schema, never interpolated into SQL).
    Join it with ``F.broadcast`` only when it is known to be small."""
    return spark.createDataFrame(list(rows), schema)
