"""Sources and sinks: CSV scans, JSON-lines "collections", file listings.

All reads take an explicit schema when one is known (no inference pass over the data), all paths are
Hadoop-FS URIs (file://, hdfs://, s3a://, ...), and missing inputs raise one typed error.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Python codec names the reference uses → the Java charset names Spark accepts (it rejects "latin-1").
ENCODING_ALIASES = {
    "latin-1": "ISO-8859-1", "latin1": "ISO-8859-1", "iso-8859-1": "ISO-8859-1", "l1": "ISO-8859-1",
    "cp1252": "windows-1252", "utf8": "UTF-8", "utf-8": "UTF-8", "ascii": "US-ASCII",
}


class SourceNotFound(FileNotFoundError):
    """The input path does not exist."""


def java_charset(encoding: str) -> str:
    return ENCODING_ALIASES.get(encoding.lower(), encoding)


def _guard(fn, path):
    try:
        return fn()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SourceNotFound(path) from e
        raise


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True,
             encoding: str = "utf-8", **options) -> DataFrame:
    """CSV with header; ``''`` → null, ``' '`` stays a string (as in pandas). Without a schema every
    column is read as string (no inference pass); coerce with :func:`quarry.functions.scalar.to_number`."""
    reader = spark.read.option("header", header).option("encoding", java_charset(encoding))
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    return _guard(lambda: reader.csv(path), path)


def write_csv(df: DataFrame, path: str, encoding: str = "utf-8", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("encoding", java_charset(encoding)).csv(path)


def _write_json(df: DataFrame, path: str, mode: str) -> int:
    obs = Observation("written")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).json(path)
    return int(obs.get["rows"])


def replace_collection(df: DataFrame, path: str) -> int:
    """Replace a document collection (JSON lines); returns the number of documents written, counted
    by an observation on the write itself (no second pass)."""
    return _write_json(df, path, "overwrite")


def append_collection(df: DataFrame, path: str) -> int:
    """Append documents; re-running duplicates them, as the reference does."""
    return _write_json(df, path, "append")


def read_collection(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read a collection back, without a store-assigned ``_id`` field."""
    df = _guard(lambda: spark.read.schema(schema).json(path), path)
    return df.drop("_id")


def list_files(spark: SparkSession, folder: str, extension: str = ".png", recursive: bool = False) -> DataFrame:
    """``(stem, path)`` for the files in ``folder`` ending in ``extension`` (case-insensitive),
    ``stem`` = lower-cased file name without the last extension. Only file metadata is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    listing = _guard(lambda: reader.load(folder).select("path"), folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    listing = listing.where(F.lower(name).endswith(extension.lower()))
    return listing.select(F.lower(F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)).alias("stem"), "path")
