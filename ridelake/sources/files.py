"""File and table sources. Every reader takes an explicit schema: no
inference pass, stable types across files, and malformed values become
NULL in typed columns instead of failing the job."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.schemas import STATION_INFO_DOC, STATUS_DOC, TRIP_CSV

MONTH_PARTITION = "month"
# ``enforceSchema=false``: a file whose header names other columns, or these in
# another order, fails the read instead of filling the wrong columns.
# Trip files follow RFC 4180: fields with commas are quoted and a quote inside
# a field is doubled; Spark's reader escapes with a backslash unless told.


def read_trips_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Header CSV scan of one monthly trip file or a directory of parts.
    Only ``*.csv`` files are read; Spark's listing already skips hidden and
    ``_``-prefixed entries such as archive-tool metadata folders."""
    reader = (spark.read.schema(TRIP_CSV).option("header", True).option("enforceSchema", False).option("escape", '"')
              .option("mode", "PERMISSIVE").option("pathGlobFilter", "*.csv"))
    return reader.csv(path if isinstance(path, str) else list(path))


def read_multi_part_csv(spark: SparkSession, month_dir: str) -> DataFrame:
    """Every CSV part anywhere under one month's landing folder (archives
    that unpack into several parts or sub-folders)."""
    return (spark.read.schema(TRIP_CSV).option("header", True).option("enforceSchema", False).option("escape", '"')
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
            .csv(month_dir)
            .filter(~F.col("_metadata.file_path").contains("/__MACOSX/")))


def read_trip_months(spark: SparkSession, root: str, months: Sequence[str] | None = None) -> DataFrame:
    """All months under ``root/month=YYYYMM/`` in ONE scan (no driver loop).

    Only the requested month folders are listed (directory pruning), each is
    read recursively so an archive that unpacked into several parts or
    sub-folders is read whole, and the month comes from the file's folder
    name as a string."""
    paths = [os.path.join(root, f"{MONTH_PARTITION}={m}") for m in months] if months else [root]
    df = (spark.read.schema(TRIP_CSV).option("header", True).option("enforceSchema", False).option("escape", '"')
          .option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.csv")
          .csv(paths))
    path = F.col("_metadata.file_path")
    return (df.filter(~path.contains("/__MACOSX/"))
            .withColumn(MONTH_PARTITION, F.regexp_extract(path, MONTH_PARTITION + r"=([0-9]{6})", 1)))


def read_station_snapshot_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Station-information documents (one JSON object per file when
    ``multi_line``; one per line otherwise)."""
    return spark.read.schema(STATION_INFO_DOC).option("multiLine", multi_line).json(path)


def parse_open_messages(df: DataFrame, col: str = "value") -> DataFrame:
    """JSON payloads as VARIANT documents (``doc``): nothing that they hold is lost to a
    schema; NULL for texts that are no JSON."""
    return df.withColumn("doc", F.try_parse_json(F.col(col)))


def read_open_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed JSON documents as VARIANT (``doc``), whatever their fields; with ``multi_line``
    a file is one document, or an array of them, over any number of lines."""
    files = spark.read.option("singleVariantColumn", "doc").option("multiLine", multi_line).json(path)
    return files.select(F.explode(F.coalesce(F.try_variant_get("doc", "$", "array<variant>"), F.array("doc"))).alias("doc"))


def parse_status_messages(df: DataFrame, col: str = "value") -> DataFrame:
    """Parse JSON payload strings into the status document structure."""
    return df.select(F.from_json(F.col(col), STATUS_DOC).alias("doc")).select("doc.*")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Structural check on a parsed batch (driver-side, schema only)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks required column(s): {missing}")
    return df


def split_malformed(df: DataFrame, required: str = "data") -> tuple[DataFrame, DataFrame]:
    """With an explicit schema a document lacking ``required`` parses with a
    NULL there: route those to a quarantine frame instead of failing."""
    ok = F.col(required).isNotNull()
    return df.filter(ok), df.filter(~ok)


def table_path(root: str, layer: str, name: str) -> str:
    return os.path.join(root, layer, name)


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """Named table scan (a model reading an upstream model or a raw table)."""
    return spark.read.parquet(table_path(root, layer, name))
