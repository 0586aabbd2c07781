"""Archived objects and warehouse tables as DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.schemas import PARSED_RECORD, POST, extended

_CORRUPT = "_corrupt"
#: Archived documents, gzipped or not.
JSON_FILES = "*.{json,json.gz}"


def _since(reader, since: dt.datetime | None):
    if since is None:
        return reader
    return reader.option("modifiedAfter", since.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S"))


def scan_parsed_json(
    spark: SparkSession, prefix: str, since: dt.datetime | None = None, one_per_object: bool = True,
) -> DataFrame:
    """Parsed records below a prefix: one document per ``.json`` or ``.json.gz`` object, or JSON lines.

    Adds object_key; an unreadable document arrives with _corrupt filled.
    """
    schema = extended(PARSED_RECORD, _CORRUPT)
    reader = (
        spark.read.schema(schema).option("multiLine", one_per_object).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT).option("pathGlobFilter", JSON_FILES)
        .option("recursiveFileLookup", True)
    )
    return _since(reader, since).json(prefix).withColumn("object_key", F.col("_metadata.file_path"))


def _objects(spark: SparkSession, prefix: str, glob: str) -> DataFrame:
    """Paths and times of the objects below a prefix. Lists names only; no content is read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(prefix)
        .select("path", "modificationTime")
    )


def count_objects(spark: SparkSession, prefix: str, glob: str = "*.json") -> int:
    return _objects(spark, prefix, glob).count()


def count_skipped(spark: SparkSession, prefix: str, since: dt.datetime | None) -> int:
    """Objects older than ``since``."""
    if since is None:
        return 0
    return _objects(spark, prefix, JSON_FILES).filter(F.col("modificationTime") < F.lit(since)).count()


def scan_pages_gz(spark: SparkSession, prefix: str, suffix: str = ".html.gz") -> DataFrame:
    """Gzipped pages as (key, object_key, html); the key is the file stem."""
    stem = "([^/]+)" + suffix.replace(".", "\\.") + "$"
    return (
        spark.read.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True)
        .text(prefix, wholetext=True)
        .select(
            F.regexp_extract(F.col("_metadata.file_path"), stem, 1).alias("key"),
            F.col("_metadata.file_path").alias("object_key"), F.col("value").alias("html"),
        )
    )


def skip_already_parsed(pages: DataFrame, parsed_ids: DataFrame, force: bool = False) -> DataFrame:
    """Pages whose key has no parsed record yet."""
    if force:
        return pages
    return pages.join(parsed_ids.select(F.col("source_job_id").alias("key")), "key", "left_anti")


def scan_posts_json_gz(spark: SparkSession, prefix: str, one_per_object: bool = True) -> DataFrame:
    """Archived posts in gzipped JSON, with their file key."""
    return (
        spark.read.schema(extended(POST, _CORRUPT))
        .option("multiLine", one_per_object).option("columnNameOfCorruptRecord", _CORRUPT)
        .option("pathGlobFilter", "*.json.gz").option("recursiveFileLookup", True).json(prefix)
        .withColumn("key", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json\.gz$", 1))
    )


def scan_listing_json(spark: SparkSession, prefix: str, one_per_object: bool = True) -> DataFrame:
    """Listing responses as one row per record: (object_key, nb_pages, job_id, alias, position)."""
    raw = (
        spark.read.schema("data array<struct<jobId:string,alias:string>>, meta struct<nbPages:int>")
        .option("multiLine", one_per_object).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
        .json(prefix)
    )
    return raw.select(
        F.col("_metadata.file_path").alias("object_key"), F.col("meta.nbPages").alias("nb_pages"),
        F.posexplode("data").alias("position", "r"),
    ).select("object_key", "nb_pages", "position", F.col("r.jobId").alias("job_id"), F.col("r.alias").alias("alias"))


def scan_function_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """JSON:API taxonomy file as (group_id, group_name, function_id, function_name)."""
    names = "attributes struct<nameEn:string,nameVi:string>"
    links = "relationships struct<jobFunction:struct<data:array<struct<id:bigint>>>>"
    raw = (
        spark.read.option("multiLine", True)
        .schema(
            f"data array<struct<id:bigint,{_typed(names)},{_typed(links)}>>, "
            f"included array<struct<id:bigint,{_typed(names)}>>"
        )
        .json(path)
    )
    groups = raw.select(F.explode("data").alias("g")).select(
        F.col("g.id").alias("group_id"), F.col("g.attributes.nameEn").alias("group_name"),
        F.explode("g.relationships.jobFunction.data").alias("f"),
    )
    functions = raw.select(F.explode("included").alias("i")).select(
        F.col("i.id").alias("function_id"), F.col("i.attributes.nameEn").alias("function_name")
    )
    return groups.select("group_id", "group_name", F.col("f.id").alias("function_id")).join(functions, "function_id")


def _typed(field: str) -> str:
    """'name type' to the 'name:type' form used inside struct<>."""
    return field.replace(" ", ":", 1)


def scan_warehouse_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table
