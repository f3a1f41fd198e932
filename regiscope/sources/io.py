"""Scans and writes: delimited registers and lookups, snapshots, documents, GeoJSON lines, link pages, replies."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns kept of the register, and of the lookups. All codes are text: leading zeros matter.
REGISTER = ["CompanyName", "CompanyNumber", "RegAddress.CareOf", "RegAddress.AddressLine1", "RegAddress.AddressLine2", "RegAddress.PostTown", "RegAddress.PostCode", "CompanyCategory", "CompanyStatus", "CountryOfOrigin", "IncorporationDate",
            "SICCode.SicText_1", "SICCode.SicText_2", "SICCode.SicText_3", "SICCode.SicText_4", "URI"]
POSTCODES = "Postcode string, localauthority_code string, localauthority_name string, ITL221CD string, ITL221NM string, Eastings double, Northings double"
SIC = "SIC_5DIGIT_CODE string, SIC_5DIGIT_NAME string, SIC_3DIGIT_NAME string, SIC_2DIGIT_CODE string, SIC_2DIGIT_CODE_NUMERIC double, SIC_2DIGIT_NAME string, SIC_SECTION_NAME string"


def scratch(spark: SparkSession) -> str:
    """A new folder in the cluster's shared one (spark.checkpoint.dir); in local mode a temporary one where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/regiscope-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: computed once, and without its lineage."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder or file, if it is there, in whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text by their header, pruned to those kept, dots in names as underscores."""
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("inferSchema", False).csv(path)
    return raw.select(*(F.col(f"`{c}`").alias(c.replace(".", "_")) for c in REGISTER if c in raw.columns))


def read_lookup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All files of a folder, of schemas that may differ, with the file each row came from."""
    return spark.read.option("mergeSchema", True).parquet(path).withColumn("source_file", F.input_file_name())


def write_snapshot(df: DataFrame, path: str, date: str) -> None:
    """A dated partition, replaced when written again."""
    df.withColumn("snapshot_date", F.lit(date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def write_partitioned(df: DataFrame, path: str, key: str | list[str] = "archive") -> None:
    """A folder per archive (or for each combination of several keys); a rerun replaces only those that it writes."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*([key] if isinstance(key, str) else key)).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """A table of the catalog in buckets of a key, a sorted file each; tables of one number of buckets join, and group, by the key without a shuffle. Its files lie under `path`, if given."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def list_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length", "modificationTime")


def read_documents(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(F.col("path").alias("filelocation"), F.col("content").cast("string").alias("content"))


def features(df: DataFrame, x: str, y: str, properties: list[str]) -> DataFrame:
    """GeoJSON, a point feature in each line."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties"))).alias("value"))


def write_features(df: DataFrame, path: str, x: str, y: str, properties: list[str]) -> None:
    features(df, x, y, properties).write.mode("overwrite").text(path)


def read_points(spark: SparkSession, path: str, properties: str) -> DataFrame:
    schema = f"type string, geometry struct<type:string,coordinates:array<double>>, properties struct<{properties}>"
    return spark.read.schema(schema).json(path).select("properties.*", F.col("geometry.coordinates")[0].alias("x"), F.col("geometry.coordinates")[1].alias("y"))


def read_polygons(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Polygon and multi-polygon features of a GeoJSON collection: properties and parts, each an outer ring and its holes."""
    schema = f"features array<struct<geometry:struct<type:string,coordinates:string>,properties:struct<{properties}>>>"  # coordinates are as deep as the type says
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    rings = "array<array<array<double>>>"
    one, many = F.from_json("f.geometry.coordinates", rings), F.from_json("f.geometry.coordinates", f"array<{rings}>")
    points = lambda part: F.transform(part, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    found = F.when(F.col("f.geometry.type") == "Polygon", F.array(points(one))).when(F.col("f.geometry.type") == "MultiPolygon", F.transform(many, points))
    return f.select("f.properties.*", found.alias("parts")).where("parts IS NOT NULL")


def links(pages: DataFrame, html: str, key: str, *holds: str, base: str = "") -> DataFrame:
    """(key, pos, link) of the links in pages of which the address holds all the given texts."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r'<a [^>]*href="([^"]*)"'), F.lit(1))).alias("pos", "href"))
    for text in holds:
        found = found.where(F.col("href").contains(text))
    return found.select(key, "pos", F.concat(F.lit(base), "href").alias("link"))


def reply_postcode(reply: str) -> F.Column:
    """The postal code of a stored geocoder reply, NULL where it has none."""
    schema = "places array<struct<addressComponents:array<struct<longText:string,shortText:string,types:array<string>>>>>"
    parts = F.from_json(reply, schema)["places"][0]["addressComponents"]
    return F.try_element_at(F.filter(parts, lambda c: F.array_contains(c["types"], "postal_code")), F.lit(1))["longText"]
