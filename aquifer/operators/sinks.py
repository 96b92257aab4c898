"""Sinks over Parquet."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import slug


def overwrite_partitions(df: DataFrame, path: str, by: list[str], spread: list[str] | None = None) -> None:
    """Replace only the partitions present in ``df``; rows are hashed on ``spread`` so that writers hold few files each."""
    out = df.repartition(*(spread or by))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


class PutError(ValueError):
    """What was put isn't what is there."""


def _file(spark: SparkSession, path: str):
    """A path as the cluster's file systems see it, and the file system it is on."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions published so far, in order; none if nothing was."""
    fs, there = _file(spark, f"{path}/current")
    if not fs.exists(there):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(there)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def point(spark: SparkSession, path: str, content: dict) -> int:
    """Add a pointer with this content; its number.

    Pointers are only added: a small file that gets its name, the next number, when it
    is whole; the highest number counts.  So a reader, or a crash in between, finds the
    old version or the new one.  There may be one writer at a time.
    """
    number = max(versions(spark, path), default=0) + 1
    fs, draft = _file(spark, f"{path}/current/{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if not fs.rename(draft, _file(spark, f"{path}/current/{number:09}.json")[1]):
        raise PutError(f"version {number} of {path} is there already")
    return number


def pointed(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """The content of a pointer, the one that counts if no number is given; None if nothing was published."""
    number = number or max(versions(spark, path), default=None)
    if number is None:
        return None
    fs, there = _file(spark, f"{path}/current/{number:09}.json")
    source = fs.open(there)
    content = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    source.close()
    return content


def publish(df: DataFrame, path: str) -> str:
    """Write a new version beside the old ones, then point to it."""
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/versions/{version}")
    point(df.sparkSession, path, {"version": version, "schema": df.schema.jsonValue()})
    return version


def published(spark: SparkSession, path: str, parts: Iterable[str] | None = None, number: int | None = None) -> DataFrame:
    """The rows of the version that counts, or of one with a number; of a table in parts, all or those named."""
    content = pointed(spark, path, number)
    if content is None:
        raise PutError(f"nothing is published in {path}")
    schema = T.StructType.fromJson(content["schema"])
    if "parts" not in content:
        return spark.read.schema(schema).parquet(f"{path}/versions/{content['version']}")
    names = content["parts"] if parts is None else [k for k in parts if k in content["parts"]]
    folders = [f"{path}/versions/{content['parts'][k]['folder']}" for k in names if content["parts"][k]["folder"] is not None]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def listed(spark: SparkSession, path: str) -> dict[str, list]:
    """The data files below a path by the folder they are in ('' for the path itself): name, size and time of each, in order of names."""
    fs, there = _file(spark, path)
    found: dict[str, list] = {}
    if not fs.exists(there):
        return found
    root = fs.resolvePath(there).toString().rstrip("/")
    files = fs.listFiles(there, True)
    while files.hasNext():
        f = files.next()
        inside = f.getPath().toString().removeprefix(root).strip("/")
        if not any(x[:1] in ("_", ".") for x in inside.split("/")):
            folder, _, name = inside.rpartition("/")
            found.setdefault(folder, []).append([name or f.getPath().getName(), f.getLen(), f.getModificationTime()])
    return {k: sorted(v) for k, v in found.items()}


def write_parts(df: DataFrame, path: str, by: Column | None, cluster: tuple[str, ...] = ()) -> dict[str, str]:
    """Write rows as a new version's parts, a folder each value of ``by`` (one part, '', without); the parts' folders.

    Large parts are split over tasks, small ones share one.  Rows of a file are sorted by
    ``cluster``, so that filters on it skip most of a file by its statistics.
    """
    version, spark = uuid.uuid4().hex, df.sparkSession
    if by is None:
        (df.sortWithinPartitions(*cluster) if cluster else df).write.parquet(f"{path}/versions/{version}")
        return {"": version}
    rows = df.withColumn("part_", by.cast("string")).hint("rebalance", "part_")
    (rows.sortWithinPartitions("part_", *cluster) if cluster else rows).write.partitionBy("part_").parquet(f"{path}/versions/{version}")
    return {unquote(k.removeprefix("part_=")): f"{version}/{k}" for k in listed(spark, f"{path}/versions/{version}")}


def history(spark: SparkSession, path: str) -> DataFrame:
    """A row each version and part: number, part and folder (null: a part without rows), read from the pointers."""
    read = spark.read.schema("version string, parts map<string, struct<folder: string>>").json(f"{path}/current")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).cast("int").alias("number")
    parts = F.coalesce("parts", F.create_map(F.lit(""), F.struct(F.col("version").alias("folder"))))
    return read.where("_metadata.file_name LIKE '%.json'").select(number, F.explode(parts).alias("part", "p")).select("number", "part", "p.folder")


def file_rows(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A row each data file of a version (the one that counts, if no number is given): part, file, size and time.  Files are listed, not read."""
    number = number or versions(spark, path)[-1]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{path}/versions")
    files = files.select(F.regexp_extract("path", "/versions/(.*)/([^/]+)$", 1).alias("folder"), F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("time"))
    return files.join(history(spark, path).where(F.col("number") == number), "folder").select("part", "file", "size", "time")


def insert_overwrite(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Replace all rows of a table by those of ``df``, which may read the table itself."""
    kept = df.select(*spark.table(name).columns)
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged-{uuid.uuid4().hex}"
    kept.write.parquet(path)
    spark.read.schema(kept.schema).parquet(path).write.insertInto(name, overwrite=True)
    fs, there = _file(spark, path)
    fs.delete(there, True)


def create_table(spark: SparkSession, name: str, ddl: str, partitioned: list[str] | None = None) -> None:
    """Create the namespace and table where they are missing."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    by = f" PARTITIONED BY ({', '.join(partitioned)})" if partitioned else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{by}")


def put_documents(docs: DataFrame, base: str, dataset: str) -> str:
    """Put raw documents (columns metadata and data), one file each, under country, city and day of the crawl; checks that they are there in full."""
    m = F.col("metadata")
    day = F.to_date(F.try_to_timestamp(m["crawled_at_utc"]))
    rows = docs.select(m["country_code"].alias("country"), slug(m["city_name"]).alias("city"), day.alias("crawl_date"), F.to_json(F.struct("metadata", "data")).alias("value"))
    path = f"{base}/raw/{dataset}/{uuid.uuid4().hex}"
    rows.write.partitionBy("country", "city", "crawl_date").option("maxRecordsPerFile", 1).text(path)
    spark = docs.sparkSession
    size = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.octet_length("value"))).first())
    sent, there = size(rows), size(spark.read.option("recursiveFileLookup", True).text(path))
    if sent != there or data_files(spark.read.option("recursiveFileLookup", True).text(path)) != sent[0]:
        raise PutError(f"sent {sent}, found {there} in {path}")
    return path


def records(events: DataFrame) -> DataFrame:
    """Events as keyed messages: the city is the key, so that its events stay in order."""
    return events.select(F.col("city_id").cast("string").alias("key"), F.to_json(F.struct(*events.columns)).alias("value"))


def produce(events: DataFrame, servers: str, topic: str) -> None:
    """Send events to a topic; needs the Kafka connector on the class path."""
    out = records(events).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    out.option("kafka.acks", "all").option("kafka.enable.idempotence", "true").option("kafka.compression.type", "gzip").save()


def produce_files(events: DataFrame, path: str, topic: str, partitions: int = 3) -> None:
    """Send events to files with Kafka's columns, for where the connector is absent: offsets count up in each partition."""
    order = Window.partitionBy("partition").orderBy("timestamp", "value")
    rows = records(events).withColumn("timestamp", F.to_timestamp(F.get_json_object("value", "$.produced_at_utc")))
    rows = rows.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int"))
    rows = rows.select(F.encode("value", "UTF-8").alias("value"), F.lit(topic).alias("topic"), "partition", (F.row_number().over(order) - 1).cast("long").alias("offset"), "timestamp")
    rows.write.mode("append").parquet(path)


def data_files(df: DataFrame) -> int:
    return len(df.inputFiles())
