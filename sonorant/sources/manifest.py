"""JSON-lines manifests with physical line numbers, and their sinks."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T

from .files import write_whole


def _places(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    """What each path or pattern names, without scheme, and the path's place in the list; a repeated one counts by its last."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for i, p in enumerate(paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(conf).globStatus(path) or ()
        out += [(s.getPath().toUri().getPath(), i) for s in found]
    return out


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file_ord, file, line_number, value) of text files or folders; numbers start at 1 in each file and count blank lines.

    All paths are one scan, however many; file_ord is the place of the path in
    the list that a file lies at or under. Files are read in splits. A line's
    place in its split comes from the order within the task, a split's first
    number from the counts of the splits before it: one small row a split, so
    their number grows with the files, and the planner sees by their measured
    size whether to broadcast them.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no paths")
    rows = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"))
    blocks = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    places = F.array(*[F.struct(F.lit(p).alias("at"), F.lit(i).alias("i")) for p, i in _places(spark, paths)])
    own = F.url_decode(F.regexp_replace(F.regexp_replace("file", r"\+", "%2B"), "^[a-z0-9]+:(//[^/]*)?", ""))
    under = F.filter(places, lambda p: (own == p["at"]) | own.startswith(F.concat(p["at"], F.lit("/"))))
    blocks = blocks.withColumn("file_ord", F.array_max(F.transform(under, lambda p: p["i"])))
    return rows.join(blocks.drop("n"), ["file", "block"]).select(
        "file_ord", "file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line_number"), "value")


def read_manifest(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Typed columns, line_number, file_ord and the line itself as `raw`, so unknown keys survive.

    Blank lines are skipped; a line that is no JSON object fails the query with
    its number. Scalars are read as text and cast, so quoted numbers count and
    what cannot be cast is null.
    """
    lines = read_lines(spark, paths).where(F.trim("value") != "")
    kinds = T.StructType.fromDDL(schema)
    simple = (T.StringType, T.DoubleType, T.IntegerType, T.LongType, T.BooleanType)
    as_text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, simple) else f.dataType) for f in kinds])
    bad = F.concat(F.lit("not a JSON object in line "), F.col("line_number").cast("string"))
    checked = F.when(F.json_object_keys("value").isNull(), F.raise_error(bad)).otherwise(F.col("value"))
    parsed = lines.select("file_ord", "file", "line_number", F.col("value").alias("raw"), F.from_json(checked, as_text).alias("r"))
    columns = [
        (F.col(f"r.{f.name}").try_cast(f.dataType) if isinstance(f.dataType, simple) else F.col(f"r.{f.name}")).alias(f.name) for f in kinds
    ]
    return parsed.select("file_ord", "file", "line_number", "raw", *columns)


def write_jsonl(df: DataFrame, path: str) -> int:
    """The rows as JSON lines in a folder that appears whole or not at all; nulls are written; returns the count."""
    seen = Observation()
    df.observe(seen, F.count("*").alias("n")).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def write_json(path: str, value: object) -> None:
    """A report as one JSON document, on any file system; readers see the old one or the whole new one."""
    write_whole(path, json.dumps(value, ensure_ascii=False, indent=2, default=str).encode("utf-8"))


def remove(spark: SparkSession, path: str) -> None:
    """A file or folder of the session's file systems, gone."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def load_env(path: str) -> None:
    """KEY=VALUE lines into the environment; what is set already stays."""
    if not os.path.exists(path):
        return
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        key, found, value = line.strip().partition("=")
        if found and key and not key.startswith("#"):
            os.environ.setdefault(key.strip(), value.strip().strip("'\""))
