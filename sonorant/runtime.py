"""Session-level helpers shared by every operator."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for lineage cuts: the session's own setting, else (local mode only) a new folder.

    On a cluster the folder must be shared by all executors, so there is no
    fallback outside local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sonorant-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of executors and keep their partitioning."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Session setting: partitions of a scan before costly work on each row. Unset, scans stay as they are read.
SCAN_PARTITIONS = "spark.sonorant.scanPartitions"


def spread(scan: DataFrame) -> DataFrame:
    """A table just read, before costly work on each row.

    The plan does not depend on the table: it is the scan, unless the session
    sets SCAN_PARTITIONS, which is for tables laid out in fewer row groups than
    there are cores (a single small file is one task otherwise).
    """
    wanted = scan.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return scan.repartition(int(wanted)) if wanted else scan


def global_row_numbers(df: DataFrame, order: list, number: str) -> DataFrame:
    """Number all rows 0, 1, 2 ... in a total order without bringing them into one task.

    Rows are range-partitioned and sorted, each partition numbers its own rows,
    and the offsets of the partitions are broadcast: one small row each, so no
    more than the partitions the session asks for. The order must be total (end
    in a unique key), or equal rows may swap.
    """
    local, part = "__local_row", "__part_row"
    ranged = cut(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(local, F.monotonically_increasing_id())
    )
    ranged = ranged.withColumn(part, F.shiftright(local, 33)).withColumn(
        local, F.col(local).bitwiseAND(F.lit((1 << 33) - 1))
    )
    counts = ranged.groupBy(part).agg(F.count("*").alias("__rows"))
    offsets = counts.select(part, (F.sum("__rows").over(Window.orderBy(part)) - F.col("__rows")).alias("__offset"))
    return (
        ranged.join(F.broadcast(offsets), part)
        .withColumn(number, F.col("__offset") + F.col(local))
        .drop(part, local, "__offset")
    )
