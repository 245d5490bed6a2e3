"""New manifest files as a stream through the stateless stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import LABELED_GATES, QualityGates, TextGates
from ..functions.text import normalize_text
from ..operators import gates
from ..operators.features import MUSIC, OVERLAP, QUALITY


def judged_stream(spark: SparkSession, folder: str, schema: str, quality_gates: QualityGates = LABELED_GATES,
                  text_gates: TextGates = TextGates(), files_per_trigger: int = 100) -> DataFrame:
    """JSON-lines files that arrive in a folder, each row with its reject_reasons from the manifest's own columns."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)
    nothing = {}
    for name, columns in (("q", QUALITY), ("o", OVERLAP), ("m", MUSIC)):
        kinds = ", ".join(f"{c}: {'string' if c == 'status' else 'boolean' if c == 'is_music' else 'double'}" for c in columns)
        nothing[name] = F.lit(None).cast(f"struct<{kinds}>")
    own = QualityGates(**{**quality_gates.__dict__, "require_quality": False, "require_overlap": False, "require_music": False})
    reasons = gates.all_reasons(
        gates.quality_reasons(F.col("duration"), F.col("sample_rate"), nothing["q"], nothing["o"], nothing["m"], own),
        gates.text_reasons(F.col("text"), F.col("__clean"), F.col("duration"), text_gates))
    return rows.withColumn("__clean", normalize_text(F.col("text"))).withColumn("reject_reasons", reasons).drop("__clean")


def reason_counts(judged: DataFrame, time: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Reasons by window of event time, with a watermark for late rows."""
    return (
        judged.withWatermark(time, late).select(time, F.explode("reject_reasons").alias("reason"))
        .groupBy(F.window(time, window), "reason").agg(F.count("*").alias("n"))
    )
