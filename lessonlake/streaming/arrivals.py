"""Pages as they arrive: the gate on a stream of files, and windowed counts with a watermark.

The archive's raw texts are write-once, so a file stream with the availableNow trigger processes exactly what
has arrived since the last run; the checkpoint folder remembers it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality

PAGES = "page_id bigint, publication_id string, page_number int, source string, text string, ocr_confidence double, extracted_at timestamp"


def arriving_pages(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def gate_stream(pages: DataFrame) -> DataFrame:
    """The gate is row by row, so it runs on a stream as it is."""
    return quality.gate(pages).select("page_id", "publication_id", "page_number", F.array_join("gate_issues", ",").alias("issues"), F.col("gate_status").alias("status"), F.col("gate_score").alias("score"), "extracted_at")


def status_windows(gated: DataFrame, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Pages by status and window of extraction; later than `late` is dropped, rows without a time are left out."""
    x = gated.where("extracted_at is not null").withWatermark("extracted_at", late)
    return x.groupBy(F.window("extracted_at", width), "status").agg(F.count("*").alias("n_pages")).select(F.col("window.start").alias("window_start"), "status", "n_pages")


def run_available(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Processes all that has arrived, then stops. Files of a batch are committed once, also after a restart."""
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
