"""Writing tables and documents: write-once, by family, JSON and YAML documents, reports."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sections


def write_once(df: DataFrame, path: str, log: DataFrame | None = None, log_path: str | None = None) -> None:
    """Fails if the target exists, as raw extractions are never overwritten. The processing log is written beside it."""
    df.write.mode("errorifexists").parquet(path)
    if log is not None:
        write_json(log, log_path or f"{path}-log")


def write_classified(df: DataFrame, path: str) -> None:
    """One folder per family, overwritten; df has publication_id."""
    df.withColumn("classification", sections.classification(F.col("publication_id"))).write.mode("overwrite").partitionBy("classification").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Every row as one JSON object."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def write_json_by(df: DataFrame, path: str, key: str = "publication_id") -> None:
    """Every row as one JSON object, in a folder for each value of the key."""
    df.select(key, F.to_json(F.struct(*df.columns)).alias("value")).repartition(key).write.mode("overwrite").partitionBy(key).text(path)


def write_yaml(df: DataFrame, folder: str, path_column: str = "path") -> None:
    """Every row as a YAML document at its own path below `folder`, a folder all executors share."""
    names = [c for c in df.columns if c != path_column]
    docs = df.select(path_column, F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("doc"))

    def write(rows) -> None:
        import yaml

        for row in rows:
            target = Path(folder, row[0])
            target.parent.mkdir(parents=True, exist_ok=True)
            part = target.with_name(f".{target.name}.part")  # a task that runs again replaces a whole file
            part.write_text(yaml.safe_dump(json.loads(row[1]), explicit_start=True, sort_keys=False, allow_unicode=True, width=4096), encoding="utf-8")
            part.replace(target)

    docs.foreachPartition(write)


def kept_timestamps(previous: DataFrame) -> DataFrame:
    """(publication_id, lesson_number, imported_at) of an earlier snapshot, to be kept on a rewrite."""
    return previous.select("publication_id", "lesson_number", F.col("source_integrity.imported_at").alias("imported_at")).dropDuplicates(["publication_id", "lesson_number"])


def epoch_timestamp(seconds: int | None) -> str | None:
    """An epoch as ISO time in UTC."""
    from datetime import UTC, datetime

    return None if seconds is None else datetime.fromtimestamp(seconds, UTC).isoformat()


def markdown(title: str, table: DataFrame, most: int = 1000) -> str:
    """A report of aggregates as Markdown for people; a table of more than `most` rows is none and an error."""
    rows = table.take(most + 1)
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no report; aggregate them or write a table")
    head = table.columns
    lines = [f"# {title}", "", "| " + " | ".join(head) + " |", "|" + " --- |" * len(head)]
    return "\n".join(lines + ["| " + " | ".join("" if r[c] is None else str(r[c]) for c in head) + " |" for r in rows]) + "\n"
