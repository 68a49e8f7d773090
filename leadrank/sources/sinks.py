"""Sinks: ranked CSV, nested JSON, run log, spreadsheet-safe export."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import spreadsheet_safe
from ..operators.lists import csv_columns


def write_ranked_csv(ranked: DataFrame, path: str) -> None:
    """Lead file in rank order: files are range-sorted, so reading them in name order gives the ranks."""
    rows = csv_columns(ranked).orderBy("rank")
    rows.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def safe_cells(df: DataFrame) -> DataFrame:
    """Neutralise formula starts in every text column; other types stay as they are."""
    return df.select(*[spreadsheet_safe(F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`")
                       for n, t in df.dtypes])


def write_safe_csv(df: DataFrame, path: str) -> None:
    (safe_cells(df).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").csv(path))


def write_lead_json(records: DataFrame, path: str) -> None:
    """Nested lead records, one JSON document per line, best lead first."""
    records.orderBy("rank").write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_run_log(run: DataFrame, path: str) -> None:
    """One record per run date: a re-run of a date replaces its record. `run` has the column as_of."""
    (run.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("as_of").parquet(path))
