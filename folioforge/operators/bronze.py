"""Raw layer: lineage, fingerprints, system time and drift of landed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.hashing import record_hash
from folioforge.functions.temporal import open_end, ts
from folioforge.schemas import CORRUPT
from folioforge.sources.landing import MONTH_IN_PATH

CONTROL = (
    "ingestion_ts", "source_file_path", "source_file_name", "load_id", "record_hash",
    "system_from_ts", "system_to_ts", "record_version", "change_type", "is_current_system",
    "source_yyyymm", "expected_grain", "schema_drift_captured_ts", "is_corrupt_record",
    "source_column_list",
)


def month_from_path() -> Column:
    return F.regexp_extract("source_file_path", MONTH_IN_PATH, 1)


def source_columns(df: DataFrame) -> list[str]:
    own = {CORRUPT, "_columns", *CONTROL}
    return [c for c in df.columns if c not in own]


def with_control_columns(
    landed: DataFrame, grain: str, load_id: str, ingestion_ts: str, month: str | None = None
) -> DataFrame:
    """Raw record plus its control columns. Without ``month``, the batch is read from the file path."""
    return landed.withColumns(
        {
            "ingestion_ts": ts(ingestion_ts),
            "load_id": F.lit(load_id),
            "record_hash": record_hash(source_columns(landed)),
            "system_from_ts": ts(ingestion_ts),
            "system_to_ts": open_end(),
            "record_version": F.lit(1),
            "change_type": F.lit("INSERT"),
            "is_current_system": F.lit(True),
            "source_yyyymm": month_from_path() if month is None else F.lit(month),
            "expected_grain": F.lit(grain),
            "schema_drift_captured_ts": ts(ingestion_ts),
            "is_corrupt_record": F.col(CORRUPT).isNotNull(),
            "source_column_list": F.array_sort("_columns"),
        }
    ).drop("_columns")


def split_corrupt(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    return bronze.where(~F.col("is_corrupt_record")), bronze.where("is_corrupt_record")


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Missing target columns become typed nulls, further columns stay, names are sorted."""
    have = set(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in target if f.name not in have}
    return df.withColumns(missing).select(*sorted([*df.columns, *missing]))


def drift_report(bronze: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Per batch and column list: new and missing columns against the declared ones, and row counts."""
    expected = F.lit(list(declared))
    return (
        bronze.groupBy("source_yyyymm", "source_column_list")
        .agg(F.count("*").alias("row_count"))
        .withColumns(
            {
                "new_columns": F.array_sort(F.array_except("source_column_list", expected)),
                "missing_columns": F.array_sort(F.array_except(expected, "source_column_list")),
            }
        )
    )
