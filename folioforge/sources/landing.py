"""Landed CSV files: paths, lines, and typed, permissive records by each file's own header."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.schemas import CORRUPT
from folioforge.session import materialize

# The batch month is the name, or the value, of the folder a file lies in.
MONTH_IN_PATH = r"[/=](\d{6})/[^/]+$"


def event_files(base: str, dataset: str, month: str) -> str:
    return f"{base}/{dataset}/{month}/*.csv"


def dimension_file(base: str, dataset: str, month: str) -> str:
    return f"{base}/dimensions/{month}/{dataset}.csv"


LINE_OPTIONS = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}
_ADDED = (CORRUPT, "_columns", "source_file_path", "source_file_name")


def with_lineage(lines: DataFrame) -> DataFrame:
    """Lines of a text scan or stream with the file they stand in; ``_opens`` marks those of a file's first block."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("source_file_path"),
        F.col("_metadata.file_name").alias("source_file_name"),
        (F.col("_metadata.file_block_start") == 0).alias("_opens"),
    ).where(F.trim("value") != "")


def file_headers(lines: DataFrame) -> DataFrame:
    """(source_file_path, header): the first line of each file that is not blank.

    Lines of a block are numbered in the order they are read, so only first blocks are looked at and each
    task keeps one line a file.
    """
    numbered = lines.where("_opens").select("source_file_path", "value", F.monotonically_increasing_id().alias("_at"))
    return numbered.groupBy("source_file_path").agg(F.min_by("value", "_at").alias("header"))


def header_columns(header: str) -> list[str]:
    """Column names of a header line. An empty name becomes ``_c`` and its place, a repeated or reserved one gets its place."""
    named, taken = [], {c.lower() for c in _ADDED}
    for place, name in enumerate(next(csv.reader([header.lstrip("\ufeff").strip()]))):
        name = name or f"_c{place}"
        while name.lower() in taken:
            name = f"{name}_{place}"
        taken.add(name.lower())
        named.append(name)
    return named


def _record(columns: list[str], types: dict[str, T.DataType]) -> Column:
    fields = [(c, types.get(c, T.StringType()).simpleString()) for c in columns] + [(CORRUPT, "string")]
    schema = ", ".join("`{}` {}".format(c.replace("`", "``"), t) for c, t in fields)
    return F.from_csv("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def parse_lines(lines: DataFrame, declared: T.StructType) -> DataFrame | None:
    """Records of ``lines``, each line parsed by the header of its file; None if there is no line.

    Undeclared columns are kept as text and columns a file lacks are null. Records that do not fit are kept in
    ``_corrupt_record``. A line that repeats its file's header is no record, so files joined end to end are read
    right. All lines go through one scan, whatever the number of headers: only distinct headers reach the driver, and
    the table of files is written, so that Catalyst knows its size when it picks the join.
    """
    types = {f.name: f.dataType for f in declared}
    headers = materialize(file_headers(lines), "headers")
    found = sorted(r.header for r in headers.select("header").distinct().toLocalIterator())
    if not found:
        return None
    layouts = [header_columns(h) for h in found]
    is_layout = [F.col("header") == h for h in found]
    parsed = lines.join(headers, "source_file_path").where(F.col("value") != F.col("header")).select(
        "source_file_path",
        "source_file_name",
        *[F.when(here, _record(columns, types)).alias(f"_r{n}") for n, (here, columns) in enumerate(zip(is_layout, layouts))],
        F.coalesce(*[F.when(here, F.lit(columns)) for here, columns in zip(is_layout, layouts)]).alias("_columns"),
    )
    # a name that differs in case only is the same column
    names = {c.lower(): c for columns in [*reversed(layouts), list(types)] for c in columns if c.lower() in {x.lower() for y in layouts for x in y}}
    picked = []
    for key, name in names.items():
        own = [F.col(f"_r{n}")[c] for n, columns in enumerate(layouts) for c in columns if c.lower() == key]
        picked.append(F.coalesce(*own).alias(name))
    corrupt = F.coalesce(*[F.col(f"_r{n}")[CORRUPT] for n in range(len(found))]).alias(CORRUPT)
    return parsed.select(*picked, corrupt, "source_file_path", "source_file_name", "_columns")


def read_landed(spark: SparkSession, paths: str | list[str], declared: T.StructType) -> DataFrame:
    """All records of the CSV files under ``paths``, see ``parse_lines``."""
    landed = parse_lines(with_lineage(spark.read.options(**LINE_OPTIONS).text(paths)), declared)
    if landed is None:
        raise FileNotFoundError(f"no CSV files under {paths}")
    return landed


def land(df: DataFrame, path: str, batch: str) -> None:
    """Write a frame as landed files, one folder per batch month."""
    df.hint("rebalance", batch).write.partitionBy(batch).option("header", "true").csv(path)
