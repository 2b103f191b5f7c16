"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.session import materialize

#: The white space that separates words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def boxed(df: DataFrame) -> DataFrame:
    """All columns of a row in one struct ``_row``, so that computed columns cannot clash with them."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("_row"))


def of(column: str) -> Column:
    """A column of a boxed row."""
    return F.col(f"_row.`{column}`")


def unboxed(df: DataFrame, columns: list[str], *added: Column) -> DataFrame:
    """The boxed columns again, followed by ``added``; an added column replaces one of the same name."""
    names = {n.lower() for n in df.select(*added).columns} if added else set()
    return df.select(*[of(c).alias(c) for c in columns if c.lower() not in names], *added)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once: as a lambda variable it can be named many times."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text between blanks; an empty array for null, empty or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back; the shuffle files of the job go when it has ended."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return materialize(df, label)
    finally:
        conf.set(name, before)
