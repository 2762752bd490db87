"""CSV in and out, every column kept as text."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.schemas import TABLES, as_text


# A line that ends outside of quotes if it begins there: values without a quote, or quoted as a whole with doubled quotes inside.
_VALUE = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
_CLOSED = f"{_VALUE}(?:,{_VALUE})*+"


def files_with_open_lines(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(files whose lines are all records of their own, all other files) of the CSV files at ``path``.

    One parallel pass over the lines; the driver gets the names of the other files.
    """
    lines = spark.read.text(path)
    whole = F.col("value").rlike(f"^{_CLOSED}$")
    split = lines.filter(F.col("value").contains('"') & ~whole).select(F.col("_metadata.file_path").alias("file")).distinct()
    wide = {row["file"] for row in split.collect()}
    names = sorted(unquote(name) for name in lines.inputFiles())
    # Both lists name local files in spellings of their own.
    plain = lambda name: re.sub("^file:/+", "/", unquote(name))
    wide = {plain(name) for name in wide}
    return [n for n in names if plain(n) not in wide], [n for n in names if plain(n) in wide]


def read_text(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool | None = None, rejects: str | None = None
) -> DataFrame:
    """Header CSV with an all-string schema: no value can fail the load, and none is lost.

    Line breaks inside quotes belong to the value. A file with such values is read by one task; all others, which a pass over
    the lines finds (``files_with_open_lines``), are cut into splits and read by many, however large. ``multiline``
    saves that pass: False where no value has a line break, True to read every file whole. A header
    that differs from the schema in names or order fails. A row with more or fewer values than
    columns fails with the row named; with ``rejects``, a column of that name is added,
    which holds such rows as they stand and is null for all others. All columns are parsed
    in any case, or a short selection would pass a row of wrong width.
    """
    if multiline is not None:
        return _csv(spark, [path], schema, multiline, rejects)
    closed, wide = files_with_open_lines(spark, path)
    parts = [_csv(spark, files, schema, several, rejects) for files, several in ((closed, False), (wide, True)) if files]
    return reduce(DataFrame.union, parts) if parts else _csv(spark, [path], schema, True, rejects)


def _csv(spark: SparkSession, files: list[str], schema: T.StructType, multiline: bool, rejects: str | None) -> DataFrame:
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)
        .option("columnPruning", False)
    )
    if rejects is None:
        return reader.schema(schema).option("mode", "FAILFAST").csv(files)
    wide = T.StructType([*schema.fields, T.StructField(rejects, T.StringType())])
    return reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rejects).csv(files)


def stage(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All raw tables from ``folder/<table>.csv``."""
    return {name: read_text(spark, f"{folder}/{name}.csv", as_text(name)) for name in TABLES}


def write_text(df: DataFrame, path: str) -> None:
    """Header CSV; padding inside values is kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def to_text(df: DataFrame) -> DataFrame:
    """Every column as a string, missing values as blanks, as in a raw extract."""
    return df.selectExpr(*[f"coalesce(string(`{c}`), '') AS `{c}`" for c in df.columns])
