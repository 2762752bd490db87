"""Folders of tables with versions, of which readers see one at a time, whole.

``folder/versions/<version>/<table>`` holds the files and ``folder/commits`` one row for each version that is
complete. A version counts from the moment its row is there, which the writer of ``commits`` brings about by moving one
file; until then nobody reads what has been written. All of it is done by Spark's own readers and writers,
so it works in every store that they reach.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T

COMMITS = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("tables", T.ArrayType(T.StringType())),
        T.StructField("committed_at", T.TimestampType()),
    ]
)


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """The committed versions: number, version, tables and time; no rows for a folder without any."""
    try:
        return spark.read.schema(COMMITS).parquet(f"{folder}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def current(spark: SparkSession, folder: str) -> Row | None:
    """The version that counts: the last one, of two writers at once the one whose name is greater."""
    return commits(spark, folder).orderBy(F.desc("number"), F.desc("version")).first()


def table_path(folder: str, name: str, version: str | None) -> str:
    """Where the files of a table are in ``version``; plain ``folder/name`` without versions."""
    return f"{folder}/{name}" if version is None else f"{folder}/versions/{version}/{name}"


class Snapshot:
    """A version in the making: put tables, read them back, commit once all are there."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.version, self.tables = spark, folder, uuid.uuid4().hex, []

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` as written."""
        path = table_path(self.folder, name, self.version)
        df.write.parquet(path)
        self.tables.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> str:
        """From here on readers see this version."""
        last = current(self.spark, self.folder)
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(last["number"] + 1 if last else 1).cast("bigint").alias("number"),
            F.lit(self.version).alias("version"),
            F.array(*[F.lit(t) for t in self.tables]).cast("array<string>").alias("tables"),
            F.current_timestamp().alias("committed_at"),
        )
        row.write.mode("append").parquet(f"{self.folder}/commits")
        return self.version


def forget(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Empty the tables of all but the last ``keep`` versions, whose rows stay in ``commits``; their names.

    A version that a long job still reads has to be among those kept.
    """
    if keep < 1:
        raise ValueError("the current version has to be kept")
    old = commits(spark, folder).orderBy(F.desc("number"), F.desc("version")).offset(keep).collect()
    for version in old:
        for name in version["tables"]:
            path = table_path(folder, name, version["version"])
            schema = spark.read.parquet(path).schema
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return [version["version"] for version in old]
