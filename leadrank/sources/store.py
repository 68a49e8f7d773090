"""Tables whose state changes in one step: new folders first, then one small commit that names what is current.

A table is a set of parts, each a Parquet folder that is written once and never changed. A commit is one row in one
small file that lists the parts of all tables; the latest commit is the state. So whoever stops between the writing of
parts and the commit leaves the former state as it was, and several tables change together. Files of a commit appear by
Spark's own commit protocol, which renames the finished file.
"""
from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder on any file system that Spark knows."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Store:
    """Tables of parts below `path`. Two runs must not commit at the same time: the later one would win."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _commits(self) -> list[tuple[int, dict[str, dict[str, str]]]]:
        """(number, state) of every commit, latest last. Commits are few: `commit` removes all but the latest two."""
        try:
            rows = self.spark.read.schema("number long, state string").json(f"{self.path}/commits/*").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted((r.number, json.loads(r.state)) for r in rows if r.state is not None)

    def state(self) -> dict[str, dict[str, str]]:
        """Current parts of each table: key of the part -> its folder."""
        commits = self._commits()
        return commits[-1][1] if commits else {}

    def parts(self, table: str) -> dict[str, str]:
        return self.state().get(table, {})

    def read(self, table: str) -> DataFrame | None:
        """The current rows of a table, or None if it has no parts."""
        folders = sorted(set(self.parts(table).values()))
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in folders]) if folders else None

    def write(self, table: str, rows: DataFrame) -> str:
        """Write rows as a new part, not yet part of the table, and name its folder."""
        folder = f"{table}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def commit(self, **tables: dict[str, str]) -> None:
        """Make the given parts the current ones of their tables; other tables stay. What no kept commit names goes."""
        commits = self._commits()
        number, now = commits[-1] if commits else (0, {})
        state = {**now, **tables}
        row = self.spark.range(1).select(F.lit(number + 1).cast("long").alias("number"), F.lit(json.dumps(state)).alias("state"))
        row.coalesce(1).write.json(f"{self.path}/commits/{number + 1:09d}-{uuid.uuid4().hex}")
        self._clean([*commits, (number + 1, state)])

    def _clean(self, commits: list[tuple[int, dict[str, dict[str, str]]]]) -> None:
        """Readers of the state before the latest one may go on, those of older ones may not."""
        def folders(some) -> set[str]:
            return {f for _, state in some for parts in state.values() for f in parts.values()}

        for folder in sorted(folders(commits[:-2]) - folders(commits[-2:])):
            delete_folder(self.spark, f"{self.path}/{folder}")
        if len(commits) > 2:
            old = self.spark.read.schema("number long, state string").json(f"{self.path}/commits/*")
            names = old.filter(F.col("number") < commits[-2][0]).select(F.col("_metadata.file_path").alias("file")).collect()
            for r in names:
                delete_folder(self.spark, r.file.rsplit("/", 1)[0])
