"""Archives loaded once: a manifest tells which members have changed since the last load, and only those are parsed.

The manifest has one row for each member: size and checksum as the archive's own directory gives them, the load that
parsed it, and how many rows and rejects came of it. A member is parsed anew if any of these differ or if other columns
are asked for. Parsed rows stay as they are, load by load; rows of members that have changed or gone are left out by a
join with the manifest, and dropped for good when `COMPACT` loads are there. Rows and manifest change in one commit.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import archives
from .store import Store

LOAD = "_load"
#: Loads after which what is current is written as one.
COMPACT = 16
_SAME = ["archive", "member", "size", "checksum", "shape"]


def load(spark: SparkSession, glob: str, columns: list[str], store: Store, table: str, delimiter: str = ",",
         own_header: bool = True) -> DataFrame:
    """Bring the stored table up to date with the archives that match `glob`; the current rows as `current` gives them."""
    shape = hashlib.sha256("\n".join([delimiter, str(own_header), *columns]).encode()).hexdigest()
    known = store.read(f"{table}_manifest")
    listed = archives.member_facts(spark, glob).withColumn("shape", F.lit(shape))
    if known is None:
        kept, fresh, number = None, listed, 1
    else:
        number = known.agg(F.max("load")).first()[0] + 1 if known.take(1) else 1
        number = max(number, max(map(int, store.parts(table)), default=0) + 1)
        kept = known.join(listed.select(*_SAME), _SAME, "left_semi")
        fresh = listed.join(known.select(*_SAME), _SAME, "left_anti")
        if fresh.isEmpty() and kept.count() == known.count():
            return current(store, table)
    members = fresh.select(F.col("archive").alias("path"), "member")
    parsed = archives.parse_members(members, columns, None, delimiter, own_header).withColumn(LOAD, F.lit(number).cast("long"))
    parts = {**store.parts(table), str(number): store.write(table, parsed)}
    rows = spark.read.parquet(f"{store.path}/{parts[str(number)]}")
    bad = F.col(archives.REJECT).isNotNull()
    counts = rows.groupBy(F.col(archives.ARCHIVE).alias("archive"), F.col(archives.MEMBER).alias("member")).agg(
        F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"))
    told = fresh.join(counts, ["archive", "member"], "left").select(
        *_SAME, F.lit(number).cast("long").alias("load"), F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("rejected", F.lit(0)).alias("rejected"))
    manifest = store.write(f"{table}_manifest", told if kept is None else kept.unionByName(told))
    used = {str(r.load) for r in spark.read.parquet(f"{store.path}/{manifest}").select("load").distinct().collect()}
    parts = {k: f for k, f in parts.items() if k in used or k == str(number)}  # a load of which nothing is current goes
    store.commit(**{table: parts, f"{table}_manifest": {"": manifest}})
    if len(parts) > COMPACT:
        _compact(store, table)
    return current(store, table)


def _live(store: Store, table: str) -> DataFrame:
    """Rows of the members as the manifest has them, with their load."""
    manifest = store.read(f"{table}_manifest").select(
        F.col("archive").alias(archives.ARCHIVE), F.col("member").alias(archives.MEMBER), F.col("load").alias(LOAD))
    return store.read(table).join(manifest, [archives.ARCHIVE, archives.MEMBER, LOAD], "left_semi")


def _compact(store: Store, table: str) -> None:
    number = max(map(int, store.parts(table))) + 1
    folder = store.write(table, _live(store, table).withColumn(LOAD, F.lit(number).cast("long")))
    manifest = store.write(f"{table}_manifest", store.read(f"{table}_manifest").withColumn("load", F.lit(number).cast("long")))
    store.commit(**{table: {str(number): folder}, f"{table}_manifest": {"": manifest}})


def current(store: Store, table: str) -> DataFrame:
    """The current rows: the loaded columns, archive, member, reject and the number of the load that parsed them."""
    return _live(store, table)


def counts(store: Store, table: str) -> tuple[int, int]:
    """(rows, rejects) of a loaded table, from its manifest alone."""
    found = store.read(f"{table}_manifest").agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected")).first()
    return found.rows or 0, found.rejected or 0
