"""Archives of CSV members as a flat all-text table.

A zip stream cannot be split, but its members can be read apart: one task lists
the members of each archive from its directory, then every member is its own
unit of work. Members are decompressed and parsed as a stream in batches, so
memory does not grow with their size. Lines with a field too many or too few are
not guessed at: they come out as rejects, with their text and where they were.
"""
from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .text_files import text_schema

ARCHIVE, MEMBER, REJECT = "_archive", "_member", "_reject"


def _locate(uri: str):
    """(file system, path) for any file system that Arrow knows; the scheme must be given, as Spark does."""
    if "://" not in uri:
        scheme, found, path = uri.partition(":/")
        if not found:
            raise ValueError(f"not a full URI: {uri}")
        uri = f"{scheme}:///{path.lstrip('/')}"
    return fs.FileSystem.from_uri(uri)


def open_file(uri: str):
    """Random-access read handle."""
    system, path = _locate(uri)
    return system.open_input_file(path)


def writable(uri: str):
    """Write handle on a new file; folders are made as needed."""
    system, path = _locate(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open_file(path) as handle, zipfile.ZipFile(handle) as archive:
                files = [i for i in archive.infolist() if not i.is_dir()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(files), pa.string()), pa.array([i.filename for i in files], pa.string()),
                 pa.array([i.file_size for i in files], pa.int64()), pa.array([i.CRC for i in files], pa.int64())],
                ["archive", "member", "size", "checksum"])


def _reader(columns: list[str], delimiter: str = ",", own_header: bool = True):
    names = [*columns, ARCHIVE, MEMBER, REJECT]
    text = pa.schema([(n, pa.string()) for n in names])

    def block(path: str, member: str, values: list[pa.Array], rejects: list[str]) -> pa.RecordBatch:
        many, bad = len(values[0]) if values else 0, len(rejects)
        full = [pa.concat_arrays([v, pa.nulls(bad, pa.string())]) for v in values] or [pa.nulls(bad, pa.string()) for _ in columns]
        return pa.RecordBatch.from_arrays(
            [*full, pa.array([path] * (many + bad)), pa.array([member] * (many + bad)),
             pa.array([None] * many + rejects, pa.string())], schema=text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, member in zip(*(c.to_pylist() for c in batch.columns)):
                rejects: list[str] = []

                def keep(row: csv.InvalidRow) -> str:
                    rejects.append(row.text)
                    return "skip"

                with open_file(path) as handle, zipfile.ZipFile(handle) as archive:
                    if not archive.getinfo(member).file_size:
                        continue
                    with archive.open(member) as raw:
                        stream = csv.open_csv(
                            raw, read_options=csv.ReadOptions() if own_header else csv.ReadOptions(column_names=columns, skip_rows=1),
                            parse_options=csv.ParseOptions(delimiter=delimiter, newlines_in_values=own_header, invalid_row_handler=keep),
                            convert_options=csv.ConvertOptions(
                                column_types={c: pa.string() for c in columns}, include_columns=columns,
                                null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=True))
                        for part in stream:
                            yield block(path, member, part.columns, rejects)
                            rejects.clear()
                if rejects:
                    yield block(path, member, [], rejects)
    return rows


def member_facts(spark: SparkSession, glob: str) -> DataFrame:
    """(archive, member, size, checksum) of every file inside the archives that match `glob`, from their directories."""
    paths = spark.read.format("binaryFile").load(glob).select("path")  # the content column is not read
    return paths.mapInArrow(_members, "archive string, member string, size long, checksum long")


def list_members(spark: SparkSession, glob: str) -> DataFrame:
    """(path, member) of every file inside the archives that match `glob`."""
    return member_facts(spark, glob).select(F.col("archive").alias("path"), "member")


def parse_members(members: DataFrame, columns: list[str], parallelism: int | None = None,
                  delimiter: str = ",", own_header: bool = True) -> DataFrame:
    """Every row of the given CSV members (path, member): the named columns as text (empty fields are null), archive, member, reject.

    Without `own_header` the first line is passed over and `columns` names all fields in order.
    A row has either values or, in the column of rejects, the text of a line with a wrong number of fields.
    """
    spark = members.sparkSession
    tasks = parallelism or max(spark.sparkContext.defaultParallelism,
                               int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = members.repartition(tasks, F.xxhash64("path", "member"))
    return spread.mapInArrow(_reader(columns, delimiter, own_header), text_schema([*columns, ARCHIVE, MEMBER, REJECT]))


def parse_archives(spark: SparkSession, glob: str, columns: list[str], parallelism: int | None = None,
                   delimiter: str = ",", own_header: bool = True) -> DataFrame:
    """`parse_members` of every member of the archives that match `glob`."""
    return parse_members(list_members(spark, glob), columns, parallelism, delimiter, own_header)


def read_archives(spark: SparkSession, glob: str, columns: list[str], parallelism: int | None = None) -> DataFrame:
    """Rows of every CSV member with the right number of fields."""
    return parse_archives(spark, glob, columns, parallelism).filter(F.col(REJECT).isNull()).select(*columns)


def read_rejects(spark: SparkSession, glob: str, columns: list[str], parallelism: int | None = None) -> DataFrame:
    """(archive, member, text) of every line with a wrong number of fields."""
    bad = parse_archives(spark, glob, columns, parallelism).filter(F.col(REJECT).isNotNull())
    return bad.select(F.col(ARCHIVE).alias("archive"), F.col(MEMBER).alias("member"), F.col(REJECT).alias("text"))
