"""Text sources: CSV chunks, tab-separated gazetteer, emission files by state."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import rules
from ..operators.match import form_contract_breaches
from ..session import stage_table

CORRUPT = "_corrupt_record"


def text_schema(columns: list[str], extra: tuple = ()) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, *extra)])


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first line of a file set, without a byte-order mark."""
    names = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
             .csv(path, inferSchema=False).columns)
    return [n.lstrip("﻿") for n in names]


def read_csv_chunks(spark: SparkSession, path: str, columns: list[str] | None = None,
                    with_rejects: bool = False, multi_line: bool = True, delimiter: str = ",") -> DataFrame:
    """Many CSV chunks as one all-text table, quoting set explicitly.

    `multi_line` accepts line breaks inside quotes, at the price of one task per
    file; `csv_ranges` reads large files by many tasks. With `with_rejects`, a row that does
    not fit the header keeps its raw text in `_corrupt_record`.
    """
    columns = columns or csv_header(spark, path)
    schema = text_schema(columns, (CORRUPT,) if with_rejects else ())
    reader = (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
              .option("sep", delimiter).option("multiLine", multi_line).option("enforceSchema", True).option("mode", "PERMISSIVE"))
    if with_rejects:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, raw text of rejected rows).

    The parser prunes columns nobody reads, and a pruned row cannot be judged, so
    the parsed rows are saved once, which the load does anyway.
    """
    saved = stage_table(rows, "parsed")
    good = saved.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, saved.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each loaded table: (name, n)."""
    counts = [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


GAZETTEER = ["geoid", "aland", "awater", "aland_sqmi", "awater_sqmi", "lat", "lon"]


def read_zip_centroids(spark: SparkSession, path: str) -> DataFrame:
    """ZIP centroids from the tab-separated gazetteer; its header is replaced by our names."""
    raw = (spark.read.schema(text_schema(GAZETTEER)).option("header", True).option("sep", "\t")
           .option("enforceSchema", True).csv(path))
    return centroids(raw)


def centroids(raw: DataFrame) -> DataFrame:
    """ZIP, latitude and longitude of padded gazetteer rows."""
    return raw.select(F.trim("geoid").alias("zip5"), F.trim("lat").cast("double").alias("lat"),
                      F.trim("lon").cast("double").alias("lon"))


def require_columns(columns: list[str], required, where: str) -> None:
    missing = sorted(set(required) - set(columns))
    if missing:
        raise ValueError(f"{where} is missing columns: {', '.join(missing)}")


def require_files(paths: list[str], states) -> None:
    """An error that names the states without an emission file."""
    have = {path.rsplit("/", 1)[-1].rsplit(".", 1)[0].rsplit("_", 1)[-1] for path in paths}
    missing = [s for s in states if s not in have]
    if missing:
        raise ValueError(f"no emission file for: {', '.join(missing)}")


def read_emission_files(spark: SparkSession, paths: list[str], states=rules.TERRITORY) -> DataFrame:
    """Emission forms of all state files, columns by role, with the state of the file name.

    Files of other states and files without a required column stop the load.
    """
    frames = None
    by_header: dict[tuple, list[str]] = {}
    for path in paths:  # one header line per file; the list is one file per state
        state = path.rsplit("/", 1)[-1].rsplit(".", 1)[0].rsplit("_", 1)[-1]
        if state not in states:
            raise ValueError(f"unexpected emission file: {path}")
        header = tuple(csv_header(spark, path))
        require_columns(list(header), rules.EMISSION_COLUMNS.values(), path)
        by_header.setdefault(header, []).append(path)
    for header, group in by_header.items():
        rows = (spark.read.schema(text_schema(list(header))).option("header", True).option("quote", '"')
                .option("escape", '"').option("multiLine", True).option("enforceSchema", True).csv(group))
        stem = F.regexp_extract(F.col("_metadata.file_name"), r"_([^_.]+)\.[^.]*$", 1)
        forms = rows.select(*[F.col(f"`{name}`").alias(role) for role, name in rules.EMISSION_COLUMNS.items()],
                            stem.alias("file_state"))
        frames = forms if frames is None else frames.unionByName(forms)
    return frames


def require_contract(forms: DataFrame, year: int = rules.EMISSION_YEAR) -> DataFrame:
    """`forms`, or an error that shows the first rows in breach of the contract."""
    first = form_contract_breaches(forms, year).limit(5).collect()
    if first:
        raise ValueError("emission forms break the contract: " + "; ".join(
            f"{r.breach} in a file of {r.file_state}" for r in first))
    return forms
