"""Enrichment CSV landing (SRC-01..03, BRZ-02, BRZ-05, SNK-02).

Every column lands as STRING under a declared schema.  :func:`load_csv`
checks the header against it (``enforceSchema=false``), so a renamed or
reordered column fails the load with a clear error instead of silently
changing the table.  :func:`load_csv_versions` takes files of several header
versions: columns are matched by name, and what does not fit the declared
schema is rescued into one column instead of being lost.

Quoted cells may hold line breaks (``multiLine``), which makes a file one
task; land large tables as many files, or turn ``multi_line`` off for files
known to hold no such cell.
"""

from __future__ import annotations

import csv
import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CSV_SCHEMAS, ENRICHMENT_FILES

RESCUED = "rescued_data"
_RECORD = "_record"


def _stamped(df: DataFrame, ingest_ts: dt.datetime | None, source) -> DataFrame:
    stamp = F.lit(ingest_ts).cast("timestamp") if ingest_ts is not None else F.current_timestamp()
    return df.withColumn("ingest_ts", stamp).withColumn("source_file", source)


def load_csv(spark: SparkSession, path: str, name: str, ingest_ts: dt.datetime | None = None,
             file_name: str | None = None, multi_line: bool = True) -> DataFrame:
    """SRC-01: one enrichment CSV as a raw frame (+ ``ingest_ts``, ``source_file``).

    Empty cells become NULL; short rows are NULL-padded (PERMISSIVE).  The
    landing time is one value per run (a literal when given, else the query's
    ``current_timestamp``).
    """
    schema = CSV_SCHEMAS[name]
    df = (spark.read.option("header", True).option("enforceSchema", False).option("multiLine", multi_line)
          .option("mode", "PERMISSIVE").schema(schema).csv(path))
    return _stamped(df, ingest_ts, F.lit(file_name) if file_name else F.col("_metadata.file_name"))


def load_enrichment(spark: SparkSession, landing_dir: str, ingest_ts: dt.datetime | None = None) -> dict[str, DataFrame]:
    """SRC-02/03: the five CSVs under ``landing_dir`` -> {raw table name: frame}."""
    out = {}
    for file_name, table in ENRICHMENT_FILES.items():
        name = file_name[:-4]
        out[table] = load_csv(spark, f"{landing_dir.rstrip('/')}/{file_name}", name, ingest_ts, file_name)
    return out


def header_versions(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """(header cells, files) of every header among the files under ``path``, in order of the header text.

    One aggregate over the files' first blocks: a file's header is its line
    with the smallest row number.  The driver gets one row per file, which is
    what a Spark file listing holds anyway.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        "value", "_metadata.file_path", "_metadata.file_block_start").filter("file_block_start = 0")
    firsts = (lines.withColumn("line", F.monotonically_increasing_id()).groupBy("file_path")
              .agg(F.min_by("value", "line").alias("header")).collect())
    files: dict[str, list[str]] = {}
    for row in firsts:
        files.setdefault(row.header.lstrip("\ufeff").rstrip("\r"), []).append(_plain_path(row.file_path))
    return [(next(csv.reader([header]), []), sorted(files[header])) for header in sorted(files)]


def _plain_path(uri: str) -> str:
    """A file's path for the reader: not percent-encoded, with the pattern characters escaped."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in unquote(uri))


def load_csv_versions(spark: SparkSession, path: str, name: str, ingest_ts: dt.datetime | None = None,
                      multi_line: bool = True) -> DataFrame:
    """SRC-01, SNK-02: files of any header versions under ``path`` as one raw frame (+ ``rescued_data``).

    A declared column that a version lacks is NULL.  ``rescued_data`` is NULL
    for a row that fits; else a JSON object of the row's cells in unknown
    columns, by name, and for a row with more or fewer cells than its header
    the whole record under ``_record``.  A repeated or blank header cell
    counts as unknown, named by its position (``_column_3``).  Quotes in
    quoted cells are doubled.  Each version is one scan of its own files; no
    row is shuffled.  A folder without files gives an empty frame.
    """
    declared = [f.name for f in CSV_SCHEMAS[name].fields]
    out = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*declared, RESCUED])
                                + ", ingest_ts timestamp, source_file string")
    for header, files in header_versions(spark, path):
        cells = []
        for k, cell in enumerate(header):
            cell = cell.strip()
            cells.append(cell if cell and cell not in cells and cell != _RECORD else f"_column_{k + 1}")
        # Columns are positions here: the reader would refuse names that differ in case only.
        ddl = ", ".join(f"c{k} string" for k in range(len(cells))) + f", {_RECORD} string"
        df = (spark.read.schema(ddl).option("header", True).option("enforceSchema", True)
              .option("multiLine", multi_line).option("escape", '"').option("mode", "PERMISSIVE")
              .option("columnPruning", False).option("columnNameOfCorruptRecord", _RECORD).csv(files))
        at = {cell: F.col(f"c{k}") for k, cell in enumerate(cells)}
        unknown = [at[c].alias(c) for c in cells if c not in declared]
        # The reader refuses a query of the broken record alone, so it always asks for the first cell, too.
        broken = F.concat(_RECORD, F.substring(F.coalesce("c0", F.lit("")), 1, 0)).alias(_RECORD)
        extra = F.to_json(F.struct(*unknown, broken))
        known = [at.get(c, F.lit(None).cast("string")).alias(c) for c in declared]
        part = df.select(*known, F.when(extra != "{}", extra).alias(RESCUED), F.col("_metadata.file_name").alias("_file"))
        out = out.unionByName(_stamped(part, ingest_ts, F.col("_file")).drop("_file"))
    return out


def rescued_cells(raw: DataFrame) -> DataFrame:
    """Rescued rows by file and unknown column (``_record`` for broken rows): what a schema change would take in."""
    keys = F.explode(F.json_object_keys(RESCUED)).alias("column_name")
    return raw.filter(F.col(RESCUED).isNotNull()).select("source_file", keys).groupBy("source_file", "column_name").agg(
        F.count(F.lit(1)).alias("rows"))
