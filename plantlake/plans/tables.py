"""Table sinks (SNK-01..08): write, overwrite by partition, compact, count, list.

Tables are parquet folders (``format`` is a parameter, so ``delta`` works
where its package is installed) registered in the session catalogue under
``<database>.<table>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import DATABASES, POINTS_RAW_SCHEMA, RAW_SCHEMAS


def create_databases(spark: SparkSession, root: str, databases=DATABASES) -> None:
    """SNK-06: one database per layer, each with its own location."""
    for db in databases:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root.rstrip('/')}/{db}'")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=(), fmt: str = "parquet",
                table: str | None = None, spark: SparkSession | None = None, only_partitions: bool = False) -> int:
    """SNK-01..03 + SNK-07: write and return the row count observed during the write.

    ``mode="overwrite"`` replaces the whole table; with ``only_partitions`` it
    replaces only the partitions present in ``df`` (dynamic partition
    overwrite), for a caller that rebuilds named dates.  The count comes from
    ``observe`` on the write itself -- no second scan.
    """
    obs = Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if only_partitions else "static")
    writer.save(path)
    if table:
        sess = spark or df.sparkSession
        sess.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {fmt} LOCATION '{path}'")
        if partition_by:
            sess.sql(f"MSCK REPAIR TABLE {table}")
        sess.catalog.refreshTable(table)
    return int(obs.get.get("rows", 0))


def compact(spark: SparkSession, path: str, partition_filter: str | None = None, target_files: int | None = None,
            partition_by=(), fmt: str = "parquet", tmp_suffix: str = "_compacted") -> str:
    """Rewrite small files (one per 5 s micro-batch) into files of the advisory size.

    Reads the table, writes it to a sibling folder and returns that path; the
    caller swaps it in.  With ``partition_filter`` (on the partition columns)
    those partitions go through the sibling folder back into the table, which
    keeps its other partitions, and the table's path is returned.  The ``rebalance`` hint
    clusters rows by the partition columns, and AQE cuts the output at
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: small partitions are
    merged into one file each, and a large (hot) partition is split into
    several tasks instead of being written by one.  ``target_files`` only
    sets the initial number of shuffle partitions.
    """
    df = spark.read.format(fmt).load(path)
    if partition_filter:
        df = df.filter(partition_filter)
    out = path.rstrip("/") + tmp_suffix
    part = df.hint("rebalance", *([target_files] if target_files else []), *partition_by)
    w = part.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(out)
    if not partition_filter:
        return out
    if not partition_by:
        raise ValueError("partition_filter needs the partition columns")
    again = spark.read.format(fmt).load(out).hint("rebalance", *partition_by)
    again.write.mode("overwrite").format(fmt).partitionBy(*partition_by) \
        .option("partitionOverwriteMode", "dynamic").save(path)
    return path


def define_raw_tables(spark: SparkSession, root: str, database: str = "bronze", fmt: str = "parquet") -> list[str]:
    """SNK-05: the raw tables under their declared schemas, created empty where they do not exist."""
    tables = {"pi_timeseries_raw": POINTS_RAW_SCHEMA, **{f"{n}_raw": s for n, s in RAW_SCHEMAS.items()}}
    for name, schema in tables.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING {fmt} "
                  f"LOCATION '{root.rstrip('/')}/{database}/{name}'")
    return sorted(tables)


def catalogue(spark: SparkSession, databases=DATABASES) -> DataFrame:
    """SNK-08: tables and columns of the layer databases (input of the schema leak check)."""
    rows = []
    for db in databases:
        if not spark.catalog.databaseExists(db):
            continue
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            for c in spark.catalog.listColumns(f"{db}.{t.name}"):
                rows.append((db, t.name, c.name, c.dataType, t.tableType))
    return spark.createDataFrame(rows, "database string, table_name string, column_name string, "
                                       "data_type string, table_type string")
