"""Readers and sinks for the jobs.

Inputs are named datasets; each is either a catalog table name or a path
(parquet unless ``format`` says otherwise).  Outputs are written with
``mode("overwrite")`` so a re-run replaces the previous result (the source's
"drop if exists" before every stage), partitioned by fiscal / pool year so
downstream readers prune by year; the years that a run does not produce stay.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

from yoyflow.session import cut_lineage, drop_path


def read_input(spark: SparkSession, location: str, fmt: str = "parquet", partitions: int | None = None) -> DataFrame:
    """A table or path.  ``partitions`` spreads the rows over that many tasks by a
    shuffle, for inputs that scan as fewer splits than wanted; by default the scan's
    own splits are kept whatever their size."""
    df = spark.read.format(fmt).load(location) if "/" in location or ":" in location else spark.table(location)
    return df if partitions is None else df.repartition(partitions)


def read_inputs(spark: SparkSession, locations: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    return {name: read_input(spark, loc, fmt) for name, loc in locations.items()}


def write_output(df: DataFrame, location: str, partition_by: str | None = None, fmt: str = "parquet", scope: Collection[int] | None = None) -> None:
    """Overwrite ``location``; with ``partition_by`` only the partitions that ``df`` has
    rows for, so that runs for several years share one folder or table.

    ``scope`` lists the partitions (years) that the run answers for.  The result is
    then written to a stage first: a failed run leaves the old result whole.  What
    the stage has no rows for is dropped from ``location`` once the new partitions
    are in place, so no old rows stay for a year that now has none."""
    if scope is not None:
        staged = cut_lineage(df)
        made = {r[0] for r in staged.select(partition_by).distinct().collect()}  # years
        if outside := made - set(scope):
            raise ValueError(f"{partition_by} outside the run's scope: {sorted(outside, key=str)}")
        if made:
            write_output(staged, location, partition_by, fmt)
        for year in sorted(set(scope) - made):
            _drop_partition(df.sparkSession, location, partition_by, year)
        return
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    if "/" in location or ":" in location:
        writer.save(location)
    elif partition_by and df.sparkSession.catalog.tableExists(location):
        columns = df.sparkSession.table(location).columns
        df.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(location)
    else:
        writer.saveAsTable(location)


def _drop_partition(spark: SparkSession, location: str, column: str, value: int) -> None:
    if "/" in location or ":" in location:
        drop_path(spark, f"{location.rstrip('/')}/{column}={value}")
    elif spark.catalog.tableExists(location):
        spark.sql(f"ALTER TABLE {location} DROP IF EXISTS PARTITION ({column} = {value})")


def write_extract(df: DataFrame, location: str, scope: Collection[int] | None = None) -> None:
    write_output(df, location, partition_by="FiscalYear", scope=scope)


def write_pool(df: DataFrame, location: str, scope: Collection[int] | None = None) -> None:
    write_output(df, location, partition_by="PoolYear_FY", scope=scope)
