"""Warehouse tables: namespaces, scans and sinks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: How the files of tables are compressed: the warehouse is written once and read often, and is most of what a load writes.
COMPRESSION = "zstd"


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the namespace unless it exists; its tables lie below ``location``."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _new_version(spark: SparkSession, name: str) -> str:
    namespace, table = name.split(".")
    base = spark.catalog.getDatabase(namespace).locationUri.rstrip("/")
    return f"{base}/{table}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Layout:
    """How a version's files are laid out.

    ``bucket_by``: rows are dealt over ``buckets`` files by these columns and sorted by them, so that tables with the same
    buckets are joined on them without a shuffle. A value's rows lie in one bucket, so a column in which one value
    holds a large part of the rows is none to bucket by. ``partition_by``: one folder for each value, so that a filter on the
    column reads the folders it needs.
    """

    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    partition_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Version:
    """A written version of a table that no name points at yet."""

    name: str
    path: str
    rows: DataFrame
    layout: Layout = field(default_factory=Layout)
    #: The name that a bucketed version has until it is published: only a named table knows its buckets.
    own_name: str | None = None


def write_version(df: DataFrame, name: str, layout: Layout = Layout()) -> Version:
    """Write the rows as a new version of a table; the table stays as it is."""
    spark, path = df.sparkSession, _new_version(df.sparkSession, name)
    if layout.bucket_by:
        if layout.partition_by or layout.buckets < 1:
            raise ValueError("a bucketed table has a number of buckets and no partitions")
        own = f"{name}_{uuid.uuid4().hex[:12]}"
        dealt = df.repartition(layout.buckets, *layout.bucket_by)  # one file for each bucket
        writer = dealt.write.format("parquet").bucketBy(layout.buckets, *layout.bucket_by).sortBy(*layout.bucket_by)
        writer.option("compression", COMPRESSION).option("path", path).saveAsTable(own)
        return Version(name, path, spark.table(own), layout, own)
    if layout.partition_by:
        # Rows of one value go to as many tasks as they need, not to one each.
        df.hint("rebalance", *layout.partition_by).write.partitionBy(*layout.partition_by).parquet(path, compression=COMPRESSION)
    else:
        df.write.parquet(path, compression=COMPRESSION)
    return Version(name, path, spark.read.schema(df.schema).parquet(path), layout)


def buckets_of(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """The number of buckets of a table and the columns they go by; (0, []) if it has none."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Num Buckets" not in told:
        return 0, []
    return int(told["Num Buckets"]), [c.strip(" `") for c in told["Bucket Columns"].strip("[]").split(",")]


def is_view(spark: SparkSession, name: str) -> bool:
    return not spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Type' AND data_type = 'VIEW'").isEmpty()


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def table_place(spark: SparkSession, name: str) -> list[str]:
    """Where the rows of a published table lie; empty if there is no such name."""
    if not spark.catalog.tableExists(name):
        return []
    if not is_view(spark, name):
        return [_location(spark, name)]
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'View Text'").first()["data_type"]
    return text.partition("parquet.`")[2].split("`")[:1]


def publish(versions: list[Version]) -> tuple[dict[str, DataFrame], list[str]]:
    """Point the tables' names at new versions. Returns the tables by name and the places of the old versions.

    A table that keeps its columns and its buckets is moved by one statement, so a reader finds the old version or the
    new one at every moment. If they change, the new version gets a name of its own first and then takes the table's
    name; between these two statements the name is missing. A partitioned version is published as a view over its
    folder, which one statement replaces. Several tables are moved one right after the other, when all of them are written;
    ``manifest.TableSet`` moves them at once. Old versions stay for readers that have begun.
    """
    tables, old = {}, []
    for version in versions:
        spark, name = version.rows.sparkSession, version.name
        exists = spark.catalog.tableExists(name)
        view = exists and is_view(spark, name)
        if exists and not view:
            old.append(_location(spark, name))
        if version.layout.partition_by:
            if exists and not view:
                spark.sql(f"DROP TABLE {name}")
            columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in version.rows.schema.fields)
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{version.path}`")
        elif exists and not view and _same_shape(spark, name, version):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{version.path}'")
            spark.catalog.refreshTable(name)
            if version.own_name:
                spark.sql(f"DROP TABLE {version.own_name}")  # its files stay, they are not the table's own
        else:
            own = version.own_name or f"{name}_{uuid.uuid4().hex[:8]}"
            if not version.own_name:
                spark.catalog.createTable(own, path=version.path, source="parquet", schema=version.rows.schema)
            if exists:
                spark.sql(f"DROP {'VIEW' if view else 'TABLE'} {name}")
            spark.sql(f"ALTER TABLE {own} RENAME TO {name}")
        tables[name] = spark.table(name)
    return tables, old


def _same_shape(spark: SparkSession, name: str, version: Version) -> bool:
    def columns(df: DataFrame) -> list[tuple]:
        return [(f.name, f.dataType) for f in df.schema.fields]

    wanted = (version.layout.buckets, list(version.layout.bucket_by)) if version.layout.bucket_by else (0, [])
    return columns(spark.table(name)) == columns(version.rows) and buckets_of(spark, name) == wanted


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Full refresh: write a new version of the table, then ``publish`` it.

    The old version serves readers until the new one is complete, so the table may be refreshed from itself, and
    a write that fails changes nothing.
    """
    return publish([write_version(df, name)])[0][name]


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, defaults: dict[str, str] | None = None
) -> None:
    """An empty table in place of any old one; ``defaults`` maps columns to SQL literals."""
    defaults = defaults or {}
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
        for f in schema.fields
    )
    path = _new_version(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")


def append_table(df: DataFrame, name: str, columns: list[str] | None = None) -> None:
    """Append the named columns to an existing table; its other columns take their defaults."""
    columns = columns or df.columns
    listed = ", ".join(f"`{c}`" for c in columns)
    df.sparkSession.sql(
        f"INSERT INTO {name} ({listed}) SELECT {listed} FROM {{rows}}", rows=df
    )


def inline_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A constant table."""
    return spark.createDataFrame(rows, schema)
