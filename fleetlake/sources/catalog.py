"""The lake's tables in the session catalog, so that SQL and ``spark.table`` find them by name.

``CatalogLake`` has the interface of ``Lake``. A table's files still change by whole folders, written aside and swapped; the
catalog holds name, schema, partitioning and partitions, which follow each write:

    first load        CREATE TABLE ... LOCATION, partitions added from the folders
    full refresh      folder swapped; same columns: partitions synchronised, else the definition is replaced
    daily load        dynamic INSERT OVERWRITE of the touched partitions through the catalog (``insertInto``)
    emptied dates     folders deleted, partitions synchronised
    append            ``insertInto``
    clustered copy    bucketed and sorted by the keys of its joins (``cluster``), so that these need no exchange

``can_merge`` asks the catalog whether a table takes row-level changes (a table of a connector with its own MERGE).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.sources.tables import Lake, simple_name


def takes_row_changes(spark: SparkSession, table: str) -> bool:
    """Whether the catalog's table implements row-level operations (what MERGE needs)."""
    session, jvm = spark._jsparkSession, spark.sparkContext._jvm
    parser = session.sessionState().sqlParser()
    parts = list(jvm.scala.jdk.javaapi.CollectionConverters.asJava(parser.parseMultipartIdentifier(table)))
    manager = session.sessionState().catalogManager()
    named = len(parts) > 1 and manager.isCatalogRegistered(parts[0])
    catalog = manager.catalog(parts[0]) if named else manager.currentCatalog()
    rest = parts[1:] if named else parts
    names = spark.sparkContext._gateway.new_array(jvm.java.lang.String, len(rest) - 1)
    for i, part in enumerate(rest[:-1]):
        names[i] = part
    found = catalog.loadTable(jvm.org.apache.spark.sql.connector.catalog.Identifier.of(names, rest[-1]))
    kind = jvm.java.lang.Class.forName("org.apache.spark.sql.connector.catalog.SupportsRowLevelOperations")
    return bool(kind.isInstance(found))


class CatalogLake(Lake):
    """Tables of ``database`` whose files lie under ``root``."""

    def __init__(self, spark: SparkSession, root: str, database: str):
        super().__init__(spark, root)
        self.database = database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    def table_name(self, name: str) -> str:
        return f"`{self.database}`.`{simple_name(name)}`"

    def _in_catalog(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.table_name(name))

    # reading ------------------------------------------------------------------------------------
    def exists(self, name: str) -> bool:
        self.finish_intents(name)
        return self._in_catalog(name)

    def read(self, name: str) -> DataFrame:
        self.finish_intents(name)
        return self.spark.table(self.table_name(name))

    def tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(f"`{self.database}`") if not t.isTemporary and not t.name.startswith("_"))

    def __iter__(self) -> Iterator[str]:
        return iter(self.tables())

    def can_merge(self, name: str) -> bool:
        return takes_row_changes(self.spark, self.table_name(name))

    # writing ------------------------------------------------------------------------------------
    def overwrite(self, name: str, df: DataFrame, partition_by: Sequence[str] = (), rebalance: bool = True) -> None:
        super().overwrite(name, df, partition_by, rebalance)
        self._define(name, df, partition_by)

    def _define(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> None:
        """The catalog's entry for the table as it now lies in its folder."""
        table = self.table_name(name)
        ordered = [f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by]
        now = [(f.name, f.dataType.simpleString()) for f in ordered]
        if self._in_catalog(name):
            had = [(c.name, c.dataType) for c in self.spark.catalog.listColumns(table)]
            parts = [c.name for c in self.spark.catalog.listColumns(table) if c.isPartition]
            if had != now or parts != list(partition_by):
                self.spark.sql(f"DROP TABLE {table}")           # external: the files stay
        if not self._in_catalog(name):
            columns = ", ".join(f"`{n}` {k}" for n, k in now)
            parted = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{parted} LOCATION '{self.path(name)}'")
        self._synchronise(name, bool(partition_by))

    def cluster(self, name: str, df: DataFrame, keys: Sequence[str], buckets: int | None = None) -> None:
        """S5 for a fact that is joined again and again: replace table ``name`` by ``df``, bucketed and sorted by ``keys``. Facts with
        the same keys and bucket count (by default the session's shuffle partitions) join bucket by bucket."""
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        fresh, old = self.stage_path(name), self.stage_path("replaced")
        written = f"`{self.database}`.`{simple_name(name)}_{fresh.rsplit('-', 1)[-1]}`"
        # rows of a bucket are gathered first: one file per bucket, instead of one per bucket and task
        (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", fresh).saveAsTable(written))
        self.spark.sql(f"DROP TABLE {written}")                    # external: the files stay
        with self._intent(name, {"fresh": fresh, "old": old}):
            self._finish_swap(fresh, self.path(name), old)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        by = ", ".join(f"`{k}`" for k in keys)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name(name)}")
        self.spark.sql(f"CREATE TABLE {self.table_name(name)} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{self.path(name)}'")

    def _synchronise(self, name: str, partitioned: bool) -> None:
        """Partitions as the folders are now; cached listings forgotten."""
        if partitioned:
            self.spark.sql(f"MSCK REPAIR TABLE {self.table_name(name)} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.table_name(name))

    def _as_stored(self, name: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in self.spark.table(self.table_name(name)).columns])

    def overwrite_partitions(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> None:
        w = self._as_stored(name, df).write.option("partitionOverwriteMode", "dynamic")
        w.insertInto(self.table_name(name), overwrite=True)

    def delete_partitions(self, name: str, column: str, values: set) -> None:
        if values:
            super().delete_partitions(name, column, values)
            self._synchronise(name, True)

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        if self._in_catalog(name):
            self._as_stored(name, df).write.insertInto(self.table_name(name))
        else:
            super().overwrite(name, df, partition_by)
            self._define(name, df, partition_by)

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name(name)}")
        super().drop(name)
