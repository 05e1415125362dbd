"""A lake of named tables on shared storage, plus catalog tables.

``Lake`` keeps each table as a parquet directory under one root on the
cluster's shared file system. Writes never overwrite a path that the same job reads: new content is
staged to a fresh path first and the table is rewritten from the stage, so a lost executor can
recompute any task from files that still exist.

A change that takes several steps (partitions overwritten, then emptied ones deleted; a table's folder swapped) is first written
down as an intent beside the tables. The intent goes when the last step is done. Whoever opens a table whose intent is
still there finishes its steps first: each can be done twice. So a writer that dies in between leaves no half change to be seen.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.sources.pages import write_lines

# Schemas of the two tracking tables (all fields NOT NULL)
CONTROL_SCHEMA = T.StructType([
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("last_run_time", T.TimestampType(), False),
    T.StructField("status", T.StringType(), False),
])
RUN_LOG_SCHEMA = T.StructType([
    T.StructField("endpoint_name", T.StringType(), False),
    T.StructField("last_run_time", T.TimestampType(), False),
    T.StructField("records_processed", T.LongType(), False),
])
METRICS_SCHEMA = T.StructType([
    T.StructField("endpoint_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("load_time", T.TimestampType(), False),
    T.StructField("records", T.LongType(), False),
    T.StructField("columns", T.LongType(), False),
    T.StructField("table_rows", T.LongType()),
    T.StructField("duplicates", T.LongType()),
    T.StructField("warning", T.StringType()),
])
METRICS_TABLE = "_load_metrics"      # not a fleet table: names that begin so are not listed
CONTROL_TABLE = "control_last_run"
RUN_LOG_TABLE = "pipeline_last_run"


def simple_name(name: str) -> str:
    """``schema.table`` -> ``table``."""
    return name.split(".")[-1]


class CatalogTables(Mapping):
    """S3: the session catalog's tables as a mapping (``spark.table``)."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        self.spark, self.database = spark, database

    def _q(self, name):
        return name if self.database is None else f"{self.database}.{name}"

    def __getitem__(self, name):
        if not self.spark.catalog.tableExists(self._q(name)):
            raise KeyError(name)
        return self.spark.table(self._q(name))

    def __iter__(self) -> Iterator[str]:
        return iter(t.name for t in self.spark.catalog.listTables(self.database))

    def __len__(self):
        return len(self.spark.catalog.listTables(self.database))


# the intents that this process is carrying out now; an intent of its own that is not among them was cut
_UNDER_WAY: set[str] = set()


class Lake(Mapping):
    """Named tables as directories under ``root``."""

    # another application's intent is left alone for so many seconds: its writer may be at it
    LEASE = 900

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._staged: list[str] = []

    # paths and file system -------------------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{simple_name(name)}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _has_data(self, path: str) -> bool:
        """A committed table: parquet jobs leave ``_SUCCESS``. Where the cluster turns success markers off, a
        folder holding data files counts as a table."""
        fs, p = self._fs(path)
        if not fs.exists(p):
            return False
        if fs.exists(self._fs(path + "/_SUCCESS")[1]):
            return True
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        if conf.get("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true") == "false":
            it = fs.listFiles(p, True)
            while it.hasNext():
                if not it.next().getPath().getName().startswith(("_", ".")):
                    return True
        return False

    def stage_path(self, name: str) -> str:
        return f"{self.root}/_staging/{simple_name(name)}-{uuid.uuid4().hex[:12]}"

    # intents ------------------------------------------------------------------------------------
    def _intent_path(self, name: str) -> str:
        return f"{self.root}/_intents/{simple_name(name)}.json"

    @contextmanager
    def _intent(self, name: str, steps: dict):
        """Write the steps down, let the block carry them out, forget them once it has."""
        fs, p = self._fs(self._intent_path(name))
        mine = uuid.uuid4().hex
        text = json.dumps({**steps, "application": self.spark.sparkContext.applicationId, "writer": mine})
        out = fs.create(p, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        _UNDER_WAY.add(mine)
        try:
            yield
            fs.delete(p, False)
        finally:
            _UNDER_WAY.discard(mine)

    def finish_intents(self, name: str) -> bool:
        """Finish the steps that a writer of ``name`` was cut off from; whether there were any."""
        fs, p = self._fs(self._intent_path(name))
        if not fs.exists(p):
            return False
        status = fs.getFileStatus(p)
        steps = json.loads(self.spark.read.text(p.toString(), wholetext=True).first()[0])    # one small file
        if steps["writer"] in _UNDER_WAY:
            return False
        if steps["application"] != self.spark.sparkContext.applicationId and time.time() - status.getModificationTime() / 1000 < self.LEASE:
            return False
        if "fresh" in steps:
            self._finish_swap(steps["fresh"], self.path(name), steps["old"])
        else:
            staged = self.spark.read.parquet(steps["staged"])
            self.overwrite_partitions(name, staged, steps["partition_by"])
            self.delete_partitions(name, steps["partition_by"][0], set(steps["gone"]))
        fs.delete(p, False)
        return True

    # S9 / S10 ---------------------------------------------------------------------------------
    def exists(self, name: str) -> bool:
        self.finish_intents(name)
        return self._has_data(self.path(name))

    def tables(self) -> list[str]:
        fs, p = self._fs(self.root)
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p)
                      if s.isDirectory() and not s.getPath().getName().startswith("_")
                      and self._has_data(s.getPath().toString()))

    def drop(self, name: str) -> None:
        fs, p = self._fs(self.path(name))
        if fs.exists(p):
            fs.delete(p, True)

    def partition_values(self, name: str, column: str) -> list[str] | None:
        """Values of partition ``column`` from the folder names alone (no file is read), unescaped;
        None when the table is not partitioned by ``column``. Bounded by the number of partitions."""
        from urllib.parse import unquote

        fs, p = self._fs(self.path(name))
        if not fs.exists(p):
            return None
        prefix = column + "="
        dirs = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        if not any(d.startswith(prefix) for d in dirs):
            return None
        return [unquote(d[len(prefix):]) for d in dirs if d.startswith(prefix)]

    def delete_partitions(self, name: str, column: str, values: set) -> None:
        """Delete the folders of the partitions whose value, as the session's text, is in ``values`` (None: NULL)."""
        from urllib.parse import unquote

        fs, p = self._fs(self.path(name))
        gone = {"__HIVE_DEFAULT_PARTITION__" if v is None else v for v in values}
        for status in fs.listStatus(p) if gone else ():
            folder, _, value = status.getPath().getName().partition("=")
            if folder == column and unquote(value) in gone:
                fs.delete(status.getPath(), True)

    # Mapping ------------------------------------------------------------------------------------
    def __getitem__(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise KeyError(name)
        return self.read(name)

    def __iter__(self):
        return iter(self.tables())

    def __len__(self):
        return len(self.tables())

    def read(self, name: str) -> DataFrame:
        """The table's rows. All files of a table have one schema."""
        self.finish_intents(name)
        return self.spark.read.parquet(self.path(name))

    def can_merge(self, name: str) -> bool:
        """Whether the table's rows can be changed in place; plain files can't."""
        return False

    def table_name(self, name: str) -> str:
        """How SQL names the table."""
        return f"parquet.`{self.path(name)}`"

    # S5 / S6 / S7 -----------------------------------------------------------------------------------
    @staticmethod
    def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
        """Rows of one partition value gathered before a partitioned write: otherwise every task of a
        wide stage writes its own small file into every date it holds. REBALANCE lets AQE merge small
        groups to the advisory size and split a hot date into several files."""
        return df.hint("rebalance", *partition_by) if partition_by else df

    def overwrite(self, name: str, df: DataFrame, partition_by: Sequence[str] = (),
                  rebalance: bool = True) -> None:
        """Replace table and schema. ``df`` must not read this table (use ``stage`` first).
        ``rebalance=False`` when ``df`` already reads files grouped by the partition column."""
        if rebalance:
            df = self._rebalanced(df, partition_by)
        # written aside and swapped in when whole: a write that fails leaves the old table as it was
        fresh = self.stage_path(name)
        w = df.write.mode("error")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(fresh)
        old = self.stage_path("replaced")
        with self._intent(name, {"fresh": fresh, "old": old}):
            self._finish_swap(fresh, self.path(name), old)

    def _finish_swap(self, fresh: str, path: str, old: str) -> None:
        """Put the folder ``fresh`` in the place of ``path``, which steps aside to ``old``: from wherever an earlier try stopped."""
        fs, target = self._fs(path)
        new, aside = self._fs(fresh)[1], self._fs(old)[1]
        if fs.exists(new):
            if fs.exists(target):
                fs.mkdirs(aside.getParent())
                if not fs.rename(target, aside):
                    raise OSError(f"{path} can't be moved aside")
            if not fs.rename(new, target):
                if fs.exists(aside):
                    fs.rename(aside, target)
                raise OSError(f"{fresh} can't take the place of {path}")
        if fs.exists(aside):
            fs.delete(aside, True)

    def replace_partitions(self, name: str, staged: DataFrame, staged_at: str, column: str, gone: set) -> None:
        """Overwrite the partitions that ``staged`` holds and delete those of ``gone``, as one change."""
        with self._intent(name, {"staged": staged_at, "partition_by": [column], "gone": sorted(gone, key=lambda v: (v is None, v))}):
            try:
                self.overwrite_partitions(name, staged, [column])
            except Exception:                  # the write was aborted: the table is as it was, and so it stays
                fs, p = self._fs(self._intent_path(name))
                fs.delete(p, False)
                raise
            self.delete_partitions(name, column, gone)

    def overwrite_partitions(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> None:
        """Replace only the partitions present in ``df`` (dynamic partition overwrite). ``df`` is a
        staged copy, already written one partition folder per value, so it is not rebalanced again."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(self.path(name)))

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """S7."""
        w = df.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))

    def stage(self, name: str, df: DataFrame, partition_by: Sequence[str] = (),
              observation: Observation | None = None, metrics: Sequence = ()) -> DataFrame:
        """Materialise ``df`` to a fresh path on shared storage and return it read back (cuts lineage).
        With ``observation``, the row count (``rows``) and any extra aggregate ``metrics`` of the
        written data are observed during the same pass."""
        p = self.stage_path(name)
        if observation is not None:
            df = df.observe(observation, F.count(F.lit(1)).alias("rows"), *metrics)
        w = self._rebalanced(df, partition_by).write.mode("error")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(p)
        self._staged.append(p)
        self.last_staged = p
        return self.spark.read.parquet(p)

    def stage_lines(self, name: str, lines: DataFrame) -> str:
        """Write a frame of text lines aside; where it lies."""
        p = self.stage_path(name)
        write_lines(lines, p)
        self._staged.append(p)
        return p

    @contextmanager
    def staging(self):
        """Scope of one load: the copies it staged are deleted when the block succeeds (nothing
        reads them afterwards); after a failure they stay for inspection."""
        mark = len(self._staged)
        yield
        for p in self._staged[mark:]:
            fs, path = self._fs(p)
            if fs.exists(path):
                fs.delete(path, True)
        del self._staged[mark:]

    # Control table --------------------------------------------------------------------------------
    def init_control(self, pipeline: str, now) -> bool:
        """Create the one-row control table with status 'initialized' unless it exists."""
        if self.exists(CONTROL_TABLE):
            return False
        self.overwrite(CONTROL_TABLE, self.spark.createDataFrame([(pipeline, now, "initialized")], CONTROL_SCHEMA))
        return True

    def stamp_control(self, pipeline: str, now, status: str = "success") -> None:
        """Overwrite the control row (one row; only ever written after every table succeeded)."""
        self.overwrite(CONTROL_TABLE, self.spark.createDataFrame([(pipeline, now, status)], CONTROL_SCHEMA))

    # Run log ----------------------------------------------------------------------------------------
    def log_run(self, endpoint: str, now, records: int) -> None:
        """Append one row. Each endpoint has a folder of its own, so its last run is found without the others' files."""
        row = self.spark.createDataFrame([(endpoint, now, int(records))], RUN_LOG_SCHEMA)
        self.append(RUN_LOG_TABLE, row.withColumn("endpoint", F.col("endpoint_name")), partition_by=["endpoint"])

    # Metrics of each load ----------------------------------------------------------------------
    def log_metrics(self, endpoint: str, now, load, checked: bool = True) -> None:
        """Append one row for a finished load; duplicates are NULL where none were looked for.

        Numbers come from the footers of written files and from queries, never from observed counts, which a
        retried task may add to twice."""
        warning = f"{load.duplicates} duplicate keys in table" if checked and load.duplicates else None
        row = (endpoint, load.table, now, int(load.records), int(load.columns), int(load.table_rows) or None,
               int(load.duplicates) if checked else None, warning)
        frame = self.spark.createDataFrame([row], METRICS_SCHEMA).coalesce(1)
        self.append(METRICS_TABLE, frame.withColumn("endpoint", F.col("endpoint_name")), partition_by=["endpoint"])

    def metrics(self) -> DataFrame:
        """One row per finished load."""
        return self.read(METRICS_TABLE).select(*METRICS_SCHEMA.names)

    def runs(self) -> DataFrame:
        """The run log."""
        return self.read(RUN_LOG_TABLE).select(*RUN_LOG_SCHEMA.names)


def register_views(tables: Mapping[str, DataFrame], names: Sequence[str] | None = None) -> list[str]:
    """Expose fleet tables (a ``Lake``, ``CatalogTables`` or the test-data fleet) as session temp views,
    so ad-hoc Spark SQL runs on them by their table names. Views are lazy: nothing is read here."""
    out = []
    for name in (names if names is not None else list(tables)):
        tables[name].createOrReplaceTempView(simple_name(name))
        out.append(simple_name(name))
    return out


def write_with_metrics(df: DataFrame, write, metrics: Sequence = ()) -> dict:
    """Run ``write(df_observed)`` and return the rows and columns seen by that same pass
    (no second scan), plus any extra aggregate ``metrics``. Duplicate counts need a distinct
    aggregate, which observation does not allow; they come from ``operators.quality.table_profile``
    on the written table."""
    obs = Observation("load_metrics")
    aggs = [F.count(F.lit(1)).alias("rows"), *metrics]
    observed = df.observe(obs, *aggs)
    write(observed)
    m = dict(obs.get)
    m["columns"] = len(df.columns)
    return m
