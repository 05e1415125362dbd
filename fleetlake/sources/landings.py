"""Which landings an endpoint's loads have taken in, so that a load opens and lists only what is new.

Landings are the sub-folders of a landing root (its own files are one more). The ledger keeps, per endpoint and landing, the folder's
change time and that of its newest file when it was read. A load lists the root alone: a folder that the ledger knows
with the same change time is neither listed nor read; one that has changed since is read by Spark with
``modifiedAfter``, so the files it held before stay unread. Stores whose folders have no change time (it is 0 there)
are listed again, with the same filter.

The ledger is appended after the table was written: a load that is cut before that reads its landings again, which an upsert
by key takes twice without harm. Driver traffic: one status per folder of the root, one per file of a newly read folder.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.sources.pages import Landing
from fleetlake.sources.tables import Lake

LEDGER_TABLE = "_landing_ledger"
LEDGER_SCHEMA = T.StructType([T.StructField("endpoint_name", T.StringType(), False), T.StructField("landing", T.StringType(), False),
                              T.StructField("folder_time", T.LongType(), False), T.StructField("newest_file", T.LongType(), False),
                              T.StructField("load_time", T.TimestampType(), False)])


@dataclass(frozen=True)
class Seen:
    """A landing as the root showed it: its name, what to read of it, its folder's change time and its newest file's (milliseconds)."""

    name: str
    landings: tuple[Landing, ...]
    folder_time: int
    newest_file: int


def _listed(lake: Lake, path: str):
    fs, p = lake._fs(path)
    return fs.listStatus(p) if fs.exists(p) else []


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def _after(milliseconds: int) -> str | None:
    """As ``modifiedAfter`` takes it, in UTC; None for a landing not seen before."""
    if milliseconds < 0:
        return None
    return (_dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=milliseconds)).strftime("%Y-%m-%dT%H:%M:%S.%f")


def known_landings(lake: Lake, endpoint: str) -> dict[str, tuple[int, int]]:
    """{landing: (folder's change time, newest file's)} by the last load that took it in: a row per landing."""
    if not lake.exists(LEDGER_TABLE):
        return {}
    rows = (lake.read(LEDGER_TABLE).where(F.col("endpoint") == endpoint).groupBy("landing")
            .agg(F.max("folder_time").alias("folder_time"), F.max("newest_file").alias("newest_file")))
    return {r["landing"]: (r["folder_time"], r["newest_file"]) for r in rows.collect()}


def unread(lake: Lake, endpoint: str, root: str) -> list[Seen]:
    """The landings under ``root`` that are new or have changed, in the order of their names."""
    known, out = known_landings(lake, endpoint), []
    folders, loose = [], []
    for status in _listed(lake, root):
        if not _hidden(status.getPath().getName()):
            (folders if status.isDirectory() else loose).append(status)
    before = known.get("", (0, -1))[1]
    fresh = [s for s in loose if s.getModificationTime() > before]
    if fresh:
        newest = max(s.getModificationTime() for s in fresh)
        out.append(Seen("", tuple(Landing(s.getPath().toString()) for s in fresh), newest, newest))
    for status in folders:
        name, changed = status.getPath().getName(), status.getModificationTime()
        folder_time, before = known.get(name, (-1, -1))
        if changed and changed == folder_time:
            continue
        files = [s.getModificationTime() for s in _listed(lake, status.getPath().toString()) if not s.isDirectory() and not _hidden(s.getPath().getName())]
        newest = max(files, default=-1)
        if newest > before:
            out.append(Seen(name, (Landing(status.getPath().toString(), _after(before)),), changed, newest))
    return sorted(out, key=lambda s: s.name)


def record(lake: Lake, endpoint: str, landings: list[Seen], now: _dt.datetime) -> None:
    """Append what a finished load has taken in; each endpoint has a folder of its own."""
    rows = [(endpoint, s.name, s.folder_time, s.newest_file, now) for s in landings]
    if rows:
        frame = lake.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1)
        lake.append(LEDGER_TABLE, frame.withColumn("endpoint", F.col("endpoint_name")), partition_by=["endpoint"])


def ledger(lake: Lake):
    return lake.read(LEDGER_TABLE).select(*LEDGER_SCHEMA.names)
