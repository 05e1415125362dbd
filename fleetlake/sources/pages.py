"""Landed API pages -> records.

A page is a JSON object ``{"offset": <row offset of the request>, "results": [record, ...]}``. Pages are
landed as JSON-lines files (one page per line; a file may hold many pages) or as one pretty-printed
page per file (``multi_line=True``). Each landing is a folder; folders sort by name in the order they
landed. Every record gets ``_seq``, a struct that orders all records for keep-last dedup: landing folder,
page (its offset where it has one, then its file and place in it), position in the page. So a landing whose offsets
start at 0 again still comes after the one before, and pages without an offset keep their order.

A page that is not whole JSON, or that has no ``results``, fails the read: a batch is complete or it fails.

The landed files are scanned once (N0, N1), in one of two ways:

* ``read_pages``, where the columns are not known. The scan takes each record as its text, exactly as it was sent, and stages
  it as JSON lines; the schema of all records (``schema_of_variant_agg``) is observed by that same write, so the union of ragged
  keys is known when the staged lines are read into columns. A column that holds objects or arrays, or scalars of several
  kinds, is text: each cell as it was sent, but for blanks between the tokens of an object.
* ``read_known``, where they are (a declared schema, or the table that an earlier load made). The scan takes each record as
  key -> text and casts the known cells leniently; nothing is inferred and nothing staged.

No record is ever collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.casts import to_type_lenient
from fleetlake.session import shared_dir

SEQ = "_seq"
TEXT_PAGES = "offset STRING, results ARRAY<STRING>"
CELL_PAGES = "offset STRING, results ARRAY<MAP<STRING, STRING>>"

# What a variant's type becomes as a column
_SCALARS: dict[str, T.DataType] = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "BOOLEAN": T.BooleanType(), "STRING": T.StringType()}


@dataclass(frozen=True)
class Landing:
    """A folder (or file, or pattern) of landed pages; with ``after``, only its files that changed after that time."""

    path: str
    after: str | None = None


def _scan(spark: SparkSession, landed: str | Sequence[Landing], pages: str | T.StructType, multi_line: bool) -> DataFrame:
    """One JSON scan over all landings; those with a time of their own are scans beside it."""
    landings = [Landing(landed)] if isinstance(landed, str) else list(landed)
    by_time: dict[str | None, list[str]] = {}
    for x in landings:
        by_time.setdefault(x.after, []).append(x.path)
    out = None
    for after, paths in by_time.items():
        reader = spark.read.schema(pages).option("multiLine", multi_line).option("mode", "FAILFAST").option("timeZone", "UTC")
        part = page_records((reader.option("modifiedAfter", after) if after else reader).json(paths))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no landing to read")
    return out


def read_pages(spark: SparkSession, landed: str | Sequence[Landing], schema: T.StructType | str | None = None, multi_line: bool = False,
               structs: bool = False, stage: Callable[..., str] | None = None) -> DataFrame:
    """Records of all landed pages as a flat DataFrame plus ``_seq``. ``schema`` is that of the pages, where it is known.

    ``structs`` keeps the objects of a record as structs, one level deep (for N14). ``stage`` writes the records' text
    (``Lake.stage_lines``); by default it lies under the shared checkpoint folder until the owner clears that."""
    if schema is not None:
        return _scan(spark, landed, schema, multi_line)
    return infer_records(_scan(spark, landed, TEXT_PAGES, multi_line), structs, stage)


def write_lines(lines: DataFrame, path: str, mode: str = "error") -> None:
    """Lines of JSON, compressed: keys, folders and file names repeat in each. A file is the work of one task, as its writing was."""
    lines.write.mode(mode).option("compression", "gzip").text(path)


def infer_records(texts: DataFrame, structs: bool = False, stage: Callable[..., str] | None = None) -> DataFrame:
    """Typed columns of records given as text (``value``, ``_seq``): staged once as JSON lines, their schema seen by that write."""
    spark, seen = texts.sparkSession, Observation("records")
    # line breaks of a record lie between its tokens: inside a string they are escaped
    record = F.coalesce(F.regexp_replace("value", r"[\r\n]+", " "), F.lit("null"))
    lines = texts.select(F.concat(F.lit('{"seq":'), F.to_json(SEQ), F.lit(',"record":'), record, F.lit("}")).alias("value"), F.parse_json("value").alias("_variant"))
    lines = lines.observe(seen, F.count(F.lit(1)).alias("rows"), F.expr("schema_of_variant_agg(_variant)").alias("kind")).select("value")
    if stage is None:
        path = shared_dir(spark, "records")
        write_lines(lines, path)
    else:
        path = stage("records", lines)
    found = seen.get
    if not found["rows"]:                                               # nothing landed
        return spark.createDataFrame([], T.StructType([T.StructField(SEQ, T.LongType())]))
    if not found["kind"].startswith("OBJECT<"):
        raise ValueError(f"the landed records are no objects but {found['kind']}")
    fields = T.StructType([T.StructField(n, _column_type(k, structs)) for n, k in object_fields(found["kind"])])
    whole = T.StructType([T.StructField("seq", texts.schema[SEQ].dataType), T.StructField("record", fields)])
    back = spark.read.schema(whole).option("mode", "FAILFAST").json(path)
    return back.select(*[_as_sent(F.col("record").getField(f.name), f.dataType).alias(f.name) for f in fields], F.col("seq").alias(SEQ))


def _as_sent(cell: Column, kind: T.DataType) -> Column:
    """A cell read as text, without the blanks between the tokens of an object or array: keys in their order, numbers as written."""
    if not isinstance(kind, T.StringType):
        return cell
    tokens = F.regexp_replace(cell, r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|\s++', "$1")
    return F.when(cell.rlike(r"^[\[{]") & F.try_parse_json(cell).isNotNull(), tokens).otherwise(cell)


def object_fields(kind: str) -> list[tuple[str, str]]:
    """The (name, type) pairs of ``OBJECT<name: type, ...>``, as ``schema_of_variant_agg`` writes it; odd names are in backquotes."""
    out, at, body = [], 0, kind[len("OBJECT<"):-1]
    while at < len(body):
        if body[at] == "`":
            end = at + 1
            while body[end] != "`" or body[end:end + 2] == "``":
                end += 2 if body[end] == "`" else 1
            name, at = body[at + 1:end].replace("``", "`"), end + 3         # `: 
        else:
            end = body.index(": ", at)
            name, at = body[at:end], end + 2
        depth, start, quoted = 0, at, False
        while at < len(body) and (depth or quoted or body[at] != ","):
            quoted ^= body[at] == "`"
            depth += 0 if quoted else (body[at] in "<(") - (body[at] in ">)")
            at += 1
        out.append((name, body[start:at]))
        at += 2
    return out


def _column_type(kind: str, structs: bool = False) -> T.DataType:
    """Numbers with a fraction or beyond 64 bits are doubles; what is nested or of several kinds is text."""
    if kind.startswith("DECIMAL"):
        return T.DoubleType()
    if kind.startswith("OBJECT<") and structs and len(kind) > len("OBJECT<>"):
        return T.StructType([T.StructField(n, _column_type(k)) for n, k in object_fields(kind)])
    return _SCALARS.get(kind, T.StringType())


def read_known(spark: SparkSession, landed: str | Sequence[Landing], types: Mapping[str, T.DataType], multi_line: bool = False,
               as_text: Sequence[str] = (), seen: Observation | None = None) -> DataFrame:
    """The ``types``' columns of all records plus ``_seq``, from one scan: cells cast leniently from their text, those of ``as_text``
    left as text, keys that a record lacks NULL. ``seen`` observes how many records hold each column (``p0``, ``p1``, ...)."""
    records = _scan(spark, landed, CELL_PAGES, multi_line)
    if seen is not None:
        records = records.observe(seen, *[F.count_if(F.map_contains_key("value", F.lit(n))).alias(f"p{i}") for i, n in enumerate(types)])

    def cell(name: str, kind: T.DataType) -> Column:
        text = F.try_element_at("value", F.lit(name))
        return (text if name in as_text else to_type_lenient(_as_sent(text, kind), T.StringType(), kind)).alias(name)
    return records.select(*[cell(n, k) for n, k in types.items()], SEQ)


def page_records(pages: DataFrame) -> DataFrame:
    """One row per record of ``pages`` (a batch or a stream of JSON files), with ``_seq``; records that are no structs are one column ``value``."""
    if "results" not in pages.columns:
        raise ValueError("the landed pages have no results")
    rec_type = pages.schema["results"].dataType.elementType
    offset = F.col("offset").try_cast("bigint") if "offset" in pages.columns else F.lit(None).cast("bigint")
    # lines of one file block are read in order by one task, so its running id orders them; a stream has no such id
    line = F.lit(0).cast("bigint") if pages.isStreaming else F.monotonically_increasing_id()
    page = F.struct(F.regexp_extract("_metadata.file_path", "^(.*)/", 1).alias("landing"), F.coalesce(offset, F.lit(0)).alias("offset"),
                    F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), line.alias("line"))
    whole = F.when(F.col("results").isNull(), F.raise_error(F.concat(F.lit("a page without results in "), F.col("_metadata.file_path")))).otherwise(F.col("results"))
    recs = pages.select(page.alias("_page"), whole.alias("_results")).select("_page", F.posexplode("_results").alias("_pos", "_rec"))
    if isinstance(rec_type, T.StructType):
        cols = [F.col("_rec").getField(f.name).alias(f.name) for f in rec_type.fields]
    else:
        cols = [F.col("_rec").alias("value")]
    return recs.select(*cols, F.struct("_page.*", F.col("_pos").alias("pos")).alias(SEQ))


def page_schema_of(spark: SparkSession, path: str, multi_line: bool = False) -> T.StructType:
    """The inferred page schema of what is landed now (a stream fixes its schema at start)."""
    return spark.read.option("mode", "FAILFAST").option("samplingRatio", 1.0).option("multiLine", multi_line).json(path).schema


def land_pages(df: DataFrame, path: str, seq_col: str, page_size: int = 100,
               timestamp_format: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", mode: str = "error") -> None:
    """Write ``df`` as API pages, the way the paged endpoint serves it (for loads, tests, replays).

    ``seq_col`` is a dense non-negative integer giving each record's row offset; page = seq div size.
    Records drop NULL fields (as a sparse API does), so pages are naturally ragged. A page holds at most
    ``page_size`` records, so each grouped row is bounded.
    """
    data_cols = [c for c in df.columns if c != seq_col]
    options = {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format}
    seq = F.col(seq_col).cast("bigint")
    # columns are smaller to shuffle than their text, which is made behind it
    keyed = df.select((F.floor(seq / page_size) * page_size).cast("bigint").alias("offset"),
                      (seq % page_size).alias("pos"), F.struct(*[F.col(f"`{c}`") for c in data_cols]).alias("rec"))
    pages = (keyed.groupBy("offset").agg(F.collect_list(F.struct("pos", "rec")).alias("items"))
             .select("offset", F.sort_array(F.transform("items", lambda x: F.struct(x["pos"].alias("pos"), F.to_json(x["rec"], options).alias("rec")))).alias("items"))
             .select(F.concat(F.lit('{"offset":'), F.col("offset").cast("string"), F.lit(',"results":['),
                              F.array_join(F.transform("items", lambda x: x["rec"]), ","),
                              F.lit("]}")).alias("value")))
    write_lines(pages, path, mode)
