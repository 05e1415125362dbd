"""Filter interaction audit by Lehmer-rank difference arrays (operator 12).

Five filters applied in some order remove a document at the first filter it fails, so all that matters of a document
is the mask of filters it fails. Orders are numbered by their Lehmer rank, which is their lexicographic place; orders that
begin alike are neighbours. A mask is removed at step k by every order whose first k - 1 filters it passes and whose k-th
it fails: each such beginning is one interval of ranks. Documents are counted per part and mask, the counts are added at the
two ends of the mask's intervals, and a prefix sum over the ranks gives what each order removes at each step.

    A  fewer than 200 words            C  more than 2 % of the characters are A-Z
    B  under half the words distinct   D  holds one of # $ % & * |
    E  a smaller id has the same text, in the whole table, whether removed or not

Equal texts are found by digest. Their rows are reduced per id, then per digest and part, before any digest meets itself
in one task, so a text that a third of all rows share arrives there as a few counts for each part.

Defined results: a null text is empty; a null part counts as the empty string; rows with a null id pass E and make no other row
fail it; rows that share the smallest id of their text all pass E; a document is good (toxic) if any row of ``labels``
says so, labels without an id say nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import batches_of_bytes, prepare, staged

FILTERS = "ABCDE"
STEPS, ORDERS = len(FILTERS), factorial(len(FILTERS))
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 2
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = b"#$%&*|"
_MARKED = "doc_id bigint, part string, mask int, digest binary"


def text_mask(raw: bytes, code_points: int) -> int:
    """Bits of the filters A to D that a text fails. ``bytes.split`` splits at exactly the blanks 09-0D and 20."""
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > CAPITALS_PERCENT * code_points) << 2 | (len(raw.translate(None, _SIGNS)) < len(raw)) << 3)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from hashlib import sha256

    for part, raws in batches_of_bytes(batches):
        column = {name: part.column(part.schema.get_field_index(name)) for name in ("doc_id", "part", "text")}
        lengths = pc.utf8_length(column["text"]).to_pylist()
        masks = [text_mask(raw, n) for raw, n in zip(raws, lengths)]
        digests = [sha256(raw).digest() for raw in raws]
        yield pa.RecordBatch.from_arrays([column["doc_id"], column["part"], pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                                         ["doc_id", "part", "mask", "digest"])


def rank_of(beginning: str) -> int:
    """Lehmer rank of the first order that begins so: each letter counts the smaller ones still unused."""
    left, rank = list(FILTERS), 0
    for i, letter in enumerate(beginning):
        rank += left.index(letter) * factorial(STEPS - 1 - i)
        left.remove(letter)
    return rank


def removal_intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of every beginning at whose last filter the mask is removed."""
    out = []
    for mask in range(1, 1 << STEPS):
        fails = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
        for step in range(1, STEPS + 1):
            for beginning in permutations(FILTERS, step):
                if beginning[-1] in fails and not fails & set(beginning[:-1]):
                    start = rank_of("".join(beginning))
                    out.append((mask, step, start, start + factorial(STEPS - step)))
    return out


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part fail exactly the filters of the mask."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    marked = rows.mapInArrow(_masks, _MARKED)
    said = (labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("bigint").alias("labelled_id"))
            .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    known = marked.join(said, marked["doc_id"] == said["labelled_id"], "left")
    alike = ["digest", "part", "mask", "good", "toxic"]
    of_id = (known.select("digest", "part", "mask", "doc_id", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
             .groupBy(*alike, "doc_id").agg(F.count(F.lit(1)).alias("n")))
    here = F.col("doc_id").isNotNull()
    group = of_id.groupBy(*alike).agg(F.sum("n").alias("n"), F.min(F.when(here, F.struct("doc_id", "n"))).alias("first"),
                                      F.coalesce(F.sum(F.when(~here, F.col("n"))), F.lit(0)).alias("without_id"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    passing = F.col("without_id") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    counted = group.withColumn("least", least).withColumn("passing", passing)
    fails_e = 1 << FILTERS.index("E")
    either = counted.select("part", "good", "toxic", F.explode(F.array(F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
                                                                       F.struct((F.col("mask") + fails_e).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))).alias("c"))
    return either.where("c.n > 0").groupBy("part", "c.mask").agg(
        F.sum("c.n").alias("n"), F.sum(F.when(F.col("good"), F.col("c.n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("c.n")).otherwise(0)).alias("toxic"))


def order_totals(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """The audit of ``mask_counts``' rows: one row per part, order and step. ``counts`` is read more than once."""
    values = ["n", "good", "toxic"]
    # a few hundred intervals, fixed by the five filters
    intervals = spark.createDataFrame(removal_intervals(), "mask int, step int, start int, stop int")

    def end(rank: str, sign: int) -> Column:
        return F.struct(F.col("step"), F.col(rank).alias("rank"), *[(F.col(v) * sign).alias(v) for v in values])

    ends = counts.join(F.broadcast(intervals), "mask").select("part", F.explode(F.array(end("start", 1), end("stop", -1))).alias("e")).select("part", "e.*")
    parts = counts.select("part").distinct()
    places = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(STEPS))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("rank"), *[F.lit(0).cast("bigint").alias(v) for v in values])
    difference = ends.unionByName(places).groupBy("part", "step", "rank").agg(*[F.sum(v).alias(v) for v in values])
    up_to = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    removed = difference.select("part", "step", "rank", *[F.sum(v).over(up_to).alias(v) for v in values]).where(F.col("rank") < ORDERS)
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])   # lexicographic, so at its rank
    removed = removed.withColumn("filter_order", F.element_at(orders, F.col("rank") + 1))
    removed = removed.withColumn("filter", F.expr("substring(filter_order, step, 1)"))

    def failing(i: int) -> Column:
        return F.struct(F.lit(FILTERS[i]).alias("filter"), F.sum(F.when(F.col("mask").bitwiseAND(1 << i) > 0, F.col("n")).otherwise(0)).alias("fails"),
                        F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)).alias("unique_fails"))

    of_part = counts.groupBy("part").agg(F.sum("n").alias("documents"), F.array(*[failing(i) for i in range(STEPS)]).alias("of"))
    of_filter = of_part.select("part", "documents", F.explode("of").alias("f")).select("part", "documents", "f.*")
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    any_step = Window.partitionBy("part", "filter")
    return removed.join(of_filter, ["part", "filter"]).select(
        "part", "filter_order", "step", (F.col("documents") - F.sum("n").over(so_far)).alias("kept"), F.col("n").alias("removed"),
        (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(any_step).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): what each of the
    filters removes at each place of each order, per part."""
    counts = staged(mask_counts(docs, labels, **columns), "mask-counts")
    return order_totals(docs.sparkSession, counts)


_LETTERS = [f.lower() for f in FILTERS]
SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
     words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS least FROM docs),
     marks AS (SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
                      100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
                      coalesce(doc_id > least, false) AS e FROM words),
     said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
     counts AS (SELECT part, a, b, c, d, e, count(*) AS n, count_if(coalesce(good, false)) AS good, count_if(coalesce(toxic, false)) AS toxic
                FROM marks LEFT JOIN said USING (doc_id) GROUP BY ALL),
     letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
     orders AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM letters p, letters q, letters r, letters s, letters t
                WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
     steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS f FROM orders, range(1, 6) x(step)),
     ran AS (SELECT counts.*, filter_order, least(""" + ", ".join(f"if({x}, strpos(filter_order, '{x.upper()}'), 9)" for x in _LETTERS) + r""") AS gone_at FROM counts, orders),
     at_step AS (SELECT part, filter_order, step, f, sum(n) FILTER (gone_at > step) AS kept, sum(n) FILTER (gone_at = step) AS removed,
                        sum(n) FILTER (gone_at < step AND CASE f """ + " ".join(f"WHEN '{x.upper()}' THEN {x}" for x in _LETTERS) + r""" END) AS redundant,
                        sum(n) FILTER (CASE f """ + " ".join(f"WHEN '{x.upper()}' THEN {x}" for x in _LETTERS) + " END AND " + " + ".join(f"{x}::INT" for x in _LETTERS) + r""" = 1) AS unique_fails,
                        sum(good) FILTER (gone_at = step) AS good_lost, sum(toxic) FILTER (gone_at = step) AS toxic_lost
                 FROM ran JOIN steps USING (filter_order) GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, """ + ", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in
                                                 ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")) + """,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM at_step"""
