"""Vector codes by member-resident Lloyd rounds (operator 11).

Vectors become whole numbers floor(1024 * x) and are cut into equal consecutive parts; every part position has a codebook
of entries and a part is coded by its nearest entry. The codebooks are fitted by Lloyd rounds over parts that live with
their entry: a row (position, entry, salt, part) lies in the files of the owner of that key, where salts split an entry with
many members. In a round

    owners     read their resident members and find each one's nearest entry; members that stay remain where they are,
    movers     alone go through a shuffle to their new owner,
    owners     add up their resident members: one sum per entry and task, added up per entry into the new codebook.

Every round's members are written to the shared folder, so a lost executor costs its own tasks only. The codebooks
(entries x dimensions whole numbers, whatever the table's size) are all that the driver and every task hold. A last narrow
pass over the vectors gives codes and errors. All arithmetic is exact: products run as doubles where they stay under 2^53 and
as 64-bit integers else.

Defined results: vectors that are null, empty or hold null or non-finite components are dropped, and so are those whose length
is not that of the smallest kept id (null ids come last; of equal ids the smallest vector first); a component beyond
2^17 counts as 2^17, so that no distance overflows; equal and null ids are kept, one row in, one row out; lengths that the
number of parts doesn't divide give parts that differ by one; fewer vectors than entries give fewer entries; errors over a
label that pass 64 bits are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import discard, give_back, prepare, small_or_not, staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LIMIT = 1 << 27                # largest component, in units of 1 / SCALE
MEMBERS = 250_000              # members of an entry that one salt takes
BLOCK = 8192                   # parts compared with a codebook at once
LABELS = 200_000               # label sums that are broadcast at most; more join by a shuffle
_MEMBER = "position int, entry int, part array<int>, moved boolean"

Codebooks = list[np.ndarray]   # per position: entries x components


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype("f8") * SCALE), -LIMIT, LIMIT).astype("i8")


def bounds(dimension: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Where the parts of a vector begin and end; the first ones are longer by one where ``parts`` doesn't divide it."""
    size, more = divmod(dimension, parts)
    ends = [(i + 1) * size + min(i + 1, more) for i in range(parts)]
    return list(zip([0, *ends[:-1]], ends))


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of every row (the lowest of equal ones) and its squared distance."""
    entry, distance = np.empty(len(rows), "i4"), np.empty(len(rows), "i8")
    largest = max(int(np.abs(rows).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = "f8" if 4 * largest * largest * rows.shape[1] < 1 << 53 else "i8"
    centre = book.astype(kind)
    length = (centre * centre).sum(axis=1)
    for a in range(0, len(rows), BLOCK):
        x = rows[a:a + BLOCK].astype(kind)
        far = length - 2 * (x @ centre.T)
        best = far.argmin(axis=1)
        entry[a:a + BLOCK] = best
        distance[a:a + BLOCK] = far[np.arange(len(x)), best] + (x * x).sum(axis=1)
    return entry, distance


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column without nulls, and where each row's begin."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _matrix(column: pa.Array) -> np.ndarray:
    values, starts = _lists(column)
    n = len(starts) - 1
    return values.reshape(n, len(values) // n if n else 0)


def _of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _as_lists(rows: np.ndarray) -> pa.Array:
    starts = np.arange(len(rows) + 1, dtype="i4") * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(rows.astype("i4").ravel()))


def _members(position: int, entry: np.ndarray, rows: np.ndarray, moved: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), position, "i4")), pa.array(entry.astype("i4")), _as_lists(rows), pa.array(moved)],
                                      ["position", "entry", "part", "moved"])


Batches = Iterator[pa.RecordBatch]


def _first_owners(books: Codebooks, cuts: list[tuple[int, int]]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                rows = whole_numbers(_matrix(_of(batch, "vector")))
                for position, (a, b) in enumerate(cuts):
                    part = rows[:, a:b]
                    yield _members(position, nearest(part, books[position])[0], part, np.ones(len(part), bool))
        give_back()
    return run


def _by_position(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, entries, parts) of each position in a batch; parts of one position are of one length."""
    positions, entries = _of(batch, "position").to_numpy(), _of(batch, "entry").to_numpy()
    for position in np.unique(positions):
        here = np.flatnonzero(positions == position)
        yield int(position), entries[here], _matrix(_of(batch, "part").take(pa.array(here))).astype("i8")


def _reassigned(books: Codebooks) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for position, entry, rows in _by_position(batch):
                now = nearest(rows, books[position])[0]
                yield _members(position, now, rows, now != entry)
        give_back()
    return run


def _sums(books: Codebooks) -> Callable[[Batches], Batches]:
    """A task's sums: per entry that has members in it, their number and the sum of each component."""
    def run(batches: Batches) -> Batches:
        total = [np.zeros((len(book), book.shape[1] + 1), "i8") for book in books]
        for batch in batches:
            for position, entry, rows in _by_position(batch):
                order = np.argsort(entry, kind="stable")
                some, starts = np.unique(entry[order], return_index=True)
                total[position][some, 1:] += np.add.reduceat(rows[order], starts, axis=0)
                total[position][some, 0] += np.diff([*starts, len(order)])
        for position, sums in enumerate(total):
            entry, component = np.nonzero(sums)
            if len(entry):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(entry), position, "i4")), pa.array(entry.astype("i4")), pa.array(component.astype("i4")),
                                                  pa.array(sums[entry, component])], ["position", "entry", "component", "total"])
        give_back()
    return run


def _usable(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(vec_id, vector, label) of the rows whose vector is whole and finite."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.coalesce(finite, F.lit(False)))


def first_codebooks(usable: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> tuple[int, Codebooks]:
    """The kept vectors' length and, per position, the parts of the ``entries`` smallest ids."""
    by_id = [F.col("vec_id").asc_nulls_last(), F.col("vector").asc()]
    one = usable.orderBy(*by_id).select(F.size("vector").alias("n")).first()
    if one is None:
        return 0, []
    dimension = one["n"]
    first = usable.where(F.size("vector") == dimension).orderBy(*by_id).select("vector").limit(entries).collect()   # ``entries`` rows
    rows = whole_numbers(np.array([r["vector"] for r in first]))
    return dimension, [rows[:, a:b] for a, b in bounds(dimension, parts)]


def _to_owners(assigned: DataFrame, members: int) -> DataFrame:
    """The movers of ``assigned`` with their new owners: (position, entry, salt), an entry having a salt for every ``members`` of its parts."""
    size = assigned.groupBy("position", "entry").agg(F.ceil(F.count(F.lit(1)) / members).alias("salts"))
    # at most one row per entry of a codebook; the table is written, so the running number comes out the same again
    movers = assigned.where("moved").withColumn("n", F.monotonically_increasing_id())
    owned = movers.join(F.broadcast(size), ["position", "entry"]).withColumn("salt", F.expr("n % salts").cast("int"))
    return owned.repartition("position", "entry", "salt").select("position", "entry", "part")


def _updated(spark: SparkSession, residents: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks of the floors of the members' means; an entry without members stays."""
    sums = residents.mapInArrow(_sums(books), "position int, entry int, component int, total bigint")
    rows = sums.groupBy("position", "entry", "component").agg(F.sum("total").alias("total")).toArrow()   # codebook-sized
    position, entry, component, total = (rows.column(n).to_numpy() for n in ("position", "entry", "component", "total"))
    out = []
    for p, book in enumerate(books):
        full = np.zeros((len(book), book.shape[1] + 1), "i8")
        here = position == p
        full[entry[here], component[here]] = total[here]
        used = full[:, :1] > 0
        out.append(np.where(used, full[:, 1:] // np.maximum(full[:, :1], 1), book))   # // is floor
    return out


def lloyd_codebooks(usable: DataFrame, dimension: int, books: Codebooks, rounds: int = ROUNDS, members: int = MEMBERS) -> Codebooks:
    """The codebooks after ``rounds`` rounds over all ``usable`` vectors of ``dimension``."""
    spark = usable.sparkSession
    cuts = bounds(dimension, len(books))
    made: list[DataFrame] = []
    residents: DataFrame | None = None
    for _ in range(rounds):
        found = (usable.where(F.size("vector") == dimension).select("vector").mapInArrow(_first_owners(books, cuts), _MEMBER) if residents is None
                 else residents.mapInArrow(_reassigned(books), _MEMBER))
        assigned = staged(found, "assigned", partition_by="moved")    # written where it was read: no shuffle
        arrived = staged(_to_owners(assigned, members), "arrived")
        before, made = made, [assigned, arrived]
        discard(*before)                                              # the round before was read for the last time
        residents = assigned.where("not moved").select("position", "entry", "part").unionByName(arrived)
        books = _updated(spark, residents, books)
    discard(*made)
    return books


def _coded(books: Codebooks, cuts: list[tuple[int, int]], label_type: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = whole_numbers(_matrix(_of(batch, "vector")))
            found = [nearest(rows[:, a:b], book) for (a, b), book in zip(cuts, books)]
            entries = np.stack([f[0] for f in found], axis=1).astype(">u2" if any(len(b) > 256 for b in books) else "u1")
            codes = [row.tobytes().hex() for row in entries]
            error = np.sum([f[1] for f in found], axis=0)
            yield pa.RecordBatch.from_arrays([_of(batch, "vec_id"), pa.array(codes, pa.string()), pa.array(error), _of(batch, "label")], ["vec_id", "code", "error", "label"])
        give_back()
    return run


def codebooks_digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def vector_codes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS, members: int = MEMBERS) -> DataFrame:
    """(vec_id, code, error, label, label_error, codebooks_sha256) of every kept vector. Codes have two hex digits a part (four
    with more than 256 entries)."""
    spark = vectors.sparkSession
    prepare(spark)
    usable = _usable(vectors, vec_id, vector, label)
    label_type = usable.schema["label"].dataType.simpleString()
    dimension, books = first_codebooks(usable, entries, parts)
    if not books:
        return spark.createDataFrame([], f"vec_id bigint, code string, error bigint, label {label_type}, label_error bigint, codebooks_sha256 string")
    books = lloyd_codebooks(usable, dimension, books, rounds, members)
    same = usable.where(F.size("vector") == dimension).select("vec_id", "vector", "label")
    coded = staged(same.mapInArrow(_coded(books, bounds(dimension, parts), label_type), f"vec_id bigint, code string, error bigint, label {label_type}"), "coded")
    of_label = staged(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error")), "label-errors")
    return (coded.join(small_or_not(of_label, LABELS), F.col("label").eqNullSafe(F.col("of_label")))
            .select("vec_id", "code", "error", "label", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")))


def _round_sql(i: int) -> str:
    """Assignment to the codebooks of round ``i`` and the codebooks after it."""
    return f"""
     near{i} AS MATERIALIZED (SELECT vec_id, label, p, any_value(parts.v) AS v, min(d) AS d, arg_min(e, d * 256 + e) AS e
        FROM (SELECT parts.*, e, list_inner_product(parts.v, parts.v) - 2 * list_inner_product(parts.v, book.v) + list_inner_product(book.v, book.v) AS d
              FROM parts JOIN book{i} book USING (p)) parts GROUP BY vec_id, label, p),
     book{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(now.v, book.v) AS v FROM book{i} book LEFT JOIN
        (SELECT p, e, list(floor(s / n) ORDER BY k) AS v
         FROM (SELECT p, e, k, sum(v[k]) AS s, count(*) AS n FROM near{i}, range(1, 17) x(k) GROUP BY p, e, k) GROUP BY p, e) now USING (p, e))"""


# 64 components, as the given table has; sums over it stay exact as doubles
SQL = """
WITH kept AS (SELECT vec_id, label, embedding FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
     parts AS MATERIALIZED (SELECT vec_id, label, p, list_transform(embedding[p * 16 + 1:p * 16 + 16], lambda x: floor(1024 * x::DOUBLE)) AS v FROM kept, range(4) x(p)),
     book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)),
""" + ",".join(_round_sql(i) for i in range(ROUNDS + 1)) + f""",
     codes AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id, label),
     digest AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, label, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes, digest"""
