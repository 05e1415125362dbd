"""Best-fit packing of token pieces into fixed-size sequences (operator 8).

Bulk-synchronous best-fit. Pieces of one length are interchangeable, so a round takes all pieces of one
length at once, longest first, and sweeps the open gaps upward from that length: the smallest gap that is
wide enough is filled first. Pieces and gaps of equal size are told apart by rank, so a match is a
range of piece ranks against a range of sequences, no two pieces want the same place, and the gaps shrink
before the next round. This gives exactly the packing of best-fit decreasing.

The sweep sees class sizes (at most ``capacity`` lengths and as many gap sizes, whatever the corpus), never
pieces. Ranks and places of the pieces themselves are computed by Spark: ranks within a length from per-task
counts and their running sums, places by a join of pieces with rank ranges.

Defined results: null text is an empty document, one piece with the end id alone; repeated rows are packed as
often as they occur; a document that fills its pieces exactly has no shorter last piece; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import batches_of_bytes, prepare, staged, texts
from fleetlake.llm.tokenize import space_free_ids

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, local_rank bigint"
RANGES = "length bigint, first_rank bigint, last_rank bigint, a_sequence bigint, first_sequence bigint, first_offset bigint"
# rank ranges are broadcast up to this many rows (48 bytes each); beyond it they join by a shuffle
BROADCAST_RANGES = 200_000


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        part_id, ranks = TaskContext.get().partitionId(), Counter()
        for part, _ in batches_of_bytes(batches, 6 << 20, uses="tokenizers"):
            doc_ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
            cols: list[list] = [[] for _ in range(8 if with_ids else 7)]
            for doc, ids in zip(doc_ids, space_free_ids(path, part.column(part.schema.get_field_index("text"))), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at:at + 4 * capacity]
                    n = len(piece) // 4
                    row = [doc, k, at // 4, n, zlib.crc32(piece), part_id, ranks[n]]
                    ranks[n] += 1
                    for col, v in zip(cols, row + [np.frombuffer(piece, "<u4").astype("i4")] * with_ids, strict=True):
                        col.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names[:len(cols)])
    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, written to the shared folder: which task made a
    piece (``part``) and its rank among that task's pieces of its length are stored with it. ``with_ids``
    adds the ids themselves."""
    prepare(docs.sparkSession)
    schema = PIECES + (", ids array<int>" if with_ids else "")
    return staged(texts(docs).mapInArrow(_cut(tokenizer_path, capacity, end_id, with_ids), schema), "pieces")


def best_fit_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rank ranges (length, first rank, last rank + 1, pieces a sequence, first sequence, first offset).

    ``counts``: pieces by length. Pieces of rank r in a range go to sequence ``first + (r - first rank) // a_sequence``.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap size -> ranges (first sequence, how many)
    sizes: list[int] = []  # the gap sizes in order
    out, opened = [], 0

    def put(size: int, first: int, n: int) -> None:
        if size and n:
            if size not in gaps:
                insort(sizes, size)
                gaps[size] = []
            gaps[size].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]

        def fill(first: int, n: int, gap: int) -> int:
            """Fill up to ``n`` sequences with this gap; how many were touched."""
            nonlocal rank, left
            each = gap // length
            full = min(n, left // each)
            for used, per in ((full, each), (int(full < n and left - full * each > 0), left - full * each)):
                if used:
                    out.append((length, rank, rank + used * per, per, first, capacity - gap))
                    put(gap - per * length, first, used)
                    rank, left, first = rank + used * per, left - used * per, first + used
            return first

        at = bisect_left(sizes, length)
        while left and at < len(sizes):
            size = sizes[at]
            ranges = gaps.pop(size)
            sizes.pop(at)
            kept = []
            for first, n in ranges:
                nxt = fill(first, n, size) if left else first
                if nxt < first + n:
                    kept.append((nxt, first + n - nxt))
            below = bisect_left(sizes, length)
            if kept:
                for first, n in kept:
                    put(size, first, n)
            at = max(below, bisect_left(sizes, size + 1))
        if left:
            n = -(-left // (capacity // length))
            fill(opened, n, capacity)
            opened += n
    return out


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset. Needs length, and part and local_rank as token_pieces writes them."""
    spark = pieces.sparkSession
    per_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = best_fit_rounds(counts, capacity)
    ranges = spark.createDataFrame(rows, RANGES) if rows else spark.createDataFrame([], RANGES)
    if len(rows) <= BROADCAST_RANGES:
        ranges = F.broadcast(ranges)
    ranked = pieces.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("local_rank"))
    at = F.col("rank") - F.col("first_rank")
    placed = ranked.join(ranges, (ranked["length"] == ranges["length"]) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("last_rank")))
    return placed.select(*(ranked[c] for c in pieces.columns if c not in ("part", "local_rank")),
                         (F.col("first_sequence") + F.floor(at / F.col("a_sequence"))).cast("bigint").alias("sequence_id"),
                         (F.col("first_offset") + at % F.col("a_sequence") * ranked["length"]).cast("bigint").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``: one row per piece."""
    return packed(token_pieces(docs, tokenizer_path, capacity, end_id, with_ids), capacity)
