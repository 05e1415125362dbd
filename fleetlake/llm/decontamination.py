"""Benchmark decontamination by spaced seeds (operator 3), in DataFrame operations only.

Tokens are lower-case runs of letters and digits. A seed hashes the tokens at the places of a fixed mask and
ignores the ones between, so a substituted token breaks only the seeds that look at it. Seeds of the
benchmark join seeds of every place of every document. Each diagonal (place in the document less place in
the item) is verified on the tokens around its hits: the pair is reported if some stretch of
``STRETCH`` aligned tokens (or the whole item, if shorter) agrees in at least ``AGREE`` percent.

No choice of the tokens that may differ breaks every seed; items shorter than a stretch have masks of their own, by length. Items below
``MIN_TOKENS`` tokens say too little and are not looked for. Items with equal tokens are reported once, under the smallest id.

All masks look at a window's first two tokens. Whether a place begins like any seed is asked of a bitmap of those beginnings, inside the
document's row, before the places become rows: only they carry the document's tokens along. More than ``BITMAP_HEADS``
beginnings go without the bitmap, every place as a row. The documents are scanned once, and nothing of them is shuffled but
hits (one per row, item, diagonal and stretch of AROUND places, reduced in the task that found them). The seeds of the benchmark are broadcast if a count shows that they are no more than
``BROADCAST_SEEDS``; more of them join by a shuffle of the documents' seeds.

Defined results: null or empty texts hold nothing and are never reported; rows with a null doc_id are looked at and
reported under null; rows that share an id are looked at each by its own text and reported together, by the best stretch of any; an empty table on either side gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepare, small_or_not, staged, texts

# places of a window that a seed hashes. By length of an item (longer ones: of a stretch), fixed masks of which one, at some place, looks
# at none of the tokens that may differ, whichever they are
FAMILIES = {5: ((0, 1, 2), (0, 1, 3)),
            6: ((0, 1, 2, 3), (0, 1, 3, 4)),
            7: ((0, 1, 3, 4),),
            8: ((0, 1, 3, 4), (0, 1, 2, 3), (0, 1, 5, 6)),
            9: ((0, 1, 3, 4), (0, 1, 5, 6)),
            10: ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 3, 4)),
            11: ((0, 1, 3, 5, 6), (0, 1, 2, 5, 6)),
            12: ((0, 1, 2, 4, 5), (0, 1, 3, 7, 8), (0, 1, 4, 6, 7), (0, 1, 3, 4, 5)),
            13: ((0, 1, 2, 4, 5), (0, 1, 6, 8, 9), (0, 1, 3, 4, 5))}
MASKS = FAMILIES[13]
HEAD = (0, 1)  # places that all masks look at
SPAN = 13
MIN_TOKENS, STRETCH, AGREE = 5, 13, 75
AROUND = 24  # tokens before a hit that are verified, and twice as many behind it
BROADCAST_SEEDS = 1_000_000
BROADCAST_IDS = 1_000_000
BITMAP_HEADS = 100_000  # as bits: 64 for each head at most, 1 MB


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _hash(at: Column, mask: tuple[int, ...], tag: int) -> Column:
    """Hash of the tokens of ``t`` at the mask's places, from ``at`` on."""
    return F.xxhash64(F.lit(tag), *(F.get("t", at + k) for k in mask))


def _every(rows: DataFrame, span: int) -> DataFrame:
    """``rows`` (with ``t``) times the places ``at`` where ``span`` tokens fit."""
    fits = F.when(F.size("t") >= span, F.sequence(F.lit(0), F.size("t") - span))
    return rows.withColumn("at", F.explode_outer(fits)).where("at is not null")


def _begins_known(at: Column, heads: DataFrame, count: int) -> Column:
    """Whether the place ``at`` of ``t`` may begin like a seed: a bit of its head's hash, in a literal."""
    bits = 1 << max(64 * count - 1, 1).bit_length()
    words = [0] * (bits >> 6)
    for r in heads.select(F.pmod("head", F.lit(bits)).alias("bit")).distinct().collect():  # at most BITMAP_HEADS
        words[r["bit"] >> 6] |= 1 << (r["bit"] & 63)
    bitmap = F.split(F.lit(",".join(str(w - (1 << 64) if w >> 63 else w) for w in words)), ",").cast("array<bigint>")  # folded into one literal
    bit = F.pmod(_hash(at, HEAD, -1), F.lit(bits))
    return F.getbit(F.get(bitmap, F.shiftright(bit, 6).cast("int")), (bit % 64).cast("int")) == 1


def _spaced(rows: DataFrame, masks: list[tuple[int, ...]], wanted=lambda m: F.lit(True)) -> DataFrame:
    """``rows`` (with ``t`` and ``at``) times the ``key`` of each mask that is wanted and fits."""
    keys = (F.when(wanted(m) & (F.col("at") + m[-1] < F.size("t")), _hash(F.col("at"), m, sum(1 << k for k in m))) for m in masks)
    return rows.withColumn("key", F.explode(F.array_compact(F.array(*keys))))


def items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, t) of the items that are looked for, one row per sequence of tokens."""
    rows = texts(benchmark, id_col, text_col).select(F.col("doc_id").alias("item_id"), tokens(F.col("text")).alias("t"))
    return staged(rows.where(F.size("t") >= MIN_TOKENS).groupBy("t").agg(F.min("item_id").alias("item_id")), "items")


def _agreement() -> Column:
    """Most equal tokens in any stretch, and the stretch's length, of arrays ``d`` and ``b`` aligned token by token."""
    equal = F.zip_with("d", "b", lambda x, y: F.when(x == y, 1).otherwise(0))
    length = F.least(F.size("b"), F.lit(STRETCH))
    sums = F.transform(F.sequence(F.lit(1), F.size("b") - length + 1), lambda i: F.aggregate(F.slice(equal, i, length), F.lit(0), lambda s, x: s + x))
    return F.struct(F.array_max(sums).alias("equal"), length.alias("length"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, doc_start, equal_tokens, compared_tokens): a row per document and item it holds, with the best
    verified stretch; doc_start is the document's token that aligns with the item's first (negative: the item's
    start is missing)."""
    best = leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("a.equal"), F.col("a.length"), (-F.col("diagonal")).alias("back"))).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.back")).alias("doc_start"), F.col("best.equal").alias("equal_tokens"), F.col("best.length").alias("compared_tokens"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, row_hash, item_id, diagonal, a): the verified stretches, ``row_hash`` that of the row's text."""
    prepare(docs.sparkSession)
    known = items(benchmark)
    size = F.least(F.size("t"), F.lit(STRETCH))
    lengths = [r["n"] for r in known.select(size.alias("n")).distinct().collect()]  # at most nine
    masks = sorted({m for n in lengths for m in FAMILIES[n]}) or list(MASKS)
    seeds = _spaced(_every(known, MIN_TOKENS - 2), masks, lambda m: size.isin([n for n in FAMILIES if m in FAMILIES[n]]))
    seeds = staged(seeds.select("key", "item_id", F.col("at").alias("item_at"), _hash(F.col("at"), HEAD, -1).alias("head")), "seeds")
    # all masks look at the window's head: a place whose head is no seed's is passed over by one look-up
    heads = staged(seeds.select("head").distinct(), "seed-heads")
    # rows are told apart by their texts: ids may repeat or be null
    rows = texts(docs).select("doc_id", F.xxhash64("text").alias("row_hash"), tokens(F.col("text")).alias("t"))
    count = heads.count()
    if 0 < count <= BITMAP_HEADS:
        fits = F.when(F.size("t") >= MIN_TOKENS - 2, F.sequence(F.lit(0), F.size("t") - (MIN_TOKENS - 2)))
        places = rows.withColumn("at", F.explode(F.filter(fits, lambda at: _begins_known(at, heads, count))))
    else:
        places = _every(rows, MIN_TOKENS - 2)
    places = places.withColumn("head", _hash(F.col("at"), HEAD, -1)).join(small_or_not(heads, BROADCAST_SEEDS), "head", "left_semi")
    hits = _spaced(places, masks).drop("head").join(small_or_not(seeds, BROADCAST_SEEDS).drop("head"), "key")
    first = F.greatest(F.col("at") - AROUND, F.lit(0))
    around = F.slice("t", first + 1, F.least(F.size("t") - first, F.lit(SPAN + 3 * AROUND)))
    # the first hit of every AROUND places of a diagonal; what is verified reaches past the last place that it stands for
    part = F.floor(F.col("at") / AROUND).alias("part")
    hits = (hits.select("doc_id", "row_hash", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal"), part, F.struct(F.col("at"), first.alias("from"), around.alias("w")).alias("hit"))
            .groupBy("doc_id", "row_hash", "item_id", "diagonal", "part").agg(F.min("hit").alias("hit")))
    # the item's tokens beside those of the document that they align with; before its start and past its end there are none
    low = F.greatest(F.col("hit.at") - AROUND - F.col("diagonal"), F.lit(0))
    high = F.least(F.size("t"), F.col("hit.at") - F.col("diagonal") + SPAN + 2 * AROUND)
    before = F.greatest(-(F.col("low") + F.col("diagonal")), F.lit(0))
    beside = F.slice("hit.w", F.col("low") + F.col("before") + F.col("diagonal") - F.col("hit.from") + 1, F.col("high") - F.col("low") - F.col("before"))
    pairs = (hits.join(known, "item_id").withColumn("low", low).withColumn("high", high).withColumn("before", before)
             .select("doc_id", "row_hash", "item_id", "diagonal", F.slice("t", F.col("low") + 1, F.col("high") - F.col("low")).alias("b"),
                     F.concat(F.array_repeat(F.lit(None).cast("string"), F.col("before").cast("int")), beside).alias("d")))
    return pairs.withColumn("a", _agreement()).where(F.col("a.equal") * 100 >= F.col("a.length") * AGREE).select("doc_id", "row_hash", "item_id", "diagonal", "a")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item, whatever their ids."""
    found = small_or_not(staged(leaks(docs, benchmark).select("doc_id", "row_hash").distinct(), "contaminated"), BROADCAST_IDS)
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(found, (own == found["row_hash"]) & docs["doc_id"].cast("bigint").eqNullSafe(found["doc_id"]), "left_anti")
