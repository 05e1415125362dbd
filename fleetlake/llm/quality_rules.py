"""Quality rules with a hashed n-gram log-likelihood ratio (operator 5).

Words and pairs of adjacent words are hashed into ``BUCKETS`` buckets. Two multinomials over the buckets are
counted: the raw corpus from every document, the target from trusted documents. A document's score is the mean,
over its n-grams, of log p(target) - log p(raw), so it does not grow with length. The threshold is fixed by
documents that the target has not seen: trusted documents are dealt in two by a hash of their id, one part
makes the target, the other and the rejected ones, every one of them, set the threshold that errs least (losing a
trusted document counts ``KEEP_WEIGHT`` times keeping a rejected one; of equal ones the lowest). Scores of labelled
documents that a task can't rank alone are ranked range by range, so their number is not bounded.
Every document is then kept or not by its base rules and that threshold alone.

Defined results: null or empty texts and texts without words have 0 words and fail the base rules; repeated rows are
scored each, and of a labelled id's rows the one that scores lowest takes part in the threshold; without trusted or without rejected labels there is no threshold and the base rules
decide; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import batches_of_bytes, prepare, small_or_not, staged, texts
from fleetlake.llm.words import SPACES, hashed_words, mapped, mixed, runs

BITS = 17
BUCKETS = 1 << BITS
SMOOTHING = 0.5
KEEP_WEIGHT = 10
BROADCAST_LABELS = 1_000_000
RANKED_ROWS = 100_000  # different scores that are ranked at once
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20
MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _buckets(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of a batch, and which text it belongs to."""
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    pairs = runs(words, 2)
    inside = of[:-1] == of[1:] if len(of) else np.zeros(0, bool)
    shift = np.uint64(64 - BITS)
    return (np.concatenate([mixed(words) >> shift, pairs[inside] >> shift]).astype("i8"), np.concatenate([of, of[:-1][inside]]) if len(of) else of)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts per bucket: of all its documents, and of those that make the target."""
    raw, target = np.zeros(BUCKETS, "i8"), np.zeros(BUCKETS, "i8")
    for part, _ in batches_of_bytes(batches):
        words, starts = hashed_words(_column(part, "text"))
        buckets, of = _buckets(words, starts)
        raw += np.bincount(buckets, minlength=BUCKETS)
        trusted = _column(part, "target").to_numpy(zero_copy_only=False).astype(bool)
        target += np.bincount(buckets[trusted[of]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(some.astype("i4")), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])


def repeated_words(words: np.ndarray, k: int = REPEAT_WINDOW) -> int:
    """Words that lie in a ``k``-word window found twice or more, first one included."""
    windows = runs(words, k)
    if len(windows) < 2:
        return 0
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    if not len(again):
        return 0
    edge = np.zeros(len(words) + 1, "i8")
    np.add.at(edge, again, 1)
    np.add.at(edge, again + k, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def _measures(text: pa.Array, raw: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The base measures of every text, and its words' hashes with their starts."""
    words, starts = hashed_words(text, lower=False)
    plain = mapped(text, SPACES)
    ends = np.frombuffer(plain.buffers()[1], "<i8", len(plain) + 1)
    data = np.frombuffer(plain.buffers()[2] or b"", "u1")

    def per_text(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks)])
        return sums[ends[1:]] - sums[ends[:-1]]

    lines = [[x for x in t.split(b"\n") if x.strip()] for t in raw]
    return {"n_words": np.diff(starts), "word_chars": per_text((data & 0xC0 != 0x80) & (data != 32)), "n_symbols": per_text(_SYMBOL[data]),
            "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], "i8"),
            "n_repeat_words": np.array([repeated_words(words[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)], "i8")}, words, starts


def _scored(ratio):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        llr = ratio.value
        for part, raw in batches_of_bytes(batches):
            text = _column(part, "text")
            found, _, _ = _measures(text, raw)
            buckets, of = _buckets(*hashed_words(text))
            n = len(raw)
            score = np.bincount(of, llr[buckets], n) / np.maximum(np.bincount(of, minlength=n), 1)
            yield pa.RecordBatch.from_arrays([_column(part, "doc_id"), *(pa.array(v.astype("i8")) for v in found.values()), pa.array(score), _column(part, "label"), _column(part, "target")],
                                             ["doc_id", *found, "score", "label", "target"])
    return run


def log_ratio(counted: DataFrame) -> np.ndarray:
    """log p(target) - log p(raw) per bucket, from the summed counts (``BUCKETS`` numbers, whatever the corpus)."""
    table = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[table["bucket"].to_numpy()], target[table["bucket"].to_numpy()] = table["raw"].to_numpy(), table["target"].to_numpy()
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + SMOOTHING) / (target.sum() + SMOOTHING * BUCKETS)) - np.log((raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS))


def threshold(scores: np.ndarray, trusted: np.ndarray) -> float:
    """The lowest threshold with the least weighted share of wrong verdicts; minus infinity without both kinds."""
    if not trusted.any() or trusted.all():
        return float("-inf")
    at = np.unique(scores)
    good, bad = np.sort(scores[trusted]), np.sort(scores[~trusted])
    lost = np.searchsorted(good, at, "left") / len(good)
    kept = 1 - np.searchsorted(bad, at, "left") / len(bad)
    best = int(np.argmin(KEEP_WEIGHT * lost + kept))
    below = at[best - 1] if best else at[best]
    return float((at[best] + below) / 2)


def ranked_threshold(held: DataFrame, rows: int = RANKED_ROWS) -> float:
    """``threshold`` of the (score, trusted) rows of ``held``: of all of them, ``rows`` different scores in a range."""
    one = held.groupBy("score").agg(F.count_if("trusted").alias("good"), F.count_if(~F.col("trusted")).alias("bad"))
    counted = staged(one, "held")
    n = counted.count()
    # dealt by ranges once and written, so that every later step sees the same ranges
    dealt = staged(counted.repartitionByRange(n // rows + 1, "score").withColumn("range", F.spark_partition_id()), "ranges")
    ranges = sorted(dealt.groupBy("range").agg(F.min("score").alias("low"), F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect(), key=lambda r: r["low"])
    goods, bads = sum(r["good"] for r in ranges), sum(r["bad"] for r in ranges)
    if not goods or not bads:
        return float("-inf")
    before, good, bad = [], 0, 0
    for r in ranges:
        before.append((r["range"], good, bad))
        good, bad = good + r["good"], bad + r["bad"]
    below = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.join(F.broadcast(held.sparkSession.createDataFrame(before, "range int, good_before bigint, bad_before bigint")), "range")
    lost = (F.col("good_before") + F.coalesce(F.sum("good").over(below), F.lit(0))) / F.lit(goods)
    kept = F.lit(1.0) - (F.col("bad_before") + F.coalesce(F.sum("bad").over(below), F.lit(0))) / F.lit(bads)
    best = ranked.select("score", (KEEP_WEIGHT * lost + kept).alias("cost")).agg(F.min_by("score", F.struct("cost", "score")).alias("at")).first()["at"]
    lower = counted.where(F.col("score") < F.lit(best)).agg(F.max("score").alias("at")).first()["at"]
    return best if lower is None else (best + lower) / 2


def quality_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = RANKED_ROWS) -> DataFrame:
    """(doc_id, base measures, base_failed, score, kept) of every row of ``docs``. ``labels``: 1 is trusted.

    ``rows``: how many different scores of labelled documents are ranked at once; more are ranked in as many ranges."""
    spark = docs.sparkSession
    prepare(spark)
    every = staged(labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("label_id"))
                   .agg(F.max(F.col(label).cast("int")).alias("label")), "labels")
    known = texts(docs).join(small_or_not(every, BROADCAST_LABELS), F.col("doc_id") == F.col("label_id"), "left")
    known = known.select("doc_id", "text", "label", F.coalesce((F.col("label") == 1) & (F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0), F.lit(False)).alias("target"))
    ratio = spark.sparkContext.broadcast(log_ratio(known.mapInArrow(_counted, "bucket int, raw bigint, target bigint")))
    scored = staged(known.mapInArrow(_scored(ratio), f"doc_id bigint, {MEASURES}, score double, label int, target boolean"), "scores")
    held = scored.where("label is not null and not target").groupBy("doc_id").agg(F.min("score").alias("score"), F.max("label").alias("label"))
    at = ranked_threshold(held.select("score", (F.col("label") == 1).alias("trusted")), rows)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "score",
                         (~failed & (F.col("score") >= F.lit(at))).alias("kept"))
