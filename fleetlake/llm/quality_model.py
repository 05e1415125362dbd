"""Quality classifier with hierarchical empirical Bayes (operator 6).

A logistic model of a document's shape (symbols, case, repetition, word lengths) gives its own evidence. Documents
are grouped by host and by path below it; by grouped sums, each host's share of good documents is
shrunk towards the corpus's and each path's towards its host's, by as much as the spread between sites says (method
of moments), so a site with few documents says little. A document's verdict adds its own evidence and
what its path's posterior, without the document itself, says beyond the corpus.

``documents`` has no address: a source of the form host/path is split at its first slash (host/a/b and
host/a/c are two paths), and where it has no path the language stands for it.

Defined results: null or empty texts are scored like any other (no words); a null source or language is a site of
its own; repeated rows are scored each; without labels of both kinds every document is kept with probability 1/2; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import batches_of_bytes, prepare, staged
from fleetlake.llm.labelled import LABELLED_ROWS, labelled_sample
from fleetlake.llm.words import SPACES, hashed_words, mapped, runs

FEATURES = ("log_words", "symbols", "upper", "digits", "stops", "word_length", "distinct", "distinct_pairs", "dup_lines", "same_as_last", "top_word", "marked")
RIDGE = 1e-3
SITE_WEIGHT = 0.5  # weight of the site's log odds beside the document's own
CLIP = 1e-4

_IS = {"symbols": b"#*$%&|<>{}[]=~^_\\@", "digits": b"0123456789", "stops": b".,;:?!", "upper": bytes(range(65, 91))}
_TABLE = {k: np.isin(np.arange(256), list(v)) for k, v in _IS.items()}


def features(text: pa.Array, raw: list[bytes]) -> np.ndarray:
    """One row of FEATURES per text; shares are of words or visible bytes."""
    words, starts = hashed_words(text, lower=False)
    n = np.diff(starts)
    plain = mapped(text, SPACES)
    ends = np.frombuffer(plain.buffers()[1], "<i8", len(plain) + 1)
    data = np.frombuffer(plain.buffers()[2] or b"", "u1")

    def per_text(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks)])
        return (sums[ends[1:]] - sums[ends[:-1]]).astype("f8")

    visible = np.maximum(per_text(data != 32), 1)
    out = np.zeros((len(raw), len(FEATURES)))
    out[:, 0] = np.log1p(n)
    for i, name in ((1, "symbols"), (2, "upper"), (3, "digits"), (4, "stops")):
        out[:, i] = per_text(_TABLE[name][data]) / visible
    out[:, 5] = visible / np.maximum(n, 1) / 10
    pairs = runs(words, 2)
    # words whose last byte is a symbol or an exclamation mark
    last = (data != 32) & np.append(data[1:] == 32, True) & (_TABLE["symbols"][data] | (data == 33)) if len(data) else np.zeros(0, bool)
    out[:, 11] = per_text(last) / np.maximum(n, 1)
    for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        w = words[a:b]
        if b > a:
            values, counts = np.unique(w, return_counts=True)
            # over long texts words recur by themselves: against what a vocabulary that grows as a root allows
            out[i, 6] = min(1.0, len(values) / min(b - a, 2 * (b - a) ** 0.8 + 1))
            out[i, 10] = counts.max() / (b - a)
            if b - a > 1:
                out[i, 7] = len(np.unique(pairs[a:b - 1])) / (b - a - 1)
                out[i, 9] = np.count_nonzero(w[1:] == w[:-1]) / (b - a - 1)
        lines = [x for x in raw[i].split(b"\n") if x.strip()]
        out[i, 8] = (len(lines) - len(set(lines))) / max(len(lines), 1)
    return out


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with the constant first, means, scales) of a ridge logistic model, by Newton's method."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.column_stack([np.ones(len(x)), np.clip((x - mean) / scale, -8, 8)])
    w, penalty = np.zeros(z.shape[1]), RIDGE * len(x) * np.r_[0, np.ones(x.shape[1])]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (y - p) - penalty * w
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty + 1e-9), grad)
        w += step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def probability(model: tuple | None, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    w, mean, scale = model
    return 1 / (1 + np.exp(-np.clip(w[0] + np.clip((x - mean) / scale, -8, 8) @ w[1:], -30, 30)))


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, raw in batches_of_bytes(batches):
        x = features(_column(part, "text"), raw)
        yield pa.RecordBatch.from_arrays([_column(part, "label"), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in batches_of_bytes(batches):
            p = probability(model, features(_column(part, "text"), raw))
            keep = [i for i, name in enumerate(part.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), pa.array(p)], [*(part.schema.names[i] for i in keep), "doc_prob"])
    return run


def document_model(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = LABELLED_ROWS) -> tuple | None:
    """Logistic model fitted on at most ``rows`` labelled documents; None unless both labels occur."""
    sample = labelled_sample(labels, label, rows=rows)
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    got = known.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("label", "text").mapInArrow(_featured, "label int, x array<double>").toArrow()
    y = got["label"].to_numpy()
    if not len(y) or y.min() == y.max():
        return None
    return fit(np.array(got["x"].to_pylist()), (y == 1).astype("f8"))


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, n, total, strength, host_mean) per path, and the corpus mean; ``scored`` has host, path, doc_prob.

    With m sites of n documents, spread b of their means and variance v within, the prior is worth
    v / max(b - m v / N, small) documents.
    """
    paths = staged(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_prob").alias("total"), F.sum(F.col("doc_prob") ** 2).alias("squares")), "paths")
    all_ = paths.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares")).first()
    if not all_["n"]:
        return paths.select("host", "path", "n", "total", F.lit(1.0).alias("strength"), F.lit(0.5).alias("host_mean")), 0.5
    mean = all_["total"] / all_["n"]
    within = max(all_["squares"] / all_["n"] - mean * mean, 1e-9)

    def strength(sites: int, between: float) -> float:
        return within / max(between - sites * within / all_["n"], within * 1e-4)

    hosts = staged(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "hosts")
    h = hosts.agg(F.count(F.lit(1)).alias("sites"), F.sum(F.col("n") * (F.col("total") / F.col("n") - mean) ** 2).alias("spread")).first()
    host_strength = strength(h["sites"], h["spread"] / all_["n"])
    shrunk = hosts.select(F.col("host").alias("h"), ((F.col("total") + host_strength * mean) / (F.col("n") + host_strength)).alias("host_mean"))
    joined = staged(paths.join(shrunk, F.col("host").eqNullSafe(F.col("h"))).select("host", "path", "n", "total", "host_mean"), "path-hosts")
    p = joined.agg(F.count(F.lit(1)).alias("sites"), F.sum(F.col("n") * (F.col("total") / F.col("n") - F.col("host_mean")) ** 2).alias("spread")).first()
    return joined.withColumn("strength", F.lit(strength(p["sites"], p["spread"] / all_["n"]))), mean


def _log_odds(p):
    p = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
    return F.log(p / (1 - p))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = LABELLED_ROWS) -> DataFrame:
    """``docs`` as (doc_id, doc_prob, host_mean, path_mean, score, kept), one row each. ``labels``: 1 is good.

    The site sums are map-side aggregates, so a host with a third of all documents is reduced in each task; they join
    back to narrow rows from written tables, where AQE splits such a host.
    """
    scored = scored_documents(docs, labels, label, rows)
    return scored.select("doc_id", "doc_prob", "host_mean", "path_mean", "score", "kept")


def scored_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = LABELLED_ROWS, also: dict | None = None) -> DataFrame:
    """As quality_scores, with the columns of ``also`` (name -> column of ``docs``, not text) carried along."""
    prepare(docs.sparkSession)
    model = document_model(docs, labels, label, rows)
    source = F.col("source").cast("string")
    path = F.when(F.instr(source, "/") > 0, F.substr(source, F.instr(source, "/") + F.lit(1))).otherwise(F.col("lang").cast("string"))
    rows_ = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.substring_index(source, "/", 1).alias("host"), path.alias("path"), *(c.alias(k) for k, c in (also or {}).items()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows_.schema if f.name != "text") + ", doc_prob double"
    scored = staged(rows_.mapInArrow(_scored(model), schema), "doc-probs")
    sites, mean = site_posteriors(scored)
    site = sites.select(F.col("host").alias("h"), F.col("path").alias("p"), "n", "total", "strength", "host_mean")
    joined = scored.join(site, scored["host"].eqNullSafe(F.col("h")) & scored["path"].eqNullSafe(F.col("p")))
    others = (F.col("total") - F.col("doc_prob") + F.col("strength") * F.col("host_mean")) / (F.col("n") - 1 + F.col("strength"))
    odds = _log_odds(F.col("doc_prob")) + SITE_WEIGHT * (_log_odds(F.col("path_mean")) - _log_odds(F.lit(mean)))
    return (joined.withColumn("path_mean", others).withColumn("score", 1 / (1 + F.exp(-odds)))
            .select(*scored.columns, "host_mean", "path_mean", "score", (F.col("score") >= 0.5).alias("kept")))
