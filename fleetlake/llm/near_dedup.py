"""Near-duplicate documents by SetSketch registers (operator 2).

Each document's distinct word shingles become ``REGISTERS`` registers: a register is the smallest of the
exponential values that its hash function gives the set's elements, on an exponentially spaced scale (base
``BASE``) and truncated to 16 bits. The register of a union is the larger of the two registers, and two
sets agree in a register about as often as their Jaccard similarity says. Bands of ``ROWS`` register values make
the candidate buckets; a pair's similarity is estimated by maximum likelihood from how many registers are
larger, smaller and equal, given both set sizes; what may reach the limit is verified on the full sets.

No pairs within a group are listed. Documents with equal sets are one class. In each bucket every class is
first compared with the bucket's smallest, its leader; connected components follow. The classes that share a bucket with
one leader are its cluster. Only clusters that still hold more than one component are looked at again: there, classes
outside the leader's component, the probes, are compared with all members, in blocks of some probes and some members that
stay in memory with their full sets, and a block returns verified links that join components, at most one less than it
has classes. So no link between different components is left out, however large the group, and no more rows leave a
block than entered it. With M members and P probes, M * ceil(P / BLOCK) + P * ceil(M / BLOCK) rows are sent.

A pair of similarity 0.8 shares no band with a chance of 2e-5 (0.8^6 over 36 bands), which is all that
can be missed; one at 0.85, 1e-8.

Defined results: null or empty texts and texts without words have no shingle and are linked with nothing;
texts of fewer words than a shingle are one shingle; rows without a doc_id are linked with nothing; repeated rows
are one class and each keeps its row; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import batches_of_bytes, discard, prepare, small_or_not, staged, texts
from fleetlake.llm.graph import components
from fleetlake.llm.words import shingle_sets

BANDS, ROWS = 36, 6
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65_535
MARGIN = 0.15  # five standard errors of the estimate at 0.8
BLOCK = 128  # probes and members of a block, about; with their full sets they are in memory together
BROADCAST_IDS = 1_000_000  # ids (8 bytes each) that are broadcast at most; more join by a shuffle
SKETCHES = "doc_id bigint, n_shingles bigint, digest binary, registers binary"

_RNG = np.random.default_rng(7)
_MUL = _RNG.integers(0, 1 << 32, REGISTERS, dtype="u4") | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, REGISTERS, dtype="u4")


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint16) of a set of 64-bit hashes; of no elements, zeros."""
    least = np.full(REGISTERS, 0xFFFFFFFF, "u4")
    x = (shingles ^ (shingles >> np.uint64(32))).astype("u4")
    for i in range(0, len(x), 512):
        np.minimum(least, (x[i:i + 512, None] * _MUL + _ADD).min(axis=0), out=least)
    smallest = -np.log1p(-(least.astype("f8") + 0.5) / 2.0 ** 32)  # of exponentials with rate 1
    scaled = np.floor(1 - np.log(smallest / RATE) / math.log(BASE))
    return np.clip(scaled, 0, TOP).astype("u2") if len(x) else np.zeros(REGISTERS, "u2")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def likeliest(larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs, on a grid of hundredths, from register comparisons.

    With u and v the sets' shares of ``n_a + n_b``, a register of the first is larger with probability
    p(u - v J) and smaller with p(v - u J), where p(x) = -log_b(1 - x (b - 1) / b).
    """
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 101)[None, :]

    def p(x):
        return np.maximum(-np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE), 1e-9)

    ok = (u - v * j >= -1e-12) & (v - u * j >= -1e-12)
    up, down = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
    score = larger[:, None] * np.log(up) + smaller[:, None] * np.log(down) + equal[:, None] * np.log(np.maximum(1 - up - down, 1e-9))
    return j[0][np.argmax(np.where(ok, score, -np.inf), axis=1)]


def _may_reach(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Of pairs of register rows, those whose similarity may be ``percent`` hundredths or more."""
    sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    estimate = likeliest((a > b).sum(1), (a < b).sum(1), (a == b).sum(1), n_a.astype("f8"), n_b.astype("f8"))
    return sizes & (estimate >= percent / 100 - MARGIN)


def _sketched(k: int):
    def run(batches):
        for part, _ in batches_of_bytes(batches):
            sets = shingle_sets(part.column(part.schema.get_field_index("text")), k)
            yield pa.RecordBatch.from_arrays([
                part.column(part.schema.get_field_index("doc_id")), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([registers(s).astype("<u2").tobytes() for s in sets], pa.binary())], ["doc_id", "n_shingles", "digest", "registers"])
    return run


def _with_sets(k: int):
    def run(batches):
        for part, _ in batches_of_bytes(batches):
            sets = shingle_sets(part.column(part.schema.get_field_index("text")), k)
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")),
                                              pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], ["doc_id", "shingles"])
    return run


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, width)


def _estimated(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                keep = _may_reach(_rows(c["registers_a"], REGISTERS), _rows(c["registers_b"], REGISTERS),
                                  c["n_a"].to_numpy(), c["n_b"].to_numpy(), percent)
                yield pa.RecordBatch.from_arrays([c["a"], c["b"]], ["a", "b"]).filter(pa.array(keep))
    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if _reaches(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], ["a", "b"])
    return run


def _reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _across(percent: int):
    """Verified links of a block, probes against rows, from different components; none that links already found imply."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        regs = np.frombuffer(b"".join(rows["registers"]), "<u2").reshape(-1, REGISTERS)
        sets = [np.frombuffer(x, "<u8") for x in rows["shingles"]]
        rep, comp, n, probe = (rows[c].to_numpy() for c in ("rep", "comp", "n", "probe"))
        root = {c: c for c in comp.tolist()}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        others, found = np.flatnonzero(~probe), []
        for i in np.flatnonzero(probe).tolist():
            apart = others[(comp[others] != comp[i]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))]
            equal = (regs[apart] == regs[i]).sum(1)
            apart = apart[equal >= (percent / 100 - 2 * MARGIN) * REGISTERS]  # far from any estimate that may reach
            if len(apart):
                apart = apart[_may_reach(np.broadcast_to(regs[i], (len(apart), REGISTERS)), regs[apart], np.full(len(apart), n[i]), n[apart], percent)]
            for j in apart.tolist():
                a, b = top(comp[i]), top(comp[j])
                if a != b and _reaches(sets[i], sets[j], percent):
                    root[max(a, b)] = min(a, b)
                    found.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return run


def _sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles) of the documents that the staged ``ids`` (doc_id) name; no other text becomes a set."""
    full = texts(docs).join(small_or_not(ids, BROADCAST_IDS), "doc_id", "left_semi").mapInArrow(_with_sets(k), "doc_id bigint, shingles binary")
    return staged(full.dropDuplicates(["doc_id", "shingles"]), "sets")


def _confirm(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets reach the limit."""
    pairs = staged(pairs, "pairs")
    ids = staged(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "doc_id"), "ids")
    full = _sets(docs, ids, k)
    first = full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    second = full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    links = staged(pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(_verified(percent), "a bigint, b bigint"), "links")
    discard(pairs, ids, full)
    return links


def blocked(near: DataFrame) -> DataFrame:
    """(leader, rep, comp, probe, block, part) from members (leader, rep, comp) of clusters: in clusters of several components
    every probe, a class outside the leader's component, meets every member in one (block of probes, part of members)."""
    per = near.groupBy("leader", "comp").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("rep") == F.col("leader")).alias("home"))
    split = per.groupBy("leader").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min(F.when(F.col("home"), F.col("comp"))).alias("home"),
                                      F.sum("n").alias("size"), F.sum(F.when(~F.col("home"), F.col("n"))).alias("probes")).where("low <> high")
    split = split.select(F.col("leader").alias("split_leader"), "home", F.ceil(F.col("probes") / BLOCK).alias("blocks"), F.ceil(F.col("size") / BLOCK).alias("parts"))
    rest = near.join(split, near["leader"] == split["split_leader"]).select("leader", "rep", "comp", "home", "blocks", "parts")

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("rep"), F.col(n))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    return (rest.select("leader", "rep", "comp", F.lit(False).alias("probe"), every("blocks").alias("block"), own("parts").alias("part"))
            .unionByName(rest.where("comp <> home").select("leader", "rep", "comp", F.lit(True).alias("probe"), own("blocks").alias("block"), every("parts").alias("part"))))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked if their ``k``-word shingle sets have 100 * intersection >= ``percent`` * union;
    component_id is the smallest doc_id reachable over links; kept marks that document itself.
    """
    prepare(docs.sparkSession)
    sketches = staged(texts(docs).mapInArrow(_sketched(k), SKETCHES), "sketches")
    named = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = staged(named.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "registers")).alias("r"))
                     .select("digest", F.col("r.doc_id").alias("rep"), F.col("r.n_shingles").alias("n"), F.col("r.registers").alias("registers")), "classes")
    width = 2 * ROWS
    keys = F.array(*(F.xxhash64(F.lit(b), F.substring("registers", b * width + 1, width)) for b in range(BANDS)))
    bands = classes.select("rep", F.explode(keys).alias("key"))
    buckets = staged(bands.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last").select("key", "leader"), "buckets")
    members = staged(bands.join(buckets, "key").select("leader", "rep").distinct(), "members")

    one = classes.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("registers_a"))
    two = classes.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("registers_b"))
    stars = members.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b"))
    likely = (stars.join(two, "b").join(one, "a").select("a", "b", "n_a", "n_b", "registers_a", "registers_b")
              .mapInArrow(_estimated(percent), "a bigint, b bigint"))
    links = _confirm(docs, likely, k, percent)
    label = components(links)

    # a leader's cluster: every class that shares a bucket with it, once, with its component
    near = staged(members.join(label, members["rep"] == label["node"], "left").select("leader", "rep", F.coalesce("label", "rep").alias("comp")), "clusters")
    discard(members, buckets, label)
    rest = staged(blocked(near), "blocks")
    ids = staged(rest.select(F.col("rep").alias("doc_id")).distinct(), "ids")
    full = _sets(docs, ids, k)
    sent = (rest.join(classes.select("rep", "n", "registers"), "rep").join(full, F.col("rep") == full["doc_id"])
            .select("leader", "block", "part", "rep", "comp", "probe", "n", "registers", "shingles"))
    more = staged(sent.groupBy("leader", "block", "part").applyInPandas(_across(percent), "a bigint, b bigint").distinct(), "links")
    label = components(links.union(more))
    discard(near, rest, ids, full, links, more)

    found = (sketches.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left")
             .join(label, F.col("rep") == F.col("node"), "left"))
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("label", "rep")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
