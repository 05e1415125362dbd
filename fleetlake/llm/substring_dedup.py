"""Repeated passages by collinear chaining (operator 4).

Words are lower-cased runs of non-space bytes. Of every ``WINDOW`` adjacent ``K``-word seeds of a document the one with
the smallest hash is kept, so two equal runs of ``K + WINDOW - 1`` words share a seed. Each seed's first place (smallest doc_id,
then position) gives its source; every other document's places of the seed are matched with that source's places alone,
so matches grow with the words and not with the square of a group. Where neighbouring seeds of a document have different
sources, the two together are a seam: its first holder is tried as well, as it may hold both parts at once. The matches of a document with one source document
are chained, and the windows around them matched again on every seed, whoever owns it: the best score ending in a match is that of the best chain before it in both texts, less a cost
for the words skipped, found by a Fenwick tree over the source positions. Chains are cut at gaps over
``MAX_GAP`` words, extended while the texts agree, and aligned (longest common subsequence). A passage of at
least ``MIN_WORDS`` words that agrees in at least ``AGREE`` percent is reported, and may be cut out of the later document;
a segment that agrees less gives its longest stretches that are passages. A text of a few words over and over has hundreds of
short segments with its source, most of which give nothing: after the first that fail, the others are judged together, by the same
alignment over tables of their windows, and those that may hold a passage are aligned one by one as before.

Places move as narrow rows, with a map-side minimum per seed; the join that brings a seed's source back has written
tables on both sides, so AQE splits a seed that a third of all documents share. Chaining streams over documents in
order, alignment over rows; neither holds more than one document's matches.

Defined results: null or empty texts and texts of fewer words than a seed hold no passage; rows with a null doc_id take
no part; rows with equal ids are one document; a passage that recurs within one document only is not reported; an
empty table gives an empty result; other columns are ignored, whatever their names (cut_passages keeps them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import batches_of_bytes, discard, free_name, prepare, small_or_not, staged, texts
from fleetlake.llm.words import hashed_words, runs

K, WINDOW = 6, 11
MAX_GAP = 60
GAP_COST = 0.01  # of a skipped word, where a match counts 1
MARGIN = 64  # words beyond a chain's ends that its extension may reach
DROP = 6  # an extension ends where it has lost this much (a word that agrees gains 1, another loses 2)
MIN_WORDS, AGREE = 50, 80
TURNS = 32  # places of one run in a source that are all matched
AT_ONCE, FEW = 256, 3  # segments tried together; fewer are tried one by one
BROADCAST_IDS = 1_000_000
PAIRS = "doc_id bigint, source bigint, d0 array<int>, d1 array<int>, s0 array<int>, s1 array<int>, seam bigint"
SPANS = "doc_id bigint, dup_of bigint, start_word bigint, n_words bigint, source_start bigint, source_words bigint, equal_words bigint"


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def minimisers(seeds: np.ndarray, starts: np.ndarray, n: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the smallest seed of every window (the first of equal ones) of the texts that have ``n`` seeds from ``starts``
    on; of a text with less seeds than a window, of them all."""
    at, least, width = np.arange(len(seeds), dtype="i4"), seeds, 1
    while width < min(window, len(seeds)):  # the smallest of each ``width`` seeds
        step = min(width, window - width, len(seeds) - width)
        later = least[step:] < least[:-step]
        at, least = np.where(later, at[step:], at[:-step]), np.where(later, least[step:], least[:-step])
        width += step
    windows = np.maximum(n - window + 1, 0)
    found = at[np.repeat(starts - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())]
    found = found[np.concatenate([[True], found[1:] != found[:-1]])[:len(found)]]  # the windows' positions never fall
    short = [a + int(np.argmin(seeds[a:a + m])) for a, m in zip(starts.tolist(), n.tolist(), strict=True) if 0 < m < window]
    return np.sort(np.concatenate([found, short]).astype("i8"))


def _seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, _ in batches_of_bytes(batches):
        words, starts = hashed_words(_column(part, "text"))
        every, ids = runs(words, K), _column(part, "doc_id").to_numpy()
        at = minimisers(every, starts[:-1], np.maximum(np.diff(starts) - K + 1, 0))
        if len(at):
            text = np.searchsorted(starts, at, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(every[at].view("i8")), pa.array(ids[text].astype("i8")), pa.array((at - starts[text]).astype("i4"))],
                                             ["seed", "doc_id", "pos"])


def chains(pos: np.ndarray, source: np.ndarray) -> list[list[int]]:
    """Matches (increasing ``pos``) as chains that increase in both texts; each match in one chain, best chains first."""
    n = len(pos)
    if n == 1:
        return [[0]]
    rising = bool(np.all(pos[1:] > pos[:-1]) and np.all(source[1:] > source[:-1]))
    if rising and GAP_COST * int(np.diff(pos + source).max()) < 0.999:  # each match adds to the score of all before it
        return [list(range(n))]
    along = (GAP_COST * (pos + source)).tolist()
    score, before = [0.0] * n, [-1] * n
    last = 0.0  # score and place of the match before: where both texts rise, no other is better
    for i in range(n if rising else 0):
        best = last - along[i] if i else 0.0
        if best > 0:
            before[i] = i - 1
        score[i] = 1 + max(best, 0.0)
        last = score[i] + along[i]
    if not rising:
        _, rank = np.unique(source, return_inverse=True)
        size = int(rank.max()) + 1
        rank = (rank + 1).tolist()
        far, by = [0.0] * (size + 1), [-1] * (size + 1)  # Fenwick tree of prefix maxima: score and place, match
        for i in range(n):
            here, best, j = along[i], 0.0, rank[i] - 1
            while j > 0:
                if by[j] >= 0 and far[j] - here > best:
                    best, before[i] = far[j] - here, by[j]
                j -= j & -j
            score[i] = 1 + best
            place, j = score[i] + here, rank[i]
            while j <= size:
                if by[j] < 0 or place > far[j]:
                    far[j], by[j] = place, i
                j += j & -j
    used, out = [False] * n, []
    for i in np.argsort(-np.array(score), kind="stable").tolist():
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def segments(pos: np.ndarray, source: np.ndarray) -> list[list[int]]:
    """The matches of every chain, cut at gaps over MAX_GAP words."""
    out, p, s = [], pos.tolist(), source.tolist()
    for chain in chains(pos, source):
        start = 0
        for k in range(1, len(chain)):
            i, j = chain[k - 1], chain[k]
            if p[j] - p[i] > MAX_GAP or s[j] - s[i] > MAX_GAP:
                out.append(chain[start:k])
                start = k
        out.append(chain[start:])
    return out


def seams(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of matches (doc_id, source, pos, source_pos, half a seed) the neighbours in a document whose sources differ: the rows
    of the one before and the one behind, and both halves."""
    by = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    a, b = by[:-1], by[1:]
    at = np.flatnonzero((a[:, 0] == b[:, 0]) & (a[:, 1] != b[:, 1]) & (b[:, 2] - a[:, 2] <= MAX_GAP))
    a, b = a[at], b[at]
    return a, b, (a[:, 4] << 32) | (b[:, 4] & 0xFFFFFFFF)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches in order of (doc_id, source, pos) to PAIRS; the last document of a batch waits for the next one."""
    hold: list[np.ndarray] = []
    fields = pa.schema([("doc_id", pa.int64()), ("source", pa.int64()), *((c, pa.list_(pa.int32())) for c in ("d0", "d1", "s0", "s1")), ("seam", pa.int64())])

    def emit(rows: np.ndarray) -> pa.RecordBatch:
        edges = np.flatnonzero(np.any(rows[1:, :2] != rows[:-1, :2], axis=1)) + 1
        out = []
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(rows)], strict=True):
            p, s = rows[a:b, 2], rows[a:b, 3]
            d0, d1, s0, s1 = zip(*((int(p[x[0]]), int(p[x[-1]]) + K, int(s[x[0]]), int(s[x[-1]]) + K) for x in segments(p, s)), strict=True)
            out.append({"doc_id": int(rows[a, 0]), "source": int(rows[a, 1]), "d0": d0, "d1": d1, "s0": s0, "s1": s1})
        for a, b, seam in zip(*(x.tolist() for x in seams(rows)), strict=True):
            out.append({"doc_id": a[0], "d0": [a[2]], "d1": [b[2] + K], "seam": seam})
        return pa.RecordBatch.from_pylist(out, fields)

    for batch in batches:
        rows = np.column_stack([batch.column(i).to_numpy().astype("i8") for i in range(5)])
        if not len(rows):
            continue
        cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
        if hold and (cut or hold[-1][-1, 0] != rows[-1, 0]) or cut:
            yield emit(np.concatenate([*hold, rows[:cut]]))
            hold = []
        hold.append(rows[cut:])
    if hold:
        yield emit(np.concatenate(hold))


def _word_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, _ in batches_of_bytes(batches):
        words, starts = hashed_words(_column(part, "text"))
        short = (words >> np.uint64(32)).astype("<u4")
        yield pa.RecordBatch.from_arrays([_column(part, "doc_id"), pa.array([short[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary())], ["doc_id", "words"])


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel rows over ``b``."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    ahead = int(differ[0]) if len(differ) else n
    differ = np.flatnonzero(a[len(a) - n + ahead:][::-1] != b[len(b) - n + ahead:][::-1])
    behind = int(differ[0]) if len(differ) else n - ahead
    a, b = a[ahead:len(a) - behind], b[ahead:len(b) - behind]  # words alike at the ends align
    if not (len(a) and len(b)):
        return ahead + behind
    places: dict[int, int] = {}
    for i, w in enumerate(b.tolist()):
        places[w] = places.get(w, 0) | (1 << i)
    row, full = (1 << len(b)) - 1, (1 << len(b)) - 1
    for w in a.tolist():
        here = places.get(w)
        if here:
            kept = row & here
            row = ((row + kept) | (row - kept)) & full
    return ahead + behind + len(b) - row.bit_count()


def _reach(d: np.ndarray, s: np.ndarray) -> int:
    """Words that an extension takes along both texts before it loses more than DROP, up to its best."""
    n, step = min(len(d), len(s)), 32
    while n:
        gain = np.cumsum(3 * (d[:min(step, n)] == s[:min(step, n)]) - 2)
        lost = np.flatnonzero(np.maximum.accumulate(np.maximum(gain, 0)) - gain > DROP)
        if len(lost) or step >= n:
            gain = gain[:lost[0]] if len(lost) else gain
            return int(np.argmax(gain)) + 1 if len(gain) and gain.max() > 0 else 0
        step *= 4
    return 0


def aligned(d: np.ndarray, s: np.ndarray, d0: int, d1: int, s0: int, s1: int) -> tuple[int, int, int, int, int]:
    """The segment extended on both sides, and how many of its words align."""
    back = _reach(d[:d0][::-1], s[:s0][::-1])
    ahead = _reach(d[d1:], s[s1:])
    d0, d1, s0, s1 = d0 - back, d1 + ahead, s0 - back, s1 + ahead
    return d0, d1, s0, s1, common_words(d[d0:d1], s[s0:s1]) if d1 - d0 >= MIN_WORDS else 0


def matches(d: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal runs of K words in both texts, in order of the first: of every diagonal run of them each K-th and the last.

    A run of words that the source holds over TURNS times is matched with its first place and with that of the same turn.
    """
    x, y = runs(d.astype("u8"), K), runs(s.astype("u8"), K)
    order = np.argsort(y, kind="stable")
    left, right = (np.searchsorted(y[order], x, side) for side in ("left", "right"))
    n = right - left
    few = np.where(n <= TURNS, n, 0)
    p = np.repeat(np.arange(len(x)), few)
    at = np.repeat(left - np.cumsum(few) + few, few) + np.arange(len(p))
    often = np.flatnonzero(n > TURNS)
    if len(often):
        by = often[np.argsort(x[often], kind="stable")]
        turn = np.arange(len(by)) - np.searchsorted(x[by], x[by], "left")
        p, at = np.concatenate([p, by, by]), np.concatenate([at, left[by], left[by] + np.minimum(turn, n[by] - 1)])
    q = order[at] if len(at) else at
    by = np.lexsort((p, p - q))
    p, q = p[by], q[by]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(p - q) != 0) | (np.diff(p) > 1)])) if len(p) else np.zeros(0, "i8")
    lengths = np.diff(np.concatenate([starts, [len(p)]]))
    turn = np.arange(len(p)) - np.repeat(starts, lengths)
    kept = (turn % K == 0) | (turn == np.repeat(lengths, lengths) - 1)
    p, q = p[kept], q[kept]
    by = np.lexsort((-q, p))  # of one place the later source first: a chain takes a place once
    return p[by], q[by]


def common_pairs(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A longest common subsequence as pairs of places."""
    if not (len(a) and len(b)):
        return []
    if len(a) == len(b) and np.array_equal(a, b):
        return [(i, i) for i in range(len(a))]
    places: dict[int, int] = {}
    for i, w in enumerate(b.tolist()):
        places[w] = places.get(w, 0) | (1 << i)
    row, full = (1 << len(b)) - 1, (1 << len(b)) - 1
    at, rows = [], [row]  # words of a that b holds, and the row before each of them
    for i, w in enumerate(a.tolist()):
        here = places.get(w)
        if here:
            kept = row & here
            row = ((row + kept) | (row - kept)) & full
            at.append(i)
            rows.append(row)
    out, i, j = [], len(at), len(b)
    while i:
        j = (~rows[i] & ((1 << j) - 1)).bit_length()  # the last place that adds a word
        if not j:
            break
        i -= 1
        while not rows[i] >> (j - 1) & 1:
            i -= 1
        j -= 1
        out.append((at[i], j))
    return out[::-1]


def paired(d: np.ndarray, s: np.ndarray, p: list[int], q: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the words that align along a chain and MARGIN words beyond it, and whether a seed holds them."""
    n, k = min(p[0], MARGIN), min(q[0], MARGIN)
    out = [(p[0] - n + i, q[0] - k + j, False) for i, j in common_pairs(d[p[0] - n:p[0]], s[q[0] - k:q[0]])]
    a, b = p[0], q[0]  # the first words that are not aligned yet
    for x, y in zip(p, q, strict=True):
        taken = max(a - x, b - y, 0)
        if taken < K:
            out += [(a + i, b + j, False) for i, j in common_pairs(d[a:x + taken], s[b:y + taken])]
            out += [(x + i, y + i, True) for i in range(taken, K)]
            a, b = x + K, y + K
    out += [(a + i, b + j, False) for i, j in common_pairs(d[a:a + MARGIN], s[b:b + MARGIN])]
    return tuple(np.array(c) for c in zip(*out, strict=True))


def longest(i: np.ndarray, j: np.ndarray) -> tuple[int, int] | None:
    """The longest stretch of aligned words, first and last, that is a passage by MIN_WORDS and AGREE."""
    k = np.arange(len(i))
    f, g = 100 * k - AGREE * i, 100 * k - AGREE * j
    far = np.full(len(i), len(i))
    for x in (f, g):
        rest = np.maximum.accumulate(x[::-1])[::-1]
        far = np.minimum(far, np.searchsorted(-rest, 100 - AGREE - x, "right") - 1)
    best, found = MIN_WORDS - 1, None
    for a in np.argsort(i - i[far], kind="stable").tolist():
        if i[far[a]] - i[a] + 1 <= best:
            break
        here = slice(a, far[a] + 1)
        b = a + int(np.flatnonzero((f[here] >= f[a] + AGREE - 100) & (g[here] >= g[a] + AGREE - 100))[-1])
        if i[b] - i[a] + 1 > best:
            best, found = i[b] - i[a] + 1, (a, b)
    return found


def stretches(i: np.ndarray, j: np.ndarray, seed: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, end, source start, end) of the passages among aligned words, longest first. Where no seed lies, their
    ends lose what does not agree (a word that agrees gains 1, another loses 2)."""
    out, work = [], [(0, len(i))]
    while work:
        low, high = work.pop()
        best = longest(i[low:high], j[low:high]) if 100 * (high - low) >= AGREE * MIN_WORDS else None
        if best is None:
            continue
        a, b = best[0] + low, best[1] + low
        held = np.flatnonzero(seed[a:b + 1])
        score = np.cumsum(1 - 2 * np.concatenate([[0], np.maximum(np.diff(i[a:b + 1]), np.diff(j[a:b + 1])) - 1]))
        if len(held):
            x, y = a + int(np.argmin(score[:held[0] + 1])), a + int(held[-1]) + int(np.argmax(score[held[-1]:]))
            if i[y] - i[x] + 1 >= MIN_WORDS and (y - x + 1) * 100 >= AGREE * (max(i[y] - i[x], j[y] - j[x]) + 1):
                a, b = x, y
        out.append((int(i[a]), int(i[b]) + 1, int(j[a]), int(j[b]) + 1))
        work += [(low, a), (b + 1, high)]
    return out


def may_hold(d: np.ndarray, s: np.ndarray) -> bool:
    """Whether a passage fits into two windows: no alignment of them has more words than their longest common subsequence."""
    return common_words(d, s) * 100 >= AGREE * MIN_WORDS


def _dense(hit: np.ndarray, percent: int, less: int) -> np.ndarray:
    """The places that lie in a stretch of MIN_WORDS words or more that has hits at ``percent`` of its places, but for ``less`` hits."""
    n = len(hit)
    hits = int(np.count_nonzero(hit)) + less
    if 100 * hits < percent * MIN_WORDS or hits - less == n >= MIN_WORDS:
        return np.full(n, 100 * hits >= percent * MIN_WORDS)
    total = np.concatenate([[0], np.cumsum(100 * hit - percent)])
    rest = np.maximum.accumulate(total[::-1])[::-1]
    far = np.searchsorted(-rest, 100 * less - total, "right") - 1  # the last end that a stretch from here may have
    start = np.flatnonzero(far - np.arange(n + 1) >= MIN_WORDS)
    edge = np.zeros(n + 1, "i8")
    np.add.at(edge, start, 1)
    np.add.at(edge, far[start], -1)
    return np.cumsum(edge)[:n] > 0


def _occurs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether each entry of ``x`` is one of ``y``."""
    y = np.sort(y)
    return y.take(y.searchsorted(x), mode="clip") == x


def where_passages_fit(d: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The places of ``d`` that a passage shared with ``s`` can hold.

    AGREE percent of its words occur in ``s``. Of its m aligned words in n, those next to each other in both texts are m - 1
    less the words that do not align, in either: 2 (n - m) at most, so m - 1 - 2 (n - m) >= (3 AGREE - 200) n / 100 - 1 word pairs
    occur in ``s`` too.
    """
    if min(len(d), len(s)) < MIN_WORDS * AGREE // 100:
        return np.zeros(len(d), bool)
    pairs = np.zeros(len(d), bool)
    pairs[:-1] = _occurs(*((x[:-1].astype("u8") << np.uint64(32)) | x[1:] for x in (d, s)))
    fits = _dense(pairs, 3 * AGREE - 200, 1)
    return fits & _dense(_occurs(d, s), AGREE, 0) if fits.any() else fits


def _common_rows(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``common_words`` of row after row of two tables (at most 64 in a row) of words 0 to n - 1, others being in one of the
    tables alone: the places of ``a`` whose words align in any row, and the bit-parallel row before each of them and behind."""
    if n <= 64:
        bits = np.zeros((len(b), n + 1), "u8")
        for w in range(n):
            bits[:, w] = np.packbits(np.pad(b == w, ((0, 0), (0, 64 - b.shape[1]))), axis=1, bitorder="little").view("<u8")[:, 0]
        here = np.take_along_axis(bits, np.where((a >= 0) & (a < n), a, n), 1)
    else:
        same = np.zeros((len(a), a.shape[1], 64), bool)
        np.equal(a[:, :, None], b[:, None, :], out=same[:, :, :b.shape[1]])
        here = np.packbits(same, axis=2, bitorder="little").view("<u8")[:, :, 0]
    at = np.flatnonzero(here.any(axis=0))
    rows = np.full((len(at) + 1, len(a)), ~np.uint64(0))
    for k, i in enumerate(at.tolist()):
        kept = rows[k] & here[:, i]
        rows[k + 1] = (rows[k] + kept) | (rows[k] - kept)
    return at, rows


def _traced(at: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``common_pairs`` by the result of ``_common_rows``: whether a place aligns, in either table."""
    one, below = np.uint64(1), np.full(rows.shape[1], ~np.uint64(0))
    own, other = np.zeros((width, rows.shape[1]), bool), np.zeros(rows.shape[1], "u8")
    for k in range(len(at) - 1, -1, -1):
        left = ~rows[k + 1] & below
        left &= ~(left >> one)  # the highest bit stays the highest, and none beside it rounds it up
        bit = np.frexp(left.astype("f8"))[1]
        top = (bit > 0) * (one << (np.maximum(bit, 1) - 1).astype("u8"))
        adds = rows[k] & top
        own[at[k]] = adds > 0
        other |= adds
        below = np.where(adds > 0, top - one, top | (top - (top > 0)))
    return own.T, np.unpackbits(other.astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")[:, :width].astype(bool)


def _holds(before: np.ndarray, n: np.ndarray, after: np.ndarray, least: int) -> np.ndarray:
    """Whether AGREE percent of a stretch of ``least`` places or more align, its ends too, where ``n`` that do lie between the two tables."""
    turn = np.arange(2 * MARGIN + int(n.max()))[None, :]
    behind = np.clip(turn - MARGIN - n[:, None], 0, MARGIN - 1)
    hit = np.where(turn < MARGIN, before[:, np.minimum(turn[0], MARGIN - 1)],
                   np.where(turn < MARGIN + n[:, None], True, np.take_along_axis(after, behind, 1) & (turn < 2 * MARGIN + n[:, None])))
    total = np.cumsum(100 * hit - AGREE, axis=1)
    rest = np.maximum.accumulate(np.where(hit, total, np.iinfo("i8").min)[:, ::-1], axis=1)[:, ::-1]  # the best end from here on
    return (hit[:, :1 - least] & (rest[:, least - 1:] >= total[:, :1 - least] - (100 - AGREE))).any(axis=1)


def without_passage(d: np.ndarray, s: np.ndarray, d0: np.ndarray, s0: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether the segments of ``n`` equal words from ``d0`` and ``s0`` on, all tried at once, give no passage: as a whole they stay
    below MIN_WORDS, and the alignment around them has no stretch of enough words that agree (``stretches`` would find none)."""
    turn = np.arange(MARGIN)
    both, codes = np.unique(np.concatenate([d, s]), return_inverse=True)
    own, other = (np.bincount(x, minlength=len(both)) > 0 for x in (codes[:len(d)], codes[len(d):]))
    common = np.flatnonzero(own & other)
    rank = np.where(own, len(common), len(common) + 1)  # a word of one text alone equals none of the other
    rank[common] = np.arange(len(common))
    outside = [np.full(MARGIN, x) for x in (-1, -2)]
    d, s = (np.concatenate([x, rank[text], x]) for x, text in zip(outside, (codes[:len(d)], codes[len(d):]), strict=True))
    back, ahead = ([d[a[:, None] + turn], s[b[:, None] + turn]] for a, b in ((d0, s0), (d0 + n + MARGIN, s0 + n + MARGIN)))
    total, open_end = n.copy(), np.zeros(len(n), bool)
    for x, y in (ahead, [z[:, ::-1] for z in back]):  # as _reach does; of one that goes on beyond MARGIN nothing is said
        gain = np.cumsum(np.where((x >= 0) & (y >= 0), 3 * (x == y) - 2, -2 * DROP), axis=1)  # where a text ends an extension is lost
        lost = np.maximum.accumulate(np.maximum(gain, 0), axis=1) - gain > DROP
        open_end |= ~lost[:, -1] & ~lost.any(axis=1)
        gain[np.maximum.accumulate(lost, axis=1)] = 0
        total += np.where(gain.max(axis=1) > 0, gain.argmax(axis=1) + 1, 0)
    none = ~open_end & (total < MIN_WORDS)
    short, least = np.flatnonzero(none), MIN_WORDS * AGREE // 100
    sides = [_common_rows(x[short], y[short], len(common)) for x, y in (back, ahead)]
    enough = n[short] + sum(np.bitwise_count(~rows[-1]).astype("i8") for _, rows in sides) >= least
    if enough.any():
        (x, u), (y, v) = (_traced(at, rows[:, enough], MARGIN) for at, rows in sides)
        rest = short[enough]
        none[rest] = ~(_holds(x, n[rest], y, MIN_WORDS) & _holds(u, n[rest], v, least))
    return none


def _judged(d: np.ndarray, s: np.ndarray, p: np.ndarray, q: np.ndarray, order: list[list[int]], turns: range, found: list[tuple]) -> dict[int, bool]:
    """``without_passage`` of those of the segments ``turns`` that are equal words alone, as their matches lie side by side."""
    pl, ql = p.tolist(), q.tolist()
    rows = []
    for k in turns:
        chain = order[k]
        d0, n = pl[chain[0]], pl[chain[-1]] + K - pl[chain[0]]
        if n < MIN_WORDS and all(pl[y] - pl[x] == ql[y] - ql[x] <= K for x, y in zip(chain, chain[1:], strict=False)) and not any(a <= d0 and d0 + n <= b for a, b, *_ in found):
            rows.append((k, d0, ql[chain[0]], n))
    if len(rows) < FEW:
        return {}
    k, d0, s0, n = np.array(rows).T
    return dict(zip(k.tolist(), without_passage(d, s, d0, s0, n).tolist(), strict=True))


def passages(d: np.ndarray, s: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(start, words, source start, source words, equal words) of the passages that two texts share.

    Longest segments first; one that lies within a passage already found adds nothing and is passed over (a text that
    repeats itself matches its source at every turn). A segment that does not agree as a whole gives the stretches of it that
    do. Passages that overlap are one, with the alignment of the longest.
    """
    if len(d) == len(s) >= MIN_WORDS and np.array_equal(d, s):
        return [(0, len(d), 0, len(d), len(d))]
    fits = []
    for own, other in ((d, s), (s, d)):
        place = where_passages_fit(own, other)
        if not place.any():
            return []
        fits.append(np.concatenate([[0], np.cumsum(place)]))
    p, q = matches(d, s)
    found: list[tuple[int, int, int, int, int]] = []
    tried: dict[tuple[int, int, int, int], bool] = {}  # short segments of one place lie in the same windows
    order = sorted(segments(p, q), key=lambda x: (p[x[0]] - p[x[-1]], p[x[0]], q[x[0]])) if len(p) else []
    none: dict[int, bool] = {}
    failed = judged = 0  # where some fail, as in a text of a few words over and over, those to come are judged together
    for k, chain in enumerate(order):
        d0, d1, s0, s1 = int(p[chain[0]]), int(p[chain[-1]]) + K, int(q[chain[0]]), int(q[chain[-1]]) + K
        if any(a <= d0 and d1 <= b for a, b, *_ in found):
            continue
        around = max(d0 - MARGIN, 0), min(d1 + MARGIN, len(d)), max(s0 - MARGIN, 0), min(s1 + MARGIN, len(s))
        if fits[0][around[0]] == fits[0][around[1]] or fits[1][around[2]] == fits[1][around[3]]:
            continue
        if failed >= FEW and k >= judged:
            judged = k + AT_ONCE
            none = _judged(d, s, p, q, order, range(k, min(judged, len(order))), found)
        if none.get(k):
            continue
        a, b, x, y, same = aligned(d, s, d0, d1, s0, s1)
        if b - a >= MIN_WORDS and same * 100 >= AGREE * max(b - a, y - x):
            found.append((a, b, x, y, same))
            continue
        failed += 1
        if around not in tried:
            tried[around] = d1 - d0 >= 2 * MIN_WORDS or may_hold(d[around[0]:around[1]], s[around[2]:around[3]])
        if tried[around]:
            found += [(*z, common_words(d[z[0]:z[1]], s[z[2]:z[3]])) for z in stretches(*paired(d, s, p[chain].tolist(), q[chain].tolist()))]
    out: list[list] = []
    for a, b, x, y, same in sorted(found):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
            out[-1][2] = max(out[-1][2], (b - a, x, y, same))
        else:
            out.append([a, b, (b - a, x, y, same)])
    return [(a, b - a, x, y - x, same) for a, b, (_, x, y, same) in out]


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SPANS.split(", ")]
    for batch in batches:
        out, known = [], {}  # copies of a document bring the same two windows: they are aligned once
        for r in batch.to_pylist():
            windows, by, sy = (r["dw"], r["sw"]), r["d_from"], r["s_from"]
            if windows not in known:
                known[windows] = passages(*(np.frombuffer(w, "<u4") for w in windows))
            out += [(r["doc_id"], r["source"], a + by, n, x + sy, m, same) for a, n, x, m, same in known[windows]]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(7)], names)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """SPANS: for every document the passages that a document of smaller id holds too, in words from 0; where passages
    overlap they are one, and source_start, source_words and equal_words are those of its longest alignment."""
    prepare(docs.sparkSession)
    rows = texts(docs).where("doc_id is not null")
    seeds = staged(rows.mapInArrow(_seeded, "seed bigint, doc_id bigint, pos int"), "seeds")
    first = seeds.groupBy("seed").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last")).where("source < last")
    first = staged(first.select("seed", "source"), "seed-sources")
    # a source's places of its own seeds; of one that it holds over TURNS times the first alone
    places = seeds.join(first, "seed").where("doc_id = source").groupBy("seed", "source").agg(F.collect_set("pos").alias("at"))
    few = F.when(F.size("at") <= TURNS, F.col("at")).otherwise(F.array(F.array_min("at")))
    places = staged(places.select("seed", "source", F.explode(few).alias("source_pos")), "source-places")
    # the pairs' later matches come beside the others; of one place the later source first, as a chain takes a place once
    matches = places.join(seeds, "seed").where("doc_id <> source").select("doc_id", "source", "pos", "source_pos", F.shiftright("seed", 32).cast("int").alias("half"))
    pairs = (matches.repartition("doc_id").sortWithinPartitions("doc_id", "source", "pos", F.desc("source_pos"))
             .mapInArrow(_chained, PAIRS))
    pairs = _with_seams(staged(pairs, "chains"))
    ids = staged(pairs.select("doc_id").union(pairs.select("source")).distinct(), "ids")
    discard(seeds, first, places)
    words = staged(rows.join(small_or_not(ids, BROADCAST_IDS), "doc_id", "left_semi").mapInArrow(_word_table, "doc_id bigint, words binary"), "words")

    def cut(low: str, high: str, name: str) -> list:
        start = F.greatest(F.array_min(low) - MARGIN, F.lit(0))
        return [start.alias(f"{name}_from"), F.substring("words", 4 * start + 1, 4 * (F.array_max(high) + MARGIN - start)).alias(f"{name}w")]

    own = pairs.join(words, "doc_id").select(*pairs.columns, *cut("d0", "d1", "d"))
    both = own.join(words.withColumnRenamed("doc_id", "source"), "source").select(*own.columns, *cut("s0", "s1", "s"))
    spans = staged(both.mapInArrow(_aligned, SPANS).dropDuplicates(["doc_id", "dup_of", "start_word", "n_words"]), "spans")
    discard(*pairs.reads, ids, words)
    return spans


def _with_seams(found: DataFrame) -> DataFrame:
    """The pairs among ``found`` and those of documents with the first holders of their seams; ``reads`` names their tables."""
    pairs = found.where("seam is null").drop("seam")
    places = found.where("seam is not null").select("seam", "doc_id", F.col("d0")[0].alias("d0"), F.col("d1")[0].alias("d1"))
    first = (places.groupBy("seam").agg(F.min(F.struct("doc_id", "d0", "d1")).alias("first"), F.max("doc_id").alias("last")).where("first.doc_id < last")
             .select("seam", F.col("first.doc_id").alias("source"), F.col("first.d0").alias("s0"), F.col("first.d1").alias("s1")))
    first = staged(first, "seam-sources")
    more = (places.join(first, "seam").where("doc_id <> source").join(pairs.select("doc_id", "source"), ["doc_id", "source"], "left_anti")
            .groupBy("doc_id", "source").agg(*(F.collect_set(c).alias(c) for c in ("d0", "d1", "s0", "s1"))))  # as bounds alone, in any order
    more = staged(more, "seams")
    both = pairs.unionByName(more)
    both.reads = [found, first, more]
    return both


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of ``spans`` (first, end), each with the white space after it."""
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, last = [], 0
    for a, b in sorted(spans):
        if at[min(b, len(at) - 1)] > last:
            out.append(text[last:max(last, at[min(a, len(at) - 1)])])
            last = at[min(b, len(at) - 1)]
    return b"".join([*out, text[last:]])


def _cut(name: str):
    """``name``: the column of spans, which goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, raw = _column(batch, name).to_pylist(), _column(batch, "text").to_pylist()
            new = [t if s is None or t is None else without(t.encode(), [(x["a"], x["b"]) for x in s]).decode() for t, s in zip(raw, spans, strict=True)]
            # a text that was all repeated passages leaves no document
            left = pa.array([s is None or bool(t and t.strip(" \t\n\v\f\r")) for t, s in zip(new, spans, strict=True)])
            kept = [n for n in batch.schema.names if n != name]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == "text" else _column(batch, n) for n in kept], kept).filter(left)
    return run


def cut_passages(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the words of ``spans`` (doc_id, start_word, n_words) cut out of their text, and n_chars to match;
    documents of which nothing is left are gone."""
    prepare(docs.sparkSession)
    key, name = free_name(docs, "span_id"), free_name(docs, "spans")
    place = F.struct(F.col("start_word").alias("a"), (F.col("start_word") + F.col("n_words")).alias("b"))
    per = staged(spans.groupBy(F.col("doc_id").alias(key)).agg(F.collect_set(place).alias(name)), "cuts")
    rows = per.agg(F.coalesce(F.sum(F.size(name) + 2), F.lit(0))).first()[0]  # a passage counts as an id of 16 bytes
    per = F.broadcast(per) if rows <= BROADCAST_IDS else per
    marked = docs.join(per, docs["doc_id"].cast("bigint") == per[key], "left").drop(key)
    done = marked.mapInArrow(_cut(name), docs.schema)
    if "n_chars" not in docs.columns:
        return done
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
