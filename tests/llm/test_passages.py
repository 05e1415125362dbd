"""Repeated passages and benchmark leaks against brute force."""
import difflib
import itertools
import random
import re

import numpy as np
import pytest

from fleetlake.llm import decontamination as dc
from fleetlake.llm import substring_dedup as sd


def _words(rnd, n, size=4000):
    return [f"w{rnd.randint(0, size)}" for _ in range(n)]


def test_chains_are_the_best():
    """Each chain increases in both texts, all matches are used once, and the first chain's score is the best possible."""
    rnd = np.random.default_rng(0)
    for _ in range(60):
        n = int(rnd.integers(1, 40))
        pos, source = np.sort(rnd.choice(400, n, replace=False)), rnd.integers(0, 400, n)
        got = sd.chains(pos, source)
        assert sorted(sum(got, [])) == list(range(n))
        for chain in got:
            assert all(pos[a] < pos[b] and source[a] < source[b] for a, b in zip(chain, chain[1:]))

        def score(chain):
            return len(chain) - sd.GAP_COST * sum(pos[b] - pos[a] + source[b] - source[a] for a, b in zip(chain, chain[1:]))
        best = [1.0] * n
        for i in range(n):
            for j in range(i):
                if pos[j] < pos[i] and source[j] < source[i]:
                    best[i] = max(best[i], 1 + best[j] - sd.GAP_COST * (pos[i] - pos[j] + source[i] - source[j]))
        assert score(got[0]) == pytest.approx(max(best))


def test_common_words():
    rnd = np.random.default_rng(3)
    for _ in range(100):
        a, b = rnd.integers(0, 6, rnd.integers(0, 30)), rnd.integers(0, 6, rnd.integers(0, 30))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert sd.common_words(a, b) == table[-1, -1]


def _ids(words):
    return np.array([hash(w) & 0xFFFFFFFF for w in words], "u4")


def test_common_pairs():
    rnd = np.random.default_rng(5)
    for _ in range(100):
        a, b = rnd.integers(0, 6, rnd.integers(0, 30)), rnd.integers(0, 6, rnd.integers(0, 30))
        got = sd.common_pairs(a, b)
        assert len(got) == sd.common_words(a, b) and all(a[i] == b[j] for i, j in got)
        assert all(x < u and y < v for (x, y), (u, v) in zip(got, got[1:]))


@pytest.mark.parametrize("gap", [25, 35, 40, 45])
def test_passages_beside_foreign_words(gap):
    """Two shared passages, with other words between them in one text or both, and one passage beside a stray seed."""
    for n in range(20):
        one, two, x, y, z = ([f"{k}{n}.{i}" for i in range(size)] for k, size in zip("abxyz", (55, 55, gap, gap, 30)))
        source = z + one + x + two + z
        for text in (one + y + two, z[::-1] + one + two[:0] + y + two, one + two + z[::-1], one + [f"q{i}" for i in range(50)] + z[-6:]):
            got = {i for a, m, *_ in sd.passages(_ids(text), _ids(source)) for i in range(a, a + m)}
            want = {i for i, w in enumerate(text) if w in set(one) | set(two)}
            assert want <= got and len(got - want) <= gap + 6


def _over_and_over(rnd, n):
    """Texts that are runs of a word or two, or of single words, as ids."""
    out = []
    while len(out) < n:
        words = rnd.integers(0, 5, rnd.integers(1, 3)).tolist() if rnd.random() < 0.7 else rnd.integers(5, 60, 9).tolist()
        out += words * int(rnd.integers(1, 70) if words[0] < 5 else 1)
    return np.array(out[:n], "u4")


def test_texts_of_a_few_words_over_and_over(monkeypatch):
    """Segments that are judged together give what they give one by one, and few of them are aligned."""
    rnd = np.random.default_rng(11)
    one, many, none, wide = sd.FEW, 0, 0, 0
    for i in range(60):
        d, s = _over_and_over(rnd, int(rnd.integers(50, 400))), _over_and_over(rnd, int(rnd.integers(50, 400)))
        if i % 3 == 0:  # beside more words than a bit row per word is kept for
            far = np.repeat(np.arange(1000, 1080, dtype="u4"), 2)
            d, s, wide = np.concatenate([far[::-1], d]), np.concatenate([s, far]), wide + 1
        monkeypatch.setattr(sd, "FEW", 1 << 30)
        want = sd.passages(d, s)
        for few, at_once in ((1, 8), (1, 256), (one, 256)):
            monkeypatch.setattr(sd, "FEW", few)
            monkeypatch.setattr(sd, "AT_ONCE", at_once)
            assert sd.passages(d, s) == want
        many, none = many + bool(want), none + (not want)
    assert many > 5 and none > 5 and wide

    calls = []
    for name in ("aligned", "paired"):
        monkeypatch.setattr(sd, name, lambda *x, f=getattr(sd, name): calls.append(0) or f(*x))
    d, s = np.repeat([9, 1, 2], [64, 596, 55]), np.repeat([7, 8, 1, 3, 4], [20, 44, 44, 44, 10])
    assert sd.passages(d.astype("u4"), s.astype("u4")) == [(64, 55, 64, 44, 44)]
    assert len(calls) <= 40  # 2,286 one by one


def test_common_rows():
    """LCS of rows tried together: the same places as one by one, with a bit row per word and with all words compared."""
    rnd = np.random.default_rng(12)
    for n, size in ((4, 64), (40, 64), (4, 20), (90, 64)):
        a, b = rnd.integers(0, n, (30, size)), rnd.integers(0, n, (30, size))
        a[:3], b[:5] = -1, -2
        a[10:13, :9], b[12:15, 11:] = -1, -2
        at, rows = sd._common_rows(a, b, n)
        own, other = sd._traced(at, rows, size)
        for i in range(30):
            want = sd.common_pairs(a[i], b[i])
            assert [x for x, _ in want] == np.flatnonzero(own[i]).tolist() and [y for _, y in want] == np.flatnonzero(other[i]).tolist()
            assert len(want) == int(np.bitwise_count(~rows[-1][i]))


def test_minimisers():
    """The smallest seed of every window of every text, the first of equal ones; no window lies across two texts."""
    rnd = np.random.default_rng(13)
    for _ in range(40):
        words = [int(x) for x in rnd.integers(0, 40, 12)]
        starts = np.concatenate([[0], np.cumsum(words)])
        seeds = rnd.integers(0, 9, max(int(starts[-1]) - 5, 0)).astype("u8")
        n = np.maximum(np.diff(starts) - 5, 0)
        want = []
        for a, m in zip(starts.tolist(), n.tolist()):
            want += sorted({a + w + int(np.argmin(seeds[a + w:a + min(w + 7, m)])) for w in range(max(m - 6, 1))} if m else ())
        assert sd.minimisers(seeds, starts[:-1], n, 7).tolist() == want


def test_chains_that_rise():
    """Matches that rise in both texts give the chains that they give with a match beside them that does not."""
    rnd = np.random.default_rng(14)
    for gap in (10, 45, 90):
        pos, source = (np.cumsum(rnd.integers(1, gap, 80)) for _ in range(2))
        got = sd.chains(pos, source)
        far = sd.chains(np.append(pos, pos[-1] + 100_000), np.append(source, 0))
        assert got == [x for x in far if x != [80]]


@pytest.fixture(scope="module")
def planted():
    """Documents with passages: exact, with substitutions, with insertions; others without any."""
    rnd = random.Random(9)
    rows, want = [], {}
    passage = _words(rnd, 70)
    for i in range(40):
        words = _words(rnd, rnd.randint(5, 250))
        at = rnd.randint(0, len(words))
        kind = i % 4
        if kind < 3:
            p = list(passage)
            if kind == 1:
                for j in range(9, 70, 20):
                    p[j] = "changed"
            if kind == 2:
                p[25:25] = ["more", "words"]
                del p[50:52]
            words[at:at] = p
            want[i] = (at, at + len(p))
        rows.append((i, (" " if i % 2 else "\n").join(words).replace("w1", "W1")))
    return rows, want


def test_planted_passages(documents, planted):
    rows, want = planted
    first = min(want)
    got = sd.repeated_passages(documents([*rows, (100, None), (101, ""), (None, rows[first][1]), (102, "a b c"), (first, rows[first][1])])).collect()
    assert {r["doc_id"] for r in got} == set(want) - {first}
    text = {i: t.lower().split() for i, t in rows}
    for i, (a, b) in want.items():
        covered = {x for r in got if r["doc_id"] == i for x in range(r["start_word"], r["start_word"] + r["n_words"])}
        if i != first:
            assert len(covered & set(range(a, b))) >= 0.9 * (b - a) and len(covered - set(range(a, b))) <= 6
    for r in got:
        d, s = text[r["doc_id"]][r["start_word"]:][:r["n_words"]], text[r["dup_of"]][r["source_start"]:][:r["source_words"]]
        assert r["equal_words"] >= sum(m.size for m in difflib.SequenceMatcher(None, d, s, autojunk=False).get_matching_blocks())


def test_passages_of_shared_owners(documents):
    """Seeds that another document owns, and passages at a later place of their source, are found too."""
    rnd = random.Random(21)
    rows, want = [], {}
    for n in range(12):
        p, x, y, z = (_words(rnd, k, 10**7) for k in (60, 20, 150, 90))
        rows += [(100 * n + 1, p[:30] + x), (100 * n + 2, y + p), (100 * n + 3, p[:15] + ["inserted"] + p[15:])]
        want[100 * n + 3] = 55
        # the source holds half of it early, the whole of it 400 words later
        rows += [(100 * n + 5, z[:45] + _words(rnd, 400, 10**7) + z), (100 * n + 6, x + z)]
        want[100 * n + 6] = 85
    got = sd.repeated_passages(documents([(i, " ".join(w)) for i, w in rows])).collect()
    for i, least in want.items():
        assert max((r["equal_words"] for r in got if r["doc_id"] == i), default=0) >= least, i


def test_where_passages_fit():
    """Every place of a passage, whatever its changes, is one that the filter leaves; texts without common words leave none."""
    rnd = random.Random(31)
    for _ in range(200):
        words = _words(rnd, rnd.randint(50, 120), 10**7)
        changed = []
        for w in words:
            kind = rnd.random()
            changed += [] if kind < 0.05 else [f"i{len(changed)}", w] if kind < 0.1 else [f"s{len(changed)}"] if kind < 0.2 else [w]
        same = sd.common_words(_ids(changed), _ids(words))
        if 100 * same < sd.AGREE * max(len(changed), len(words)) or len(changed) < sd.MIN_WORDS:
            continue
        d, s = _ids(_words(rnd, 70, 10**7) + changed + _words(rnd, 70, 10**7)), _ids(_words(rnd, 20, 10**7) + words)
        assert sd.where_passages_fit(d, s)[70:70 + len(changed)].all() and sd.where_passages_fit(s, d)[20:].all()
        assert not sd.where_passages_fit(d, _ids(_words(rnd, 200, 10**7))).any()


def test_seams():
    """Neighbouring seeds of different sources, within MAX_GAP words, in order of the document."""
    rows = np.array([[1, 7, 50, 0, 11], [1, 7, 60, 0, 12], [1, 8, 55, 0, -13], [1, 9, 300, 0, 14], [2, 7, 310, 0, 15], [2, 8, 330, 0, 16]])
    a, b, seam = sd.seams(rows)
    assert a[:, 4].tolist() == [11, -13, 15] and b[:, 4].tolist() == [-13, 12, 16] and len(set(seam.tolist())) == 3
    assert sd.seams(np.zeros((0, 5), "i8"))[2].tolist() == []


def test_halves_of_other_owners(documents):
    """Smaller ids own each half of a passage that only later documents hold whole; one group of them is large."""
    rnd = random.Random(14)
    rows = []
    for n in range(30):
        p = _words(rnd, 60, 10**7)
        own = [_words(rnd, 25, 10**7) for _ in range(5)]
        rows += [(200 * n + 1, own[0] + p[:30] + own[1]), (200 * n + 2, own[2] + p[30:]), (200 * n + 3, own[3] + p + own[4])]
        rows += [(200 * n + k, _words(rnd, 25, 10**7) + p + _words(rnd, 9, 10**7)) for k in range(4, 100 if n == 0 else 5)]
    got = sd.repeated_passages(documents([(i, " ".join(w)) for i, w in rows])).collect()
    whole = {i for i, _ in rows if i % 200 > 3}
    assert {r["doc_id"] for r in got if r["equal_words"] >= 60} == whole == {r["doc_id"] for r in got}
    assert len(got) <= 4 * len(whole)  # of a passage's many holders a few are sources (seeds at its ends have first holders of their own)


def test_recall_of_changed_passages(documents):
    """Passages of 60 words with random changes that agree in 80 %: at least nine in ten are found."""
    rnd = random.Random(77)
    for percent, least in ((0, 1.0), (10, 0.95), (15, 0.9), (20, 0.85)):
        rows, n = [], 0
        while n < 100:
            p = _words(rnd, 60, 10**7)
            q = [w if i in (0, 59) or rnd.random() * 100 >= percent else f"c{n}.{i}" for i, w in enumerate(p)]
            if sum(a == b for a, b in zip(p, q)) < 48:
                continue
            rows += [(2 * n, _words(rnd, 30, 10**7) + p + _words(rnd, 20, 10**7)), (2 * n + 1, _words(rnd, 20, 10**7) + q + _words(rnd, 30, 10**7))]
            n += 1
        got = sd.repeated_passages(documents([(i, " ".join(w)) for i, w in rows])).collect()
        assert len({r["doc_id"] for r in got}) >= 100 * least, percent


def test_cut(documents, planted):
    rows, want = planted
    docs = documents([*rows, (200, rows[0][1]), (201, None), (202, "")])
    spans = sd.repeated_passages(docs)
    out = {r["doc_id"]: r for r in sd.cut_passages(docs, spans).collect()}
    assert sd.cut_passages(docs, spans).columns == docs.columns
    assert 200 not in out and out[201]["text"] is None and out[202]["text"] == ""  # a whole copy leaves nothing
    for i, t in rows:
        if i in want and i != min(want):
            left = out[i]["text"].split()
            assert len(left) <= len(t.split()) - 0.9 * (want[i][1] - want[i][0]) and out[i]["n_chars"] == len(out[i]["text"])
        else:
            assert out[i]["text"] == t
    assert sd.without(b"  a b\n c d ", [(1, 3)]) == b"  a d " and sd.without(b"a b", [(0, 2)]) == b""


def test_passages_of_hot_text(documents, monkeypatch):
    """A passage that every document holds gives one match row per document and seed, not pairs."""
    monkeypatch.setattr(sd, "BROADCAST_IDS", 0)  # by shuffles
    line = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{line} own{i} text{i}") for i in range(300)]
    got = sd.repeated_passages(documents(rows)).collect()
    assert len(got) == 299 and {r["dup_of"] for r in got} == {0}
    assert sd.repeated_passages(documents([])).count() == 0
    assert sd.repeated_passages(documents([(1, "For " * 3000), (2, "For " * 2500)])).count() >= 1


def _tokens(text):
    return [x for x in re.split(r"[^0-9a-z]+", (text or "").lower()) if x]


def brute_leaks(rows, items):
    found = set()
    for i, t in rows:
        t = _tokens(t)
        for j, b in items:
            b = _tokens(b)
            n = min(len(b), dc.STRETCH)
            if len(b) < dc.MIN_TOKENS:
                continue
            for g in range(-len(b), len(t)):
                equal = [int(0 <= g + k < len(t) and t[g + k] == b[k]) for k in range(len(b))]
                if max(sum(equal[k:k + n]) for k in range(len(b) - n + 1)) * 100 >= dc.AGREE * n:
                    found.add((i, j))
    return found


def test_leaks(spark, documents):
    rnd = random.Random(4)
    items = [(i, " ".join(_words(rnd, n))) for i, n in enumerate([30, 20, 14, 9, 5, 4, 1, 0, 40])] + [(20, None), (21, "same tokens as in another item here"), (22, "Same tokens, as in another item here!")]
    rows = []
    for i in range(60):
        words = _words(rnd, rnd.randint(0, 120))
        item = items[i % 9][1].split()
        if i % 3 == 0:
            words[len(words) // 2:0] = item
        elif i % 3 == 1 and len(item) >= 13:
            item[::6] = ["other"] * len(item[::6])
            words += item
        rows.append((i, ", ".join(words).upper()))
    rows += [(100, None), (101, ""), (102, items[0][1][:60]), (103, "x same tokens as in another item here y"), (103, "x same tokens as in another item here y"), (None, items[1][1])]
    benchmark = spark.createDataFrame([(i, t, 1, "a") for i, t in items], "item_id bigint, text string, t int, key string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(documents(rows), benchmark).collect()}
    assert got == brute_leaks(rows, [x for x in items if x[0] != 22])
    assert len(got) > 20
    kept = [r["doc_id"] for r in dc.clean(documents(rows), benchmark).collect()]
    assert sorted(kept, key=str) == sorted((i for i, _ in rows if i not in {a for a, _ in got}), key=str)
    assert dc.contaminated(documents([]), benchmark).count() == 0
    assert dc.contaminated(documents(rows), benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("bitmap", [dc.BITMAP_HEADS, 0])
def test_leaks_of_rows_that_share_an_id(spark, documents, monkeypatch, bitmap):
    """Another row's text, which begins a diagonal alike, hides nothing; a row goes by its own text."""
    monkeypatch.setattr(dc, "BITMAP_HEADS", bitmap)
    item = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november".split()
    part, whole = " ".join(item[:3] + ["other"] * 11), " ".join(item)
    benchmark = spark.createDataFrame([(1, whole)], "item_id bigint, text string")
    rows = [(5, part), (5, whole), (None, part), (None, whole), (6, part), (7, "word " * 100_000 + whole)]
    assert [tuple(r)[:2] for r in sorted(dc.contaminated(documents(rows), benchmark).collect(), key=str)] == [(5, 1), (7, 1), (None, 1)]
    assert sorted(((r["doc_id"], r["text"]) for r in dc.clean(documents(rows), benchmark).collect()), key=str) == [(5, part), (6, part), (None, part)]


def test_leaks_of_long_items(spark, documents):
    """A lone seed far before the copied part, on the same diagonal, does not hide it."""
    rnd = random.Random(12)
    item = _words(rnd, 400)
    rows = []
    for i, at in enumerate((30, 90, 200, 380)):
        other = [f"x{rnd.randint(0, 9999)}" for _ in range(400)]
        for k in dc.MASKS[0]:
            other[5 + k] = item[5 + k]            # a seed, but no stretch
        other[at:at + 20] = item[at:at + 20]
        rows.append((i, " ".join(other)))
    rows.append((9, " ".join(rows[0][1].split()[:25] + rows[0][1].split()[50:])))
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(documents(rows), benchmark).collect()}
    assert got == brute_leaks(rows, [(1, " ".join(item))]) == {(i, 1) for i in range(4)}


def test_leaks_run_without_python(spark, documents):
    benchmark = spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(30)))], "item_id bigint, text string")
    plan = dc.contaminated(documents([(1, "a b")]), benchmark)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_leaks_by_shuffle(spark, documents, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_SEEDS", 0)
    monkeypatch.setattr(dc, "BROADCAST_IDS", 0)
    item = " ".join(f"b{i}" for i in range(30))
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert [tuple(r)[:3] for r in dc.contaminated(documents([(1, "a b"), (2, f"c {item} d")]), benchmark).collect()] == [(2, 1, 1)]


def test_masks_leave_no_change_out():
    """Whichever tokens of a stretch differ, some mask at some place looks at none of them."""
    for n, masks in dc.FAMILIES.items():
        differ = n - -(-n * dc.AGREE // 100)
        for lost in itertools.combinations(range(n), differ):
            assert any(not {at + k for k in m} & set(lost) for m in masks for at in range(n - m[-1])), (n, lost)
        assert all(m[:2] == dc.HEAD for m in masks)
    assert list(dc.FAMILIES) == list(range(dc.MIN_TOKENS, dc.STRETCH + 1))


def test_leaks_with_changes(spark, documents):
    """Items of every length with as many tokens changed as may be, and copies cut off by a document's ends."""
    rnd = random.Random(8)
    items = [(n, " ".join(_words(rnd, n, 10**6))) for n in [*range(5, 20), 30]]
    rows = []
    for n, item in items:
        words = item.split()
        for _ in range(12):
            new, k = list(words), min(n, dc.STRETCH)
            at = rnd.randint(0, n - k)
            for j in [*rnd.sample(range(at, at + k), k - -(-k * dc.AGREE // 100)), *range(at), *range(at + k, n)]:
                new[j] = "other"
            rows.append((len(rows), " ".join(_words(rnd, 9) + new + _words(rnd, 9))))
        for cut in (2, 3, 4, 10):
            rows += [(len(rows), " ".join(words[cut:] + _words(rnd, 5))), (len(rows) + 1, " ".join(_words(rnd, 5) + words[:-cut]))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(documents(rows), benchmark).collect()}
    assert got == brute_leaks(rows, items)
