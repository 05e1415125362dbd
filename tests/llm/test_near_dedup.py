"""Near duplicates against all pairs, SetSketch properties, components."""
import random

import numpy as np
import pytest

from fleetlake.llm import near_dedup as nd
from fleetlake.llm.graph import components


def _set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k):
    """Component and set size per row, from all pairs."""
    sets = [(i, _set(t, k)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = top(i), top(j)
                root[max(p, q)] = min(p, q)
    return sorted(((i, len(s), top(i)) for i, s in sets), key=str)


def _edited(rnd, words, share):
    return [rnd.choice(words) + "x" if rnd.random() < share else w for w in words]


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    base = [rnd.choice(vocabulary) for _ in range(150)]
    for _ in range(140):  # one group: copies that drift away from the first by different amounts
        rows.append((n := n + 1, " ".join(_edited(rnd, base, rnd.choice([0, 0.01, 0.03, 0.06, 0.1])))))
    chain = [rnd.choice(vocabulary) for _ in range(200)]
    for _ in range(12):  # a chain: each like the one before
        rows.append((n := n + 1, " ".join(chain)))
        chain = _edited(rnd, chain, 0.02)
    rows += [((n := n + 1), " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60)))) for _ in range(60)]
    rows += [(n + 1, None), (n + 2, ""), (n + 3, " \n\t"), (n + 4, "One two"), (n + 5, "one\ttwo"), (n + 6, "one two three"), (None, "one two"), (3, rows[2][1]), (n + 7, "é É"), (n + 8, "é é"),
             (n + 9, "long " + " ".join(f"t{i}" for i in range(30_000))), (n + 10, " ".join(f"t{i}" for i in range(30_000)))]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("k", "block"), [(4, 128), (5, 16)])
def test_same_as_all_pairs(documents, corpus, monkeypatch, k, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    if block == 16:
        monkeypatch.setattr(nd, "BROADCAST_IDS", 0)  # by shuffles
    got = nd.near_duplicates(documents(corpus), k=k).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(corpus, k)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_no_documents(documents):
    assert nd.near_duplicates(documents([])).count() == 0


def test_registers_merge_and_estimate():
    rnd = np.random.default_rng(1)
    x, y = rnd.integers(0, 1 << 64, 900, dtype="u8"), rnd.integers(0, 1 << 64, 900, dtype="u8")
    assert np.array_equal(nd.merged(nd.registers(x), nd.registers(y)), nd.registers(np.concatenate([x, y])))
    assert not nd.registers(x[:0]).any()
    for shared in (0, 300, 600, 900):
        a, b = nd.registers(x), nd.registers(np.concatenate([x[:shared], y[shared:]]))
        true = shared / (1800 - shared)
        got = nd.likeliest(np.array([(a > b).sum()]), np.array([(a < b).sum()]), np.array([(a == b).sum()]), np.array([900.0]), np.array([900.0]))
        assert abs(got[0] - true) < 0.13


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 50)]
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: top(x) for x in root}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_blocks_grow_with_the_probes(spark, monkeypatch):
    """Of a cluster of 900 with 5 outsiders, each member goes to one block of probes; every outsider meets every member once."""
    monkeypatch.setattr(nd, "BLOCK", 16)
    near = [(1, i, 1) for i in range(1, 901)] + [(1, 2000 + i, 2000 + i % 2) for i in range(5)] + [(3000, 3000 + i, 3000) for i in range(50)]
    near += [(5000, 5000 + i, 5000 + i) for i in range(60)]  # no two linked yet
    rows = nd.blocked(spark.createDataFrame(near, "leader bigint, rep bigint, comp bigint")).collect()
    for leader, size, probes in ((1, 905, 5), (5000, 60, 59)):
        mine = [r for r in rows if r["leader"] == leader]
        assert len(mine) <= size * -(-probes // 16) + probes * -(-size // 16)
        members, asks = ({(r["rep"], r["block"], r["part"]) for r in mine if r["probe"] == p} for p in (False, True))
        by: dict = {}
        for rep, *cell in members:
            by.setdefault(tuple(cell), []).append(rep)
        met = [(a, b) for a, *cell in asks for b in by.get(tuple(cell), [])]
        assert len(met) == len(set(met)) == size * probes
    assert not [r for r in rows if r["leader"] == 3000]  # one component: nothing is sent
