"""Vector codes against plain Lloyd rounds over Python integers."""
import hashlib
import math
import random

import numpy as np
import pytest

from fleetlake.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, entry string, part int, moved boolean"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, True) for r in rows], SCHEMA)


def plain(rows, parts, entries, rounds):
    """{row number: (code, error)}, label errors and codebooks, by the definition."""
    whole = [(n, i, [max(-vc.LIMIT, min(vc.LIMIT, math.floor(1024 * float(np.float32(x))))) for x in v], label) for n, (i, v, label) in enumerate(rows)
             if v and all(x is not None and math.isfinite(x) for x in v)]
    whole.sort(key=lambda r: (r[1] is None, r[1], r[2]))
    whole = [r for r in whole if len(r[2]) == len(whole[0][2])]
    if not whole:
        return {}, {}, []
    cuts = vc.bounds(len(whole[0][2]), parts)
    books = [[r[2][a:b] for r in whole[:entries]] for a, b in cuts]

    def near(x, book):
        return min((sum((p - q) ** 2 for p, q in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for k, (a, b) in enumerate(cuts):
            members = {}
            for r in whole:
                members.setdefault(near(r[2][a:b], books[k])[1], []).append(r[2][a:b])
            books[k] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else old for e, old in enumerate(books[k])]
    out, by_label = {}, {}
    for n, i, v, label in whole:
        found = [near(v[a:b], book) for (a, b), book in zip(cuts, books)]
        out[n] = (i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label)
        by_label[label] = by_label.get(label, 0) + out[n][2]
    return out, by_label, books


def check(spark, rows, parts=4, entries=4, rounds=4, members=7):
    want, by_label, books = plain(rows, parts, entries, rounds)
    got = vc.vector_codes(frame(spark, rows), parts=parts, entries=entries, rounds=rounds, members=members).collect()
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label"], r["label_error"]) for r in got), key=str) == \
        sorted(((*w, by_label[w[3]]) for w in want.values()), key=str)
    assert {r["codebooks_sha256"] for r in got} <= {digest}
    return got


def test_rounds_and_edges(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) + i % 5 for _ in range(9)], rnd.choice([None, 1, 2])) for i in range(120)]
    rows += [(200, None, 1), (201, [], 1), (202, [1.0, None] + [0.0] * 7, 1), (203, [float("nan")] * 9, 1), (204, [float("-inf")] * 9, 1), (205, [1.0] * 8, 1)]
    rows += [(None, [0.5] * 9, None), (7, [-0.001] * 9, 2), (7, [-0.001] * 9, 2)]        # null, equal ids
    rows += [(300 + i, [2.0] * 9, 1) for i in range(60)]                                 # copies, a third of all
    assert len(check(spark, rows)) == 120 + 3 + 60


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [0.25, -0.25, 1.0, 3.0], 1)], [(5, [1e30, -1e30, 0.0, 2.0], None), (4, [1.0, 1.0, 1.0, 1.0], 3)], [(1, [0.5, 0.25], 1), (2, [0.1, 0.9], 2)]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_nearest_is_exact_beyond_doubles():
    rows = np.array([[vc.LIMIT, -vc.LIMIT], [vc.LIMIT - 1, -vc.LIMIT]])
    book = np.array([[vc.LIMIT - 1, -vc.LIMIT], [vc.LIMIT, -vc.LIMIT], [vc.LIMIT, -vc.LIMIT]])
    entry, distance = vc.nearest(rows, book)
    assert entry.tolist() == [1, 0] and distance.tolist() == [0, 0]


def test_only_movers_are_shuffled(spark, monkeypatch):
    """Members whose entry stays are written where they were read; the shuffle takes the others."""
    sent, owners = [], vc._to_owners

    def counted(assigned, members):
        sent.append((assigned.where("moved").count(), assigned.count()))
        return owners(assigned, members)
    monkeypatch.setattr(vc, "_to_owners", counted)
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 1) + 6 * (i % 4) for _ in range(8)], 1) for i in range(200)]
    check(spark, rows)
    assert sent[0] == (800, 800) and all(all_ == 800 for _, all_ in sent) and sum(m for m, _ in sent[1:]) < 800


def test_salts_split_a_large_entry(spark):
    assigned = spark.createDataFrame([(0, 0, [i], True) for i in range(40)] + [(0, 1, [1], True), (1, 0, [1], False)], vc._MEMBER)
    parts = vc._to_owners(assigned, 10)
    assert parts.count() == 41
    assert "hashpartitioning(position" in parts._jdf.queryExecution().toString() and "salt" in parts._jdf.queryExecution().toString()
