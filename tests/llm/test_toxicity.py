"""Toxicity: automata against edit distance, quotation, held-out labels."""
import random
import zlib

import numpy as np

from fleetlake.llm import toxicity as tx

SF = "/root/testdata/sf0.01"


def _edits(a, b):
    """Edit distance with swaps of neighbours (each letter edited once)."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_is_edit_distance():
    rnd = random.Random(3)
    for _ in range(3000):
        terms = ["".join(rnd.choice("abc") for _ in range(rnd.randint(4, 9))) for _ in range(5)]
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 10)))
        want = min(((_edits(word, t), t) for t in terms if _edits(word, t) <= tx.allowed_edits(len(t))), default=None)
        got = tx.nearest_term(word, tx.build_trie(terms))
        assert (want is None) == (got is None) and (got is None or (got[1], got[0]) == want)


def test_no_near_word_is_passed_over():
    rnd = random.Random(8)
    for _ in range(3000):
        length = rnd.choice([5, 7, 8, 9])
        terms = ["".join(rnd.choice("abo") for _ in range(length)) for _ in range(3)]
        word = "".join(rnd.choice("abo0") for _ in range(rnd.randint(length - 3, length + 3)))
        edits = tx.allowed_edits(length)
        near = tx.nearest_term(word, tx.build_trie(terms), edits)
        assert tx.Trie(terms, edits).edits_to(word) == (near[1] if near else None)


def test_no_possible_word_is_ruled_out():
    import pyarrow as pa

    rnd = random.Random(6)
    find = tx.Finder(["moronic", "scum", "disgusting", "réeux"], ["blar", "épa"], [])
    base = ["moronic", "scum", "disgusting", "réeux", "blarney", "épaule"]
    words = set()
    for _ in range(4000):
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(w))
            w[at:at + rnd.randint(0, 1)] = rnd.choice(["", "x", "0", "$", "é", "É", "\u212a", "S", "!", "-", "“", "”", "###"])
        words.add("".join(w).replace("m", rnd.choice("mM")) or "z")
    words = sorted(words)
    hit = [find(w) is not None for w in words]
    assert sum(hit) > 300 and all(p or not h for p, h in zip(find.possible(pa.array(words, pa.large_string())), hit, strict=True))
    assert all(p or not h for p, h in zip(find.possible(pa.array(["pad", *words], pa.large_string())[1:]), hit, strict=True))


def test_finder():
    find = tx.Finder(["moronic", "scum", "disgusting"], ["blar"], [("moronic", 0)])
    assert [find(w) for w in ("SCUM!", "5cum", "scun", "moronic", "moronik", "disgusting", "dizgusting", "d1sgustng", "blarney", "bl@rx", "", "***", "x" * 10_000)] == \
        [0, 0, None, 0, None, 0, 1, 1, 3, 3, None, None, None]


def test_quotation_is_not_abuse():
    find = tx.Finder(["idiot"], [], [])

    def score(t):
        x = tx.hit_features(t, find)
        return 1 / (1 + np.exp(-(tx.PRIOR[0] + x @ tx.PRIOR[1:])))
    abuse, typo, quoted, said = (score(t) for t in ("you are an idiot and always will be", "you are an idoit and always will be", 'the sign read "no idiot here" in red', "they wrote the word idiot on it"))
    assert abuse > 0.7 and typo > 0.7 and quoted < 0.3 and said < 0.3
    assert tx.context('a "b c" d “e” "f')[1] == [False, True, True, False, True, False]


def test_edges(documents, labels):
    rows = [(1, None), (2, ""), (3, "you idiot"), (3, "you idiot"), (None, "idiot"), (4, "idiot " * 30_000), (5, "#$% \n")]
    got = tx.toxicity(documents(rows), labels([(1, 1, None), (None, 1, 1)])).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert tx.toxicity(documents([]), labels([(1, 1, 1)])).count() == 0


def test_held_out_labels_are_never_read(documents, labels):
    """Labels of held-out ids change no score."""
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["plain", "words", "of", "text", "here"]) for _ in range(20)) + (f" {rnd.choice('abcdef')} nasty{'' if i % 2 else ''}" if i % 3 == 0 else "")) for i in range(200)]
    true = [(i, 1, int(i % 3 == 0)) for i in range(200)]
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in true]
    one, two = ({r["doc_id"]: r["score"] for r in tx.toxicity(documents(rows), labels(x)).collect()} for x in (true, other))
    assert one == two
    assert all((s >= 0.7) == (i % 3 == 0) for i, s in one.items())


def test_held_out_accuracy(spark):
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r["doc_id"]: r["toxic"] for r in known.collect()}
    held = [(r["predicted"], toxic[r["doc_id"]]) for r in tx.toxicity(docs, known).collect() if r["held_out"] and r["doc_id"] in toxic]
    caught = [p for p, t in held if t]
    assert sum(caught) / len(caught) > 0.6
    assert sum(p for p, t in held if not t) <= 0.02 * len(held)
