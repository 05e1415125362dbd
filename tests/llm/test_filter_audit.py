"""The filter audit against every order applied to every document."""
import random
import re
from itertools import permutations

from fleetlake.llm import filter_audit as fa

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def plain(rows, labels):
    """By the definition: each order's filters one after the other over the documents of each part."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, *_ in rows:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    docs = {}
    for d, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, bad in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                                               bool(re.search("[#$%&*|]", text)), d is not None and d > least[text])) if bad}
        docs.setdefault(source or "", []).append((d, fails))
    out = []
    for part, some in docs.items():
        rows_of = []
        for order in permutations("ABCDE"):
            left = some
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                rows_of.append([part, "".join(order), step, len(left), len(gone), sum(f in x[1] for x in some) - len(gone), sum(x[1] == {f} for x in some),
                                sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)])
        total = {f: sum(r[4] for r in rows_of if r[1][r[2] - 1] == f) for f in "ABCDE"}
        out += [(*r, total[r[1][r[2] - 1]]) for r in rows_of]
    return sorted(out)


def audit(spark, documents, rows, labels):
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return sorted(tuple(r[c] for c in COLUMNS) for r in fa.filter_audit(documents(rows), frame).collect())


def test_every_order(spark, documents):
    rnd = random.Random(1)

    def text():
        words = [rnd.choice("abcdefgh") * rnd.randint(1, 3 if rnd.random() < .5 else 60) for _ in range(rnd.choice([3, 150, 199, 200, 260]))]
        return rnd.choice(["", "# ", "A" * 9]) + rnd.choice([" ", "\n", "   "]).join(words) + rnd.choice(["", "|"])
    texts = [text() for _ in range(12)]
    rows = [(i, rnd.choice(texts), "en", rnd.choice(["a", "b", None, "hot", "hot", "hot"])) for i in range(60)]
    rows += [(None, texts[0], "en", "a"), (None, texts[0], "en", "a"), (3, None, "en", "a"), (90, "", "en", "z"), (91, "word " * 30_000, "en", "z")]
    rows += [(0, rows[0][1], "en", rows[0][3]), (0, rows[0][1], "en", "elsewhere")]                 # a repeated id, here and in another part
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(50)] + [(3, 1, 1), (3, 0, 1), (None, 1, 1)]
    assert audit(spark, documents, rows, labels) == plain(rows, labels)


def test_empty(spark, documents):
    assert audit(spark, documents, [], []) == []
    assert len(audit(spark, documents, [(1, "x", "en", None)], [])) == 600


def test_ranks_are_lexicographic_places():
    assert [fa.rank_of("".join(p)) for p in permutations("ABCDE")] == list(range(120))
    for mask in range(1, 32):
        of_mask = [x for x in fa.removal_intervals() if x[0] == mask]
        assert sum(stop - start for _, _, start, stop in of_mask) == 120       # every order removes it once


def test_code_points_not_bytes():
    assert fa.text_mask("éééA".encode(), 4) >> 2 & 1 and not fa.text_mask(("é" * 50 + "A").encode(), 51) >> 2 & 1
