"""Token counts and packing against the library and a plain best-fit."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fleetlake.llm import packing, queries
from fleetlake.llm.token_counts import lasting_cache, token_counts
from fleetlake.llm.tokenize import byte_level_counts, file_digest, space_free_ids

ALPHABET = [" ", "\n", "\t", "a", "é", "1", "!", "'s", "<|endoftext|>", " ", "́", "Σ", "\x1c", "\x85", " ", "中", "\r", "\0", "  ", "I", "<|startoftext|>", "İ", "e", ".", ",", "word"]


def _texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_units_give_the_librarys_ids(tokenizer):
    texts = _texts(4000, 1) + ["", " ", "a. b, c", "word. word, word!", "x" * 5000]
    byte, word = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    assert byte_level_counts(tokenizer("byte_bpe_50k.json"), pa.array(texts)) == [len(e) for e in byte.encode_batch(texts, add_special_tokens=False)]
    got = space_free_ids(tokenizer("word_bpe_49k.json"), pa.array(texts))
    assert got == [np.array(e.ids, "<u4").tobytes() for e in word.encode_batch(texts, add_special_tokens=False)]
    # a slice of a larger array, and a cache that overflows, change nothing
    assert space_free_ids(tokenizer("word_bpe_49k.json"), pa.array(["z", *texts])[1:50]) == got[:49]


def test_small_cache(tokenizer, monkeypatch):
    from fleetlake.llm import tokenize

    texts = [" ".join(f"w{i} x{j}." for j in range(30)) for i in range(20)]
    want = byte_level_counts(tokenizer("byte_bpe_50k.json"), pa.array(texts))
    monkeypatch.setattr(tokenize, "CACHE_UNITS", 10)
    tokenize._LOADED.clear()
    assert [byte_level_counts(tokenizer("byte_bpe_50k.json"), pa.array([t]))[0] for t in texts] == want
    tokenize._LOADED.clear()


def test_counts_and_cache(spark, documents, tokenizer, scratch):
    path = tokenizer("byte_bpe_50k.json")
    rows = [(1, "hello world"), (2, "hello world"), (3, None), (3, None), (None, ""), (4, "é\n\n x"), (5, "long " * 20_000)]
    lib = Tokenizer.from_file(path)
    want = sorted(((i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False))) for i, t in rows), key=str)

    def run(d):
        return sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts(d, path, scratch).collect()), key=str)
    assert run(documents(rows)) == want
    stored = spark.read.parquet(scratch).count()
    assert stored == len({t or "" for _, t in rows})  # equal texts were encoded once
    assert run(documents(rows)) == want and spark.read.parquet(scratch).count() == stored  # all hits: nothing appended
    assert run(documents([*rows, (9, "new")]))[-2:] != [] and spark.read.parquet(scratch).count() == stored + 1
    assert run(documents([])) == []
    # a second writer that stored the same digests, and one that died, change no result
    cache = f"{scratch}/tokenizer={file_digest(path)}"
    spark.read.parquet(cache).select("digest", "n_tokens").write.parquet(f"{cache}/call=other")
    spark.read.parquet(cache).select("digest").limit(2).write.parquet(f"{cache}/call=dead/_temporary/0")
    assert run(documents(rows)) == want


def test_the_query_finds_its_cache(spark):
    """The second call of the registered query encodes nothing."""
    sf = "/root/testdata/sf0.001"
    folder = lasting_cache(spark, sf)
    first = sorted(map(tuple, queries.op7_token_counts(spark, sf).collect()))
    stored = spark.read.parquet(folder).count()
    assert sorted(map(tuple, queries.op7_token_counts(spark, sf + "/").collect())) == first
    assert stored == spark.read.parquet(folder).count() == spark.read.parquet(f"{sf}/documents.parquet").selectExpr("coalesce(text, '') t").distinct().count()
    assert lasting_cache(spark, "/elsewhere") != folder


def _best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return sorted(gaps)


@pytest.mark.parametrize("seed", range(25))
def test_rounds_are_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 37, 64])
    lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 120))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    used: dict[int, list] = {}
    placed = {n: 0 for n in counts}
    for length, first, last, each, sequence, offset in packing.best_fit_rounds(counts, capacity):
        assert first == placed[length]
        placed[length] = last
        for r in range(last - first):
            used.setdefault(sequence + r // each, []).append((offset + r % each * length, length))
    assert placed == counts
    for pieces in used.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in used.values()) == _best_fit_decreasing(lengths, capacity)


def test_packing(documents, tokenizer):
    path = tokenizer("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    rows = [(i, " ".join(["word"] * n)) for i, n in enumerate([0, 1, 5, 9, 10, 19, 20, 21, 3, 3, 3, 7, 7])] + [(50, None), (51, ""), (51, ""), (None, "a b c")]
    ids = sorted([np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for _, t in rows], key=len)
    got = packing.pack_documents(documents(rows), path, capacity=10, with_ids=True).collect()
    assert sorted(sum((list(r["ids"]) for r in got), [])) == sorted(np.concatenate(ids).tolist())
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in got)
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))] and sum(n for _, n in pieces) <= 10
    assert len(by) == len(_best_fit_decreasing([r["length"] for r in got], 10))
    assert packing.pack_documents(documents([]), path).count() == 0
