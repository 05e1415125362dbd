"""The pipeline: stages take effect, keep the columns of documents, and run() is their composition."""
import os
import random

import corpus_pipeline as cp
from fleetlake.llm.near_dedup import near_duplicates

SF = "/root/testdata/sf0.001"


def _tables(spark, folder, documents, benchmark, labels):
    documents.write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")


def test_planted(spark, scratch, documents, labels):
    rnd = random.Random(1)

    def words(n):
        return [f"w{rnd.randint(0, 3000)}" for _ in range(n)]
    clean = [(i, " ".join(words(120)) + ".") for i in range(60)]
    junk = [(100 + i, " ".join(w + "***" for w in words(60))) for i in range(30)]
    item, passage = words(25), words(70)
    copy = clean[5][1].split()
    copy[60] = "other"
    planted = [(200, " ".join(words(40) + item + words(40))), (201, " ".join(copy)), (202, clean[7][1]), (203, " ".join(words(50) + passage + words(50))), (204, " ".join(words(50) + passage + words(50))),
               (205, None), (205, None), (None, " ".join(words(90))), (8, clean[8][1])]
    known = [(i, 1, 0) for i, _ in clean[:40]] + [(i, 0, 0) for i, _ in junk[:20]]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    folder = os.path.join(scratch, "t")
    _tables(spark, folder, documents([*clean, *junk, *planted]), benchmark, labels(known))
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    first = docs.columns
    for name, stage in cp.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = sorted((r["doc_id"] for r in docs.collect()), key=str)
        if name != cp.STAGES[-1][0]:
            assert docs.columns == first
    good = {i for i, _ in clean}
    assert good <= set(kept["quality_classifier"]) and not {i for i, _ in junk} & set(kept["quality_classifier"])
    near = kept["minhash_near_dedup"]
    assert good <= set(near) and not {201, 202} & set(near) and near.count(8) == 1 and near.count(205) <= 1 and None in near
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/substring_dedup").collect()}
    assert " ".join(passage) in texts[203] and passage[30] not in texts[204].split() and len(texts[204].split()) in range(97, 101)
    assert all(texts[i] == t for i, t in clean)
    assert 200 not in kept["benchmark_decontamination"] and good <= set(kept["benchmark_decontamination"])
    assert set(kept["best_fit_packing"]) == set(kept["benchmark_decontamination"])
    assert sorted(map(tuple, cp.run(spark, folder).select("doc_id", "piece", "length", "ids_crc32").collect()), key=str) == \
        sorted(map(tuple, docs.select("doc_id", "piece", "length", "ids_crc32").collect()), key=str)


def test_given_tables(spark):
    out = cp.run(spark, SF)
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r["quality"] == 1}
    near = {r["doc_id"] for r in near_duplicates(docs, 5, 80).where("not kept").collect()}
    assert not ids & near and len(good & ids) > 0.75 * len(good - near)


def test_no_documents(spark, scratch, documents, labels):
    folder = os.path.join(scratch, "empty")
    _tables(spark, folder, documents([]), spark.createDataFrame([], "item_id bigint, text string"), labels([]))
    assert cp.run(spark, folder).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_a_stage_called_twice(spark, scratch, documents, labels):
    """Neither another call of a stage nor a whole run in between takes the files of a result that is not read yet."""
    rows = [(i, f"word{i % 7} " * 30 + f"end{i}.") for i in range(20)]
    folder = os.path.join(scratch, "twice")
    _tables(spark, folder, documents(rows), spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id bigint, text string"), labels([(1, 1, 0), (2, 0, 0)]))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one, two = (cp.near_duplicates(spark, docs, folder) for _ in range(2))
    ran = cp.run(spark, folder)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())) and ran.count() <= len(rows)
