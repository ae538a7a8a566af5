import corpus_pipeline as pipeline
from helpers import documents, odd_texts, prose

from rosterloom.llm import packing


def test_stages_take_effect(spark, tmp_path):
    copy = prose(120, 50)
    near = copy.split()
    near[60] = "other"
    passage = prose(25, 60)
    texts = [prose(60, 100 + i) + "." for i in range(120)]
    for i in range(0, 120, 4):
        texts[i] = " ".join(["BUY!!", "###"] * 20)
    texts += [copy, " ".join(near), copy, prose(30, 61) + " " + passage + " " + prose(30, 62),
              prose(40, 63) + " token=zQ9xLm3RtYw81kPd " + prose(20, 64)] + odd_texts()
    folder = str(tmp_path)
    spark_docs = documents(spark, texts)
    spark_docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(120)],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")

    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for number, (name, stage) in enumerate(pipeline.STAGES):
        result = stage(spark, docs, folder)
        result.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if name != "packing":
            assert sorted(docs.columns) == sorted(spark_docs.columns)
            seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = set(seen["quality"])
    assert not kept & set(range(0, 120, 4)) and set(range(1, 120, 4)) <= kept
    assert {120, 121, 122} <= kept and len({120, 121, 122} & set(seen["near_duplicates"])) == 1
    assert 123 in seen["near_duplicates"] and 123 not in seen["benchmark"]
    assert set(seen["secrets"]) == set(seen["benchmark"])
    assert "zQ9xLm3RtYw81kPd" not in seen["secrets"][124] and "[SECRET]" in seen["secrets"][124]
    rows = docs.toPandas()
    tokenizer = packing.Tokenizer()
    assert set(rows.doc_id) == set(seen["secrets"])
    assert rows.length.sum() == sum(len(tokenizer.full_ids(t or "")) + 1
                                    for t in seen["secrets"].values())


def test_run_returns_the_last_stage(spark):
    rows = pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and "sequence_id" in rows.columns
