"""Language identification: held-out accuracy, odd texts, inputs that must not matter."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import functions as F

from gridcast.llm.language import family, identify, language_of_documents, train

FOLDER = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(FOLDER)
    got = language_of_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.99 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_texts(spark):
    known = spark.read.parquet(FOLDER).select("doc_id", "text", "lang")
    model = train(known.limit(200))
    odd = [None, "", "12 34 -- 5", "🙂", "The of and that tion", "é", "x" * 3_000_000, "日本語"]
    docs = spark.createDataFrame([(i, t, "keep", i / 2) for i, t in enumerate(odd)], "doc_id long, text string, lang string, score double")
    got = {r["doc_id"]: r for r in identify(docs, model).collect()}
    assert [i for i in got if got[i]["_lang_pred"] == "und"] == [0, 1, 2, 3]
    assert got[4]["_lang_pred"] == "en" and got[4]["lang"] == "keep" and got[4]["score"] == 2.0
    assert identify(docs.limit(0), model).count() == 0


def test_inputs_of_a_prediction_are_texts_alone(spark):
    docs = spark.read.parquet(FOLDER).limit(300)
    model = train(docs)
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", -F.col("doc_id"))
    first = sorted((r["text"], r["_lang_pred"]) for r in identify(docs, model).collect())
    assert first == sorted((r["text"], r["_lang_pred"]) for r in identify(other, model).collect())


def test_few_languages(spark):
    none = train(spark.createDataFrame([(1, None, "en"), (2, "x", None)], "doc_id long, text string, lang string"))
    one = train(spark.createDataFrame([(1, "hello", "en")], "doc_id long, text string, lang string"))
    docs = spark.createDataFrame([(1, "hello")], "doc_id long, text string")
    assert [r["_lang_pred"] for r in identify(docs, none).collect()] == ["und"]
    assert [r["_lang_pred"] for r in identify(docs, one).collect()] == ["en"]
    assert family("de-AT") == family("en") != family("fr") and family("qq") != family("qr")
