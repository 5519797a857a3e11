"""Streams on a few files, run to the end."""

from pyspark.sql import functions as F

from glossmill.streaming import lifecycle


def stream(spark, tmp_path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).parquet(str(tmp_path / "in"))


def finished(df, name, mode):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return df.sparkSession.table(name)


def test_concept_status(spark, tmp_path):
    rows = [(1, "a", 0), (1, "a", 5), (1, "b", 9), (2, "a", 3), (3, "a", 1), (3, "b", 2), (3, "c", 3)]
    source = stream(spark, tmp_path, rows, "concept int, source string, at int").withColumn("ts", F.timestamp_seconds("at"))
    got = finished(lifecycle.concept_status(source), "status", "complete")
    assert {r.concept: r.status for r in got.collect()} == {1: "established", 2: "emerging", 3: "crystallized"}


def test_turn_signal(spark, tmp_path):
    source = stream(spark, tmp_path, [(1, 0, "The duty of the house"), (1, 1, "")], "conv_id int, turn int, text string")
    tiers = spark.createDataFrame([("the", 1), ("of", 1), ("house", 2)], "word string, tier int")
    got = {r.turn: (r.n_words, r.common, r.domain, r.signal) for r in finished(lifecycle.turn_signal(source, tiers, ["duty"]), "turns", "append").collect()}
    assert got == {0: (5, 4, 1, 0.25), 1: (0, 0, 0, 0.0)}


def test_append_new(spark, tmp_path):
    source = stream(spark, tmp_path, [("a", 0), ("a", 1), ("b", 2)], "phrase string, at int").withColumn("ts", F.timestamp_seconds("at"))
    lifecycle.append_new(source, ["phrase"], str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination(120)
    assert sorted(r.phrase for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
