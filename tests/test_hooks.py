"""Hooks on Arrow batches, templates, aligned columns, CSV and model round trips."""

import math
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from promptwatt import constants as K
from promptwatt.operators import features as FT
from promptwatt.operators import hooks as H
from promptwatt.operators import ml as ML
from promptwatt.operators import rewrite as RW
from promptwatt.sources import io as IO

TEXTS = ["Running dogs quickly sleep.", "", None, "   ", "x", "doing doing doing", "naïve-ly größer 日本語", "long " * 3000]


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3)


def test_token_counter_sees_every_text_once_a_batch(spark):
    def count(values):
        assert len(set(values.to_pylist())) == len(values)
        return H.piece_counts(values)

    d = texts(spark).withColumn("text", F.coalesce("text", F.lit("")))
    many = d.unionByName(d).coalesce(1)
    got = FT.features(many, "text", token_counter=H.token_counter(count), max_tokens=512).collect()
    assert len(got) == 2 * len(TEXTS)
    for r in got:
        words = (TEXTS[r.id] or "").split()
        assert r.token_count == min(512, K.PIECE_SPECIALS + sum(math.ceil(len(w) / K.PIECE_CHARS) for w in words))


def test_token_counter_gives_nothing_for_null(spark):
    got = texts(spark).select("id", H.token_counter(H.piece_counts)(F.col("text")).alias("n")).collect()
    assert {r.id: r.n for r in got}[2] == 0 and {r.id: r.n for r in got}[1] == K.PIECE_SPECIALS


def test_tagger_sees_neighbours_and_ratios_follow(spark):
    def after_x(lists):  # a word after "x" is a verb, any other a noun
        return pa.array(["VB" if k and ws[k - 1] == "x" else "NN" for ws in lists.to_pylist() for k in range(len(ws))], pa.string())

    rows = [(1, ["x", "go", "x", "x"]), (2, []), (3, None), (4, ["a"])]
    d = spark.createDataFrame(rows, "id int, words array<string>").withColumn("tags", H.tagger(after_x)("words"))
    got = {r.id: r for r in d.collect()}
    assert [(t.token, t.tag) for t in got[1].tags] == [("x", "NN"), ("go", "VB"), ("x", "NN"), ("x", "VB")]
    assert got[2].tags == [] and got[3].tags == [] and len(got[4].tags) == 1
    out = {r.id: r for r in FT.features(d.withColumn("text", F.concat_ws(" ", "words")), "text", tags_col="tags").collect()}
    assert (out[1].noun_ratio, out[1].verb_ratio, out[2].noun_ratio, out[4].noun_ratio) == (0.5, 0.5, 0.0, 1.0)


def test_suffix_tags_of_words_and_of_none():
    words = pa.array([["quickly", "running"], [], ["dogs", "zz"]])
    assert H.suffix_tags(words).to_pylist() == ["RB", "VBG", "NNS", K.SUFFIX_REST]
    assert H.suffix_tags(pa.array([[], []], pa.list_(pa.string()))).to_pylist() == []


def test_templates_with_missing_values_and_unknown_categories(spark):
    rows = [("question", "Spark", None), ("comparison", None, "a"), ("none", "x", "y"), (None, "x", "y")]
    d = spark.createDataFrame(rows, "category string, topic string, item1 string")
    got = {r.category: r.prompt for r in RW.fill_template(RW.templates_table(spark), d).collect()}
    assert got == {"question": "Spark?", "comparison": "Compare a and {item2}.", "none": None, None: None}


def test_numeric_columns_and_alignment(spark):
    d = spark.createDataFrame([(1, 2, 3.5, "t", True), (2, None, 1.0, None, None)], "id int, a int, b double, s string, f boolean")
    names = ML.numeric_columns(d, exclude=("id",))
    assert names == ["a", "b"]
    out = ML.align_features(d, ["b", "missing", "a"])
    assert out.columns == ["id", "s", "f", "b", "missing", "a"]
    assert sorted(tuple(r[3:]) for r in out.collect()) == [(1.0, 0.0, 0.0), (3.5, 0.0, 2.0)]


def test_csv_round_trip_with_and_without_schema(spark, tmp_path):
    d = spark.createDataFrame([(1, 2.5, 'say "hi", you'), (2, None, "line\nbreak"), (3, 0.1, None)], "id int, v double, t string")
    path = str(tmp_path / "t")
    IO.write_csv(d.filter("id <> 2"), path)
    assert sorted(map(tuple, IO.read_csv(spark, path, d.schema).collect())) == sorted(map(tuple, d.filter("id <> 2").collect()))
    assert [f.dataType.simpleString() for f in IO.read_csv(spark, path).schema] == ["int", "double", "string"]
    IO.write_csv(d.filter("id = 1"), path)  # replaces
    assert IO.read_csv(spark, path, d.schema).count() == 1


def test_export_writes_the_whole_period_and_nothing_for_none(spark, tmp_path):
    log = spark.range(3000).select(F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("timestamp"), F.col("id").alias("n"))
    path = str(tmp_path / "all")
    assert IO.export_logs(log, path) == 3000 and IO.read_csv(spark, path).count() == 3000
    none = str(tmp_path / "none")
    assert IO.export_logs(log, none, start="2001-01-01", end="2001-01-02") == 0 and not os.path.exists(none)
    few = str(tmp_path / "few")
    assert IO.export_logs(log, few, limit=10) == 10
    assert {r.n for r in IO.read_csv(spark, few).collect()} == set(range(2990, 3000))  # the newest


def test_model_round_trip_predicts_alike(spark, tmp_path):
    d = spark.range(200).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"))
    d = d.withColumn("y", 3 * F.col("a") - F.col("b") + 1)
    model = ML.pipeline(["a", "b"], "y", kind="ridge").fit(d)
    IO.save_model(model, str(tmp_path / "m"))
    again = IO.load_model(str(tmp_path / "m"))
    want = {r.id: r.prediction for r in model.transform(d).collect()}
    got = {r.id: r.prediction for r in again.transform(d).collect()}
    assert got == pytest.approx(want)
