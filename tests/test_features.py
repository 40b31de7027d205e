import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.functions.text import attention_mask, token_window, words
from sluiceway.operators.features import FeatureTransformer, add_text_features, add_time_features, to_feature_rows
from sluiceway.operators.ranking import exact_order_statistics, exact_positions, repeat_row
from sluiceway.operators import features, ranking
from sluiceway.operators.profile import column_stats, describe, null_profile, numeric_histogram, value_counts
from sluiceway.operators.split import split, with_split


@pytest.fixture
def people(spark):
    rows = [(25, 50000.0, "A"), (30, 60000.0, "B"), (35, 70000.0, "A"), (40, 80000.0, "C"), (45, 90000.0, "B")]
    return spark.createDataFrame(rows, "age int, income double, category string")


def column(df, name, order):
    return [r[name] for r in df.orderBy(order).collect()]


def test_standard_scaler_uses_population_deviation(people):
    out = FeatureTransformer().add_scaler("age").fit_transform(people)
    expected = [-math.sqrt(2), -1 / math.sqrt(2), 0, 1 / math.sqrt(2), math.sqrt(2)]
    assert column(out, "age", "income") == pytest.approx(expected)


def test_minmax_scaler_and_other_names(people):
    for method in ("minmax", "anything"):
        out = FeatureTransformer().add_scaler("income", method).fit_transform(people)
        assert column(out, "income", "age") == pytest.approx([0, 0.25, 0.5, 0.75, 1])


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "a double, b double")
    out = FeatureTransformer().add_scaler("a").add_scaler("b", "minmax").fit_transform(df)
    assert [tuple(r) for r in out.collect()] == [(0.0, 0.0), (0.0, 0.0)]


def test_scalers_ignore_missing_values_and_do_not_clip(spark):
    train = spark.createDataFrame([(0.0,), (10.0,), (None,), (float("nan"),)], "x double")
    model = FeatureTransformer().add_scaler("x", "minmax").fit(train)
    out = model.transform(spark.createDataFrame([(20.0,), (None,)], "x double"))
    assert {r.x for r in out.collect()} == {2.0, None}


def test_label_encoder(people, spark):
    out = FeatureTransformer().add_encoder("category").fit_transform(people)
    assert column(out, "category", "age") == [0, 1, 0, 2, 1]
    assert dict(out.dtypes)["category"] == "bigint"


def test_label_encoder_nulls_booleans_and_unseen(spark):
    df = spark.createDataFrame([("b", True), (None, None), ("z", False)], "c string, f boolean")
    model = FeatureTransformer().add_encoder("c").add_encoder("f").fit(df)
    assert {(r.value, r.code) for r in model.label_table("c").collect()} == {("None", 0), ("b", 1), ("z", 2)}
    assert [r.value for r in model.label_table("f").orderBy("code").collect()] == ["False", "None", "True"]
    other = spark.createDataFrame([("q", True)], "c string, f boolean")
    with pytest.raises(Exception, match="unseen value in column c: q"):
        model.transform(other).collect()
    model.handle_unseen = "keep"
    assert model.transform(other).first().c == -1


def test_large_vocabularies_are_ranked_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(features, "SMALL_VOCABULARY", 10)
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("c"))
    codes = features.label_codes(df, "c").collect()
    assert [r.value for r in sorted(codes, key=lambda r: r.code)] == sorted(r.value for r in codes)
    assert sorted(r.code for r in codes) == list(range(1000))


def test_custom_steps_run_in_order_after_the_others(people):
    model = FeatureTransformer().add_scaler("age", "minmax")
    model.add_custom("double", lambda df: df.withColumn("age_doubled", F.col("age") * 2))
    model.add_custom("add", lambda df: df.withColumn("more", F.col("age_doubled") + 1))
    assert column(model.fit_transform(people), "more", "income") == pytest.approx([1, 1.5, 2, 2.5, 3])


def test_transform_before_fit_raises(people):
    with pytest.raises(RuntimeError):
        FeatureTransformer().add_scaler("age").transform(people)
    with pytest.raises(RuntimeError):
        FeatureTransformer().add_encoder("category").transform(people)


def test_absent_columns_are_skipped(people):
    out = FeatureTransformer().add_scaler("nope").add_encoder("nothing").fit_transform(people)
    assert out.columns == people.columns


def test_text_features(spark):
    df = spark.createDataFrame([("hello world",), ("foo",), ("a\x1cb c d",), ("",), (None,), ("  x \n",), ("\U0001f600 y",)], "text string")
    out = [(r.text_len, r.word_count) for r in add_text_features(df).collect()]
    assert out == [(11, 2), (3, 1), (7, 4), (0, 0), (0, 0), (5, 1), (3, 2)]
    assert add_text_features(spark.range(1)).columns == ["id"]


def test_words_split_like_python(spark):
    text = "a".join(chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000)
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(words(F.col("text")).alias("w")).first().w == text.split()
    assert add_text_features(df).first().word_count == len(text.split())


def test_time_features(spark):
    rows = [(dt.datetime(2024, 1, 15, 10, 30),), (dt.datetime(2024, 6, 20, 18, 0),), (None,)]
    for kind in ("timestamp", "timestamp_ntz"):
        out = add_time_features(spark.createDataFrame(rows, f"created_at {kind}"))
        got = [tuple(r)[1:] for r in out.collect()]
        assert got == [(10, 0, 1), (18, 3, 6), (None, None, None)]


def test_feature_rows(spark):
    df = spark.createDataFrame([(7, 1.5, None, True, [1])], "id int, x double, s string, b boolean, a array<int>")
    row = to_feature_rows(df).first()
    assert (row.entity_id, row.feature_values) == ("7", '{"x":1.5,"b":true}')
    assert to_feature_rows(df.drop("id")).first().entity_id == "unknown"


def test_tokens_are_cut_padded_and_masked(spark):
    df = spark.createDataFrame([("a b c d",), ("x",), ("",)], "text string").select(words(F.col("text")).alias("t"))
    got = df.select(token_window(F.col("t"), 3).alias("w"), attention_mask(F.col("t"), 3).alias("m")).collect()
    assert [r.w for r in got] == [["a", "b", "c"], ["x", "[PAD]", "[PAD]"], ["[PAD]"] * 3]
    assert [r.m for r in got] == [[1, 1, 1], [1, 0, 0], [0, 0, 0]]


# ---- exact split --------------------------------------------------------------------------------


@pytest.mark.parametrize("rows, sizes", [(10, (8, 1, 1)), (19, (15, 1, 3)), (1, (0, 0, 1)), (0, (0, 0, 0)), (1000, (800, 100, 100))])
def test_split_sizes_are_exact(spark, rows, sizes):
    parts = split(spark.range(rows), id_col="id")
    assert tuple(p.count() for p in parts) == sizes


def test_split_is_a_repeatable_partition_of_the_rows(spark):
    df = spark.range(500)
    first = {r.id: r.split for r in with_split(df, id_col="id").collect()}
    again = {r.id: r.split for r in with_split(df.repartition(7), id_col="id").collect()}
    other = {r.id: r.split for r in with_split(df, id_col="id", seed=7).collect()}
    assert first == again and len(first) == 500 and first != other


def test_split_without_an_id_uses_the_whole_row(spark):
    df = spark.range(50).select((F.col("id") % 5).alias("a"), F.col("id").alias("b"))
    assert sorted(p.count() for p in split(df)) == [5, 5, 40]


def test_split_divides_equal_ids_and_complete_copies(spark):
    same_id = spark.range(19).select(F.lit(7).alias("id"), F.col("id").alias("v"))
    copies = spark.range(19).select(F.lit(7).alias("id"), F.lit("x").alias("v"))
    mixed = spark.range(19).select(F.lit(7).alias("id"), (F.col("id") % 3).alias("v"))
    moments = spark.range(19).select(F.lit(7).alias("id"), F.timestamp_micros(F.col("id")).alias("at"))
    for df in (same_id, copies, mixed, moments):
        out = with_split(df, id_col="id")
        assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 15, "val": 1, "test": 3}
        assert out.drop("split").exceptAll(df).count() == 0


def test_split_search_goes_deeper_when_prefixes_are_full(spark, monkeypatch):
    expected = {r.id: r.split for r in with_split(spark.range(300), id_col="id").collect()}
    monkeypatch.setattr(ranking, "BRACKET_ROWS", 0)
    assert {r.id: r.split for r in with_split(spark.range(300), id_col="id").collect()} == expected


def test_repeat_row_is_generated_in_blocks(spark):
    row = spark.createDataFrame([(1, "a")], "k int, t string")
    assert repeat_row(row, 25, block=10).groupBy("k", "t").count().first()["count"] == 25
    assert repeat_row(row, 0).count() == 0


# ---- ranks and profiles -------------------------------------------------------------------------


def test_positions_with_one_hot_group_and_ties(spark):
    rows = [("hot" if i % 3 else f"g{i % 5}", i // 50, i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, t int, i int")
    got = {r.i: r.pos for r in exact_positions(df, ["g"], ["t", "i"], partitions=6).collect()}
    seen: dict = {}
    for g, t, i in sorted(rows):
        assert got[i] == seen.get(g, 0)
        seen[g] = seen.get(g, 0) + 1


def test_positions_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "g string, i int")
    assert sorted((r.g or "", r.i, r.pos) for r in exact_positions(df, ["g"], ["i"]).collect()) == [("", 1, 0), ("", 2, 1), ("a", 1, 0)]


@pytest.mark.parametrize("limit", [5, 200_000])
def test_order_statistics_equal_a_sort(spark, monkeypatch, limit):
    monkeypatch.setattr(ranking, "BRACKET_ROWS", limit)
    draw = random.Random(3)
    values = [draw.choice([0.0, 1.0, draw.gauss(0, 1), 1e300, -1e-300, 5e-324]) for _ in range(700)]
    df = spark.createDataFrame([(v, float(i % 2)) for i, v in enumerate(values)], "x double, y double")
    wanted = [1, 2, 175, 350, 351, 525, 699, 700]
    stats = column_stats(df, ["x", "y"])
    got = exact_order_statistics(df, {"x": wanted, "y": [350, 351]}, stats)
    ordered = sorted(values)
    assert [got["x", r] for r in wanted] == [ordered[r - 1] for r in wanted]
    assert (got["y", 350], got["y", 351]) == (0.0, 1.0)


def test_order_statistics_take_few_rounds_whatever_the_spread(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BRACKET_ROWS", 3)
    draw = random.Random(5)
    values = [draw.choice([-1, 1]) * 10 ** draw.uniform(-300, 300) for _ in range(400)] + [5e-324, 1e-323, 1.5e-323, 0.0, 0.0]
    near = 1.0
    for _ in range(50):
        near = math.nextafter(near, 2)
        values.append(near)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rounds = []
    plain = ranking.zoom_bin
    monkeypatch.setattr(ranking, "zoom_bin", lambda bins: rounds.append(1) or plain(bins))
    wanted = list(range(1, len(values) + 1, 13))
    got = exact_order_statistics(df, {"x": wanted}, column_stats(df, ["x"]))
    assert [got["x", r] for r in wanted] == [sorted(values)[r - 1] for r in wanted]
    assert len(rounds) <= 8


def test_describe_matches_numpy(spark):
    values = [3.5, 1.0, 9.25, 4.0, 4.0, 7.0]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double")
    row = describe(df).first()
    assert row["count"] == 6 and row.mean == pytest.approx(np.mean(values)) and row.std == pytest.approx(np.std(values, ddof=1))
    assert [row["min"], row.p25, row.p50, row.p75, row["max"]] == pytest.approx(np.quantile(values, [0, 0.25, 0.5, 0.75, 1]).tolist())


def test_histogram_matches_numpy(spark):
    draw = random.Random(1)
    values = [round(draw.uniform(0, 3), 1) for _ in range(400)]
    df = spark.createDataFrame([(v, 2.0) for v in values], "x double, c double")
    rows = numeric_histogram(df).collect()
    counts, edges = np.histogram(values, bins=30)
    got = sorted((r.bin, r.rows, r.lower) for r in rows if r.column == "x")
    assert [g[1] for g in got] == counts.tolist()
    assert [g[2] for g in got] == pytest.approx(edges[:-1].tolist())
    assert {r.bin: r.rows for r in rows if r.column == "c" and r.rows} == {15: 400}


def test_value_counts_and_null_profile(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("a", float("nan")), (None, 2.0)], "label string, x double")
    assert [tuple(r) for r in value_counts(df, "label").collect()] == [("a", 2, 0.667), ("b", 1, 0.333)]
    assert [tuple(r) for r in null_profile(df).collect()] == [("x", 50.0), ("label", 25.0)]
