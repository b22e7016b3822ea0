import pytest
from pyspark.sql import functions as F

from adlake.functions import binning, scalar, sets, vocab


def values(spark, data, schema, *columns):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*columns).collect()]


def test_fixed_lists():
    assert (len(vocab.TOP_COUNTRIES), len(vocab.TOP_MAKES), len(vocab.TOP_MODELS)) == (10, 27, 100)
    assert "tecno mobile limited" in vocab.TOP_MAKES and "iphone9,3" in vocab.TOP_MODELS


def test_text_defaults(spark):
    got = values(
        spark, [(None,), ("",), (" ",), ("US",), ("US 1.2",)], "c string",
        scalar.empty_to("c"), scalar.us_or("c", "Other"), scalar.major_version("c"), scalar.top_country("c"),
    )
    assert got == [
        ("##empty##", "Other", "-1", "others"),
        ("##empty##", "Other", "-1", "others"),
        (" ", "Other", "", "others"),
        ("US", "US", "US", "us"),
        ("US 1.2", "Other", "US", "others"),
    ]


def test_null_logic_of_value_group(spark):
    data = [("US", "video", 11.0), ("US", "video", 10.0), ("US", "video", 0.0), ("US", "video", None),
            (None, "video", 11.0), (None, "banner", 11.0), ("US", None, 3.0), ("IN", None, 3.0)]
    got = values(spark, data, "c string, a string, p double", scalar.device_value_group("c", "a", "p"))
    assert [g[0] for g in got] == ["high", "low", "unknown", "unknown", "high", "all", "low", "all"]


def test_clamp_keeps_null_and_allowed_falls_back(spark):
    got = values(
        spark, [(None,), (-5.0,), (3.0,), (99.0,)], "x double",
        scalar.clamp(F.col("x"), 0.0, 10.0), scalar.only_allowed(F.col("x"), [3.0], -1.0),
    )
    assert got == [(None, -1.0), (0.0, -1.0), (3.0, 3.0), (10.0, -1.0)]


def test_flags_ratio_and_offset(spark):
    got = values(
        spark, [(True, 2.0, 0.0), (False, 2.0, 4.0), (None, None, -1.0)], "b boolean, n double, d double",
        scalar.flag_text("b"), scalar.ratio_or_zero("n", "d"), scalar.offset_capped("n", 1, 2.5), scalar.positive("n"),
    )
    assert got == [("1", 0.0, 2.5, 1), ("0", 0.5, 2.5, 1), ("0", 0.0, None, 0)]


def test_pick_by_skips_absent_columns(spark):
    df = spark.createDataFrame([("banner", 1.0), ("native", 2.0), (None, 3.0)], "placement_type string, var_hbedsp_highest_price_banner7d double")
    out = df.select(scalar.pick_by("placement_type", vocab.PRICE_VARIANCE_COLUMNS, df.columns))
    assert [r[0] for r in out.collect()] == [1.0, 0.0, 0.0]
    assert df.select(scalar.pick_by("placement_type", {"x": "y"}, df.columns)).first()[0] == 0.0


def test_keys_and_codes(spark):
    got = values(
        spark, [("a", None), (None, 2)], "x string, y int", scalar.feature_key(["x", "y"]),
        scalar.translate_code("x", {"a": "A"}), scalar.translate_code("x", {}),
    )
    assert got == [("a||__NULL__", "A", "a"), ("__NULL__||2", None, None)]


def test_token_id_is_stable_and_positive(spark):
    df = spark.createDataFrame([("x", 5, 2.0), (None, None, float("nan"))], "s string, i int, d double")
    got = df.select(scalar.token_id("s", "string"), scalar.token_id("i", "int"), scalar.token_id("d", "double")).collect()
    assert got[0][0] > 0 and got[0][0] < 1 << 62 and tuple(got[0])[1:] == (5, 2)
    assert tuple(got[1]) == (0, 0, 0)


def test_preset_labels(spark):
    assert binning.range_labels(vocab.PRICE_BOUNDS) == ["(0,1]", "(1,2]", "(2,4]", "(4,8]", "(8,16]", ">16"]
    assert binning.range_labels(vocab.PRICE_VARIANCE_BOUNDS)[0] == "(0,0.001058551445165888]"
    got = values(
        spark, [(None,), (0.0,), (-1.0,), (1.0,), (1.01,), (17.0,)], "x double", binning.price_bin("x"),
        binning.hour_gap_bin("x"), binning.fixed_bins("x", [0.0]),
    )
    assert [g[0] for g in got] == ["##empty##", "##empty##", "##empty##", "(0,1]", "(1,2]", ">16"]
    assert [g[1] for g in got][:4] == ["others", "others", "others", "(0,24]"]
    assert [g[2] for g in got] == ["unknown", "bucket_1", "bucket_1", "bucket_2", "bucket_2", "bucket_2"]


def test_generated_bounds():
    assert binning.even_bounds(10) == pytest.approx([-2.0, -1.5, -1, -0.5, 0, 0.5, 1, 1.5, 2.0])
    assert binning.share_bounds(4) == pytest.approx([0.5, 0.5**0.5, 0.75**0.5])
    with pytest.raises(ValueError):
        binning.even_bounds(1)
    with pytest.raises(ValueError):
        binning.label_bins("x", [1, 2], ["a"])


def test_jaccard_and_overlap(spark):
    data = [(["a", "b"], ["b", "c"]), ([], []), (["a"], [])]
    got = values(spark, data, "x array<string>, y array<string>", sets.jaccard("x", "y"), sets.overlap("x", "y"))
    assert got[0] == (pytest.approx(1 / 3), 0.5)
    assert got[1:] == [(0.0, 0.0), (0.0, 0.0)]
