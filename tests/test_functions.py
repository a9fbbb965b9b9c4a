import pytest
from pyspark.sql import functions as F

from larkspur.functions import binning, markup, numeric, text, vectors
from larkspur.operators import features


def values(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def numbered(spark, items, kind):
    return spark.createDataFrame(list(enumerate(items)), f"i int, v {kind}")


def test_safe_ratio_is_null_on_zero_divisor(spark):
    df = spark.createDataFrame([(0, 1.0, 0), (1, 0.0, 0), (2, None, 2), (3, 6.0, 3)], "i int, a double, b int")
    assert values(df, numeric.safe_ratio(F.col("a"), F.col("b"))) == [None, None, None, 2.0]


def test_threshold_is_inclusive(spark):
    df = numbered(spark, [0.39, 0.4, 0.41], "double")
    assert values(df, numeric.threshold_label(F.col("v"), 0.4)) == [0, 1, 1]


def test_portable_hash_matches_plain_arithmetic(spark):
    keys = [0, 1, 17, 2**31, 2**62, -5]
    expected = [(((k % 2147483647) * 48271 + 42) % 2147483647) * 16807 % 2147483647 for k in keys]
    assert values(numbered(spark, keys, "long"), numeric.portable_hash(F.col("v"))) == expected


def test_age_intervals_close_on_the_right_and_take_the_lowest(spark):
    df = numbered(spark, [-1, 0, 30, 31, 60, 61, 100, 101, None], "int")
    found = values(df, binning.interval_ordinal(F.col("v"), features.AGE_CUTS, include_lowest=True))
    assert found == [None, 0, 0, 1, 3, 4, 4, None, None]
    ranked = features.add_age_rank(df.withColumnRenamed("v", "age"))
    assert values(ranked, "risk_age_rank")[1:4] == ["30대이하", "30대이하", "30대"]


def test_tenure_intervals_leave_out_the_lowest(spark):
    df = numbered(spark, [0, 1, 1, 3, 10], "int").withColumnRenamed("v", "tenure")
    found = values(features.add_tenure_band(df), "tenure_band")
    assert found == [None, "1년", "1년", "3년", "10년"]


def test_labels_must_fit_cuts():
    with pytest.raises(ValueError):
        binning.interval_label(F.lit(1), [0, 1, 2], ["a"])


def test_histogram_edges_close_on_the_left_except_the_last(spark):
    df = numbered(spark, [5.0, 10.0, 19.9, 20.0, 90.0, 95.0], "double")
    found = values(df, binning.edge_bin(F.col("v"), list(range(10, 100, 10))))
    assert found == [None, 0, 0, 1, 7, None]


def test_equal_width_bins_of_a_constant_land_in_one_bin(spark):
    df = numbered(spark, [3.0, 3.0], "double")
    found = values(df, binning.equal_width_bin(F.col("v"), F.lit(3.0), F.lit(3.0), 4))
    assert len(set(found)) == 1 and found[0] in range(4)


def test_tokens_sentences_and_stripping(spark):
    df = numbered(spark, ["　 Hé llo-World 42! Next\nlast. ", "", "..."], "string")
    assert values(df, text.tokens(F.col("v"))) == [["hé", "llo", "world", "42", "next", "last"], [], []]
    assert values(df, text.sentences(F.col("v"))) == [["Hé llo-World 42", "Next", "last"], [], []]
    assert values(df, text.strip_text(F.col("v")))[0] == "Hé llo-World 42! Next\nlast."


def test_containment(spark):
    df = spark.createDataFrame([(0, ["a", "b", "a"], ["a"]), (1, [], ["a"])], "i int, p array<string>, w array<string>")
    assert values(df, text.containment(F.col("p"), F.col("w"))) == [0.5, 0.0]


def test_cosine_of_zero_or_missing_vectors_is_null(spark):
    df = spark.createDataFrame(
        [(0, [1.0, 0.0], [2.0, 0.0]), (1, [0.0, 0.0], [1.0, 0.0]), (2, None, [1.0, 0.0])],
        "i int, a array<double>, b array<double>",
    )
    assert values(df, vectors.cosine(F.col("a"), F.col("b"))) == [1.0, None, None]


def test_marked_region_is_first_and_shortest(spark):
    marker = "<!-- 조문정보 -->"
    page = f"x {marker} a\nb <!--조문정보--> c {marker}"
    df = numbered(spark, [page, f"only one {marker}", None], "string")
    assert values(df, markup.marked_region(F.col("v"))) == [f"{marker} a\nb <!--조문정보-->", None, None]


def test_background_url_forms(spark):
    styles = [
        "background-image:url(http://a/b.png)",
        "color:red;background-image: url('http://a/c.png')",
        'background-image:url("http://a/d.png");',
        "color:red",
        None,
    ]
    found = values(numbered(spark, styles, "string"), markup.background_url(F.col("v")))
    assert found == ["http://a/b.png", "http://a/c.png", "http://a/d.png", None, None]


def test_first_attribute_with_and_without_class(spark):
    page = '<img alt="x" src="/one.png"><img src="/two.png" class="big img_thumb"><div class="img_thumbs" src="/3">'
    df = numbered(spark, [page, "<p>none</p>"], "string")
    assert values(df, markup.first_attribute(F.col("v"), "img", "src")) == ["/one.png", None]
    assert values(df, markup.first_attribute(F.col("v"), "img", "src", "img_thumb")) == ["/two.png", None]
    assert values(df, markup.first_attribute(F.col("v"), "div", "src", "img_thumb")) == [None, None]


def test_class_blocks_follow_nesting(spark):
    page = (
        '<div class="pgroup"> <span> 제1조 </span><div class="lawcon"><b>A &amp; </b>\n B</div></div>'
        '<div class="pgroup"><p>no text class</p></div>'
        '<div class="x pgroup"><div class="lawcon">C<br>D</div></div>tail'
    )
    df = numbered(spark, [page, None, ""], "string")
    assert values(df, markup.class_blocks(F.col("v"))) == [["제1조A &B", "CD"], None, []]


def test_bare_angle_brackets_stay_in_their_text_node():
    page = '<div class="a"> a < b and 5 <개정 2020> x <b> c </b><!-- n --> d </div>'
    assert markup._read_blocks(page, "div", "a", None) == ["a < b and 5 <개정 2020> xcd"]
