import pytest
from pyspark.sql import functions as F

from larkspur.functions import selectors

PAGE = """<html><body><img class=img_thumb src=/before><button class="big btn_thumb"><span><img class="img_thumb x" src="/in"><br>Text</span></button>
<div id=a><p class="one two">First <b>bold</b></p><div><p lang=en-GB>Second</p></div></div><img class="img_thumb" src="/after">
<ul><li><a href="https://x.org/a.pdf">A</a><li><a name=n>B</a></ul><script>var p = "<p class=one>";</script></body></html>"""


def found(spark, page, selector, attribute=None):
    df = spark.createDataFrame([(page,)], "html string")
    column = selectors.select_attribute(F.col("html"), selector, attribute) if attribute else selectors.select_text(F.col("html"), selector)
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    ("selector", "attribute", "expected"),
    [
        ("button.btn_thumb .img_thumb", "src", ["/in"]),
        (".btn_thumb > .img_thumb", "src", []),
        ("button > span > img", "SRC", ["/in"]),
        ("img.img_thumb", "src", ["/before", "/in", "/after"]),
        ("img.img_thumb.x, #a p", "class", ["img_thumb x", "one two", None]),
        ("#a > p", None, ["First bold"]),
        ("div p", None, ["First bold", "Second"]),
        ("div div p, p.two.one", None, ["First bold", "Second"]),
        ("[lang|=en]", None, ["Second"]),
        ("a[href]", None, ["A"]),
        ("a[href^='https:'][href$=\".pdf\"][href*=org]", "href", ["https://x.org/a.pdf"]),
        ("li a[name=n], p[class~=two]", "name", [None, "n"]),
        ("* > b", None, ["bold"]),
        ("p p", None, []),
    ],
)
def test_selectors(spark, selector, attribute, expected):
    assert found(spark, PAGE, selector, attribute) == expected


def test_descent_forgets_closed_elements(spark):
    page = "<div class=a></div><p>no</p><div class=a><section><p>yes</p></section></div><p>no</p></div><p>no</p>"
    assert found(spark, page, "div.a p") == ["yes"]
    assert found(spark, page, "div.a > p") == []


def test_nested_matches_and_odd_pages(spark):
    assert found(spark, "<div>a<div>b</div>c</div>", "div") == ["a b c", "b"]
    assert found(spark, "<div>" * 500 + "x", "div div")[-1] == "x"
    assert found(spark, "", "p") == [] and found(spark, None, "p") is None
    assert found(spark, "</p></b><p>x", "p") == ["x"]


@pytest.mark.parametrize("bad", ["", "p >", "p,", "> p", "p:hover", "a[", "p..x", ".ap*"])
def test_unreadable_selectors_raise(bad):
    with pytest.raises(ValueError):
        selectors.compile_selector(bad)
