import time

import pytest

from larkspur.llm.pages import extract_pages, main_text

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site, name, and, more</h1></header><nav><ul><li><a href=/a>A</a></ul></nav>
<div class="ad">Buy, now, all, of, this, text, is, long, very, long</div><!-- <p>no</p> -->
<div id=wrap><article><h1>Head &amp; line</h1><p><b>One, two,
 three.<br><p>Four &lt; five&nbsp; six <a href="x>y">seven</a> eight, nine ten eleven twelve.<ul><li>a<li>b</ul></article>
<section id="comments"><p>Reader, says, hello, a lot, of, things, here, and, there</p></section>
<aside>Side, side, side</aside><form><p>Your, name, and, mail</p></form></div>
<div class="cookie-notice"><p>We, use, cookies, to, do, things</p></div><footer>&copy; 2020</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE) == "Head & line\nOne, two, three.\nFour < five six seven eight, nine ten eleven twelve.\na\nb"


def test_article_without_article_element_keeps_good_siblings():
    body = "<p>" + "Words of the story, with commas, go on and on. " * 4 + "</p>"
    page = f"<body><div class=menu>{body}</div><div class=c>{body}<h2>Next</h2>{body}</div><div><a href=1>one</a> <a href=2>two</a></div>"
    text = main_text(page)
    assert text.count("Words of the story") == 8 and "Next" in text and "one" not in text


def test_wrappers_of_the_whole_page_are_kept():
    body = "<p>" + "Words of the story, with commas, go on and on. " * 4 + "</p>"
    rest = "<div class=sidebar><p>Side, notes, of, the, site</p></div><form><p>Your, mail, please</p></form>"
    for wrapper in ("div class='page has-sidebar'", "div id='layout-no-footer'", "form id='aspnetForm'", "form role=form"):
        for inner in (f"<article>{body}{body}</article>", f"<div>{body}{body}</div>"):
            tag = wrapper.split()[0]
            text = main_text(f"<body><{wrapper}>{inner}{rest}</{tag}></body>")
            assert text.count("Words of the story") == 8, (wrapper, inner)
            assert "Side" not in text and ("Your" not in text or tag == "form")
    comments = f"<section id=comments>{body}{body}{body}</section>"
    assert main_text(f"<div class=has-sidebar><article><p>Short, but the story.</p></article>{comments}</div>") == "Short, but the story."


STORY = "<p>" + "The council met on Monday, the mayor said, and the bridge will be built. " * 3 + "</p>"
OTHER = "<p>" + "Readers, visitors, and others write, at length, about other things. " * 5 + "</p>"
#: Blocks that must not be in the text, whatever elements they are made of.
BESIDE = {
    "comments": f"<section id=comments>{f'<article class=comment-body>{OTHER}</article>' * 4}</section>",
    "comment texts": f"<div class=comment-list>{f'<div class=comment-content>{OTHER}</div>' * 3}</div>",
    "loose comments": f"<article class='comment even'>{OTHER}</article>" * 3,
    "sidebar": f"<div class=sidebar>{f'<article class=teaser>{OTHER}</article>' * 4}</div>",
    "promoted": f"<div class=promo>{f'<article>{OTHER}</article>' * 4}</div>",
    "footer": f"<div id=page-footer>{OTHER}</div>",
    "notice": f"<div class=cookie-notice>{OTHER}</div>",
    "advert": f"<div class='ad top'>{OTHER}</div>",
    "form": f"<form>{OTHER}</form>",
    "related": f"<div class=related-posts>{OTHER}{OTHER}</div>",
    "hidden": f"<div hidden>{OTHER}</div>",
}
FRAMES = [
    "{}", "<main>{}</main>", "<div class=has-sidebar>{}</div>", "<div id=layout-no-footer>{}</div>", "<div class='content-sidebar-wrap'><main>{}</main></div>",
]


@pytest.mark.parametrize("beside", BESIDE)
@pytest.mark.parametrize("frame", FRAMES)
def test_story_in_varied_layouts(frame, beside):
    for story in (f"<article>{STORY}</article>", f"<article class='post hentry'><h1>Title</h1>{STORY}{STORY}</article>"):
        text = main_text(f"<body>{frame.format(story)}{BESIDE[beside]}</body>")
        assert text.count("The council met") == story.count("The council met") and "Readers" not in text
        before = main_text(f"<body>{BESIDE[beside]}{frame.format(story)}</body>")
        assert before == text


def test_framing_forms_and_headers():
    for frame in ("form id=aspnetForm", "form role=form", "div class=banner", "div class=widget"):
        text = main_text(f"<{frame}><article>{STORY}</article><div class=sidebar>{OTHER}</div></{frame.split()[0]}>")
        assert text.count("The council met") == 3 and "Readers" not in text


def test_nothing_but_notices_is_empty():
    assert main_text("<ul class=menu><li><a href=1>A</a></ul><div class=cookie-notice><p>We use cookies, ok</p></div>") == ""
    assert main_text("<div class=comment>Only this</div>") == ""
    assert main_text("<form><p>Your, mail, please</p></form><footer>x</footer>") == ""


def test_many_stray_tags_take_linear_time():
    for piece in ("<b></i>", "</i><b>", "<b><div>", "<p><b></p>", "<li><b>"):
        start = time.perf_counter()
        main_text("<i><table><td><div>" + piece * 100_000 + "end")
        assert time.perf_counter() - start < 20


def test_odd_pages():
    cases = {None: "", "": "", "<": "<", "a<b": "a", "<p": "", "<!-- x": "", "plain & simple": "plain & simple", "<p>just text": "just text"}
    assert {k: main_text(k) for k in cases} == cases
    assert main_text("<div>" * 3000 + "deep" + "</p>" * 3000) == "deep"
    assert main_text("<p>" + "word, " * 200_000 + "</p>").count("word,") == 200_000
    assert main_text("<script>never closed") == ""


def test_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, "u", "<p>é</p>", "clash", 9), (1, "u", "<p>é</p>", None, None), (None, None, None, "x", 0)]
    found = sorted(map(tuple, extract_pages(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert found == [(1, "u", "é", 1), (1, "u", "é", 1), (None, None, "", 0)]
    assert extract_pages(spark.createDataFrame([], schema)).count() == 0
