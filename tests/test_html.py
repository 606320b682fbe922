"""Cleaning rules and the choice of content, on pages made here."""

import base64

import pytest

from sedge.html.clean import Options, Profile, clean, data_uri, object_key, page_title, precleaned
from sedge.html.tree import outermost, parse, select

LONG = "Tides rise and fall twice a day along this shore. " * 8


def body(html, **options):
    return precleaned(html, Options(**options), "d")[0].html()


@pytest.mark.parametrize("tag", ["script", "style", "noscript", "iframe", "template", "object", "form", "button", "nav"])
def test_noise_goes(tag):
    assert "gone" not in body(f"<p>kept</p><{tag}>gone</{tag}>") and "kept" in body(f"<{tag}>gone</{tag}><p>kept</p>")


def test_chrome_goes_but_within_the_content():
    html = body("<header>a1</header><article><header>a2</header><aside>a3</aside><footer>a4</footer></article><aside>a5</aside><footer>a6</footer>")
    assert [k for k in range(1, 7) if f"a{k}" in html] == [2, 3, 4]


@pytest.mark.parametrize("attrs", ['class="x sf-hidden"', "hidden", 'style="color:red; DISPLAY : none"', 'style="visibility:hidden"', "role=navigation", "role=banner", 'aria-modal="true"', 'class="yarpp-related"', 'class="promo"'])
def test_hidden_and_selected_elements_go(attrs):
    assert "gone" not in body(f"<div {attrs}><p>gone</p></div><p>kept</p>", extra_remove_selectors=(".promo",))


def test_attributes_and_comments():
    html = body('<p style="color:red" onclick="x()" id="k">a<!-- note --></p>')
    assert html == '<p id="k">a</p>'


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('a <script type="math/tex">x^2</script> b', "a $x^2$ b"),
        ('<script type="math/tex; mode=display"> y </script>', "$$y$$"),
        ('<span class="MathJax">drawn</span><p>t</p>', "<p>t</p>"),
        ('<span class="katex"><math><annotation encoding="application/x-tex">a_1</annotation></math><b>a1</b></span>', "$a_1$"),
        ('<div class="katex-display"><span class="katex"><math><annotation encoding="application/x-tex">b</annotation></math></span></div>', "$$b$$"),
        ('<mjx-container display="true" aria-label="c over d"><b>c</b></mjx-container>', "$$c over d$$"),
        ('<math display="block"><mi>e</mi></math>', "$$e$$"),
        ("<math> </math><p>t</p>", "<p>t</p>"),
    ],
)
def test_formulas(html, want):
    assert body(html) == want


def test_inline_data():
    payload = b"\x89PNG" + bytes(range(256)) * 20
    uri = "data:image/png;base64," + base64.b64encode(payload).decode()
    html = f'<article><h1>t</h1><p>{LONG}</p><img src="{uri}" alt="a"><img src="data:image/gif;base64,AAAA"><a href="data:x,{"y" * 5000}">l</a></article>'
    got = clean(html, Options(base_url="http://store/"), "My Book/ch 1")
    assert got.images == [(0, "images/html/My_Book/ch_1/img_0000.png", "image/png", payload)]
    assert 'src="http://store/images/html/My_Book/ch_1/img_0000.png"' in got.html and "gif" not in got.html and "data:" not in got.html
    assert "img src" not in clean(html, Options(export_images=False)).html.replace('<img alt="a">', "")
    assert data_uri("data:;base64,QUI=\n") == ("application/octet-stream", b"AB") and data_uri("data:image/png;base64,@@") is None and data_uri("data:image/png,x") is None
    assert object_key("/a b/é.x/") == "a_b/_x"


def test_titles_and_headings():
    assert page_title("<title>Neap &amp; spring — The Shore</title>") == "Neap & spring" and page_title("<title> One </title>") == "One" and page_title("<p>") == ""
    assert body('<h2>Moon <a href="#m">#</a>¶</h2>') == "<h2>Moon </h2>"
    got = clean(f"<title>Moon | Shore</title><article><p>{LONG}</p></article>")
    assert got.html.startswith("<h1>Moon</h1>\n<article>") and got.strategy == "article" and got.title == "Moon"
    assert not clean(f"<title>Moon</title><main><h1>Own</h1><p>{LONG}</p></main>").html.startswith("<h1>Moon")


def test_choice_of_content():
    assert clean(f"<div>menu</div><main><p>{LONG}</p></main>").strategy == "main"
    assert clean(f"<div role=main><p>{LONG}</p></div>").strategy == "[role=main]"
    assert clean(f"<article>short</article><div><div><p>{LONG}</p></div><div><a>link</a></div></div>").strategy == "densest"
    got = clean("<title>T</title><p>little</p>")
    assert got.strategy == "precleaned" and not got.html.startswith("<h1>") and got.text_chars == len("T little")
    site = Profile("shore", ".shore", ".tide", (".ad",))
    got = clean(f'<body class="shore"><div class="tide"><div class="tide"><p>{LONG}</p></div><p class="ad">buy</p></div><article>{LONG}</article></body>', Options(profiles=(site,)))
    assert got.strategy == "shore" and "buy" not in got.html and got.html.count("Tides rise") == 8
    assert clean(f"<article>{LONG}</article>", Options(profiles=(site,))).strategy == "article"
    assert clean("").text_chars == 0 and clean("<" * 50 + "&&#x;").strategy == "precleaned"


def test_selectors():
    top = parse('<div id=a class="x y"><p data-k="v1 v2"><b>1</b></p></div><ul><li>1<li>2</ul>')
    for text, n in {"div.x.y > p b": 1, "#a p, li": 3, "[data-k~=v2]": 1, "div > b": 0, "[data-k^=v1][data-k$=v2]": 1, "*": 6}.items():
        assert len(select(top, text)) == n, text
    assert len(outermost(select(parse("<p><i><i>a</i></i></p>"), "i"))) == 1
    with pytest.raises(ValueError):
        select(top, "a:hover")


def test_pages_on_a_table(spark):
    from sedge.operators.pages import clean_pages, media

    uri = "data:image/png;base64," + base64.b64encode(bytes(5000)).decode()
    rows = [(1, f"<article><p>{LONG}</p><img src='{uri}'></article>".encode() + b"\xff"), (2, None), (3, b""), (4, ("<div>" * 3000 + "x").encode())]
    got = {r.page_id: r for r in clean_pages(spark.createDataFrame(rows, "page_id long, html binary")).collect()}
    assert got[1].strategy == "article" and got[1].error is None and got[2].text == got[3].text == "" and got[4].text == "x"
    found = media(clean_pages(spark.createDataFrame(rows, "page_id long, html binary"))).collect()
    assert [(r.object_key, r.content_type, len(r.payload)) for r in found] == [("images/html/1/img_0000.png", "image/png", 5000)]


def test_references_that_are_cut_off(spark, tmp_path):
    from sedge.plans import catalogue

    cut = "Ebb &amp; flow &amp"
    page = f"<title>{cut}</title><!-- &amp --><script type='math/tex'>a &b</script><article><h1>{cut}</h1><p>{LONG}</p><a href='?a=1&copy=2'>R&D; &lt</a></article>"
    spark.createDataFrame([(1, page), (2, None)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    [got] = catalogue.queries()["html_main_content"](spark, str(tmp_path)).collect()
    text = f"Ebb & flow &amp {LONG.strip()} R&D; &lt"
    assert got == (1, "Ebb & flow &amp", text, len(text))
    assert catalogue.queries()["html_title"](spark, str(tmp_path)).first().title == got.title
    # elsewhere such references are read as browsers do, and formulas keep their signs either way
    assert clean(page).title == "Ebb & flow &" and all("$a &amp;b$" in body(page, complete_references=only) for only in (False, True))
