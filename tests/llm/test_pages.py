import pytest

from pricelens.llm.pages import extract_pages, parse_page, templates


def text(page):
    return "\n\n".join(parse_page(page)[0])


def test_article_without_boilerplate():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
    <body class="home"><nav><ul><li><a href="/a">a</a></ul></nav><div class="ad">buy</div><div id="cookie-notice">ok</div>
    <article class="post"><header>By X</header><h1>Title &amp; more</h1><p><b>One<br>two<p>Three  &lt;b&gt;
    4&nbsp;&#53;</p><form><input value="x>y">mail</form><aside>see also</aside><ul><li>i<li>j</ul>
    a < b and c<d e</div> tail<section class="comments"><article>me too</article></section></article>
    <footer>&copy; z</footer>"""
    assert text(page).split("\n\n") == ["Title & more", "One two", "Three <b> 4 5", "i", "j", "a < b and c tail"] \
        or text(page).startswith("Title & more\n\nOne two\n\nThree <b> 4 5\n\ni\n\nj\n\na < b and c")
    for gone in ("buy", "ok", "mail", "see also", "me too", "©", "By X", "var t"):
        assert gone not in text(page)


def test_odd_markup():
    assert text("") == "" and text("plain & simple") == "plain & simple"
    assert text("<p>a</b></i>b</div>c") == "abc"
    assert text("<!-- <p>x</p> -->y<!-- open") == "y"
    assert text("<p class='a>b'>x</p>") == "x"
    assert text('<p class="open>x</p>y') in ("x\n\ny", "xy", "y")
    assert text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert text("<table><tr><td>a<td>b<tr><td>c</table>") == "a b\n\nc"
    assert text("<script>never closed <p>x") == ""
    assert text("<main><p>in</p></main><p>out</p>") == "in"


def test_templates_of_a_host_are_deleted(spark):
    bar = '<div><div class="x1">Top stories of the day</div><span>Weather</span></div>'
    page = lambda host, i: (i, f"http://{host}/{i}", f"<body>{bar}<div><p>Story number {i}</p></div></body>")
    rows = [page("big.example", i) for i in range(30)] + [page("small.example", 100 + i) for i in range(3)]
    got = {r["pid"]: r["text"] for r in extract_pages(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story number {i}" for i in range(30))
    assert all(got[100 + i] == f"Top stories of the day\n\nWeather\n\nStory number {100 + i}"
               or got[100 + i].endswith(f"Story number {100 + i}") for i in range(3))
    assert "Weather" in got[100]


def test_copied_articles_are_content(spark):
    rows = [(i, "http://h.example/a", "<article><h1>Same</h1><p>Same text</p></article>") for i in range(40)]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"Same\n\nSame text"}


def test_odd_rows_and_empty_table(spark):
    rows = [(1, None, None, 1), (1, None, None, 1), (None, "u", "<p>a</p>", 1), (2, "no host", "", 1),
            (3, "http://x/y", "<article>" + "word " * 200_000 + "</article>", 1), (3, "http://x/y", "<p>b", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = sorted(((r["pid"], r["url"], len(r["text"])) for r in extract_pages(df).collect()), key=str)
    assert got == sorted([(1, None, 0), (1, None, 0), (None, "u", 1), (2, "no host", 0),
                          (3, "http://x/y", 999_999), (3, "http://x/y", 1)], key=str)
    assert extract_pages(df.where("false")).count() == 0


def texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["pid"]: r["text"] for r in extract_pages(pages).collect()}


def test_inserts_that_recur_in_different_articles_go(spark):
    """A neutral box inside the article goes; copied articles keep everything else."""
    box = '<div class="x17"><p>Get our letter every week</p></div>'
    page = lambda i, body: (i, f"http://h.example/{i}", f"<article><p>{body}</p>{box}<p>End of {body}</p></article>")
    rows = [page(i, f"story {i}") for i in range(20)] + [page(100 + i, "a copied story") for i in range(20)]
    rows += [(200, "http://small.example/1", f"<article><p>alone</p>{box}</article>")]
    got = texts(spark, rows)
    assert all(got[i] == f"story {i}\n\nEnd of story {i}" for i in range(20))
    assert {got[100 + i] for i in range(20)} == {"a copied story\n\nEnd of a copied story"}
    assert got[200] == "alone\n\nGet our letter every week"


def test_different_pages_count_not_rows_or_shares(spark):
    """Without an article: copied pages keep their text, sections' menus go on a large host."""
    page = lambda i, menu, body: (i, f"http://h.example/{i}", f"<div>{menu}<p>{body}</p></div>")
    menu = lambda i: f"<div class=m><div>Menu of section {i % 6}</div></div>" if i < 120 else f"<div>teaser {i}</div>"
    rows = [page(i, menu(i), f"story {i}") for i in range(200)]
    rows += [page(300 + i, "<div>A copied start</div>", "and a copied end") for i in range(30)]
    got = texts(spark, rows)
    assert all(got[i] == f"story {i}" for i in range(120))
    assert all(got[i] == f"teaser {i}\n\nstory {i}" for i in range(120, 200))
    got = {i: got[200 + i] for i in range(100, 130)}
    assert {got[100 + i] for i in range(30)} == {"A copied start\n\nand a copied end"}


@pytest.mark.parametrize("others", [0, 3000])
def test_headings_and_sentences_that_articles_share_stay(spark, others):
    dish = lambda i: (i, f"http://h.example/{i}", f"<article><h1>Dish {i}</h1><h2>Ingredients</h2><ul><li>salt<li>item {i}</ul>"  # noqa: E731
                      f"<h2>Method</h2><p>Mix well.</p><p>Serve dish {i}</p></article>")
    rows = [dish(i) for i in range(8)] + [
        (100 + i, f"http://h.example/{100 + i}", f"<article><h1>Page {i}</h1><h2>Part {i}</h2><p>Text {i}</p></article>")
        for i in range(others)]
    got = texts(spark, rows)
    for i in range(8):
        assert got[i] == f"Dish {i}\n\nIngredients\n\nsalt\n\nitem {i}\n\nMethod\n\nMix well.\n\nServe dish {i}"


def test_names_that_tell_about_a_page_drop_nothing():
    assert text('<div class="layout with-sidebar"><article>a</article></div>') == "a"
    assert text('<article class="post no-comments">a</article>') == "a"
    assert text('<div class="page-header"><h1>x</h1><main class="widget">a</main></div>') == "a"
    assert text('<p class="sidebar">x</p><div class="sidebar"><article>card</article></div><p>long body</p>') == "long body"
    assert text('<div id="cookie-notice">x</div><div class="site-footer">y</div><div class="a-b">z</div>') == "z"
    assert text('<article>a<section class="comments"><article>me too</article></section></article>') == "a"


def test_the_zone_with_the_text_is_the_main_text():
    cards = "<main><h1>Title</h1><p>First paragraph</p><p>Second one</p><section><article>Card</article></section></main>"
    assert text(cards) == "Title\n\nFirst paragraph\n\nSecond one\n\nCard"
    assert text("<main><div>Home</div><article><h1>T</h1><p>long enough text</p></article></main>") == "T\n\nlong enough text"
    assert text("<p>A page of text that is much longer</p><p>than its card</p><article>x</article>").startswith("A page")


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a '" * 250_000, '<a "' * 250_000 + ">", "<!-" * 300_000, "</p " * 250_000, "<b>" * 200_000 + "<hr>" * 100_000,
    "<script>" + "</script " * 100_000, "<div>x" * 20_000, "<b>x</i>" * 100_000, "<li><b>" * 100_000, "<p>" * 200_000])
def test_time_grows_with_the_page_only(page):
    import time
    start = time.process_time()
    blocks, marks = parse_page(page)
    assert time.process_time() - start < 4.0 and len(marks) <= len(page) // 3 and len(blocks) <= len(page) // 3


def test_templates_equal_a_plain_count(spark):
    import random
    dice = random.Random(3)
    rows = [(dice.choice("ab"), dice.randrange(4), dice.randrange(12), dice.randrange(30)) for _ in range(1500)]
    got = {tuple(r) for r in templates(spark.createDataFrame(rows, "host string, path long, mark long, rest int"), 8).collect()}
    rests, want = {}, set()
    for host, path, mark, rest in rows:
        rests.setdefault((host, path, mark), set()).add(rest)
    for (host, path, mark), n in rests.items():
        at = [len(x) for (h, p, _), x in rests.items() if (h, p) == (host, path)]
        if len(n) >= 8 and 2 * sum(x for x in at if x >= 8) >= sum(at):
            want.add((host, path, mark))
    assert got == want and want
