import time

import pytest

from strata_spark.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- ad 1 --><div class="ad">Buy</div>
<article><h1>Head &amp; all</h1><p><b>First   line.<br><p>Second &lt;b&gt; <a href="/y">link</a> text goes on here.</p><form><input name=q>Send</form><p>Third,
 on two lines.</p><div class="comments"><p>Nice!</p></div></article><footer>&copy; host</footer></body></html>"""
TEXT = "Head & all\nFirst line.\nSecond <b> link text goes on here.\nThird, on two lines."


@pytest.mark.parametrize("cut", ["", "</body></html>", "</article><footer>&copy; host</footer></body></html>"])
def test_one_page(cut):
    assert html.main_text(PAGE.removesuffix(cut), None) == TEXT


def test_odd_pages():
    assert html.main_text(None, None) == html.main_text("", "/x") == html.main_text("<p>  </p>", None) == ""
    assert html.main_text("just text &eacute;", None) == "just text é"
    assert html.main_text("<p>a<p>b</p>\n<p>c <3 d", None) == "a\nb\nc <3 d"
    assert html.main_text("<script>x", None) == "" and html.main_text("<p>one</p><div class='side", None) == "one"
    assert html.main_text("<p>" * 5000 + "deep", None) == "deep"
    assert html.main_text("<div>" * 3000 + "deep", None) == "deep"


def test_tags_that_are_odd():
    assert html.main_text("<article><p title=it's>One.<p title=\"a > b\">Two.</p><p data-x='1\">Three.</p></article>", None) == "One.\nTwo.\nThree."
    inside = "<p>Text.</p><div class='warning'>Mind the step.</div><figure><img src=x><figcaption>A caption.</figcaption></figure><div class='disclaimer'>No advice.</div>"
    assert html.main_text(f"<body><nav>menu</nav><article>{inside}</article></body>", None) == "Text.\nMind the step.\nA caption.\nNo advice."


@pytest.mark.parametrize("page", ["<a " * 100_000, "<a x=\"" * 100_000 + "<p>t", "<p>t" + "<b x='" * 50_001, "<div>" * 100_000 + "deep", "<div>x" * 100_000, "</b></x><i>" * 100_000, "<div class=a1><p>" * 50_000 + "</p></div></span></q>" * 50_000, "<svg>" * 30_000, "<!-- x" * 100_000, "<li><td>" * 50_000, "<p class='" + " " * 300_000])
def test_long_odd_pages_take_linear_time(page):
    began = time.process_time()
    html.main_text(page, "/html/body")
    html.votes(html.parse(page))
    assert time.process_time() - began < 20


@pytest.mark.parametrize("name", ["single-post right-sidebar", "no-sidebar", "layout-with-sidebar", "has-header-image", "header-fixed", "post comments-open", "sidebar"])
def test_names_that_describe_the_layout(name):
    inside = "<p>The text of the page goes on.</p><div class='ad-box big'>Buy</div><div id=comments>Nice!</div><figure><img src=x><figcaption>A caption.</figcaption></figure>"
    want = "The text of the page goes on.\nA caption."
    for tag in ("html", "body", "main", "article"):
        assert html.main_text(f"<{tag} class='{name}'>{inside}</{tag}>", None) == want, tag
    if not name.startswith(("header", "sidebar")):
        assert html.main_text(f"<body><div class='{name}'>{inside}</div></body>", None) == want


@pytest.mark.parametrize("opened", ["<div title=\"a hidden gem\">", "<div title='x hidden class=ad y'>", "<p data-note=\"is hidden here\">", "<div data-x=' id=sidebar'>", "<div class=story class=ads>", "<div CLASS=story hiddenx>", "<div class='x' data-hidden>",
    "<section id=social-impact>", "<section class='related-work'>", "<section class='shareholders-report'>", "<section class=navy>", "<section id=adventure>", "<div class='header-less comments-on-kant'>", "<section id=menus>", "<div aria-hidden=false>"])
def test_no_text_is_lost_by_quoted_words_or_like_names(opened):
    tag = opened[1:].split()[0].rstrip(">")
    page = f"<html><body><nav>Menu</nav><article><p>One.</p>{opened}Two.</{tag}><p>Three.</p></article></body></html>"
    assert html.main_text(page, None) == "One.\nTwo.\nThree."
    assert html.main_text(page, "/html/body/article") == "One.\nTwo.\nThree."
    alone = f"<html><body><nav>Menu</nav><article>{opened}Two.</{tag}></article></body></html>"
    assert html.main_text(alone, None) == "Two."


@pytest.mark.parametrize("opened", ["<div hidden>", "<div class='x' HIDDEN=''>", "<div class=\"big Ads\">", "<div id='comments'>", "<div role=navigation>", "<div class='a' id=\"cookie-notice\">", "<div class=ad class=story>", "<aside>", "<footer>", "<div title=\"it's\" class='sidebar'>"])
def test_what_goes(opened):
    tag = opened[1:].split()[0].rstrip(">")
    assert html.main_text(f"<body><article><p>One.</p>{opened}No.</{tag}><p>Two.</p></article></body>", None) == "One.\nTwo."


def test_an_article_has_its_own_header():
    page = "<body><header><h1>Site</h1></header><article><header class=header><h1>Title</h1><p>By me</p></header><p>Text of it.</p><footer>Filed</footer></article></body>"
    assert html.main_text(page, None) == "Title\nBy me\nText of it."


def test_attributes():
    assert html.attributes_of(" a=1 A=2 b = 'x y' c d=\"e=f g\" /h='i' j=") == {"a": "1", "b": "x y", "c": "", "d": "e=f g", "h": "i", "j": ""}


def test_ties_go_to_the_deeper_path():
    assert html.best({"/a/b": (5, 2), "/a": (5, 1), "/z": (4, 9)}) == "/a/b"
    assert html.best({"/b": (5, 1), "/a": (5, 1)}) == "/a" and html.best({}) is None
    deep = "<div class='" + "x" * 200 + "'>"
    page = html.parse(f"<body>{deep}{deep}<section><p>All of the text.</p></section></div></div></body>")
    by_path = html.votes(page)
    win = html.best(by_path)
    assert win.startswith("#") and by_path[win][1] == max(d for _, d in by_path.values()) and html.main_text(f"<body>{deep}{deep}<section><p>All of the text.</p></section></div></div></body>", None) == "All of the text."


def test_votes_of_a_host_by_brute_force(spark):
    import random

    rng = random.Random(5)
    boxes = ["div.a", "div.b", "section.c", "main", "div.share-it"]

    def page():
        out, blocks = [], []
        for box in rng.sample(boxes, rng.randint(1, 5)):
            tag, _, name = box.partition(".")
            words = "w" * rng.choice([1, 5, 20, 20])
            out.append(f"<{tag} class='{name}'><p>{words}</p></{tag}>")
            blocks.append((box, words))
        return "<html><body>" + "".join(out) + "</body></html>", blocks

    hosts = {f"h{k}.example": [page() for _ in range(rng.randint(1, 6))] for k in range(30)}
    rows = [(i, f"https://{h}/{i}", source) for h, pages in hosts.items() for i, (source, _) in enumerate(pages)]
    got = {r.url: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    for h, pages in hosts.items():
        total = {}
        for _, blocks in pages:
            own = [(("/html/body/" + b).removesuffix("."), len(w), 3 if b == "main" else 2) for b, w in blocks if b != "div.share-it" or len(blocks) == 1]  # suspect, but for a page that has nothing else
            whole = sum(n for _, n, _ in own)
            for path, depth in (("/html/body", 2), ("/html", 1)):
                if whole:
                    total[path, depth] = total.get((path, depth), 0) + whole
            for path, n, weight in own:
                total[path, 3] = total.get((path, 3), 0) + n * weight
        win = min(total, key=lambda k: (-total[k], -k[1], k[0]))[0] if total else None
        for i, (_, blocks) in enumerate(pages):
            inside = [w for b, w in blocks if win in ("/html", "/html/body") or win == ("/html/body/" + b).removesuffix(".")]
            if inside or win is None:
                assert got[f"https://{h}/{i}"] == "\n".join(inside or [w for _, w in blocks])


def test_names_do_not_drop_a_whole_page():
    page = "<html><body><div id='header-fixed'><div class='story'><p>All of the text is in here.</p></div><nav>Menu</nav></div></body></html>"
    assert html.main_text(page, None) == "All of the text is in here."
    assert "/html/body/div/div.story" in html.votes(html.parse(page))
    assert html.main_text("<body><nav>Menu</nav><footer class='x'>Foot</footer></body>", None) == ""


@pytest.mark.parametrize("opened", ["<body>", "<body class=x>", "", "words ", "<img src=x>", "<link href=y><meta name=z><body>"])
def test_head_ends_without_its_end_tag(opened):
    page = html.parse(f"<html><head><title>t</title>\n<style>p {{}}</style>{opened}<div class='story'><p>The text of the page.</p></div></html>")
    assert [b[0] for b in page.blocks if not b[2]][-1] == "The text of the page." and not any("/head/" in p for p in page.paths)
    if "<body>" in opened:
        closed = html.parse("<html><head><title>t</title></head><body><div class='story'><p>The text of the page.</p></div></body></html>")
        assert html.best(html.votes(page)) == html.best(html.votes(closed))


@pytest.mark.parametrize("cut", ["<svg class='i'/>", "<svg/>", "<svg viewBox='0 0 1 1' />", "<svg>", "<select>", "<object data=x>", "<iframe src=x>", "<noscript>", "<template>"])
def test_text_after_what_is_not_closed(cut):
    name = cut.strip("</>").split()[0].strip("/")
    for rest in ("", f"<{name}>no text</{name}>", f"<{name}><{name}>no</{name}> text</{name}>", f"<script>'</{name}>'</script>"):
        assert html.main_text(f"<body><p>One.</p>{cut}<p>Two.</p>{rest}<p>Three.</p></body>", "/body") == "One.\nTwo.\nThree.", rest
    assert html.main_text("<body><p>One.</p>" + f"<{name}>" * 20_000 + "<p>Two.</p></body>", "/body") == "One.\nTwo."


def test_what_swallows_the_rest():
    for tag in ("script", "style", "title", "textarea"):
        assert html.main_text(f"<body><p>One.</p><{tag}>Two.", "/body") == html.main_text(f"<body><p>One.</p><{tag}><p>x</{tag} ></body>", "/body") == "One."
    assert html.main_text("<body><p>One.</p><svg><title/><style>a{}</style><g>no</g></svg><p>Two.</p></body>", "/body") == "One.\nTwo."


def test_hosts_agree(spark):
    body = "<html><body><div class='story7'><p>{}</p></div><div class='extra'><p>{}</p></div></body></html>"
    rows = [(i, f"http://A.example:80/{i}", body.format(f"The story number {i} is told at length here.", "Short words.")) for i in range(8)]
    rows += [(8, "http://a.example/8", body.format("Tiny.", "On this page the extra box is much longer than the story is.")), (9, None, None), (9, "odd", "<p>alone</p>"), (10, "http://b.example", body.format("Tiny.", "On this page the extra box is much longer than the story is."))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", pages_text())
    for most in (100, 0):
        got = html.extract(pages, broadcast_hosts=most)
        assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
        texts = {(r.page_id, r.url): (r.text, r.n_chars) for r in got.collect()}
        assert len(texts) == len(rows) and texts[8, "http://a.example/8"] == ("Tiny.", 5)
        assert texts[10, "http://b.example"][0].startswith("On this page") and texts[9, None] == ("", 0) and texts[9, "odd"] == ("alone", 5)
    assert html.extract(pages.where("false")).count() == 0


def pages_text():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = html.extract(pages).collect()
    for r in rows:
        inside = r.html.partition("<article>")[2].partition("</article>")[0]
        want = [w for w in (" ".join(x.split()) for x in plain(inside)) if w]
        assert r.text.split("\n") == want


def plain(source):
    """Brute force for this table's markup: blocks begin at h1 and p."""
    import html as entities
    import re

    return [entities.unescape(re.sub(r"<[^>]*>", "", re.sub("<br>", " ", x))) for x in re.split(r"</?(?:h1|p)>", source)]
