import time

import pytest

from aisleframe.llm.extraction import extract_pages, main_text, parse

PARAGRAPHS = [
    "This is the first paragraph of the story, with enough words to be one.",
    "A second paragraph &amp; more text follows here,\n  with   spaces and a <a href=x>link</a> inside it.",
    "Third and last: the end of the text is near, as they say."]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
LINES = [
    "Title", "This is the first paragraph of the story, with enough words to be one.",
    "A second paragraph & more text follows here, with spaces and a link inside it.",
    "Third and last: the end of the text is near, as they say."]
COMMENT = "<p>I like this very much, thank you for the article my friend, and so do all of my many friends.</p>"

PAGES = {
    "named divisions": f"<html><body><div id=header><h2>Site</h2><p>Welcome to the site of sites</p></div><div class='nav'><ul><li><a>Home</a>"
    f"<li><a>News</a></ul></div><div id=content><h1>Title</h1>{BODY}</div><div class=sidebar><h3>Popular</h3><ul><li><a href=a>One story</a>"
    f"</li></ul></div><div id='comments'>{COMMENT}{COMMENT}</div><div id=footer>All rights</div></body></html>",
    "sections": f"<body><header><h1>Site</h1></header><main><h1>Title</h1>{BODY}<section class='comments'><h2>Comments</h2>{COMMENT}</section>"
    f"<aside><p>Related</p></aside><form><input><p>Subscribe now</p></form></main><footer>x</footer>",
    "flat": f"<h1>Title</h1>{BODY}",
    "table": f"<table><tr><td><a>Home</a> <a>B</a><td><h1>Title</h1>{BODY}<td class=ad>Buy now</table>",
    "wrapped": f"<body><div class=wrap><div class=cookie-notice>{COMMENT}</div><div class=post><h1>Title</h1><div class=text>{BODY}</div></div>"
    "<div class='related-posts'><a>x story</a><a>y story</a></div></div>",
    "no names": f"<body><div><div><a href=1>Home</a> | <a href=2>About</a></div><div><h1>Title</h1>{BODY}</div><div>&copy; 2020</div></div></body>",
    "unclosed": f"<nav><ul><li><a>Menu</a></ul></nav><article><h1>Title<p>{PARAGRAPHS[0]}<p><b>{PARAGRAPHS[1]}<br><p>{PARAGRAPHS[2]}</article><footer>f</footer>",
    "scripts": f"<script>if(a<b){{x('</p>')}}</script><style>p{{}}</style><article><!-- <p>no</p> --><h1>Title</h1>{BODY}<script>1<2</script></article>",
    "title division": f"<div class=page-header><p>Site of many words</p></div><div class=post><div class='entry-header'><h1>Title</h1></div>{BODY}</div>",
    "comments in the article": f"<article><h1>Title</h1>{BODY}<div class='comment-list'>{COMMENT}</div></article>",
    "advert with unclosed tags": f"<div class=ad><p><b>Buy<p>now</div><article><h1>Title</h1>{BODY}</article>",
}


@pytest.mark.parametrize("name", PAGES)
def test_article_only(name):
    assert main_text(PAGES[name]).split("\n") == LINES


def test_blocks_and_references():
    assert main_text("<article><ul><li>one &lt;b&gt;<li>t&#119;o</ul><pre>a\n b</pre><p>x<br>y &amp z&am</article>") == "one <b>\ntwo\na b\nx y & z&am"
    assert main_text("just text &eacute;") == "just text é"
    for empty in ("", "<nav>a</nav>", "<p></p>", "<", "<!-- ", "<script>x"):
        assert main_text(empty) in ("", "<")


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "<p>inside here</p>" + "</div>" * 5000
    assert main_text(deep) == "inside here"
    long = "<article>" + "<p>word word word</p>" * 20000 + "</article>"
    assert main_text(long).count("\n") == 19999


def test_table(spark):
    rows = [(1, "u", PAGES["flat"], 1, "t"), (1, "u", PAGES["flat"], 1, "t"), (2, None, None, 2, None), (None, "v", "", 3, "z")]
    found = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long, text string")).collect()
    assert sorted((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in found) == sorted(
        [(1, "u", "\n".join(LINES), len("\n".join(LINES)))] * 2 + [(2, "", "", 0), (0, "v", "", 0)])
    assert found[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def paragraphs(name, n, words=50):
    return [f"{name}{k} " + "word " * words + f"end{k}" for k in range(n)]


SPLIT = {
    "equal": [("div", 4, 50), ("div", 4, 50)],
    "shorter ones": [("div", 4, 50), ("div", 3, 45), ("div", 4, 55), ("div", 2, 30), ("div", 1, 60)],
    "sections": [("section", 5, 60), ("section", 3, 40), ("section", 2, 12)],
    "inner ones": [("div><div", 3, 50), ("div", 4, 50), ("div><section", 4, 40)],
}


@pytest.mark.parametrize("name", SPLIT)
@pytest.mark.parametrize("heading", ["", "<h1>Title</h1>"])
@pytest.mark.parametrize("wrapped", [False, True])
def test_article_in_several_blocks(name, heading, wrapped):
    blocks, lines = [], ["Title"] if heading else []
    for i, (tag, n, words) in enumerate(SPLIT[name]):
        texts = paragraphs(f"b{i}p", n, words)
        close = "".join(f"</{t.strip('<')}>" for t in reversed(tag.split(">")))
        blocks.append(f"<{tag}><h2>Part {i}</h2>" + "".join(f"<p>{t}</p>" for t in texts) + close)
        lines += [f"Part {i}", *texts]
    article = f"{heading}<div>{''.join(blocks)}</div>" if wrapped else heading + "".join(blocks)
    menu = "".join(f"<a href={k}>Menu entry {k}</a> | " for k in range(12))
    page = f"<body><div>{menu}</div><div id=c>{article}</div><div><ul><li><a href=x>Some other story</a></ul></div><div>&copy; 2020 Example</div></body>"
    assert main_text(page).split("\n") == lines
    assert main_text(f"<body><div id=c>{article}</div></body>").split("\n") == lines


@pytest.mark.parametrize("attributes", [
    "class='content with-sidebar'", "class='has-header'", "class='post-12 post type-post tag-python category-menu'", "class=widget", "id=legal class=notice",
    "class='page-header'"])
@pytest.mark.parametrize("inner", ["", "<div class=text>"])
def test_names_around_the_article(attributes, inner):
    close = "</div>" if inner else ""
    page = f"<body><div class=nav><a href=x>Home</a></div><div {attributes}>{inner}<h1>Title</h1>{BODY}{close}<div class='comments'>{COMMENT * 5}</div></div><div id=footer>All rights</div></body>"
    assert main_text(page).split("\n") == LINES


@pytest.mark.parametrize("around", ["main", "article", "div"])
def test_divisions_in_the_article_are_judged_by_density(around):
    texts = paragraphs("p", 5, 40)
    inner = "".join(f"<p>{t}</p>" for t in texts)
    extra = "<div><a href=1>Home</a> <a href=2>News</a></div>", "<div>Sign up for our letter!</div>"
    page = f"<body><{around}>{extra[0]}<div><h1>Title</h1>{inner}</div>{extra[1]}</{around}><footer>f</footer></body>"
    assert main_text(page).split("\n") == ["Title", *texts]


def test_divisions_of_the_article_stay():
    texts = paragraphs("p", 5, 40)
    inner = "".join(f"<p>{t}</p>" for t in texts)
    for tag in ("article", "main"):
        page = f"<{tag}><h1>Title</h1><div>{inner}</div><ul><li>one<li>two</ul><section><h2>End</h2><p>A last remark of a few words here.</p></section></{tag}>"
        assert main_text(page).split("\n") == ["Title", *texts, "one", "two", "End", "A last remark of a few words here."]
        page = f"<{tag}>" + "".join(f"<div>{t}</div>" for t in (*texts, "Short <b>one</b>.")) + f"</{tag}>"
        assert main_text(page).split("\n") == [*texts, "Short one."]


@pytest.mark.parametrize("around", ["main", "div"])
def test_two_articles(around):
    first, second = paragraphs("a", 4, 50), paragraphs("b", 3, 45)
    article = lambda ts: "<article>" + "".join(f"<p>{t}</p>" for t in ts) + "</article>"
    teasers = "<article><h3>Other story</h3><p>Some words of it.</p></article>" * 2
    page = f"<nav>n</nav><{around}>{article(first)}{article(second)}{teasers}</{around}><footer>f</footer>"
    assert main_text(page).split("\n") == [*first, *second]


def test_forms_around_the_page():
    controls = "<input name=q><select><option>One<option>Two</select><button>Search now</button><label>Your name</label><textarea>t</textarea>"
    small = "<form><input><p>Subscribe now</p></form>"
    for inside in (f"{controls}<div><h1>Title</h1>{BODY}</div>", f"<fieldset class=widget><div><h1>Title</h1>{BODY}</div>{controls}</fieldset>"):
        assert main_text(f"<body><form id=aspnetForm method=post><div class=nav><a>Home</a></div>{inside}</form>{small}</body>").split("\n") == LINES
    assert main_text("<form><nav>a b c</nav></form>") == ""


@pytest.mark.parametrize("many", ["<b>{}</i>", "<nav><b>{}</i>", "<b>{}<p>x"])
def test_many_stray_tags(many):
    opened, stray = many.split("{}")
    page = f"<div>{opened * 200_000}{stray * 200_000}</div>"
    began = time.perf_counter()
    parse(page)
    assert time.perf_counter() - began < 20  # the square of the number would take hours
