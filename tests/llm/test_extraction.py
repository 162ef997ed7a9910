import html
import re
import time

import pytest
from terrace.llm.blocks import text_blocks
from terrace.llm.extraction import block_tree, extract_main_text, grow_tree, labelled_table, main_text

from terrace.llm.queries import QUERIES

PAGES = [
    (None, ""),
    ("", ""),
    ("   \n ", ""),
    ("plain text only", "plain text only"),
    ("<p>One  paragraph\twith&nbsp;words.</p><p>Two.</p>", "One paragraph with words.\nTwo."),
    (
        "<header><h1>Site</h1><nav><a href=/>Home</a></nav></header><main><article><header><h1>Headline</h1></header>"
        "<p>Body &amp; soul &eacute; with <a href=x>link</a> in it.</p><aside>Side</aside><p>More<br>text</p>"
        "<section id='comments'><article class='comment'><p>A reader says something long enough here</p></article>"
        "</section></article></main><footer>Foot</footer>",
        "Headline\nBody & soul é with link in it.\nMore text",
    ),
    (
        "<div class='content'><h2>Title</h2><p>Some words of the text.</p><div class='sidebar'><p>side text</p></div></div>"
        "<div class='cookie-banner'>We use cookies</div>",
        "Title\nSome words of the text.",
    ),
    ("<article><p>unclosed <b>bold<br><p>second<ul><li>one<li>two</ul>", "unclosed bold\nsecond\none\ntwo"),
    ("<div class='ad'>Buy now<article><p>story text</p></article>", "story text"),
    ("<article>x &lt;b&gt; y</article><script>if(a<b){}</script><!-- c --><style>p{}</style>", "x <b> y"),
    ("<article><form><input> <p>Enter mail</p></form><p title='a > b'>kept</p></article></div></p>", "kept"),
    ("<article><p>" + "word " * 200000 + "</p></article>", " ".join(["word"] * 200000)),
    ("<" * 20000, "<" * 20000),
    (
        "<div class='content-sidebar-wrap'><main class='content'><h1>A</h1><p>Text of it.</p></main>"
        "<aside><article>teaser</article></aside><ol class='commentlist'><li>me too</li></ol></div><div id='siteFooter'>x</div>",
        "A\nText of it.",
    ),
    (
        "<div role='navigation'>Go</div><div id='mainContent'><p>One.</p><div class='adsense'>Buy</div><p>Two <i>in</i>line.</p>"
        "<p hidden>never</p><div class='related-posts'><p>See also this</p></div></div><div class='cookieBar'>Yes?</div>",
        "One.\nTwo inline.",
    ),
    ("<a href='" * 3000, None),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    got = main_text(page, block_tree())
    assert text is None or got == text


def test_query_finds_the_articles_whole(spark, sf):
    rows = {r["page_id"]: r for r in QUERIES["op8_html_extraction"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for page in pages:
        inner = re.search(r"<article>(.*?)(</article>|$)", page["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
        want = "\n".join(w for p in parts if (w := " ".join(html.unescape(p).split())))
        assert (rows[page["page_id"]]["text"], rows[page["page_id"]]["n_chars"]) == (want, len(want))


def test_columns_that_clash_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "<p>a b</p>", "old", 7)] * 3 + [(None, None, None, 0)], "n_chars long, html string, text string, copy int")
    got = extract_main_text(df, "html").collect()
    assert sorted((r["text"], r["n_chars"], r["copy"]) for r in got) == [("", 0, 0)] + [("a b", 3, 7)] * 3
    assert extract_main_text(df.limit(0), "html").collect() == []


def test_tree_fits_its_table():
    x, y = labelled_table()
    tree = grow_tree(x, y)
    assert sum((tree.of(r) >= 0.5) == v for r, v in zip(x, y)) >= 0.99 * len(y)


def test_blocks_know_their_links():
    first, second = text_blocks("<p>say <a href=1>two words</a></p><a href=2><div>all linked</div></a>")
    assert (first.words, first.link_words, second.link_density) == (3, 2, 1.0)


UNSEEN = ["hidden", "HIDDEN=''", "aria-hidden='true'", "style='color:red; display : none'", "class='a hidden b'", "class=sr-only"]
SEEN = [
    "style='overflow:hidden'", "class='overflow-hidden'", "class='lg:hidden'", 'aria-hidden="false"', "title='a hidden gem'",
    "data-state='hidden'", "data-class='hidden'", "id='hidden'", "class='hidden-xs'", "class='hidden md:block'",
    "class='d-none d-lg-flex'", "title=\"style='display:none'\"", "style='display:none;display:block'", "alt='x' 'hidden'",
]


@pytest.mark.parametrize("said", SEEN)
@pytest.mark.parametrize("page", ["<body {0}><article>{1}</article>", "<div {0}><article>{1}</article></div>", "<article {0}>{1}</article>"])
def test_elements_that_are_shown_keep_their_text(page, said):
    text = "<h1>A title</h1><p>Some words of the text.</p>"
    assert main_text(page.format(said, text), block_tree()) == "A title\nSome words of the text."


@pytest.mark.parametrize("said", UNSEEN)
def test_elements_that_are_not_shown(said):
    page = f"<body {said}><article><p>Some words of the text.</p><div {said}>never</div></article><div {said}><article>nor this</article></div>"
    assert main_text(page, block_tree()) == "Some words of the text."


BETWEEN = [
    "<svg class='i'/>", "<svg/>", "<math/>", "<SVG class='i' />", "<video-player src='x'></video-player>", "<title-bar>", "<template-x>", "<!-->",
    "<!--->", "<!-- c --!>", "<!---->", "<video src='x'>", "<audio/>", "<svg><path d='M0'/><text>never</text></svg >",
    "<script>if (a</b>c) '</scripts>'</script x>", "<style>p{}</style\n>", "<object data='x'><svg/>never</object>",
]


@pytest.mark.parametrize("between", BETWEEN)
def test_nothing_after_an_element_without_an_end_is_lost(between):
    page = f"<article><p>Words before it.</p>{between}<p>The main text after it.</p></article>"
    assert main_text(page, block_tree()) == "Words before it.\nThe main text after it."


def test_what_is_cut_off_within_a_script_is_no_text():
    assert main_text("<article><p>Words before it.</p><script>var a = 1;<p>b</p>", block_tree()) == "Words before it."


def test_many_elements_without_an_end_take_no_longer():
    blocks = text_blocks("<p>a<video><svg>" * 50000)
    assert len(blocks) == 50000


MAIN = "The ferry left the harbour before dawn, and the keeper of the light wrote down its name as he had every day."


@pytest.mark.parametrize(
    "opened",
    [
        "<div class='post category-social'>", "<div class='story tag-alert'>", "<article class='post comment-count-3'>",
        "<main><section id='social-history'>", "<article><div class='tabs'>", "<body class='has-sidebar no-banner'><article>",
    ],
)
def test_classes_that_tell_what_a_page_is_about_lose_no_text(opened):
    assert [b.kind for b in text_blocks(f"{opened}<p>{MAIN}</p>")] == ["article"]


@pytest.mark.parametrize(
    "inner, kind",
    [("ad-container", "advert"), ("ad-wrapper", "advert"), ("comments-wrapper", "comments"), ("comments-container", "comments")],
)
def test_what_stands_around_adverts_and_comments_is_no_layout(inner, kind):
    for around in ("<article>", "<div class='post'>", "<main>"):
        blocks = text_blocks(f"{around}<p>{MAIN}</p><div class='{inner}'><p>other</p></div><p>{MAIN}</p>")
        assert [b.kind for b in blocks] == ["article", kind, "article"]


@pytest.mark.parametrize(
    "broken", ["<a ", "<a href='x", "<a href='x>", "<a href='\">", "<", "<!--", "<!", "<div>", "</p>", "<svg>", "<b<!--"]
)
def test_broken_pages_take_time_in_proportion(broken):
    begun = time.process_time()
    text_blocks(f"<p>{MAIN}</p>" + broken * (1_000_000 // len(broken)))
    text_blocks(f"<p>{MAIN}</p>" + broken * (500_000 // len(broken)) + "<div>" * 50_000 + "</p>" * 50_000)
    assert time.process_time() - begun < 8


def test_an_unfinished_comment_takes_the_rest_and_an_unfinished_tag_is_text():
    assert [b.text for b in text_blocks("<p>a</p> b <c <!-- d")] == ["a", "b <c"]
    assert [b.text for b in text_blocks("<p>a</p> b <c d")] == ["a", "b <c d"]
