import pytest

from tests.llm import cases
from threadmood.llm import html_text


@pytest.fixture(scope="module")
def text_of(spark):
    [tree] = html_text.trained_tree(spark)
    return lambda page: html_text.main_text(page, tree)


def test_article_only(text_of):
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a = "</p><p>no";</script></head><body>
    <nav><a href=x>Menu</a></nav><!-- <p>no</p> --><div class="ad">Buy   this</div>
    <article><h1>A &amp; B&nbsp;&copy;</h1><p><b>First <i>one</i><br><p>Second&#33;
    line   here</p><p></p><p>5 < 6</p><script>no()</script><ul><li>x<li>y</ul>
    <div class="comments"><p>A reader says that this is a long comment about the article above.</p></div></article>
    <aside><p>A sidebar with quite a number of words in it that read like prose.</p></aside>
    <form><p>Write to us</p><input value=no></form>
    <footer>&copy; me &middot; all rights</footer></body></html>"""
    assert text_of(page) == "A & B ©\nFirst one\nSecond! line here\n5 < 6\nx\ny"


def test_broken_pages_do_not_crash(text_of):
    for page in ("", "<", "<p", "</p></p>", "<article><p>open <b>text", "<!-- open <p>no", "<script>open", "&am", "<a href='x>y</a>", "a" * 100_000, "<p>" * 5000):
        text_of(page)
    assert text_of("<article><p>open <b>text") == "open text"


def test_labelled_table_is_learnt(spark):
    [tree] = html_text.trained_tree(spark)
    rows = html_text.labelled_blocks()
    right = sum(html_text.is_main(tree, tuple(own)) == (mark == 1.0) for mark, own in rows)
    assert right >= 0.95 * len(rows)


def test_table_of_pages(spark, sf_dir):
    """Held-out accuracy: every paragraph of the article and nothing else, on all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert len(found) == pages.count()
    for r in pages.collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        blocks = article.replace("<br>", " ").replace("<b>", "").replace("</b>", "").replace("</p>", "<p>").replace("<h1>", "<p>").replace("</h1>", "<p>")
        import html

        want = [" ".join(html.unescape(b).split()) for b in blocks.split("<p>")]
        assert found[r.page_id] == "\n".join(b for b in want if b)


def test_odd_rows_and_columns(spark):
    rows = [(1, None, "old", "k"), (2, "", "old", "k"), (3, "<p>" + cases.LONG + "</p>", "old", "k"), (3, "<p>" + cases.LONG + "</p>", "old", "k")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, page string")
    found = html_text.extract(df)
    assert sorted(found.columns) == ["page", "page_id", "text"]
    out = [(r.page_id, r.text, r.page) for r in found.collect()]
    assert sorted(out, key=lambda r: r[0]) == [(1, "", "k"), (2, "", "k"), (3, cases.LONG, "k"), (3, cases.LONG, "k")]
    assert html_text.extract(df.limit(0)).count() == 0


LINES = [f"Line {i} of the story tells of a river, of boats and of the people who crossed it that year." for i in range(3)]


@pytest.mark.parametrize(
    "inside",
    [
        "<p class='notice'>An ad.<p>{0}<p>{1}<p>{2}",
        "<p class='notice'>An ad.<div>{0}</div><p>{1}<hr><p>{2}",
        "<ul><li class='ad'>An ad.<li>{0}<li>{1}</ul><p>{2}",
        "<ul><li class='ad'><p>An ad.<li><p>{0}<p>{1}</ul><p>{2}",
        "<dl><dt class='ad'>An ad.<dd>{0}<dt>{1}<dd>{2}</dl>",
        "<table><tr><td class='ad'>An ad.<td>{0}<tr><td>{1}<td>{2}</table>",
        "<table><thead class='ad'><tr><th>An ad.<tbody><tr><td>{0}<tr><td>{1}</table><p>{2}",
        "<p>{0}<p class='ad'><a href=x>An ad.<p>{1}<p>{2}",
        "<p>{0}<noscript><p>An ad.</noscript><p>{1}<ul><li>{2}</ul>",
    ],
)
def test_omitted_end_tags(text_of, inside):
    page = "<html><head><title>No</title></head><body><article>" + inside.format(*LINES) + "</article></body></html>"
    assert text_of(page) == "\n".join(LINES)


@pytest.mark.parametrize("top", ["<body>", "<body class=x>", "", "<noscript><style>p{}</style><body>", "<script>x</script><link rel=y><meta z>"])
def test_a_head_without_its_end(text_of, top):
    page = f"<html><head><title>No</title><style>p{{}}</style>{top}<article><p>{LINES[0]}<p>{LINES[1]}</article>"
    assert text_of(page) == "\n".join(LINES[:2])
    assert text_of("<head><title>No</title>\n " + LINES[0]) == text_of(LINES[0])


def test_links_end_with_their_block():
    _, after = html_text.flat_blocks("<li><a href=x>one two<li>three four")
    assert after[:3] == ("three four", 2, 0.0)


def test_deep_pages_take_linear_time(text_of):
    text_of("<div>" * 50_000 + LINES[0])


@pytest.mark.parametrize(
    "page",
    [
        "<main class='has-sidebar'>{}</main>",
        "<div id='page' class='no-sidebar header-fixed'><article>{}</article></div>",
        "<div id='page' class='no-sidebar header-fixed'><div>{}</div></div>",
        "<article class='post comments-open'>{}</article>",
        "<article class='post format-banner has-sidebar'>{}</article>",
        "<div class='page-header-sidebar'><article>{}</article></div>",
        "<form id='form1'><div class='menu content'><main>{}</main></div></form>",
        "<div class='sidebar-layout'><main class='widget'><article>{}</article></main></div>",
    ],
)
def test_wrappers_that_tell_the_layout(text_of, page):
    story = "<h1>The crossing</h1>" + "".join(f"<p>{line}</p>" for line in LINES) + "<p>So it was.</p><p>" + LINES[0] + "</p>"
    frame = "<nav><a href=x>Menu</a></nav>"
    inner = story + "<div class='sidebar'><p>A box inside of it with many words that are not part of the story at all.</p></div>"
    found = text_of(f"<html><body>{frame}{page.format(inner)}<footer>All rights are with the makers of this page.</footer></body></html>")
    assert found == "\n".join(["The crossing", *LINES, "So it was.", LINES[0]])


def test_articles_in_frames_stay_out(text_of):
    line = f"<p>{LINES[0]}</p>"
    for page in (
        f"<section id='comments'><article class='comment-body'>{line}</article></section>",
        f"<article>{{}}</article><article class='comment'>{line}</article>",
        f"<aside><article>{line}</article></aside>",
        f"<div class='related-posts'><article>{line}</article></div>",
        "<div class='sidebar'><article><h3><a href=x>Another story of that year</a></h3><p><a href=y>Read more</a></p></article></div>",
    ):
        assert text_of("<html><body>" + page.format("") + "</body></html>") == ""
