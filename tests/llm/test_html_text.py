import html
import re
import time

from riskframe.llm import html_text

SCHEMA = "page_id long, url string, html string, text string, n_chars string"
PAGE = (
    "<html><head><title>T</title><script>var t='</p>';</script></head><body><header>Head line</header><nav><ul><li><a href=/a>Home</a></ul></nav>"
    "<div class='cookie-notice'>We use cookies</div><article><h1>Title&nbsp;here</h1><p>First  block\n of <b>te</b>xt &amp; more words to read.<p>Second block &lt;ok&gt;<br>line two."
    "<aside>Related things</aside><div class=ad>Buy now</div><p>Third block with some more words.</article><div id=comments><p>Nice post</p></div>"
    "<form>Name <input></form><footer>&copy; us</footer></body></html>"
)


def test_agrees_with_marked_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    got = html_text.extract(pages).collect()
    assert len(got) == len(source)
    for r in got:
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", source[r["page_id"]], re.S)[1]
        plain = html.unescape(re.sub(r"<(?:/?p|/?h1|br)>", " ", inner).replace("<b>", "").replace("</b>", ""))
        assert r["text"] == " ".join(plain.split()) and r["n_chars"] == len(r["text"])


def test_what_is_no_article_goes(spark, sf):
    weights = html_text.learn(spark.read.parquet(f"{sf}/pages.parquet"))
    want = "Title here First block of text & more words to read. Second block <ok> line two. Third block with some more words."
    assert html_text.main_text(PAGE, weights) == want


WORDS = "Some running text of an article with quite a few words in it to be read."
WRAPPERS = [
    "<div class='content-sidebar-wrap'>{}</div>", "<div class='site has-sidebar'>{}</div>", "<div class=no-sidebar>{}</div>",
    "<div class='main-menu-open'>{}</div>", "<section id='social-impact'>{}</section>", "<section class='search-engine'>{}</section>",
    "<figure><img><figcaption>{}</figcaption></figure>", "<object>{}</object>", "<dialog open>{}</dialog>",
]


def test_wrappers_of_text_stay():
    for wrapper in WRAPPERS:
        assert html_text.main_text(wrapper.format(f"<p>{WORDS}</p>"), {}) == WORDS, wrapper
        assert html_text.main_text(f"<article>{wrapper.format(WORDS)}</article>", {}) == WORDS, wrapper


def test_an_article_in_a_named_element_is_one():
    for tag in ("article", "main"):
        page = f"<div class=widget><{tag}><p>{WORDS}<div class=ad>Buy</div></{tag}><p>Outside again</div>"
        assert html_text.main_text(page, {}) == WORDS
    # a comment is none, nor what a menu inside an article holds
    assert html_text.main_text(f"<div id=comments><article>{WORDS}</article></div>", {}) == ""
    assert html_text.main_text(f"<main>{WORDS}<div class=related><article>More</article></div></main>", {}) == WORDS
    for name in ("site-footer", "cookie-notice", "left_sidebar", "x comment-list"):
        assert html_text.main_text(f"<div class='{name}'>{WORDS}</div>", {}) == ""


def test_weights_come_from_marked_pages_however_rare(spark):
    page = f"<nav>Home</nav><article>{'<p>' + WORDS}</article>" * 5
    rows = [(i, "u", page if i == 7 else "<p>no mark", "t", "n") for i in range(500)]
    assert html_text.learn(spark.createDataFrame(rows, SCHEMA), train_pages=5)["word p"] > 0


def test_best_run():
    assert html_text.best_run([1, -3, 2, 2, -1, 3, -9, 4]) == (2, 6)
    assert html_text.best_run([-1, 0, -2]) == (0, 0) and html_text.best_run([]) == (0, 0)


def test_hard_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain words only"), (3, "u", "<p>a<p>b"), (3, "u", "<p>a<p>b"), (4, "u", "<<<>>> 1 < 3 &am &amp x"), (5, "u", "<div <p 'x> unended"), (6, "u", "<p>w" * 50_000)]
    got = html_text.extract(spark.createDataFrame([(*r, "t", "n") for r in rows], SCHEMA), {}).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == text[2] == "" and text[None] == "plain words only" and text[4] == "<<<>>> 1 < 3 &am & x"
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_odd_markup_takes_linear_time():
    began = time.time()
    for page in ("<a " * 50_000, '<a "' * 50_000, "<b>x</i>" * 50_000, "<li>x<p>" * 30_000, "<!--" * 50_000, "<script>" * 20_000):
        html_text.main_text(page, {})
    assert time.time() - began < 20
