import time

from rollmatch.llm.htmltext import extract_pages, main_text

PROSE = ["A first paragraph, long enough to count, with commas, and words.", "Second one: more prose follows here, also with some commas, yes.",
         "The last paragraph closes the piece, calmly, and then it ends."]


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


def test_article_without_surroundings():
    ps = "".join(f"<p>{p}</p>" for p in PROSE)
    body = (f"<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class='ad'>Buy this, now, today, please!</div>"
            f"<article><h1>Title</h1>{ps}<form><input><button>Send</button></form></article><aside><p>Sidebar text, long enough, with commas, to score.</p></aside>"
            f"<div id='comments'><p>I disagree, strongly, and at length, with all of this.</p></div><footer>&copy; site</footer>")
    assert main_text(page(body)) == "\n\n".join(["Title", *PROSE])


def test_divs_only_and_link_lists():
    ps = "".join(f"<div>{p}</div>" for p in PROSE)
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Some linked headline, number {i}, of the day</a></li>" for i in range(9)) + "</ul>"
    assert main_text(page(f"<div>{links}</div><div class='content'>{ps}</div>")) == "\n\n".join(PROSE)


def test_siblings_of_the_best_container_stay():
    a, b = "".join(f"<p>{p}</p>" for p in PROSE), "".join(f"<p>{p}</p>" for p in reversed(PROSE))
    assert main_text(page(f"<div><section>{a}</section><section>{b}</section></div>")) == "\n\n".join([*PROSE, *reversed(PROSE)])


def test_unclosed_tags_references_and_space():
    html = "<article><p><b>One &amp; two,&nbsp;&#x41;  three\n four, five six seven eight<br>nine<p>Second   part, of the text, goes here too &lt;ok&gt;<ul><li>x<li>y</article>"
    assert main_text(html) == "One & two, A three four, five six seven eight nine\n\nSecond part, of the text, goes here too <ok>\n\nx\n\ny"


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "plain words only"), (4, None, "<p>" * 3000), (None, "u", "<div>" * 2000 + "x" + "</div>" * 2000),
            (5, "u", "<!-- never closed"), (6, "u", "<script>var a = '<p>no</p>'"), (7, "u", "<article><p>" + "word, " * 50_000 + "</p></article>"), (7, "u", "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    out = extract_pages(df).collect()
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    by = {(r["page_id"], r["n_chars"] > 0): r["text"] for r in out}
    assert by[(3, True)] == "plain words only" and (1, False) in by and (2, False) in by and by[(None, True)] == "x" and (7, False) in by
    assert len(by[(7, True)].split()) == 50_000
    assert extract_pages(df.limit(0)).count() == 0


def test_long_nested_articles_stay_whole():
    for n in (1, 3, 8, 40, 400):
        body = [f"Paragraph {i} of the body, long enough to score, with commas, and more words to fill a line or so." for i in range(n)]
        ps = "".join(f"<p>{p}</p>" for p in body)
        parts = (f"<h1>Headline</h1><p>A short lead.</p><div class='content'>{ps}</div><ul><li>one</li><li>two</li></ul><blockquote>Quoted.</blockquote>"
                 "<table><tr><td>cell</td></tr></table><section><h2>Note</h2><p>Small.</p></section>")
        whole = "\n\n".join(["Headline", "A short lead.", *body, "one", "two", "Quoted.", "cell", "Note", "Small."])
        links = "<ul>" + "".join(f"<li><a href='/{i}'>Some linked headline, number {i}, of the day</a></li>" for i in range(9)) + "</ul>"
        assert main_text(page(f"<nav>Menu</nav><article>{parts}</article><footer>end</footer>")) == whole
        assert main_text(page(f"<main><div><div>{parts}</div></div></main>")) == whole
        assert main_text(page(f"<main><article>{parts}</article>{links}<p>Correction.</p></main>")) == whole + "\n\nCorrection."
        # no article element: links beside the text go, all else stays
        assert main_text(page(f"<div id='page'>{links}<div>{parts}</div></div>")) == whole
        assert main_text(page(f"<div>Loose text.{parts}</div>{links}")) == "Loose text.\n\n" + whole


def test_comments_and_adverts_inside_the_article_go():
    ps = "".join(f"<p>{p}</p>" for p in PROSE)
    rude = "<p>I disagree, strongly, and at length, with all of this.</p>"
    for part in (f"<div class='post-comments'>{rude}</div>", f"<div class='main-sidebar'>{rude}</div>", f"<div class='ad content-ad'>{rude}</div>", f"<div class='ad-inline-3'>{rude}</div>",
                 f"<div id='comments'>{rude}</div>", f"<ul class='comment-list'><li>{rude}</ul>", f"<article class='comment'>{rude}</article>", f"<div class='related-posts'>{rude}</div>"):
        assert main_text(page(f"<article>{ps}{part}</article>")) == "\n\n".join(PROSE), part
        assert main_text(page(f"<main><article class='post has-comments'>{ps}</article>{part}</main>")) == "\n\n".join(PROSE), part


def test_headings_and_sections_named_by_anchors_stay():
    ps = "".join(f"<p>{p}</p>" for p in PROSE)
    for part in ("<h2 id='related-work'>Head</h2>", "<h2 id='social-impact'>Head</h2>", "<h3 class='comments' id='share'>Head</h3>", "<section id='comments-on-method'>Head</section>",
                 "<div class='entry-header'><h1>Head</h1></div>", "<header><h1>Head</h1></header>", "<section id='search-space'>Head</section>"):
        assert main_text(page(f"<article>{part}{ps}</article>")) == "\n\n".join(["Head", *PROSE]), part


def test_deep_nesting_is_linear():
    def seconds(n):
        html = "<div>x" * n + "</div>" * n
        start = time.process_time()
        assert main_text(html).split() == ["x"] * n
        return time.process_time() - start
    seconds(1000)
    assert seconds(48_000) < 8 * max(seconds(12_000), 0.05)
