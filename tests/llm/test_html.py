import html
import re
import time

import numpy as np

from binscope.llm import html as H

from .cases import by_row

PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h2>Site</h2></header>
<div id="main-menu"><a href=x>Home</a> <a>About</a></div>
<div class="wrap"><div class="content"><h1>Title &amp; more</h1><p>First para, with <b>text</b>
 and&nbsp;more words. And more.<p>Second para one; two,<br>three.<ul><li>item one, and words<li>item two</ul>
<div class="share-box">Share</div><form>Name <input></form><table><tr><td>cell a, b</td><td>cell c</td></tr></table></div>
<div class="sidebar"><p>Side stuff, words.</p></div></div>
<div class="comments"><p>Nice one, really! So nice.</p></div><div class="cookie-notice">We use cookies.</div>
<script>var t="</p><p>no</p>";</script><!-- <p>no</p> --><footer>F, all rights.</footer></body></html>"""


def article(page):
    """The blocks of the article element of the generated pages."""
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))]
    return "\n".join(b for b in blocks if b)


def test_main_text_of_a_page_without_article():
    assert H.extract(PAGE) == "\n".join([
        "Title & more", "First para, with text and more words. And more.", "Second para one; two, three.", "item one, and words", "item two", "cell a, b", "cell c"])


def test_article_is_preferred_and_its_header_stays():
    page = "<body><main><p>Teaser, short.</p><article><header><h1>Head</h1></header><section><p>Long text, with words. More.</p></section><footer>by me</footer></article></main></body>"
    assert H.extract(page) == "Head\nLong text, with words. More."


def test_asides_of_any_size_and_wrappers():
    short, thread = "<p>Short text, of the article.</p>", "<p>A long comment, with many words. And more.</p>" * 60
    assert H.extract(f"<body><article>{short}</article><div id=comments>{thread}</div></body>") == "Short text, of the article."
    assert H.extract(f"<body><div class=post-text>{short}</div><div class='comment-list'>{thread}</div></body>") == "Short text, of the article."
    assert H.extract(f"<body><article>{short}</article><div class=zone>{thread}</div></body>") == "Short text, of the article."
    other = "<p>Other text, elsewhere.</p>" * 2
    for name in ("has-sidebar", "no-sidebar"):
        assert H.extract(f"<body><div class={name}><div>{short * 9}</div></div><div>{other}</div></body>").startswith("Short text")
    assert H.extract(f"<body><div class=sidebar><article>{short}</article></div><div>{thread}</div></body>") == "Short text, of the article."


PARA = "<p>This is one paragraph of the article, with commas, and words. It goes on.</p>"
PLAIN = "This is one paragraph of the article, with commas, and words. It goes on."


def test_an_article_element_without_content_is_a_teaser():
    for teaser in ("<h1>Teaser</h1><p>short</p>", "<h2>Teaser</h2><p>short</p>", "<a href=x>Read this one, now</a>"):
        for head in ("", "<h1>Head</h1>"):
            page = f"<body><article>{teaser}</article><div class=main-text>{head}{PARA * 10}</div></body>"
            assert H.extract(page) == "\n".join(["Head"] * bool(head) + [PLAIN] * 10)
    assert H.extract("<body><article><h1>Only</h1><p>short</p></article><ul><li><a href=x>More</a></ul></body>") == "Only\nshort"


def test_sections_named_by_their_topic_stay_in_an_article():
    """By the ratios of their paths; blocks of one path are judged alike."""
    page = (f"<body><article><h1>Head</h1>{PARA * 3}<section class=social><h2 class=banner>Social policy</h2>{PARA * 2}</section>"
            f"<section class=social><div>Tweet</div></section><div class=share-box>Share this, now.</div>{PARA}</article></body>")
    assert H.extract(page) == "\n".join(["Head", *[PLAIN] * 3, "Social policy", *[PLAIN] * 3])


def test_content_blocks_match_brute_force():
    r = np.random.default_rng(11)
    texts = ["a", "menu", "Some words, here. And there!", "A longer text without marks in it " * 3, "One, two; three: four. " * 4]
    for _ in range(200):
        nodes = [H.Node("p", int(p), None) for p in r.integers(0, 4, 4)]
        blocks = []
        for _ in range(r.integers(1, 15)):
            t = texts[r.integers(len(texts))].strip()
            blocks.append(H.Block(nodes[r.integers(4)], t, int(r.integers(0, len(t) + 1)) if r.random() < 0.3 else 0))
        length, marks = [], []
        for b in blocks:
            same = [x for x in blocks if x.node.path == b.node.path]
            length.append(sum(len(x.text) - x.links for x in same) / len(same))
            marks.append(1 + sum(c in ".,;:!?" for x in same for c in x.text) / len(same))
        fused = []
        for k in range(len(blocks)):
            near = [(j, w) for j, w in ((k - 1, 0.25), (k, 0.5), (k + 1, 0.25)) if 0 <= j < len(blocks)]
            total = sum(w for _, w in near)
            fused.append(sum(length[j] * w for j, w in near) / total * sum(marks[j] * w for j, w in near) / total)
        least = H.SHARE * sum(fused) / len(fused)
        for got, want in zip(H.content_blocks(blocks), (fused, [x * y for x, y in zip(length, marks)])):
            assert all(g == (f >= least) or abs(f - least) < 1e-9 for g, f in zip(got, want, strict=True))


def test_skipped_elements_end_with_their_parent():
    for tag in ("video-player", "svg-icon", "button-group", "object-x"):
        assert H.extract(f"<body><p>Before, one.</p><{tag}></{tag}><p>After, two.</p></body>") == "Before, one.\nAfter, two."
    for tag in ("button", "select", "iframe", "object", "canvas", "audio"):
        assert H.extract(f"<body><div><p>Before, one.</p><div><{tag}>x</div><p>After, two.</p></div></body>") == "Before, one.\nAfter, two."
        assert H.extract(f"<body><p>Before, one <{tag}>x<p>After, two.</p></body>") == "Before, one\nAfter, two."
    assert H.extract("<body><p>One <button>x<p>y</p></button>two.</p><svg><title>z</title></svg><noscript><p>no</p></noscript></body>") == "One two."


def test_lists_of_links_in_an_article_stay():
    links = "<ul><li><a href=1>Source one</a><li><a href=2>Source two</a></ul>"
    page = f"<body>{links}<article><h1>Head</h1><p>Text, with words.</p>{links}</article>{links}</body>"
    assert H.extract(page) == "Head\nText, with words.\nSource one\nSource two"


def test_generated_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = H.extract_pages(pages).collect()
    assert len(rows) == 250
    for r in rows:
        assert r["_main"]["text"] == article(r["html"]) and r["_main"]["n_chars"] == len(r["_main"]["text"])


def test_broken_and_empty_pages(spark):
    cases = {None: "", "": "", "<p": "<p", "text only": "text only", "<script>x": "", "<!-- c": "", "<p>a<b>c</p>d": "ac\nd", "</div></p>x": "x",
             "<ul><li><a href=1>one</a><li><a>two</a></ul>": "", "<p>&lt;p&gt; &amp;amp;</p>": "<p> &amp;", "<P CLASS=x>Up</P>": "Up",
             "<div>" * 3000 + "deep, text." + "</div>" * 10: "deep, text."}
    for page, text in cases.items():
        assert H.extract(page) == text, page
    df = spark.createDataFrame([(i, p, 1, 2) for i, p in enumerate(cases)] * 2, "page_id long, html string, text int, n_chars int")
    got = H.extract_pages(df)
    assert got.columns == ["page_id", "html", "text", "n_chars", "_main"]
    assert by_row((r["page_id"], r["_main"]["text"]) for r in got.collect()) == by_row(list(enumerate(cases.values())) * 2)
    assert H.extract_pages(df.limit(0)).count() == 0


#: The same tokens by one expression, in quadratic time on pages with unclosed quotes.
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(H.RAW)})(?=[\s/>])[^>]*?(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*|/)?)>",
    re.S | re.I)


def test_tokens_are_those_of_the_expression():
    r = np.random.default_rng(7)
    parts = ["<p", "<a ", "<script", "</script>", "<!--", "-->", "<!", "<?x", "</", "div", ">", "/>", "/", '"', "'", " ", "=x", "\n", "<STYLE >", "text", "<b>", "<p class='a'>", "\xa0", "<"]
    for _ in range(20000):
        page = "".join(parts[i] for i in r.integers(0, len(parts), r.integers(1, 25)))
        want = [(m.start(), m.end(), (m["tag"] or "").lower(), bool(m["end"]), m["rest"] or "") for m in TOKEN.finditer(page)]
        assert list(H.read_tokens(page)) == want, page


def test_bad_markup_takes_time_in_proportion():
    n = 1 << 20
    for piece in ("<p class='x>a \"</p>", "<p title=\"a>b</p>'", "<script ", "<!", "<p ", "<!-- ", "<div></span></p></li>", "<h1><td>", "<button><p>", "</a", "<li><div>"):
        t = time.process_time()
        H.extract(piece * (n // len(piece)))
        assert time.process_time() - t < 20, piece
    t = time.process_time()
    assert H.extract("<div>" * 100_000 + "<article>deep, text.</article>" + "</p></b></form>" * 100_000).startswith("deep, text.")
    assert time.process_time() - t < 20
