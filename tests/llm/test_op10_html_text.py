import html
import re

from conftest import SF_SMALL
from strivelake.llm import html_text
from strivelake.llm.html_text import extract_pages, extract_text
from strivelake.llm.queries import op10_html_text

PAGE = """<html class="js"><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<div id="cookie-notice">We use cookies. Accept, please.</div>
<header class="site-header"><a href="/">Site</a><p>Slogan, nice.</p></header>
<div class="menu"><ul><li><a href=x>Home</a></li><li><a href=y>About us</a></li></ul></div>
<div id="wrap"><div class="content"><h1>The &eacute;tude</h1><p>First   paragraph, with <a href=q>a link</a> and <i>style</i>.
More.</p><ul><li>one item</li><li>two <b>items</b></ul><div class="ad">Buy now. Cheap, good.</div><p>Short.<p>Second &amp; more,
yes; it is long enough to count.</p><blockquote>Quoted&nbsp;text, here.</blockquote></div>
<aside>Side bar text, long. And more.</aside><div class="sidebar"><p>Other text, see here, there.</p></div></div>
<form><label>Name</label><input></form><section id="comments"><h2>Comments</h2><p>I think this is great, a long comment.
Yes, it is.</p></section><footer>&copy; x</footer><script>var a="<p>x</p>";</script></body></html>"""


def test_article_without_the_rest():
    assert extract_text(PAGE) == "\n\n".join([
        "The étude", "First paragraph, with a link and style. More.", "one item", "two items", "Short.",
        "Second & more, yes; it is long enough to count.", "Quoted text, here."])


def test_pages_of_the_table(spark):
    rows = {r.page_id: r for r in op10_html_text(spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*?)(</article>|$)", p.html or "", re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " ")))).strip()
                  for x in re.split(r"</?(?:p|h1)>", inner)]
        assert rows[p.page_id].text == "\n\n".join(b for b in blocks if b)
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text) and rows[p.page_id].url == p.url


def test_edges(spark):
    cases = {None: "", "": "", "<p></p>": "", "plain text only": "plain text only", "<article><p>Hi</article>": "Hi",
             "<div><p>x &lt; y &am</div><!-- c -->": "x < y &am", "<p>cut off <b>he": "cut off he",
             "</div></p><p>stray": "stray", "<main><h1>T</h1><div><p>" + "long, text. " * 9000 + "</main>":
             "T\n\n" + ("long, text. " * 9000).strip()}
    pages = spark.createDataFrame([(k, "u", h, "t") for k, h in enumerate(cases)] * 2,
                                  "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in extract_pages(pages).collect()}
    assert got == dict(enumerate(cases.values()))
    assert extract_pages(pages.limit(0)).count() == 0


PARAGRAPHS = ["The river rose in the night, slowly at first; by dawn, as the old people had said, it stood at the door.",
              "Nobody slept. The boats, tied to the fence, knocked against each other, and the dogs, wet and tired, would not stop.",
              "When the water fell, three days later, the garden was gone, the road too, and the letters lay in the mud."]
MENU = "<div><ul><li><a href=a>Home</a></li><li><a href=b>About</a></li><li><a href=c>Press</a></li></ul></div>"
COMMENTS = "<div>" + "".join(f"<div><div>Reader {k}</div><div>So true, thanks</div></div>" for k in range(40)) + "</div>"


def test_ratios_find_the_article_among_plain_divs(monkeypatch):
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    page = f"<body><div><h1>After the flood</h1></div>{MENU}<div>{body}</div>{COMMENTS}<div>Made by us.</div></body>"
    assert extract_text(page) == "\n\n".join(["After the flood", *PARAGRAPHS])
    parts = "".join(f"<div><h2>Part {k}</h2><p>{p}</p><p>{p}</p></div>" for k, p in enumerate(PARAGRAPHS))
    page = f"<body>{MENU}<div>{parts}</div>{COMMENTS}</body>"
    assert extract_text(page) == "\n\n".join(x for k, p in enumerate(PARAGRAPHS) for x in (f"Part {k}", p, p))
    monkeypatch.setattr(html_text, "_ratios", lambda blocks: [1.0] * len(blocks))
    assert "So true" in extract_text(page)


def test_pages_without_names(spark):
    pages = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/pages.parquet").collect()
    same = 0
    for p in pages:
        plain = re.sub(r"\s(class|id|role|style)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", p.html or "")
        plain = re.sub(r"<(/?)(article|main|nav|aside|header|footer|section)\b", r"<\1div", plain)
        same += extract_text(plain) == extract_text(p.html)
    assert same >= 0.75 * len(pages)
