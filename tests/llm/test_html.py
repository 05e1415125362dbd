"""Extraction of articles: markup of all kinds, the vote of hosts, and whole pages against what they were made of."""
import random
from html import escape

from fleetlake.llm import html_text as ht

LONG = "Prose that goes on for a while, as articles do, with commas and more of them."


def text(html):
    return ht.read_page(html).article([])[0]


def test_what_is_left_out():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
      <nav><ul><li><a href="/">x</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
      <div id="content" class="post-123"><header class=entry-header><h1>Title &amp; &lt;b&gt;</h1><span>by me</span></header>
      <p>One  two&nbsp;three. <em>four</em>five {LONG}<p>After<br>break<ul><li>item <a href=x>link</a></li><li>two</ul>
      <ul><li><a href=1>Next</a><li><a href=2>Prev</a><li><a href=3>Top</a></ul>
      <div class="ad-slot">Buy</div><div role=complementary>more</div><form>Sign <input></form><script>if (a < b) {{ "</p>" }}</script>
      <table><tr><td>c1<td>c2</table><pre> a\n  b</pre><!-- note <p>gone</p> --></div>
      <section class=comments><h2>Comments</h2><p>First! {LONG * 20}</p></section>
      <div id=sidebar><p>{LONG}</p></div><aside>{LONG}</aside><footer>&copy; x</footer></body>"""
    assert text(page).split("\n\n") == ["Title & <b>", f"One two three. fourfive {LONG}", "After break", "item link", "two", "c1", "c2", "a b"]


def test_broken_markup():
    for html, want in {"": "", "plain & more": "plain & more", "<p>a<p>b": "a\n\nb", "<div": "", "x < y <b>z": "x < y z", "<!-- c": "", "<script>x": "", "a<p title='x": "a",
                       "<p>&#x41;&eacute;&am &notit;": "Aé&am ¬it;", "<p><b>one<br><p>two</b></p></div>": "one\n\ntwo", "<p>a</span>b": "ab"}.items():
        assert text(html) == want, html
    assert text("<div>" * 20_000 + "deep") == "deep"
    assert text("<p title='" * 3 + "x") == "" and len(text("<" * 50_000)) == 50_000


def test_classes_do_not_empty_a_page():
    assert text(f"<body><div class='promo'><p>{LONG}</p></div></body>") == LONG


COLS = "page_id bigint, url string, html string, host string, path bigint, text int, paths string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, 2, "p") for r in rows], COLS)


def got(spark, rows):
    return {(r["page_id"], r["url"]): (r["text"], r["n_chars"], r["by_host"]) for r in ht.main_text(pages(spark, rows)).collect()}


def test_host_vote(spark):
    """A page whose own best container is a long box beside its short article follows its host."""
    def page(article, box):
        return f"<body><div class='m{len(article)}'><div class=story>{article}</div><div class=box>{box}</div></div></body>"
    rows = [(i, f"https://a.example.org/{i}", page(f"<p>{LONG * 4} {i}</p>", "<p>x</p>")) for i in range(30)]
    odd = page(f"<p>{LONG * 4}</p>", f"<p>{LONG * 5}</p>")
    rows += [(100, "https://a.example.org/odd", odd), (101, "https://b.example.org/odd", odd), (102, None, odd), (103, "no host", odd)]
    out = got(spark, rows)
    assert len(out) == 34 and out[(0, "https://a.example.org/0")][0] == LONG * 4 + " 0"
    assert out[(100, "https://a.example.org/odd")] == (LONG * 4, len(LONG) * 4, True)
    assert out[(101, "https://b.example.org/odd")][0] != LONG * 4
    assert out[(102, None)][2] is False and out[(103, "no host")][2] is False


def test_tables(spark):
    html = f"<article><p>{LONG}</p></article>"
    rows = [(1, "http://x.org/1", html), (1, "http://x.org/2", None), (None, "http://x.org/3", html), (4, "http://x.org/4", ""), (5, "http://x.org/5", "<article>" + "<p>é word</p>" * 40_000)]
    out = got(spark, rows)
    assert out[(1, "http://x.org/2")][:2] == ("", 0) and out[(None, "http://x.org/3")][0] == LONG and out[(4, "http://x.org/4")][0] == ""
    assert out[(5, "http://x.org/5")][0] == "\n\n".join(["é word"] * 40_000) and out[(5, "http://x.org/5")][1] == 8 * 40_000 - 2
    assert got(spark, []) == {}


def test_made_pages(spark):
    """Pages of several templates give back exactly the blocks they were made of."""
    rnd = random.Random(4)
    frames = ["<body><nav><a>m</a></nav><main><article>{}</article><aside>side</aside></main><footer>f</footer></body>",
              "<body><div class=header><h1>Site</h1></div><div id=wrap><div class='entry-content'>{}</div><div class='sidebar'><p>other</p></div></div></body>",
              "<html><body><table><tr><td class=nav><a>x</a></td><td class=text>{}</td></tr></table></body></html>",
              "<body>{}<div id=comments><p>" + LONG * 3 + "</p></div></body>"]
    rows, want = [], {}
    for i in range(80):
        blocks = [" ".join(rnd.choice(["a<b", "R&D", "word", "été", "\"quoted\"", LONG]) for _ in range(rnd.randint(3, 40))) for _ in range(rnd.randint(2, 9))]
        body = "".join(rnd.choice([f"<p>{escape(b)}</p>", f"<p>{escape(b)}", f"<div>{escape(b)}</div>", f"<h2><i>{escape(b)}</i></h2>"]).replace("word", rnd.choice(["word", "<b>word</b>"])) + "\n" for b in blocks)
        url = f"http://{rnd.choice('abc')}.org/{i}"
        rows.append((i, url, frames[i % 4].format(body)))
        want[(i, url)] = "\n\n".join(blocks)
    out = got(spark, rows)
    assert {k: v[0] for k, v in out.items()} == want
