"""Operator 3 on pages whose main text is known."""

from bellwether.llm.html_extract import blocks, extract, main_text

LONG = "It was the best of times and it was the worst of times, in the age of wisdom and of the fool that was here."


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var a="</p><p>{LONG}";</script>
    </head><body><header><h2>Site name</h2></header><nav><ul><li><a href="/a">The</a></li></ul></nav>
    <div class="cookie-notice">We use cookies. {LONG}</div><div id="sidebar"><p>{LONG}</p></div>
    <article><h1>Head &amp; line</h1><p><b>{LONG}<br>second&nbsp;line<br><p>Short.</p>
    <div class="ad">Buy it. {LONG}</div><!-- {LONG} --><form><label>Your name</label><input value="x > y"></form>
    <p>x | y | z</p><ul><li>first point</li><li>second <a href="#">point</a></li></ul>
    <section class="comments"><p>{LONG}</p></section><aside>{LONG}</aside></article>
    <footer>&copy; me &middot; {LONG}</footer></body></html>"""
    assert main_text(page).split("\n\n") == [
        "Head & line", f"{LONG} second line", "Short.", "x | y | z", "first point", "second point"]


def test_page_without_article_is_decided_by_its_blocks():
    page = (f"<div><a href='/1'>Home of the site and of all the other sites that there are in the world</a></div>"
            f"<div><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div>"
            "<div><a href='/2'>More of the same and of all the things that there are here</a> !</div>")
    assert main_text(page).split("\n\n") == [LONG, "Short one.", LONG]


def test_unclosed_and_broken_markup():
    assert main_text("<article><p>One<p>Two<div>Three</article><footer>no") == "One\n\nTwo\n\nThree"
    assert main_text("<article><p>a < b and c > d &am") == "a < b and c > d &am"
    assert main_text('<article><p title="a>b">kept</p><script>if (a < b) {') == "kept"
    assert main_text("<article><p hidden>no</p><p style='display:none'>no</p><p>yes</p>") == "yes"
    assert main_text("just text") == "just text"
    assert [b.text for b in blocks("<p>a<span>b</span>\n c</p>")] == ["ab c"]


def test_edges(spark):
    rows = [(1, "u", None, 1), (2, None, "", 2), (2, None, "", 2), (None, "u", "<article><p>é</p>", 3),
            (4, "u", "<article>" + "<p>word and the rest</p>" * 3000, 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted(((r["page_id"] or 0), r["n_chars"]) for r in extract(pages).collect())
    assert got == [(0, 1), (1, 0), (2, 0), (2, 0), (4, 3000 * 17 + 2999 * 2)]
    assert extract(pages.limit(0)).count() == 0
    out = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    assert out[1] == "" and out[None] == "é"


def test_driver_pages_keep_the_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in pages.join(extract(pages).select("page_id", "text"), "page_id").collect():
        body = r["html"].split("<article>")[1].split("</article>")[0]
        import html
        import re
        want = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?p>|</?h1>", body)]
        assert r["text"] == "\n\n".join(w for w in want if w)


def test_names_decide_only_as_heads():
    """Names on an article, its headings or what holds it, and names that only mention a part of the page."""
    article = f"<article><h1>Head</h1><p>{LONG}</p></article>"
    want = f"Head\n\n{LONG}"
    assert main_text(f'<div id="page" class="has-sidebar">{article}</div>') == want
    assert main_text(f'<article class="post has-comments"><h1>Head</h1><p>{LONG}</p></article>') == want
    assert main_text(f'<article><h1>Head</h1><section id="social-impact"><p>{LONG}</p></section></article>') == want
    assert main_text(f'<div class="content no-sidebar">{article}</div>') == want
    assert main_text(f'<article><h2 id="search-algorithms">Head</h2><p>{LONG}</p></article>') == want
    assert main_text(f"<article><h1>Head</h1><p>© is a sign. {LONG}</p></article>") == f"Head\n\n© is a sign. {LONG}"
    assert main_text(f'<div class="sidebar">{article}</div>') == want                 # it holds the main article
    for name in ("ad", "ad-slot", "cookie-notice", "sidebar left", "commentList", "site-footer", "related", "social"):
        assert main_text(f'{article}<div class="{name}"><p>{LONG}</p></div>') == want
        assert main_text(f'<article><h1>Head</h1><p>{LONG}</p><div class="{name}"><p>{LONG}</p></div></article>') == want
    aside = f'<div class="sidebar"><article><p>Teaser of the other.</p></article></div>'
    assert main_text(article + aside) == want                                         # the smaller article stays where it is
    assert main_text(f'{article}<section class="comments"><article class="c"><p>I say so.</p></article></section>') == want


def test_labels_equal_a_plain_labeller():
    """The two passes by their definition, with a search over all blocks for the nearest decided one."""
    import random

    from bellwether.llm import html_extract as H
    rng = random.Random(7)

    def plain(found):
        has_main = any(b.inside and not b.bad for b in found)

        def clear(b):
            letters = len(b.text.replace(" ", "")) or 1
            words = [w.strip(".,;:!?()") for w in b.text.lower().split()]
            if b.bad or b.linked / letters > (0.8 if b.inside else 0.5):
                return False
            if b.text[0] == "©" and not b.inside and len(b.text) < 70:
                return False
            if len(b.text) >= 70 and sum(w in H.STOP_WORDS for w in words) / len(words) >= 0.12:
                return True
            return None
        first = [clear(b) for b in found]
        out = []
        for i, b in enumerate(found):
            x = first[i]
            if x is None:
                near = [(abs(k - i), not first[k]) for k, o in enumerate(found)
                        if first[k] is not None and not o.bad and o.inside == b.inside]
                x = not min(near)[1] if near else b.inside or not (has_main or any(first))
            out.append(bool(x) and (b.inside or not has_main))
        return out
    for _ in range(400):
        found = []
        for _ in range(rng.randint(0, 14)):
            text = rng.choice(["Short.", LONG, "x" * 80, "© me", LONG + LONG, "A link here"])
            found.append(H.Block(text, rng.choice([0, 0, len(text) // 2, len(text)]), rng.random() < .2, rng.random() < .5))
        assert H.label(found) == plain(found)


def test_very_long_and_deep_pages():
    deep = "<div>" * 3000 + f"<article><p>{LONG}</p>" + "</div>" * 3000
    assert main_text(deep) == LONG
    wide = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    assert main_text(wide).count(LONG) == 20_000
