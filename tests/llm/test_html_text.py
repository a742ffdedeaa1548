import pytest

from snapweave.llm import html_text as h

PROSE = "It was the best of times and it was the worst of times for all of the people who had been there with us, and they said that it would be so for years to come. " * 2


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("just text", "just text"),
        ("<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/>x</a></li></ul></nav><div class=ad>Buy the thing</div><article><h1>Head &amp; more</h1><p><b>bold.<br><p>para&nbsp;two</p></article><footer>&copy; x</footer>", "Head & more\nbold.\npara two"),
        (f"<body><div id=sidebar>{PROSE}</div><div><h2>Title</h2><p>{PROSE}</p><p>short one</p><p>{PROSE}</p></div><div class='comments'><p>{PROSE}</p></div></body>", f"Title\n{PROSE.strip()}\nshort one\n{PROSE.strip()}"),
        ("<article><p>a<!-- no --><p>b<aside>no</aside><form>no</form><section class='comment-list'>no</section><p>c<p hidden>no</p></article>", "a\nb\nc"),
        ("<nav><a>menu</a><article><p>kept though the menu is open</p></article>", "kept though the menu is open"),
        ("<article><p>x &lt;b&gt; y</p><p>a\n  b\tc</p><textarea>no</textarea><noscript>no</noscript></article>", "x <b> y\na b c"),
        ("<main><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></main>", "one\ntwo\nc1\nc2"),
        ("<script>unclosed <p>nothing", ""),
        ("<!-- unclosed <p>nothing", ""),
        ("a < b and <3 hearts", "a < b and <3 hearts"),
        ("<article class='article-with-ad'><p>Real text here.</p></article>", "Real text here."),
        (f"<div class='notice-board'><p>{PROSE}</p></div>", PROSE.strip()),
        (f"<article><p>{PROSE}</p><section id='comment-on-policy'><p>{PROSE}</p></section><ul><li><a>one</a><li><a>two</a></ul><div class='comment-list'>{PROSE}</div></article>", f"{PROSE.strip()}\n{PROSE.strip()}"),
        (f"<article><p>teaser</p></article><div><h2>Title</h2><p>{PROSE}</p><p>short</p></div><div class=ad>{PROSE}</div>", f"teaser\nTitle\n{PROSE.strip()}"),
        (f"<div class='content sidebar'><p>{PROSE}</p></div><nav>x</nav>", PROSE.strip()),
        ("<header><p>site</p></header><article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", "T\nx"),
    ],
)
def test_pages(page, text):
    assert h.extract(page) == text


def test_neighbours_decide_short_blocks():
    blocks = [h.Block("menu item", 9, False, False), h.Block("short", 0, False, False), h.Block(PROSE, 0, False, False), h.Block("short", 0, False, False), h.Block("short", 0, False, False), h.Block("link link", 9, False, False)]
    assert h.labels(blocks) == [False, False, True, True, False, False]


def brute_labels(page, rules):
    """The rules again, block by block, each looking for its neighbours."""
    def decide(b, names):
        words = [w.strip(".,;:!?\"'()") for w in b.text.lower().split()]
        if b.mark == "hidden":
            return False
        if b.link_chars / len(b.text) > rules.max_link_density or (not b.inside and b.link_chars and len(b.text) < rules.short):
            return False
        if (names and b.mark == "named") or (not b.inside and b.text[0] == "©"):
            return False
        return True if not b.heading and len(b.text) >= rules.long and sum(w in h.STOP_WORDS for w in words) / len(words) >= rules.stop_words else None

    article = any(b.inside for b in page)
    first = [decide(b, True) for b in page]
    if not any(first) and not [b for b, x in zip(page, first, strict=True) if x is None and (b.inside or not article)]:
        first = [decide(b, False) for b in page]
    out = []
    for k, b in enumerate(page):
        near = [(abs(n - k), n) for n, x in enumerate(first) if x is not None and page[n].inside == b.inside]
        steps = lambda n: sum(page[i].inside == b.inside for i in range(min(n, k), max(n, k)))
        left = max((n for _, n in near if n < k), default=None)
        right = min((n for _, n in near if n > k), default=None)
        if first[k] is not None:
            out.append(first[k])
        elif not any(first[n] for _, n in near):
            out.append(b.inside or not article)
        elif b.heading:
            out.append(first[right] if right is not None else b.inside)
        elif left is None or right is None:
            out.append(first[left if right is None else right])
        elif first[left] == first[right] or steps(left) != steps(right):
            out.append(first[left] if steps(left) < steps(right) else first[right])
        else:
            out.append(b.inside or len(b.text) >= rules.short)
    return out


def test_labels_equal_brute_force():
    import random

    r = random.Random(3)
    for _ in range(3000):
        page = []
        for _ in range(r.randint(0, 9)):
            text = r.choice([PROSE, PROSE[:100], "short words", "© x", "zq " * 90])
            page.append(h.Block(text, r.choice([0, 0, 5, len(text)]), r.random() < 0.2, r.random() < 0.5, r.choice(["", "", "", "named", "hidden"])))
        assert h.labels(page) == brute_labels(page, h.Rules())


def test_long_and_malformed_pages_are_linear():
    for page in ("<div>" * 50000 + "</b>" * 50000, "<p>x" * 50000, "<div>" * 5000 + "x", "<a <a <a " * 20000, '<a "' * 20000, "&amp;" * 50000):
        h.extract(page)


def test_table(spark):
    rows = [(1, "u", "<article><p>x</p></article>"), (1, "u", "<article><p>x</p></article>"), (None, None, None)]
    pages = spark.createDataFrame([(*r, "t", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, h.extract_pages(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0)], key=repr)
    assert h.extract_pages(pages.where("page_id = 2")).count() == 0
