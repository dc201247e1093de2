"""Style trees: pages of known articles, damaged markup, templates, and importance by plain counts."""

from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest

from tabmill.llm import style_tree as s

SCHEMA = "page_id long, url string, html string, text string, noise int"


def text_of(source):
    return "\n".join(s.main_blocks(s.parse(source)))


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("", ""),
        ("just text &amp; more &lt;b&gt;", "just text & more <b>"),
        ("<nav>menu<p>x</nav><article><h1>T</h1><p><b>one<br><p>two\n  three</p></article><footer>f</footer>", "T\none\ntwo three"),
        ('<article><p>a</p><div class="ad">b</div><script>"</p>";x</script><p>c<!-- d --></p><section id="comments"><p>e</section><form><p>f</form>g</article>h', "a\nc\ng"),
        ("<header>site</header><main><header><h1>t</h1></header><p>x<i>y</i>z</main>", "t\nxyz"),
        ("<p>a<p>b<ul><li>c<li>d</ul>e", "a\nb\nc\nd\ne"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<article>open <p>never closed <div title='a>b'>in", "open\nnever closed\nin"),
        ("<style>p{}</style><title>t</title><textarea><p>x</textarea>y</p></div></div>z", "y\nz"),
        ("<article></article><p>outside only", "outside only"),
        ("a < b > c <3 &nope; &#233;&eacute; <a href=x>link</a>", "a < b > c <3 &nope; éé link"),
        ("<script>never closed <p>x", ""),
        ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_blocks(source, want):
    assert text_of(source) == want


def site(n, seed=0):
    rng = np.random.default_rng(seed)
    words = lambda k: " ".join("".join(rng.choice(list("abcdefg"), 5)) for _ in range(k))
    out = []
    for i in range(n):
        paragraphs = [words(12) for _ in range(3)]
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        out.append((f'<div class="top"><p>All days open</p></div><div class="text"><h2>{paragraphs[0][:9]}</h2>{body}<div class="join">Join us now</div></div>', "\n".join([paragraphs[0][:9], *paragraphs])))
    return out


def test_templates_go_and_articles_stay(rows):
    pages, want = [], {}
    for i, (source, text) in enumerate(site(40)):
        pages.append((i, f"https://u@Host.example:8080/{i}?x", source, "", 0))
        want[i] = text
    for i in range(30):  # copies on a host of their own: the only article there is isn't a template
        pages.append((100 + i, "http://copies.example/a", site(1, 9)[0][0], "", 0))
        want[100 + i] = text_of(site(1, 9)[0][0])
    for i, (source, _) in enumerate(site(5, 4)):  # too few pages to judge
        pages.append((200 + i, "http://small.example/", source, "", 0))
        want[200 + i] = text_of(source)
    pages += [(300, None, None, None, None), (301, "not a url", "", None, None), (None, "http://small.example/", "<p>x", None, None), pages[0]]
    want |= {300: "", 301: "", None: "x"}
    got = s.main_text(rows(pages, SCHEMA)).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)
    assert s.main_text(rows([], SCHEMA)).collect() == []


def test_importance_by_plain_counts(rows):
    pages = [(h, source) for h, n in (("a", 12), ("b", 7)) for source, _ in site(n, n)]
    pages += pages[:4]
    seen = defaultdict(set)
    for h, source in pages:
        for page, node, style, content in s.observations(s.parse(source)):
            seen[h, node].add((page, style, content))
    got = {(r.host, r.node): r for r in s.importance(rows(pages, "host string, html string")).collect()}
    assert set(got) == set(seen)
    for key, values in seen.items():
        m = len(values)
        assert got[key].pages == m
        for at, name in ((1, "presentation"), (2, "content")):
            counts = Counter(v[at] for v in values).values()
            assert got[key][name] == pytest.approx(-sum(c / m * log(c / m) for c in counts) / log(m), abs=1e-9)


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ('<div class="layout has-sidebar"><article><p>one two three</p></article><div class="sidebar">x</div></div>', "one two three"),
        ('<nav>menu</nav><div id="search-page"><p>one two three</p><div class="ads">buy</div></div>', "one two three"),
        ('<div class="post-with-comments"><p>one two three</p><section id="comments"><p>me too</section></div>', "one two three"),
        ('<form><nav>menu</nav><div><p>one two three</p></div></form>', "one two three"),
        ('<article><p>one</p></article><aside><article><p>a longer teaser</p></article></aside>', "one"),
    ],
)
def test_declared_noise_never_takes_the_article(source, want):
    assert text_of(source) == want


def test_declared_nodes_are_counted():
    page = s.parse('<nav><p>menu</p></nav><p>text</p>')
    assert {n.key for n in page.nodes} == {k & (1 << 64) - 1 for _, k, _, _ in s.observations(page)}
