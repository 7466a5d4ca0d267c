"""Main text of pages against a brute-force style tree and hand-made pages."""

import collections
import html as entities
import itertools
import math
import random
import re

import pytest

from pagemill.llm import main_text
from pagemill.llm.main_text import extract_main_text, read_tree
from pagemill.llm.queries import QUERIES
from pagemill.session import table

SCHEMA = "page_id bigint, url string, html string"


def extracted(spark, pages):
    return {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(pages, SCHEMA)).collect()}


def children_with_paths(node, path):
    seen = collections.Counter()
    for name, group in itertools.groupby(node.children, key=lambda c: f"{c.tag}.{c.names}"):
        step = (*path, name, seen[name])
        seen[name] += 1
        for child in group:
            yield child, step


def merged(trees):
    """``path -> (importance, styles)`` of one host by the definitions of the style tree."""
    shown, held = collections.defaultdict(list), collections.defaultdict(list)
    for tree in trees:
        styles, contents = collections.defaultdict(set), collections.defaultdict(collections.Counter)

        def walk(node, path):
            styles[path].add(tuple(n for n, _ in itertools.groupby(f"{c.tag}.{c.names}" for c in node.children)))
            if node.text is not None:
                contents[path].update([("text", node.text), *[("href", x) for x in node.links]])
            for child, step in children_with_paths(node, path):
                walk(child, step)

        walk(tree, ())
        for path, found in styles.items():
            shown[path].append(frozenset(found))
            held[path].append(contents[path])
    answer = {}
    for path, pages in shown.items():
        m = len(pages)
        if m < main_text.MIN_PAGES:
            continue
        share = [n / m for n in collections.Counter(pages).values()]
        worth = -sum(p * math.log(p, m) for p in share)
        features = {f for c in held[path] for f in c}
        if features:
            entropies = []
            for f in features:
                counts = [c[f] for c in held[path] if c[f]]
                entropies.append(-sum(n / sum(counts) * math.log(n / sum(counts), m) for n in counts))
            worth = 1 - sum(entropies) / len(entropies)
        answer[path] = (worth, len(share))
    return answer


def text_by_hand(tree, worth):
    def judge(node, path, main):
        main_here = main or node.fixed == 1
        below = [judge(c, p, main_here) for c, p in children_with_paths(node, path)]
        own, styles = worth.get(path, (1.0, 1))
        if node.fixed is not None:
            own = float(node.fixed)
        elif below:
            share = main_text.GAMMA**styles
            own = (1 - share) * own + share * sum(b[0] for b in below) / len(below)
        best = max([own, *[b[1] for b in below]])
        if node.fixed == 0 or node.tag == "header" and not main:
            return own, best, [], []
        guarded = node.fixed == 1 or main_here and (node.tag in main_text.TEXTUAL or node.text is not None)
        mine = [(main_here, node.text)] if node.text else []
        every = mine + [t for b in below for t in b[2]]
        kept = mine + [t for b in below for t in b[3]]
        return own, best, every, kept if guarded or best >= main_text.MIN_IMPORTANCE else []

    _, _, every, kept = judge(tree, (), False)
    return "\n".join([t for main, t in kept if main] or [t for _, t in kept] or [t for _, t in every])


def site(rng, host, n_pages, with_main):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    top, left, offers, notice = text(4), [text(2) for _ in range(3)], [text(5) for _ in range(3)], text(9)
    pages = []
    for _ in range(n_pages):
        body = "".join(f"<p>{text(rng.randint(3, 30))}</p>" for _ in range(rng.randint(1, 5)))
        if rng.random() < 0.2:
            body += f"<p>{notice}</p>"
        extra = f"<div class='tip'><div>{notice}</div></div>" if rng.random() < 0.7 else ""
        inner = f"<h1>{text(3)}</h1>{body}{extra}"
        inner = f"<article>{inner}</article>" if with_main else f"<div class=c1>{inner}</div>"
        pages.append(
            f"<html><body><div class=x1>{top}</div><div class=x2>{''.join(f'<span>{x}</span><br>' for x in left)}</div>"
            f"{inner}<div class=x3><p>{rng.choice(offers)}</p></div>{text(3) if rng.random() < 0.3 else ''}</body>"
        )
    return [(f"http://{host}/{n}", p) for n, p in enumerate(pages)]


def test_texts_equal_a_brute_force_style_tree(spark):
    rng = random.Random(8)
    pages = [p for n, size in enumerate((1, 2, 3, 8, 25, 40)) for p in site(rng, f"h{n}.example", size, n % 2 == 0)]
    pages = [(n, *p) for n, p in enumerate(pages)]
    trees = {n: read_tree(h) for n, _, h in pages}
    hosts = collections.defaultdict(list)
    for n, url, _ in pages:
        hosts[url.split("/")[2]].append(n)
    want = {}
    for members in hosts.values():
        worth = merged([trees[n] for n in members])
        want |= {n: text_by_hand(trees[n], worth) for n in members}
    assert extracted(spark, pages) == want


def test_noise_without_a_name_is_found_by_its_entropy(spark):
    rng = random.Random(3)
    pages = [(n, *p) for n, p in enumerate(site(rng, "a.example", 30, False))]
    for n, text in extracted(spark, pages).items():
        page = pages[n][2]
        inner = page[page.index("<div class=c1>") + 14 : page.index("<div class=x3>")]
        inner = re.sub("<div class='tip'>.*?</div></div>", "", inner)
        want = [x for x in re.split(r"<[^>]*>", inner) if x.strip()]
        assert [x for x in text.split("\n") if x in want] == want and len(text.split("\n")) <= len(want) + 1
        assert page[page.index("x1>") + 3 : page.index("</div>")] not in text


def test_stated_roles_markup_and_references(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
    <article><header><h1>The &quot;title&quot;</h1></header><p><b>One &amp; two<br>three   four<p>five&nbsp;six
    <ul><li>first<li>second</ul><pre>a   b</pre><div class="ad">Buy</div><form><input value=x>Mail</form>
    <div hidden>secret</div><table><tr><td>1<td>2</table>tail <i>text</i></article>
    <section id="comments"><article class="comment"><p>A reader says</p></article></section>
    <aside>Side</aside><div role="banner">Banner</div><footer>&copy; me</footer></body></html>"""
    want = 'The "title"\nOne & two three four\nfive six\nfirst\nsecond\na b\n1\n2\ntail text'
    assert extracted(spark, [(1, "http://x.example/", page)]) == {1: want}


def test_menus_of_links_only_are_dropped_outside_of_the_article(spark):
    links = "<ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul>"
    pages = [(1, "http://x.example/", f"{links}<p>Text</p>"), (2, "http://y.example/", f"<main>{links}<p>Text</p></main>")]
    assert extracted(spark, pages) == {1: "Text", 2: "One\nTwo\nText"}


def test_copies_keep_their_article(spark):
    body = "<div class=m>menu</div>{}<p>Same text on every page.</p>{}"
    pages = [(n, f"http://a.example/{n}", body.format("<article>", "</article>")) for n in range(20)]
    pages += [(100 + n, f"http://b.example/{n}", body.format("<div>", "</div>")) for n in range(20)]
    found = extracted(spark, pages)
    assert {found[n] for n in range(20)} == {"Same text on every page."}
    assert {found[100 + n] for n in range(20)} == {"menu\nSame text on every page."} or {
        found[100 + n] for n in range(20)
    } == {"Same text on every page."}


def test_nasty_rows(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    wide = "<p>word</p>" * 30_000
    rows = [
        (1, None, "<p>a"), (2, "no host", "b"), (3, "http://h.example", None), (4, "http://h.example", ""),
        (5, "http://h.example", deep), (6, "http://h.example", wide), (None, "http://h.example", "<p>c</p></div></p>"),
        (7, "http://h.example", "x < y &#0; &bogus; <![if IE]> z <"), (8, "http://H.example", "<script>unclosed"),
    ]
    df = spark.createDataFrame([(*r, 1, "k", [1]) for r in [*rows, *rows[:3]]], f"{SCHEMA}, bucket int, host string, key array<int>")
    found = [tuple(r) for r in extract_main_text(df).collect()]
    assert len(found) == 12 and all(len(r[2]) == r[3] for r in found)
    texts = {r[0]: r[2] for r in found}
    assert texts[1] == "a" and texts[2] == "b" and texts[3] == texts[4] == texts[8] == "" and texts[None] == "c"
    assert texts[5] == "deep" and texts[6] == "\n".join(["word"] * 30_000) and texts[7].startswith("x < y")
    assert extract_main_text(df.limit(0)).collect() == []


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_finds_whole_articles(spark, folder):
    folder = f"/root/testdata/{folder}"
    found = {r["page_id"]: r for r in QUERIES["op12_html_extraction"](spark, folder).collect()}
    for r in table(spark, folder, "pages").collect():
        article = r["html"][r["html"].index("<article>") : r["html"].index("</article>")]
        blocks = [re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(b for b in (" ".join(entities.unescape(b).split()) for b in blocks) if b)
        got = found[r["page_id"]]
        assert (got["url"], got["text"], got["n_chars"]) == (r["url"], want, len(want))
