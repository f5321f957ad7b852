"""Page extraction: markup cases, repeated strings against plain counts, templates without names, odd rows."""

import random
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline  # noqa: F401  (registers the package with the workers)
from tidewell.llm import pages
from tidewell.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"


def sentence(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n)) + "."


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        ("<p>a &amp; b&nbsp;c<br>d</p>\n<p> e\tf </p>", ["a & b c d", "e f"]),
        ("<nav><ul><li>Home</ul></nav><article><h1>T</h1><p>x<p>y<aside>z</aside></article><p>tail", ["T", "x", "y"]),
        ("<header>top</header><main><header><h1>T</h1></header><p>x</main><footer>f</footer>", ["T", "x"]),
        ("<div class='site-header menu'>m</div><div id=post-content><p>x</p><div class='ad-box'>buy</div>y</div>", ["x", "y"]),
        ("<body class='has-sidebar'><p>x</p><div class=sidebar>s</div><section id=comments><p>nice</section>", ["x"]),
        ("<article><p>x</p><article class='comment'><p>first!</p></article><form>mail <input></form></article>", ["x"]),
        ("<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no</p> --><p>x<!-- n", ["x"]),
        ("<p hidden>h</p><div style='display: none'>h</div><div aria-hidden=true>h</div><p>x", ["x"]),
        ("<div role=navigation>n</div><div role=main><p>x</p></div><div>y</div>", ["x"]),
        ("<nav>never closed <p>n<article><p>x</p></article>", ["x"]),
        ("<aside>never closed<main><p>x</p></main>", ["x"]),
        ("<article><p>a<b>b</p><p>c</b>d</article><div>e</div>", ["ab", "cd"]),
        ("<b><nav>n</b>m</nav><p>x", ["x"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a b", "c"]),
        ('<p title="a > b">x</p><p>1 < 2 &lt; 3 &#x41;&#66;', ["x", "1 < 2 < 3 AB"]),
        ("plain text", ["plain text"]),
        ("", []),
        (None, []),
    ],
)
def test_blocks(page, blocks):
    assert pages.blocks_of(page)[1] == blocks


@pytest.mark.parametrize("piece", ["<a ", "<a '", '<a "', "<", "<!--", "</", "<p>", "</b><i>", "&amp", "x y "])
def test_time_is_linear(piece):
    began = time.perf_counter()
    pages.blocks_of(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - began < 10


def plain_counts(streams, least):
    owners = defaultdict(set)
    for k, page in enumerate(streams):
        for i in range(len(page) - least + 1):
            owners[tuple(page[i : i + least])].add(k)
    return [[len(owners[tuple(p[i : i + least])]) if i + least <= len(p) else 0 for i in range(len(p))] for p in streams]


@pytest.mark.parametrize("seed", range(8))
def test_repeats_equal_plain_counts(seed):
    rng = random.Random(seed)
    least = rng.choice([1, 2, 4, 8])
    streams = [[rng.choice("abc") for _ in range(rng.randrange(40))] for _ in range(rng.randrange(1, 9))]
    on, places = pages.repeated_on(streams, least)
    assert [on[own].tolist() for own in places] == plain_counts(streams, least)


def test_string_classes_are_equal_prefixes():
    rng = random.Random(3)
    tokens = np.array([rng.randrange(3) for _ in range(200)])
    padded = [*tokens.tolist(), *[-1] * 8]
    strings = [tuple(padded[i : i + 4]) for i in range(200)]
    classes = pages.string_classes(tokens, 4)
    # Numbers follow the order of the suffixes, as in a suffix array.
    assert [sorted(set(strings)).index(s) for s in strings] == classes.tolist()


def soup(rng, n, variants, *, named=False):
    """(pages, their articles): templates in plain divs, a notice in every article, copies and shared passages."""
    menus = [sentence(rng, 9) for _ in range(variants)]
    feet = [sentence(rng, 14) for _ in range(variants)]
    notice, passage = sentence(rng, 12), sentence(rng, 60)
    out, truth = [], []
    for i in range(n):
        article = [sentence(rng, rng.randrange(20, 60)) for _ in range(5)]
        if i % 5 == 1 and truth:
            article = truth[-1]
        if named and i % 6 == 2:
            article = [*article, passage]
        truth.append(article)
        body = "".join(f"<p>{b}</p>" for b in [*article[:2], *([notice] if named else []), *article[2:]])
        body = f"<article>{body}</article>" if named else f"<div>{body}</div>"
        menu = "".join(f"<div><a href=x>{w}</a></div>" for w in menus[i % variants].split())
        out.append(f"<html><body><div>{menu}</div>{body}<div>{feet[i % variants]} page {i} of many</div></body></html>")
    return out, truth


@pytest.mark.parametrize("named", [False, True])
@pytest.mark.parametrize(("part_chars", "variants"), [(4 << 20, 4), (30_000, 1)])
def test_templates_without_names(spark, monkeypatch, named, part_chars, variants):
    monkeypatch.setattr(pages, "PART_CHARS", part_chars)
    html, truth = soup(random.Random(7), 60, variants, named=named)
    rows = [(i, f"https://host{i // 40}.example.org/{i}", h) for i, h in enumerate(html)]
    got = {r.page_id: r for r in pages.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(got) == len(rows)
    wrong = [i for i, blocks in enumerate(truth) if got[i].text != "\n\n".join(blocks)]
    assert not wrong
    assert sum(r.n_boilerplate for r in got.values()) > 0


def test_pages_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op12_pages"](spark, folder).collect()
    source = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    assert len(got) == len(source)
    for row in got:
        level, blocks = pages.blocks_of(source[row.page_id].html)
        assert level == pages.IN_ARTICLE and row.text == "\n\n".join(blocks) and row.n_chars == len(row.text)
        assert row.url == source[row.page_id].url


def test_odd_pages(spark, tmp_path):
    long = "<article>" + "<p>word &lt; word</p>" * 50_000 + "</article>"
    rows = [(1, "http://a.b/", None), (2, None, "<p>x"), (2, None, "<p>x"), (3, "not a url", ""), (None, "http://a.b/", "<p>y"),
            (4, "HTTP://u@A.b:80/z", long), (5, "http://a.b/q", "<p>\x00zero"), (6, "", "<script>x")]
    names = {c: F.lit("x") for c in ("host", "h", "part", "parts", "blocks", "large", "chars", "text")}
    spark.createDataFrame(rows, PAGES).withColumns(names).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((tuple(r) for r in QUERIES["op12_pages"](spark, str(tmp_path)).collect()), key=repr)
    texts = ["", "x", "x", "", "y", "\n\n".join(["word < word"] * 50_000), "zero", ""]
    assert got == sorted(((i, u, t, len(t), 0) for (i, u, _), t in zip(rows, texts, strict=True)), key=repr)
    spark.createDataFrame([], PAGES).write.parquet(f"{tmp_path}/none/pages.parquet")
    assert QUERIES["op12_pages"](spark, f"{tmp_path}/none").count() == 0


def test_hosts():
    urls = ["http://U@Ex.org:8/x", " https://a.b?x", "ftp://h#t", "//no", "mailto:x", "", None, "http:///x"]
    assert [pages.host_of(u) for u in urls] == ["ex.org", "a.b", "h", None, None, None, None, None]
