"""Wrapper induction on small sites, tree matching against all matchings, and odd pages."""

import itertools
import random

import pytest

from lexspark.llm import wrappers

SCHEMA = "page_id long, url string, html string, text string, layout string, key string"


def texts_of(spark, pages, host="http://h.example/"):
    rows = [(i, None if host is None else f"{host}{i}", page, "t", "l", "k") for i, page in enumerate(pages)]
    found = wrappers.extract(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


def test_parse_blocks_and_references():
    page = (
        '<!DOCTYPE html><html><head><title>no</title><script>var t="</p>";</script><style>p{}</style></head>'
        "<body><p>a &amp; b&nbsp;&#x41;&am <b>bo</b>ld<br>next\n line<p>two<ul><li>x<li>y</ul>bare<!-- no <p> -->text"
        "<table><tr><td>1<td>2</table><a href='>'>link</a> 1 < 2 <unfinished"
    )
    labels, parents, blocks = wrappers.parse(page)
    assert [t for _, t, _ in blocks] == ["a & b A&am bold next line", "two", "x", "y", "baretext", "1", "2", "link 1 < 2"]
    assert blocks[-1][2] == 4
    assert wrappers.read_layout(wrappers.write_layout(labels, parents)) == (labels, parents)


@pytest.mark.parametrize("page", ["", "<", "<div>" * 3000 + "deep", "</p></p>x", "<!-- open", "<p class='a", "<script>x", "<b>" * 2000, "\x00퟿"])
def test_odd_pages_parse(page):
    blocks = wrappers.parse(page)[2]
    assert ("deep" in page) == any("deep" in t for _, t, _ in blocks)


def brute_weight(tree, other, a=0, b=0):
    (labels, parents), (other_labels, other_parents) = tree, other
    rows = [i for i, p in enumerate(parents) if p == a]
    columns = [i for i, p in enumerate(other_parents) if p == b]
    best = 0
    for k in range(min(len(rows), len(columns)) + 1):
        for xs in itertools.combinations(rows, k):
            for ys in itertools.combinations(columns, k):
                if all(labels[x].split(".")[0] == other_labels[y].split(".")[0] for x, y in zip(xs, ys)):
                    best = max(best, sum(brute_weight(tree, other, x, y) for x, y in zip(xs, ys)))
    return best + 1 + (labels[a] == other_labels[b])


def test_tree_matching_is_the_best_one():
    pick = random.Random(4)
    for _ in range(150):
        trees = []
        for _ in range(2):
            n = pick.randrange(1, 8)
            trees.append((["html", *(pick.choice(["p", "div", "div.a", "div.b"]) for _ in range(n))], [-1, *(pick.randrange(i + 1) for i in range(n))]))
        matched = wrappers.match_trees(*trees[0], *trees[1])
        (labels, parents), (other_labels, other_parents) = trees
        assert len(set(matched.values())) == len(matched)
        for a, b in matched.items():
            assert labels[a].split(".")[0] == other_labels[b].split(".")[0]
            assert a == 0 or matched[parents[a]] == other_parents[b]
        weight = sum(1 + (labels[a] == other_labels[b]) for a, b in matched.items())
        assert weight == brute_weight(*trees)


def test_declared_regions(spark):
    pages = [
        f"<html><body><header>Site {i}</header><nav><a>n{i}</a></nav><div class='cookie-notice'>We use {i}</div><main><article>"
        f"<header><h1>Title {i}</h1></header><p>Body {i}</p><aside>aside {i}</aside><div class='share-bar'>share</div>"
        f"<div class=tools>Print</div><p>More &lt;{i}&gt;</p><form>f<input></form><div id='comments'><p>reader {i}</p></div></article></main>"
        f"<footer>foot {i}</footer></body></html>"
        for i in range(5)
    ]
    assert texts_of(spark, pages) == [f"Title {i}\nBody {i}\nMore <{i}>" for i in range(5)]


def test_class_names_about_other_parts():
    for name, never in (("has-sidebar", False), ("content-sidebar-wrap", False), ("left-sidebar", True), ("ads-top x", True), ("download", False)):
        assert wrappers._label("div", f' class="{name}"')[1] is never
    assert wrappers._label("body", ' class="menu"')[1] is False


def test_undeclared_regions_come_from_what_varies(spark):
    pages = [
        f"<body><div class=top><b>The site</b></div><table><tr><td><a>A{i}</a> <a>B{i}</a></td></tr></table>"
        f"<div class=box><h2>Heading {i}</h2><p>Long running text number {i} with many words.</p><p>Read on</p>"
        f"<div class=byline>All rights reserved</div><div class=extra>{'Only here.' if i == 2 else ''}</div></div><div class=end>The end</div>"
        for i in range(6)
    ]
    got = texts_of(spark, pages)
    assert got[1] == "Heading 1\nLong running text number 1 with many words.\nRead on"
    assert got[2].endswith("Only here.")


def test_layouts_of_a_host_are_aligned(spark):
    pages = [f"<body><div class=a><p>text of page {i}, which varies</p></div><div class=foo><section>same words</section></div>" for i in range(4)]
    # the same template under another class name
    pages += [f"<body><div class=a><p>text of page {i}, which varies</p></div><div class=bar><section>same words</section></div>" for i in range(4, 6)]
    assert texts_of(spark, pages) == [f"text of page {i}, which varies" for i in range(6)]


def test_copies_make_no_template(spark):
    page = "<body><article><h1>One title</h1><p>{}</p><p>shared paragraph</p></article>"
    pages = [page.format("same")] * 5 + [page.format(f"near copy {i}") for i in range(4)]
    assert texts_of(spark, pages) == ["One title\nsame\nshared paragraph"] * 5 + [f"One title\nnear copy {i}\nshared paragraph" for i in range(4)]


def test_odd_rows(spark):
    pages = [None, "", "   ", "plain words", "<p>x", "<p>x", "<article></article>", "<nav>only a menu</nav>", "<p>" + "word " * 200_000]
    want = ["", "", "", "plain words", "x", "x", "", "", " ".join(["word"] * 200_000)]
    assert texts_of(spark, pages, None) == want
    assert texts_of(spark, pages, "not a url ") == want
    assert wrappers.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_both_joins_give_the_same_rows(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    one = sorted(map(tuple, wrappers.extract(pages).collect()))
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, wrappers.extract(pages).collect())) == one
    assert len(one) == pages.count() and all(text for *_, text in one)


def test_hosts(spark):
    urls = ["https://User:x@Www.A.example:80/p?q", "http://b.example", "//c.example/x", "mailto:x", "", None, "http://d.example?x=//e"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    got = [r[0] for r in rows.orderBy("i").select(wrappers.host_of(rows["url"])).collect()]
    assert got == ["www.a.example", "b.example", "c.example", "", "", "", "d.example"]
