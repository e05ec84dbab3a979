"""HTML extraction: parsing, simple tree matching, wrappers of whole hosts, the driver's pages."""

import html
import itertools
import random
import re

import pytest

import __spark_entry__ as E
from cohortlens.llm import page_tree as pt
from cohortlens.llm import storage
from cohortlens.llm import wrapper_extract as wx
from helpers import SF


def alone(text):
    root, found = wx.page(text)
    return wx.content(root, found, None, set(), set())


def plain(text):
    """The driver's pages: the article's paragraphs, cut at the tags."""
    body = re.search(r"<article>(.*?)</article>", text, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
    return "\n".join(t for t in (" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts) if t)


def test_whole_table(spark):
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in E.queries()["op11_wrapper_extract"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert got == {r.page_id: (r.url, plain(r.html), len(plain(r.html))) for r in rows}


@pytest.mark.parametrize("text,want", [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("a &amp b &am &quot;c&quot;&nbsp;&#x41;", 'a & b &am "c" A'),
    ("<p><b>one<br><p>two</p>three", "one\ntwo\nthree"), ("<p>a<!-- <p>b -->c</p>", "ac"), ("<p title='x>y'>a</p>", "a"),
    ("<p title=don't>a</p>", "a"), ("1 < 2 <p>x", "1 < 2\nx"), ("<p>cut <a href", "cut"), ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<div>a<script>var t='</p>';</script>b</div>", "ab"),
    ("<title>t</title><p>x", "x"), ("<script>never closed <p>x", ""), ("<p>a<button>no</button>b<span class=ad>no</span>c", "abc"),
    ("<form><p>no</form><p>yes", "yes"), ("<form><article><p>yes, it is the page</article></form>", "yes, it is the page"),
    ("<main><header><h1>t</h1><p>by</p></header><p>x</main>", "t\nx"), ("<div class='reader-comments'><p>no</div><p>x", "x"),
    ("<article><p>x<section id=comments><article class=comment>no</article></section></article><aside>no</aside>", "x"),
    ("<div hidden><p>no</div><div style='display: none'>no</div><p>x", "x"), ("<main></main><div><p>x</div>", "x"),
])
def test_single_pages(text, want):
    assert alone(text) == want


def test_deep_wide_and_long_pages():
    assert alone("<div>" * 30000 + "x") == "x"
    assert alone("<p>a</p><div>b</div>" * 3000) == "\n".join(["a", "b"] * 3000)
    assert alone("".join(f"<div class=c{chr(97 + i % 26)}{chr(97 + i // 26)}>a</div>" for i in range(600))) == "\n".join(["a"] * 600)
    long = "word " * 300000
    assert alone(f"<article>{long}</article>") == long.strip()


def plain_match(a, b):
    """Simple tree matching by its recursion over all order-keeping pairings."""
    if a[0] != b[0]:
        return 0
    best = 0
    for k in range(1, min(len(a[1]), len(b[1])) + 1):
        for xs in itertools.combinations(a[1], k):
            for ys in itertools.combinations(b[1], k):
                best = max(best, sum(plain_match(x, y) for x, y in zip(xs, ys)))
    return best + 1


def random_shape(rng, depth):
    return [rng.choice("ab"), [random_shape(rng, depth - 1) for _ in range(rng.randint(0, 3))] if depth else []]


def test_simple_tree_matching_against_all_pairings():
    rng = random.Random(4)
    for _ in range(150):
        a, b = random_shape(rng, 3), random_shape(rng, 3)
        assert pt.match(a, b) == plain_match(a, b)
        pairs = pt.align(a[1], b[1])
        assert [i for i, _ in pairs if i is not None] == list(range(len(a[1]))) and [j for _, j in pairs if j is not None] == list(range(len(b[1])))
        both = sum(plain_match(a[1][i], b[1][j]) for i, j in pairs if i is not None and j is not None)
        assert a[0] != b[0] or both + 1 == plain_match(a, b)


def _site(i, body):
    return (f"<html><body><div class=top><div>Daily Site</div><div>tip {'abc'[i % 3]}</div></div><div class=wrap><h1>Title {i}</h1>{body}"
            f"<div class=more><p>Read our journal</p></div></div><div class=end><p>All rights kept</p></div></body></html>")


@pytest.mark.parametrize("parts", [1, 4])
def test_wrapper_of_unmarked_site(spark, parts):
    """No semantic marks at all: the constant and the rotating nodes are found by alignment alone."""
    rows = []
    for i in range(24):
        extra = "<div class=note2><p>Some extra about %d</p></div>" % i if i % 4 == 0 else ""
        rows.append((i, f"https://Site.example/{i}", _site(i, extra + f"<p>Story {i} begins.</p><p>It ends {i * 7}.</p>")))
    copy = "<p>One story that was posted often.</p><p>Its second part.</p>"
    rows += [(100 + i, f"http://user@copies.example:80/{i}", _site(5, copy)) for i in range(20)]  # one page, many copies
    rows += [(200, None, _site(1, "<p>x</p>")), (201, "no host", _site(1, "<p>x</p>")), (202, "https://site.example/none", None), (7, "https://site.example/7", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, wrapper string").repartition(parts)
    out = wx.extract(df, storage.work_folder(spark, "t")).collect()
    got = {(r.page_id, r.url): r.text for r in out}
    assert len(out) == len(rows)
    for i in range(24):
        extra = [f"Some extra about {i}"] if i % 4 == 0 else []
        assert got[(i, f"https://Site.example/{i}")] == "\n".join([f"Title {i}", *extra, f"Story {i} begins.", f"It ends {i * 7}."])
    assert all("One story that was posted often.\nIts second part." in got[(100 + i, f"http://user@copies.example:80/{i}")] for i in range(20))
    assert got[(202, "https://site.example/none")] == got[(7, "https://site.example/7")] == ""
    assert "\nx\n" in got[(200, None)] and "\nx\n" in got[(201, "no host")]


def test_near_copies_of_one_host_lose_nothing(spark):
    rows = []
    for i in range(12):
        ps = [f"Paragraph {k} of the shared passage." for k in range(8)]
        ps[i % 8] += f" Edited {i}."
        rows.append((i, "http://h.example/", "<article><h1>Same title</h1>" + "".join(f"<p>{p}" for p in ps) + "</article>", ps))
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wx.extract(df, storage.work_folder(spark, "t")).collect()}
    assert got == {i: "\n".join(["Same title", *ps]) for i, _, _, ps in rows}


def test_wrappers_fold_in_steps(spark, monkeypatch):
    """Many shapes of one host, few a step: the wrapper holds all their nodes."""
    monkeypatch.setattr(wx, "FAN", 3)
    pages = [(i, "http://h.example/", "".join(f"<div class={'abcdefgh'[k]}x><p>{i}</p></div>" for k in range(8) if i >> k & 1)) for i in range(1, 60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    facts = wx.page_facts(df.withColumn("host", wx.host_of("url")), "host", "html")
    known = wx.wrappers(facts, storage.work_folder(spark, "t")).collect()
    assert len(known) == 1
    assert all(f"div.{c}x" in known[0].wrapper for c in "abcdef")


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert wx.extract(df, storage.work_folder(spark, "t")).collect() == []
