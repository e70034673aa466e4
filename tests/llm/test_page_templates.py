import html as entities
import re
import time

import numpy as np
import pandas as pd

from tests.conftest import DATA
from tidemark.llm import queries
from tidemark.llm.html_tokens import CLOSE, OFF, START, TEXT, tokens
from tidemark.llm.page_templates import MIXED, OUTSIDE, main_text, main_texts, relations, templates, valid, _stream

PAGES = "page_id long, url string, html string, text string, host string, names string"


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)
    return sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in main_texts(frame).collect()), key=str)


def shop(i, body):
    """A host without article tags: only its template tells what is its text."""
    items = "".join(f"<li><a href='/{i}/{k}'>link {k} of {i}</a></li>" for k in range(i % 3 + 1))
    return (f"<html><head><title>t{i}</title></head><body><div class=top><span>The shop of all shops</span></div><ul>{items}</ul>"
            f"<div id=x{i}>{body}</div><div class=end>Open all day</div></body></html>")


def test_whole_table_of_articles(spark):
    found = {r["page_id"]: r for r in queries.op12(spark, DATA).collect()}
    pages = pd.read_parquet(f"{DATA}/pages.parquet")
    assert len(found) == len(pages)
    for page, text in zip(pages["page_id"], pages["html"]):
        inside = re.search("<article>(.*?)</article>", text, re.S)[1]
        want = " ".join(entities.unescape(re.sub("<[^>]*>", " ", inside)).split())
        assert found[page]["text"] == want and found[page]["n_chars"] == len(want)


def test_host_template_without_article_tags(spark):
    rows = [(i, f"http://s.example/{i}", shop(i, f"<p>What {i} costs<p>and <b>why {i}</b><p>All prices in euros")) for i in range(8)]
    for page, _, text, _ in run(spark, rows):
        assert text == f"What {page} costs and why {page}"


def test_defined_results(spark):
    page = "<body><nav>menu</nav><article><h1>A &amp; B</h1><p>one\n two&nbsp;x<p>three<br>4</article><footer>f</footer>"
    rows = [(1, "http://a.example/1", None), (2, "http://a.example/2", ""), (3, None, page), (4, "no url", page), (None, "http://A.example:80?x", page),
            (5, "http://b.example", page), (5, "http://b.example", page), (6, "http://b.example", " \n "), (7, "http://b.example", "<"),
            (8, "http://b.example", "plain &lt; text"), (9, "http://b.example", "<div><p>cut &am")]
    text = "A & B one two x three 4"
    want = [(1, "http://a.example/1", "", 0), (2, "http://a.example/2", "", 0)]
    want += [(*k, text, len(text)) for k in ((3, None), (4, "no url"), (None, "http://A.example:80?x"), (5, "http://b.example"), (5, "http://b.example"))]
    want += [(6, "http://b.example", "", 0), (7, "http://b.example", "<", 1), (8, "http://b.example", "plain < text", 12), (9, "http://b.example", "cut &am", 7)]
    assert run(spark, rows) == sorted(want, key=str)
    assert run(spark, []) == []


def test_marks_of_elements():
    for off in ("<div class='post-comments'>x</div>", "<div id=cookieNotice>x</div>", "<aside>x</aside>", "<form>x</form>", "<div role=search>x</div>",
                "<script>x<p></script>", "<style>x</style>", "<!-- x --><!--> -->"[:10], "<div class='ad'>x<p>x</div>", "<textarea>x</textarea>"):
        assert main_text(f"<article><p>a</p>{off}<p>b</p></article>", set()) == "a b", off
    assert main_text("<form action=/><article>a</article><p>x</p></form>", set()) == "a"
    assert main_text("<aside><article>x</article></aside><main><header>h</header><p>a</p></main>", set()) == "h a"
    assert main_text("<body class='has-sidebar'><header>x</header><article class=post><p>a</p></article>", set()) == "a"
    assert main_text("<article>a<svg><text>x</text></svg><span>b</span><i>c</i><div>d</article>", set()) == "a bc d"
    assert main_text('<article><a title="a > b" class=x href=\'>\'>a</a> <img alt="<p>x"> b</article>', set()) == "a b"


def test_malformed_and_long_pages_take_linear_time():
    started = time.time()
    for page in ("<div>" * 100_000 + "x" + "</p>" * 100_000, "<p a=\"" * 50_000, "<!--" * 100_000, "<li><b>" * 50_000, "</" * 100_000, "&" * 200_000,
                 "<a href='x" * 50_000, "<ul>" + "<b>" * 50_000 + "<li>" * 50_000):
        main_text(page, set())
    assert main_text("<article><p>" + "word " * 400_000 + "</article>", set()).count("word") == 400_000
    assert time.time() - started < 30


def test_tokens_have_paths():
    found = tokens("<div class='b a'><p>one<p>one</div><div class='a b'><p>one</div><p>one")
    texts = [t.role for t in found if t.kind == TEXT]
    assert texts[0] == texts[1] == texts[2] != texts[3]
    assert [t.kind for t in found[:4]] == [START, START, TEXT, START] and found[-1].region != OFF
    assert tokens("</p>")[0].kind == CLOSE


def test_relations_of_classes():
    known = {1: 10, 2: 10, 3: 10, 4: 20, 5: 20, 6: 30}
    got = relations([1, 4, 5, 4, 5, 2, 3, 6], known, {10: 3, 20: 2, 30: 1})
    assert (got[10, 20], got[20, 10], got[10, 30], got[30, 10]) == (0, OUTSIDE, OUTSIDE, OUTSIDE)
    assert got[10, 10] != MIXED != got[20, 20]
    assert relations([4, 5, 5, 4], known, {20: 2})[20, 20] == MIXED
    assert relations([1, 4, 2, 5, 3], known, {10: 3, 20: 2})[10, 20] == MIXED
    same = relations([1, 4, 5, 2, 3], known, {10: 3, 20: 2})
    assert valid({10: (9, 3), 20: (9, 2)}, same) == {10, 20}
    crossed = {(10, 10): 7, (20, 20): 8, (10, 20): MIXED, (20, 10): MIXED}
    assert valid({10: (9, 3), 20: (8, 2)}, crossed) == {10}
    assert valid({10: (9, 3)}, {(10, 10): MIXED}) == set()


def test_classes_against_brute_force(spark):
    """Template roles of each host: frequent tokens that share their occurrence vector with another one, ordered and nested."""
    rows = [(h, shop(i + 1, f"<p>{h} {i}</p>" * (i % 4))) for h in ("a", "b") for i in range(9)] + [("tiny", shop(3, ""))]
    frame = pd.DataFrame({"host": [h for h, _ in rows], "page": range(len(rows)), "html": [p for _, p in rows]})
    stream = next(_stream(iter([frame])))
    stream["roles"], made = [r.tolist() for r in stream["roles"]], {}
    hosts, found, _ = templates(spark.createDataFrame(stream, "host string, page long, roles array<long>, seen array<struct<role: long, c: int>>"))
    for r in hosts.join(found, "grp").collect():
        made[r["host"]] = set(r["names"])
    for host in ("a", "b"):
        pages = [r for h, r in zip(stream["host"], stream["roles"]) if h == host]
        vectors = {}
        for role in {x for p in pages for x in p}:
            v = tuple(p.count(role) for p in pages)
            if sum(c > 0 for c in v) >= 5:
                vectors.setdefault(v, []).append(role)
        large = {v: r for v, r in vectors.items() if len(r) > 1}
        assert made[host] == {x for r in large.values() for x in r}  # all of these are in order and nest
        assert len(large) >= 2
    assert np.all([len(v) for v in made.values()])
