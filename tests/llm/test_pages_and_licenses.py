import html
import re

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from featureforge.llm import catalog, licenses, pages
from tests.llm.conftest import LONG, ODD, SF


def test_articles_of_all_pages(spark):
    got = {r["page_id"]: r for r in catalog.op3_main_text(spark, SF).collect()}
    table = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    assert len(got) == len(table)
    for p in table:
        inner = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        blocks = (re.sub("</?b>", "", x) for x in re.split(r"</?(?:p|h1|br)>", inner))
        want = " ".join(" ".join(html.unescape(x).split()) for x in blocks if x.strip())
        assert (got[p["page_id"]]["text"], got[p["page_id"]]["n_chars"]) == (want, len(want))


def test_differencing_finds_the_frame(spark):
    site = [(i, f"http://h.example/a/{i}", f"<div>Home | About</div><p>Body {i} text</p><div>Contact us</div>") for i in range(6)]
    odd = [(7, None, None), (8, "", ""), (9, "http://k.example/x", "<p>alone &amp; whole</p>"), (9, "http://k.example/x", "<p>alone &amp; whole</p>"),
           (10, "http://l.example/x", "<p>" + LONG + "</p>")]
    df = spark.createDataFrame(site + odd, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS host", "2 AS lines")
    got = sorted(((r["page_id"], r["text"]) for r in pages.main_texts(df).collect()), key=str)
    want = [(i, f"Body {i} text") for i in range(6)] + [(7, ""), (8, ""), (9, "alone & whole"), (9, "alone & whole"), (10, LONG.strip())]
    assert got == sorted(want, key=str)
    assert pages.main_texts(df.limit(0)).collect() == []


def test_articles_are_judged_and_do_not_hide_plain_text(spark):
    """Boilerplate inside articles goes; quotations and copies stay; a teaser
    card does not replace the text outside it."""
    quote = "A quoted sentence that two neighbours have."
    rows = [(i, f"http://h.example/a/{i}", f"<article><h1>Title {i}</h1><p>Read more on our site</p><p>Body of page {i} with its own words"
             f"{' and more ' * 9}</p>{f'<p>{quote}</p>' if i in (3, 4) else ''}<p>Sign up today</p></article>") for i in range(8)]
    rows += [(10 + i, f"http://c.example/a/{i}", "<article><h1>Same</h1><p>The same text on every page</p></article>") for i in range(8)]
    rows += [(20 + i, f"http://t.example/a/{i}", f"<div>Home | About</div><article>Teaser {i}</article><p>Main text {i} in plain blocks</p>"
              "<div>Contact us</div>") for i in range(6)]
    rows += [(30, "http://u.example/a", "<article>Teaser</article><p>A lonely page with its main text in plain blocks</p>"),
             (31, "http://v.example/a", "<div>Home</div><article>A lonely page with its article</article>")]
    got = {r["page_id"]: r["text"] for r in pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    more = " ".join((" and more " * 9).split())
    for i in range(8):
        assert got[i] == f"Title {i} Body of page {i} with its own words {more}" + (f" {quote}" if i in (3, 4) else "")
        assert got[10 + i] == "Same The same text on every page"
    assert [got[20 + i] for i in range(6)] == [f"Teaser {i} Main text {i} in plain blocks" for i in range(6)]
    assert got[30] == "Teaser A lonely page with its main text in plain blocks" and got[31] == "A lonely page with its article"


def test_frame_and_article_parts():
    source = ('<nav>menu</nav><article class="x"><header><h1>T</h1></header><p>a<br>b <b>c</b></p><aside>no</aside>d'
              '<div class="user-comments">no</div></article><div id="cookie-notice">no</div>t<script>if(a<b)</script>')
    kept = [x for part, x in pages.page_lines(source) if part == pages.ARTICLE]
    assert kept == ["T", "a", "b c", "d"]
    assert [x for part, x in pages.page_lines(source) if part == pages.PLAIN] == ["t"]


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=10), st.lists(st.integers(0, 3), max_size=10))
def test_common_lines_is_a_longest_common_subsequence(a, b):
    shared = [x for x, s in zip(a, pages.common_lines(a, b)) if s]
    rest = iter(b)
    assert all(x in rest for x in shared) and len(shared) == longest(a, b)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=12), st.lists(st.integers(1, 6), max_size=8))
def test_patience_aligns_equal_words_in_order(text, template):
    pairs = licenses.patience(text, template)
    assert all(text[i] == template[j] for i, j in pairs)
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
    assert len(pairs) <= longest(text, template)


@settings(max_examples=100, deadline=None)
@given(st.permutations(range(8)))
def test_increasing_is_longest(order):
    got = [b for _, b in licenses.increasing(list(enumerate(order)))]
    assert got == sorted(got) and len(got) == longest(order, sorted(order))


def test_notices_in_documents(spark, rows):
    notices = {"Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0 notice", "Released under the MIT License": "MIT notice",
               "This work is licensed under the GNU General Public License, version 3": "GPL-3.0 notice",
               "Licensed under the Apache License, Version 2.0": "Apache-2.0 notice", "All rights reserved": "All rights reserved"}
    got = {r["doc_id"]: r for r in catalog.op5_license_scan(spark, SF).collect()}
    assert len(got) == len(rows)
    for k, text in rows:
        want = {name for line, name in notices.items() if line.lower() in text.lower()}
        assert want <= set((got[k]["licenses"] or "").split(","))
        assert bool(want) == (got[k]["n_licenses"] > 0)


def test_edited_and_repeated_licences(spark, odd, empty):
    mit = licenses.TEMPLATES["MIT"]
    words = mit.split()
    edited = " ".join(words[:40] + ["foo"] + words[44:])
    df = spark.createDataFrame([(1, f"x {edited} y"), (2, f"{mit} z {mit}"), (3, " ".join(words[:20]))], "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in licenses.license_scan(df).collect()}
    assert [(x["license"], x["coverage"] > 0.9, x["coverage"] < 1) for x in got[1]] == [("MIT", True, True)]
    assert [(x["license"], x["coverage"]) for x in got[2]] == [("MIT", 1.0)]
    assert got[3] == []
    assert len(licenses.license_scan(odd).collect()) == len(ODD)
    assert licenses.license_scan(empty).collect() == []


def test_copies_without_their_rarest_words(spark):
    """The copy lacks three words that the prose has once each."""
    rare = {"hereby", "all", "rights"}
    copy = " ".join(w for w in licenses.TEMPLATES["MIT"].split() if w.strip(",").lower() not in rare)
    prose = " ".join(f"w{i} " + {100: "hereby", 400: "all", 700: "rights"}.get(i, "") for i in range(1000))
    inserted = licenses.TEMPLATES["MIT"].split()
    inserted = " ".join(inserted[:30] + [f"x{i}" for i in range(40)] + inserted[30:])
    df = spark.createDataFrame([(1, f"{prose} {copy}"),
                                (2, f"{inserted} {prose}")], "doc_id long, text string")
    got = {r["doc_id"]: [x["license"] for x in r["licenses"]] for r in licenses.license_scan(df).collect()}
    assert got == {1: ["MIT"], 2: ["MIT"]}
