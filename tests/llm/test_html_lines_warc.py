"""Ops 1, 2 and 4."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import time
from collections import Counter

import pytest

from haltwerk.llm import extract, lines, warc
from haltwerk.llm.html_text import blocks_of

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, host string, key string, covered string"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "k", "c") for r in rows], PAGES)


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(1, None, None), (2, "http://a b/ü", ""), (3, "x", "WARC/1.0\r\n\r\nhi"), (5, "x\ny", "é\n\n"), (4, "x", "é\n\n"), (9, "", "z" * 2_000_000)]
    return _pages(spark, [*rows, (None, "u", "q"), (8, "u", "q"), (8, "u", "q"), (None, None, None)])


def test_articles_of_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in extract.extract_main_text(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*)</article>", r.html, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n\n".join(x for x in parts if x)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<nav>m</nav><main><p>a</p><aside>s</aside><p>b<br>c</p></main><footer>f</footer>", ["a", "b c"]),
        ("<header>site</header><article><header><h1>T</h1></header><p>x &lt;b&gt; &amp; y&#33;</article><section class='user-comments'><article>no</article></section>", ["T", "x <b> & y!"]),
        ("<div class='ad'>buy</div><div id=content><p>one</p><form>f <input value=x></form><p>two<script>var t='</p>'</script></div>", ["one", "two"]),
        ("<article><p>keep<div class='cookie-notice'>ok?</div><p hidden>h<p>more</article>", ["keep", "more"]),
        ("<article>a<!-- <p>gone</p> -->b<style>p{}</style> <b>c<p>d</article>", ["ab c", "d"]),
        ("<article><p>1 < 2 and 3 > 2</p><table><tr><td>x<td>y</table></article>", ["1 < 2 and 3 > 2", "x", "y"]),
    ],
)
def test_blocks_by_markup(page, text):
    assert [b.text for b in blocks_of(page) if b.role == 2] == text


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x" + "</p>" * 100_000, "<a " * 60_000, "<a " * 60_000 + ">", '<a "' * 20_001, "<!--" * 60_000, "<title>" * 30_000, "<i>" * 50_000 + "</i>" * 50_000])
def test_hostile_markup_takes_linear_time(page):
    start = time.perf_counter()
    blocks_of(page)
    assert time.perf_counter() - start < 20


def test_boilerplate_of_pages_without_structure(spark, none, odd_pages):
    page = lambda x: f"<body><div>Home</div><div>About us now</div>{x}<div>Copyright by us all rights</div></body>"
    rows = [(1, "http://h.com/1", page("<p>first unique text&nbsp;here</p>")), (2, "http://H.com:80/2", page("<p>second unique text here</p>"))]
    rows += [(3, "http://other.org", page("<p>third</p>")), (4, "http://h.com/4", page("<p>first unique text here</p><p>and more of it</p>")), rows[0]]
    got = sorted((r.page_id, r.text, r.n_repeated) for r in extract.extract_main_text(_pages(spark, rows)).collect())
    # Page 1 is all repeated on other pages, so it is taken for a copy and stays whole.
    whole = "Home\n\nAbout us now\n\nfirst unique text here\n\nCopyright by us all rights"
    assert got == [(1, whole, 0), (1, whole, 0), (2, "second unique text here", 3), (3, "Home\n\nAbout us now\n\nthird\n\nCopyright by us all rights", 0), (4, "and more of it", 4)]
    assert extract.extract_main_text(_pages(spark, [])).collect() == []
    odd = extract.extract_main_text(odd_pages).collect()
    assert len(odd) == odd_pages.count() and all(r.n_chars == len(r.text) for r in odd)
    assert {r.text for r in odd if r.page_id in (1, 2)} == {""}


def test_copies_of_an_article_do_not_erase_each_other(spark):
    """An unmarked article on a page, its exact copy, a near copy and a page that quotes it, among 20 pages of a host with one menu."""
    page = lambda x: f"<body><div>Home and about us</div>{x}<div>Copyright by us all rights</div></body>"
    body = "<p>the first paragraph of the article</p><p>its second paragraph is here</p>"
    rows = [(1, "http://h.com/1", page(body)), (2, "http://h.com/copy", page(body)), (3, "http://h.com/3", page(body + "<p>one line more than it</p>"))]
    rows += [(4, "http://h.com/4", page("<p>they wrote of it so</p><p>its second paragraph is here</p>"))]
    rows += [(i, f"http://h.com/{i}", page(f"<p>page number {i} has this text</p>")) for i in range(5, 21)]
    got = {r.page_id: (r.text, r.n_repeated) for r in extract.extract_main_text(_pages(spark, rows)).collect()}
    article = "the first paragraph of the article\n\nits second paragraph is here"
    assert got[1] == got[2] == (article, 2)
    assert got[3] == (f"{article}\n\none line more than it", 2)
    assert got[4] == ("they wrote of it so\n\nits second paragraph is here", 2)
    assert all(got[i] == (f"page number {i} has this text", 2) for i in range(5, 21))


def test_contents_are_counted_once_across_range_borders(spark):
    """Copies of one content in many small ranges are one content; two others have the substring too."""
    rows = [(i, 7, "<p>same words on every page</p><p>of the first content here</p>") for i in range(300)]
    rows += [(300 + i, 7, f"<p>same words on every page</p><p>content number {i} is here</p>") for i in range(2)]
    rows += [(400 + i, 7, f"<p>page number {i} here now</p>") for i in range(3)]
    cut = extract.suffixes(spark.createDataFrame(rows, "page long, host long, html string")).repartition(20)
    assert extract.repeated_substrings(cut).count() == 0
    assert extract.repeated_substrings(cut.where("page < 402")).count() == 1


def test_stretches_across_range_borders(spark):
    """One suffix on every page of a host, in many small ranges."""
    rows = [(i, 7, f"<p>same words on every page</p><p>page number {i} here now</p>") for i in range(300)]
    df = spark.createDataFrame(rows, "page long, host long, html string")
    found = extract.repeated_substrings(extract.suffixes(df).repartition(20)).collect()
    assert len(found) == 1


def _lines(text):
    kept = [(x.strip(" \t\r\x0b\x0c"), i) for i, x in enumerate((text or "").split("\n"))]
    return [(x, i, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for x, i in kept if x]


def _repeated(texts, least):
    """Lines of windows (shortest runs of ``least`` words) that stand earlier without sharing lines with the first place: what must go."""
    seen, gone = {}, {d: set() for d in texts}
    for d in sorted(texts):
        found = _lines(texts[d])
        for i in range(len(found)):
            words = 0
            for j in range(i, len(found)):
                words += found[j][2]
                if words >= least:
                    key = tuple(x[0] for x in found[i : j + 1])
                    of, end = seen.setdefault(key, (d, j))
                    gone[d] |= {x[1] for x in found[i : j + 1]} if (of, end) != (d, j) and (of != d or i > end) else set()
                    break
    return gone


def _stands_earlier(texts, d, at, least):
    """Whether the line is in a run of ``least`` words that agrees with an earlier one: what may go."""
    mine = _lines(texts[d])
    n = next(k for k, x in enumerate(mine) if x[1] == at)
    for e in sorted(texts):
        other = _lines(texts[e])
        for m, x in enumerate(other):
            if (e, m) >= (d, n):
                return False
            if x[0] == mine[n][0]:
                a = b = 0
                while n - a > 0 and m - a > 0 and mine[n - a - 1][0] == other[m - a - 1][0]:
                    a += 1
                while n + b + 1 < len(mine) and m + b + 1 < len(other) and mine[n + b + 1][0] == other[m + b + 1][0]:
                    b += 1
                if sum(x[2] for x in mine[n - a : n + b + 1]) >= least:
                    return True
    return False


@pytest.mark.parametrize("least", [50, 6])
def test_repeated_runs_against_all_windows(docs, texts, least):
    must = _repeated(texts, least)
    got = {r.doc_id: r for r in lines.dedup_lines(docs, least).collect()}
    assert got.keys() == texts.keys() and sum(map(len, must.values()))
    for d, text in texts.items():
        assert got[d].n_lines == text.count("\n") + 1 and got[d].n_chars == len(got[d].text)
        if not must[d]:
            assert got[d].n_removed == 0 or least == 6
        assert got[d].n_removed >= len(must[d])
        if got[d].n_removed == len(must[d]):
            assert got[d].text == "\n".join(x for i, x in enumerate(text.split("\n")) if i not in must[d])
    if least == 50:
        extra = {d for d in texts if got[d].n_removed > len(must[d])}
        for d in extra:
            left = Counter(x.strip(" \t\r\x0b\x0c") for x in got[d].text.split("\n"))
            cut = [i for x, i, _ in _lines(texts[d]) if not left[x]]
            assert all(_stands_earlier(texts, d, i, least) for i in cut)


def test_run_whose_longest_line_stands_alone_earlier(spark):
    """Document 1 has the longest line with other neighbours; 2 and 3 share the passage around it, 4 its last lines after a long one."""
    passage = "a b c\nthe longest line of them all\nd e f"
    rows = [(1, "x y z\nthe longest line of them all\nu v w"), (2, f"two\n{passage}\nend of two"), (3, f"three\n{passage}\nend of three")]
    rows += [(5, "one two three four five six seven eight nine ten\nshort"), (4, "one two three four five six seven eight nine ten\nshort\nother")]
    left = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()}
    assert left == dict(rows) | {3: "three\nend of three", 5: ""}


@pytest.mark.parametrize("least", [50, 6])
def test_all_lines_that_stand_earlier_go(docs, texts, least):
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs, least).collect()}
    for d, gone in _repeated(texts, least).items():
        assert not Counter(x for x, *_ in _lines(got[d])) - Counter(x for x, i, _ in _lines(texts[d]) if i not in gone)


@pytest.mark.parametrize("n", [1, 4, 5, 9, 10, 11, 23])
def test_a_run_that_overlaps_itself_stays_once(spark, n):
    """Equal lines of ten words, also in a second document: 50 words stay in the first, nothing is lost as a whole."""
    line = "one two three four five six seven eight nine ten"
    rows = [(1, "\n".join([line] * n)), (2, "\n".join(["head of it"] + [line] * n))]
    left = {r.doc_id: r.text.split("\n") for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()}
    assert left[1] == [line] * (n if n < 10 else 5)
    assert left[2] == ["head of it"] + [line] * (n if n < 5 else 0)


def test_tabs_inside_a_line_count(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, "\t".join(words)), (2, " ".join(words)), (3, "\t " + " ".join(words) + " \t\r")]
    left = {r.doc_id: r.n_removed for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()}
    assert left == {1: 0, 2: 0, 3: 1}


def test_lines_of_odd_rows(odd, none, spark):
    got = lines.dedup_lines(odd, 5)
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed", "n_chars"] and got.count() == odd.count()
    assert lines.dedup_lines(none).collect() == []
    run = "one two three\n\nfour five six\nseven eight"
    rows = [(2, f"start\n{run}\nend"), (1, f"{run} \nother\n{run}"), (None, run), (1, f"{run} \nother\n{run}")]
    left = Counter((r.doc_id, r.text) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect())
    assert left == Counter({(2, "start\n\nend"): 1, (1, f"{run} \nother\n"): 2, (None, ""): 1})


def _answer(rows):
    first, out = {}, Counter()
    for p, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        digest = base64.b32encode(hashlib.sha1(h).digest()).decode()
        out[(p, len(h), digest, "revisit", first[h]) if h in first else (p, len(h), digest, "response", None)] += 1
        first.setdefault(h, p)
    return out


def test_pages_through_both_archives(spark, odd_pages, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 100_000)
    for pages in (spark.read.parquet(f"{SF}/pages.parquet"), odd_pages):
        got = Counter(tuple(r)[:5] for r in warc.pages_to_warc(pages).collect())
        assert got == _answer([(r.page_id, (r.html or "").encode()) for r in pages.collect()])
    assert warc.pages_to_warc(_pages(spark, [])).collect() == []


def test_short_payloads_may_all_respond(spark):
    df = _pages(spark, [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")])
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.pages_to_warc(df, min_bytes=4).collect())
    assert got == [(1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]


def test_header_lines_of_both_versions():
    body = b"HTTP/1.0 200 OK\r\n\r\nhi"
    one = b"filedesc://a.arc 0.0.0.0 19960923142103 text/plain 76\n" + b"1 0 X\nURL IP-address Archive-date Content-type Archive-length\n".ljust(76, b"\n")
    one += b"\nhttp://x.org/ 1.2.3.4 19961104142103 text/html %d\n%s\nhttp://y.org/ 1.2.3.4 19961104142104 text/plain 3\nabc\n" % (len(body), body)
    got = list(warc.read_arc(one))
    assert [(h["URL"], h["Archive-date"], c) for _, h, c in got[1:]] == [("http://x.org/", "19961104142103", body), ("http://y.org/", "19961104142104", b"abc")]
    two = warc.arc_filedesc("2", "b.arc", "20000101000000") + b"\nhttp://x.org/ 1.2.3.4 20000102030405 text/html 200 - - 77 b.arc %d\n%s\nbroken line\nrest" % (len(body), body)
    got = list(warc.read_arc(two))
    assert got[1][1]["Result-code"] == "200" and got[1][1]["Offset"] == "77" and got[1][2] == body
    assert got[2][1] is None and got[2][2] == b"broken line\nrest"
    records = [next(warc.read_warc(warc.convert_record("b.arc", o, h, c, None) + b"\n")) for o, h, c in got]
    assert [r[0]["WARC-Type"] for r in records] == ["warcinfo", "response", "metadata"]
    assert records[1][0]["WARC-Date"] == "2000-01-02T03:04:05Z" and records[1][1] == body
    assert records[1][0]["WARC-Record-ID"] == next(warc.read_warc(warc.convert_record("b.arc", got[1][0], *got[1][1:], None) + b"\n"))[0]["WARC-Record-ID"]
    revisit = next(warc.read_warc(warc.convert_record("b.arc", *got[1], ("<urn:uuid:1>", 5)) + b"\n"))
    assert revisit[0]["WARC-Refers-To"] == "<urn:uuid:1>" and revisit[1] == b"HTTP/1.0 200 OK\r\n\r\n"
    with pytest.raises(ValueError, match="ends early"):
        list(warc.read_warc(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc"))
