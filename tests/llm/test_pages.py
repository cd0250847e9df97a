"""Archives and main text."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from spendlens.functions.staging import work_folder
from spendlens.llm import html_text, warc
from spendlens.llm.shipping import open_store, ship

PAGES = [(1, "http://www.a.com/x?q=1", "same"), (2, "https://a.com/y", "same"), (3, None, None), (4, "no host", ""),
         (5, "http://[bad/\r\nX: y", "é\r\n\r\nWARC/1.1\r\n"), (6, "http://a.com/y", "x" * 300_000), (2, "https://a.com/y", "same"),
         (None, "http://n.org/", "alone"), (8, "http://a.com:81/z#f", "same")]


def label(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(pages):
    best = {}
    for i, _, html in pages:
        if i is not None:
            best[html or ""] = max(best.get(html or "", i), i)
    rows = []
    for i, _, html in pages:
        payload, holder = (html or "").encode(), best.get(html or "")
        revisit = i is not None and holder > i
        rows.append((i, len(payload), label(payload), "revisit" if revisit else "response", holder if revisit else None))
    return sorted(rows, key=repr)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


@pytest.mark.parametrize("lines", [1, 3, 512])
def test_archive_and_read(table, monkeypatch, lines):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    docs = table([(*p, 1, "z") for p in PAGES], "page_id long, url string, html string, row int, key string", files=3)
    assert got(warc.archive_and_read(docs)) == expected(PAGES)
    assert warc.archive_and_read(docs.limit(0)).count() == 0


def test_sample(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert got(warc.archive_and_read(pages)) == expected([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_missing_keys_find_nothing_and_members_are_records(table, spark):
    ship(spark)
    pages, folder = table(PAGES, "page_id long, url string, html string"), work_folder(spark, "warc")
    store, path = open_store(folder)
    store.create_dir(path)
    captures = warc.write_archives(pages, folder)
    index = warc.build_index(captures, folder)
    wanted = spark.createDataFrame([("com,a)/nothing", 1, 0), ("", -5, 0), ("zz", 9, 9)], "key string, page_id long, row long")
    assert warc.read_captures(wanted, index, folder).count() == 0
    capture = captures.first()
    with store.open_input_file(f"{path}/{capture.archive}") as source:
        assert gzip.decompress(source.read_at(capture.length, capture.start)).startswith(b"WARC/1.1\r\n")


@pytest.mark.parametrize("html, lines", [
    ("<p>a  b\n c</p>d<br>e<p>f", ["a b c", "d e", "f"]),
    ("<nav>m</nav><article><h1>T</h1><p>x &amp; y&nbsp;z<p><b>u</article><footer>f</footer>", ["T", "x & y z", "u"]),
    ("<script>var t='</p><p>no';</script><!-- <p>no --><style>p{}</style><p class='ad x'>no</p><p>yes", ["yes"]),
    ("a < b <c", ["a < b"]), ("", []), ("<title>no</title>" + "<div>" * 2000 + "deep", ["deep"]),
    ("<form><input><p>no</form><div id='side-bar cookie'>no</div><main>in<aside>no</aside></main>", ["in"]),
    ("<article><p>x</p><section id='comments'><p>no</p></section></article>", ["x"]),
])
def test_lines(html, lines):
    assert [t for t, _ in html_text.lines_of(html)] == lines


@pytest.mark.parametrize("own, other", [("abcde", "xbcyde"), ("aaaa", "aa"), ("", "a"), ("abcabba", "cbabac"), ("xyz", "xyz")])
def test_common_lines(own, other):
    def longest(a, b):
        if not a or not b:
            return 0
        return 1 + longest(a[1:], b[1:]) if a[0] == b[0] else max(longest(a[1:], b), longest(a, b[1:]))

    shared = sorted(html_text.common_lines([ord(c) for c in own], [ord(c) for c in other]))
    assert len(shared) == longest(own, other)
    rest = iter(other)
    assert all(own[i] in rest for i in shared)


def test_neighbours_decide_where_no_article_is_marked(table):
    frame = "<div>Home</div><div>All topics</div>{}<div>Imprint 2020</div>"
    pages = [(i, f"http://h.org/p/{i}?x=1", frame.format(f"<p>text {i}</p><p>more {i}</p>")) for i in range(6)]
    pages += [(10, "http://other.org/p/1", frame.format("<p>alone</p>")), (11, None, None), (12, "http://q.org/", "<article>s</article>"),
              (13, "http://q.org/a", "<article>s</article>")]
    docs = table([(*p, 0) for p in pages], "page_id long, url string, html string, range int", files=3)
    rows = {r.page_id: r for r in html_text.main_text(docs).collect()}
    assert {i: rows[i].text for i in range(6)} == {i: f"text {i}\nmore {i}" for i in range(6)}
    assert rows[10].text == "Home\nAll topics\nalone\nImprint 2020" and rows[11].text == "" and rows[11].n_chars == 0
    assert rows[12].text == rows[13].text == "s" and rows[5].url == "http://h.org/p/5?x=1"
    assert html_text.main_text(docs.limit(0)).count() == 0


@pytest.mark.parametrize("coalesced", ["true", "false"])
def test_copies_are_not_compared(table, spark, coalesced):
    frame = "<div>Home</div>{}<div>Imprint</div>"
    pages = []
    for host, topics in (("a.org", [1, 1, 2, 2, 2, 3]), ("b.org", [4] * 40 + [5]), ("c.org", [6] * 3), ("d.org", [7] * 30 + [8] * 30 + [7] * 30)):
        pages += [(len(pages) + i, f"http://{host}/p/{i // 2:03d}", frame.format(f"<p>text {n}</p><p>more {n}</p>")) for i, n in enumerate(topics)]
    docs = table(pages, "page_id long, url string, html string", files=3)
    key, held = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(key, coalesced)  # false: the runs of copies reach over ranges
    try:
        texts = {r.page_id: r.text for r in html_text.main_text(docs).collect()}
    finally:
        spark.conf.set(key, held)
    for i, url, html in pages:
        lines = [t for t, _ in html_text.lines_of(html)]
        assert texts[i] == "\n".join(lines if "c.org" in url else lines[1:-1])
