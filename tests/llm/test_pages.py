"""Extraction and archives: hand-written pages, damaged files, and round trips of the given table."""

from __future__ import annotations

import gzip
import hashlib
import re
from collections import Counter

import pytest
from awkward import SF_DIR, make_docs, rows, shipped  # noqa: F401

import corpus_pipeline
from deskmart.llm import html_extraction, warc

PAGES = "page_id long, url string, html string"


def page(main: str, n: int = 0, template: str = "article") -> str:
    opened, closed = {"article": ("<article>", "</article>"), "div": (f'<div class="post-{n} body">', "</div>")}[template]
    return (
        f"<!DOCTYPE html><html><head><title>t{n}</title><style>p{{}}</style><script>var a='</p><p>no';</script></head>"
        f'<body class="has-sidebar"><header><h2>Site</h2></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- <p>gone</p> -->'
        f'<div class="ad">Buy this now, it is the best offer there ever was in the whole world.</div>{opened}{main}'
        f'<aside>See also</aside><form><input name=q><label>Search</label></form>{closed}'
        f'<div class="related"><p>Other stories that are quite long and go on for a while to look like text.</p></div>'
        f'<section id="comments"><p>First! A reader says a lot of things here that are not the article.</p></section>'
        f'<div class="cookie-notice">We use cookies</div><footer>&copy; me</footer></body></html>'
    )


BODY = "<h1>Caf&eacute; &amp; Bar</h1><p>One <b>bold</b>\n  word &lt;tag&gt;<p>Two&nbsp;&#8364;<br>three</p><ul><li>a<li>b</ul>"
TEXT = "Café & Bar One bold word <tag> Two € three a b"


def extract(spark, rows):
    return {r.page_id: (r.text, r.n_chars) for r in html_extraction.extract_main_text(spark.createDataFrame(rows, PAGES + ", text string")).collect()}


def test_main_text(spark):
    rows = [(i, f"https://h{i % 2}.example/{i}", page(BODY, i, ("article", "div")[i % 2]), "x") for i in range(6)]
    got = extract(spark, rows)
    assert got == {i: (TEXT, len(TEXT)) for i in range(6)}


def test_short_article_is_found_by_its_host(spark):
    long = "<p>" + "Words that make a paragraph of some length. " * 20 + "</p>"
    box = '<div class="x1"><p>' + "Unmarked text that stands on every page of this host. " * 3 + "</p></div>"
    rows = [(i, "http://a.example/", f'<body>{box}<div class="main-{i}">{long}</div></body>', None) for i in range(8)]
    rows.append((8, "http://A.example:80/x", f'<body>{box}<div class="main-8"><p>Tiny.</p></div></body>', None))
    got = extract(spark, rows)
    assert got[8][0] == "Tiny." and got[0][0] == " ".join(("Words that make a paragraph of some length. " * 20).split())


def test_pages_of_another_template_keep_their_own(spark):
    """Pages whose host's usual container is empty, holds a scrap, or is missing."""
    long = "<p>" + "Words that make a paragraph of some length. " * 20 + "</p>"
    told = " ".join(("Words that make a paragraph of some length. " * 20).split())
    rows = [(i, "http://a.example/", f'<body><div class="main">{long}</div></body>', None) for i in range(60)]
    others = ["", "Scrap.", "<p>See below.</p>"]
    rows += [(100 + i, "http://a.example/", f'<body><div class="main">{o}</div><div class="story">{long}</div></body>', None) for i, o in enumerate(others)]
    rows.append((200, "http://a.example/", f'<body><table><tr><td>{long}</td></tr></table></body>', None))
    got = extract(spark, rows)
    assert {got[i][0] for i in [*range(60), 100, 101, 102, 200]} == {told}


def test_pages_without_a_host_do_not_vote_together(spark):
    box = '<div class="x1"><p>' + "Unmarked text that stands on every page of this host. " * 3 + "</p></div>"
    long = "<p>" + "Words that make a paragraph of some length. " * 20 + "</p>"
    rows = [(i, url, f'<body>{box}<div class="main-{i}">{long}</div></body>', None) for i, url in enumerate([None, "", "mailto:a", "/x"] * 3)]
    rows.append((99, None, f'<body>{box}<div class="main-8"><p>Tiny.</p></div></body>', None))
    assert extract(spark, rows)[99][0].startswith("Unmarked")


@pytest.mark.parametrize(
    "inside",
    [
        '<p class="advert">Buy!</p>', "<p hidden>gone</p>", '<span style="display:none">gone</span>', '<ul><li class="comment">First!<li class="comment">Second</ul>',
        '<h3 class="related">More</h3>', '<article class="comment"><p>First!</p></article>', '<div><p class="ad">x <b>y</b></p></div>',
        '<span hidden>a <span>b</span> c</span>', '<p class="sponsored">unclosed',
    ],
)
def test_marked_elements_are_left_out(inside):
    html = f"<article><h1>Title</h1><p>Text before.</p>{inside}<p>Text <i class='x'>after</i>.</p></article>"
    assert html_extraction.main_text(html, {}) == "Title Text before. Text after."


def test_elements_inside_words_and_sentences():
    html = '<article><p>It is <math><mi>x</mi><mo>=</mo><mn>1</mn></math>, so wo<img src="a>b">rd.</p><p class="article-header lead">Kept</p></article>'
    assert html_extraction.main_text(html, {}) == "It is x=1, so word. Kept"


@pytest.mark.parametrize("unit", ['<a "', "<![CDATA[", "<!x", "<a '\"", '<a ">" ', "<a ", "<!--", "</script ", "<p class='x\">", "<"])
@pytest.mark.parametrize("end", ["", "'", "'>", '">', "]]>"])
def test_time_is_linear_in_the_page(unit, end):
    import time

    page = "<p>start</p><script>" * (unit == "</script ") + unit * (1_000_000 // len(unit)) + end
    began = time.process_time()
    html_extraction.main_text(page, {})
    assert time.process_time() - began < 12  # quadratic time would take hours


def test_odd_pages(spark):
    rows = [
        (1, None, None, None),
        (2, "not a url", "", None),
        (3, "http://b.example/", "no markup at all", None),
        (4, "http://c.example/", "<p>open <b>never closed <div>x</span></div></div></p> tail < 3 &amp", None),
        (5, "http://d.example/", "<script>only code", None),
        (6, "http://e.example/", "<p>" + "long " * 200_000 + "</p>", None),
        (7, "http://f.example/", "<article></article><nav>menu</nav>", None),
        (None, "http://g.example/", "<p>no id</p>", None),
        (None, "http://g.example/", "<p>no id</p>", None),
    ]
    got = extract(spark, rows)
    assert got[1] == got[2] == got[5] == got[7] == ("", 0)
    assert got[3][0] == "no markup at all" and got[4][0] == "open never closed x tail < 3 &"
    assert got[6][1] == 5 * 200_000 - 1 and got[None] == ("no id", 5)
    assert html_extraction.extract_main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_pages_of_given_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    unescape = html_extraction.entities.unescape
    for r in html_extraction.extract_main_text(pages).collect():
        inner = re.search(r"<article>(.*)</article>", html[r.page_id], re.S)[1]
        blocks = re.sub(r"</?(b|i|em|strong|a|span)\b[^>]*>", "", inner)
        assert r.text == " ".join(unescape(re.sub(r"<[a-zA-Z/][^>]*>", " ", blocks)).split())
        assert r.n_chars == len(r.text)


# Archives


def write(tmp_path, spark, rows):
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(rows, PAGES + ", payload string").repartition(2), path)
    return path


def test_round_trip(spark, tmp_path):
    big, long = "é" * 600, "x" * 3_000_000
    rows = [(1, "http://a/ b\n", big, "z"), (2, "http://b/", big, "z"), (3, None, big, "z"), (4, "http://c/", "small", "z"), (5, "http://d/", "small", "z")]
    rows += [(6, "http://e/", None, "z"), (7, "http://f/", "WARC/1.1\r\n\r\n" * 200, "z"), (8, "http://g/", long, "z"), (None, "http://h/", big, "z")]
    rows += [(3, None, big, "z"), (None, None, "only" * 300, "z")]
    rows += [(2**53 + 1, None, "p" * 2000, "z"), (2**53 + 3, None, "p" * 2000, "z")]
    path = write(tmp_path, spark, rows)
    got = warc.read_archives(spark, path).collect()
    assert all(r.reason is None for r in got) and len(got) == len(rows)
    expected = Counter()
    for i, url, html, _ in rows:
        data = (html or "").encode()
        revisit, best = (html == big and i != 3) or i == 2**53 + 1, 3 if html == big else 2**53 + 3
        told = None if url is None else url.replace(" ", "%20").replace("\n", "%0A")
        expected[(i, told, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", best if revisit else None)] += 1
        assert any(r.page_id == i and r.payload == (None if revisit else data) for r in got)
    assert Counter((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected


def test_empty_table(spark, tmp_path):
    assert warc.read_archives(spark, write(tmp_path, spark, [])).count() == 0


RECORDS = [warc.record(i, f"http://x/{i}", f"payload {i} ".encode() * 50) for i in range(6)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_after_damage(packed):
    parts = [gzip.compress(r, mtime=0) if packed else r for r in RECORDS]
    whole = b"".join(parts)
    start = [len(b"".join(parts[:i])) for i in range(7)]

    def read(data):
        found = list(warc.salvage(data))
        return [warc.page_of(f.record.headers["warc-record-id"]) for f in found if f.record], [(f.start, f.end) for f in found if f.record is None]

    assert read(whole) == ([0, 1, 2, 3, 4, 5], [])
    middle = start[2] + len(parts[2]) // 2
    flipped = whole[:middle] + bytes([whole[middle] ^ 0xFF]) + whole[middle + 1 :]
    assert read(flipped) == ([0, 1, 3, 4, 5], [(start[2], start[3])])
    cut = whole[:middle] + whole[start[3] :]
    assert read(cut) == ([0, 1, 3, 4, 5], [(start[2], middle)])
    junk = whole[: start[1]] + b"\x1f\x8b\x08 WARC/1.1\r\n junk" + whole[start[1] :]
    ids, gaps = read(junk)
    assert ids == [0, 1, 2, 3, 4, 5] and gaps == [(start[1], start[1] + 19)]
    assert read(whole[: start[5] + 30]) == ([0, 1, 2, 3, 4], [(start[5], start[5] + 30)])
    assert read(b"nothing here") == ([], [(0, 12)]) and read(b"") == ([], [])


def _ids(found):
    return [warc.page_of(f.record.headers["warc-record-id"]) for f in found if f.record]


def test_archives_compressed_as_a_whole():
    """One member with five records, the third damaged before compression: four records, one gap with its inner place."""
    parts = list(RECORDS[:5])
    at = parts[2].index(b"payload 2") + 3
    parts[2] = parts[2][:at] + b"X" + parts[2][at + 1 :]
    data = gzip.compress(b"".join(parts), mtime=0)
    found = list(warc.salvage(data))
    assert _ids(found) == [0, 1, 3, 4]
    (gap,) = [f for f in found if f.record is None]
    begin = len(parts[0]) + len(parts[1])
    assert (gap.start, gap.end, gap.inner_start, gap.inner_end) == (0, len(data), begin, begin + len(parts[2]))
    assert gap.reason == "block digest differs"
    whole = list(warc.salvage(gzip.compress(b"".join(RECORDS), mtime=0) + gzip.compress(RECORDS[0], mtime=0)))
    assert _ids(whole) == [0, 1, 2, 3, 4, 5, 0] and whole[1].inner_start == len(RECORDS[0]) and whole[-1].inner_start is None


@pytest.mark.parametrize("cut", [True, False])
def test_records_before_the_damage_of_a_member(cut):
    import random

    rng = random.Random(1)
    parts = [warc.record(i, None, bytes(rng.randrange(256) for _ in range(30_000))) for i in range(6)]
    data = gzip.compress(b"".join(parts), mtime=0)
    at = len(data) * 7 // 12
    broken = data[:at] if cut else data[:at] + bytes([data[at] ^ 0x55]) + data[at + 1 :]
    tail = gzip.compress(RECORDS[0], mtime=0)
    found = list(warc.salvage(broken + (b"" if cut else tail)))
    ids = [warc.page_of(f.record.headers["warc-record-id"]) for f in found if f.record]
    assert ids[:3] == [0, 1, 2] and (cut or ids[-1] == 0) and 3 not in ids
    gaps = [f for f in found if f.record is None]
    assert all(g.start == 0 and g.inner_start >= sum(map(len, parts[:3])) and g.reason for g in gaps)
    assert max(g.end for g in gaps) == len(broken)


def test_files_are_cut_by_bytes_and_found_by_name(spark, tmp_path):
    import random

    rng = random.Random(2)
    rows = [(i, None, "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(20_000)), None) for i in range(12)]
    path = tmp_path / "cut"
    warc.write_archives(spark.createDataFrame(rows, PAGES + ", payload string").coalesce(1), str(path), file_bytes=150_000)
    files = list(path.rglob("*.txt"))
    assert len(files) > 3 and max(f.stat().st_size for f in files) < 160_000
    assert sorted(r.page_id for r in warc.read_archives(spark, str(path)).collect()) == list(range(12))
    for name, data in (("a.warc", RECORDS[0]), ("b.warc.gz", gzip.compress(RECORDS[1])), ("c.warc.gz", gzip.compress(RECORDS[2] + RECORDS[3])), ("d.idx", b"no")):
        (tmp_path / name).write_bytes(data)
    got = warc.read_archives(spark, f"{tmp_path}/*.*").collect()
    assert sorted(r.page_id for r in got) == [0, 1, 2, 3]


def test_gaps_are_reported(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(gzip.compress(RECORDS[0]) + b"broken" + gzip.compress(RECORDS[1]))
    got = warc.read_archives(spark, str(tmp_path), with_payload=False).collect()
    assert sorted(r.page_id for r in got if r.reason is None) == [0, 1]
    gap = next(r for r in got if r.reason)
    assert gap.end - gap.start == 6 and gap.page_id is None


# Pipeline


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        whole = Counter(tuple(r) for r in docs.collect())
        kept = Counter(tuple(r) for r in out.collect())
        assert kept and set(kept) <= set(whole) and all(n <= 2 * whole[r] for r, n in kept.items())
        docs = spark.createDataFrame([r for r, n in kept.items() for _ in range(n)], docs.schema)
    last = Counter((r.doc_id, r.size) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect())
    assert Counter((r.doc_id, r.size) for r in corpus_pipeline.run(spark, SF_DIR).collect()) == last


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, make_docs, rows, empty):
    """NULLs, empty texts, repeated rows, clashing column names; and no rows at all."""
    docs = make_docs(rows, extra=True)
    docs = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        got = Counter(tuple(r) for r in out.collect())
        if name == corpus_pipeline.STAGES[-1][0]:
            assert sum(got.values()) == docs.count()
        else:
            whole = Counter(tuple(r) for r in docs.collect())
            assert out.columns == docs.columns and set(got) <= set(whole)
            assert all(n <= 2 * whole[r] for r, n in got.items()) and (empty or got)
