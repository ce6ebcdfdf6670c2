import hashlib
import html as entities
import random
import re
import struct
import time

import pytest
import zstandard

from ecoframe.llm import html_extract, warc
from ecoframe.session import scratch_path
from tests_llm_paths import SF


def test_main_text_of_the_sample_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in html_extract.extract_pages(pages).collect()}
    for page in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", page["html"], re.S).group(1)
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert got[page["page_id"]]["text"] == want
        assert got[page["page_id"]]["n_chars"] == len(want)


LONG = "This paragraph is long enough to be the content of the page, with words and words. " * 3


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p></p><br>", ""),
    (f"<nav><a href=x>Menu</a></nav><p>{LONG}</p><p>Short.</p><p>{LONG}</p><footer>foot</footer>",
     f"{LONG.strip()}\n\nShort.\n\n{LONG.strip()}"),
    (f"<main><p>One<br>two&nbsp;&lt;3</p><ul><li>a<li>b</ul><script>x='</p>'</script><p>{LONG}</main><p>after",
     f"One two <3\n\na\n\nb\n\n{LONG.strip()}"),
    (f"<article><header><h1>T</h1></header><p>{LONG}<div class='comments'><p>hi</p></div></article>"
     f"<div class='sidebar-left'><p>{LONG}</p></div><form><p>{LONG}</p></form><aside>{LONG}</aside>", f"T\n\n{LONG.strip()}"),
    (f"<div id=cookie-notice>{LONG}</div><div class='post-body'><p>{LONG}</div><!-- {LONG} -->", LONG.strip()),
    ("<p>open <b>tags <i>everywhere", "open tags everywhere"), ("</p></div><<>&#x;", "<<>&#x;"),
])
def test_main_text_cases(page, text):
    assert html_extract.main_text(page) == text


HEAD, THICK, END = "A title of this page", "word and more words " * 50, "A closing word for the reader."


@pytest.mark.parametrize("page, kept", [
    # no container: the enclosing block keeps its heading and its short end
    (f"<h1>{HEAD}</h1><p>{THICK}</p><p>{THICK}</p><p>{END}</p>", [HEAD, THICK, THICK, END]),
    (f"<div><ul><li><a>Home</a><li><a>News</a><li><a>Shop</a></ul></div><div><h1>{HEAD}</h1><p>{THICK}</p><p>{THICK}</p><p>{END}</p></div>"
     "<div><p>One</p><p>Two</p></div>", [HEAD, THICK, THICK, END]),
    # the ratio decides inside a container
    (f"<article><h1>{HEAD}</h1><p>{THICK}</p><p>{THICK}</p><p>{END}</p><div><p><a>x</a></p><p><a>y</a></p><p><a>z</a></p></div></article>",
     [HEAD, THICK, THICK, END]),
    # and between containers and the rest
    (f"<article><a>a</a><b>b</b></article><p>x</p><div><h1>{HEAD}</h1><p>{THICK}</p><p>{THICK}</p><p>{END}</p></div>", [HEAD, THICK, THICK, END]),
    # layout classes on what holds the content
    (f"<div class='sidebar-layout'><article><h1>{HEAD}</h1><p>{THICK}</p></article><div class=sidebar>{THICK}</div></div>", [HEAD, THICK]),
    (f"<div class='page widget'><h1>{HEAD}</h1><p>{THICK}</p><p>{THICK}</p></div><p>x</p>", [HEAD, THICK, THICK]),
    (f"<p>{THICK}</p><div class=comments><article class=comment>{THICK}</article><p>{THICK}</p></div>", [THICK]),
])
def test_main_text_by_ratio(page, kept):
    assert html_extract.main_text(page) == "\n\n".join(k.strip() for k in kept)


def test_extract_repeated_rows_and_empty_table(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "x", 1)] * 2 + [(None, None, None, None, None)], schema)
    got = sorted(map(tuple, html_extract.extract_pages(pages).collect()), key=str)
    assert got == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)], key=str)
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_bundle_is_plain_zstd_with_a_seek_table():
    out = warc.BundleWriter(frame_bytes=1000, level=3)
    made = {}
    for i in range(50):
        payload = f"<p>{i}</p>".encode() * (i * 7 % 40)
        rid, record = warc.make_record(i, f"http://x/{i}\r\nInjected: 1", payload, hashlib.sha1(payload).hexdigest(), None, "2024-01-01T00:00:00Z")
        made[rid] = (record, payload)
        out.add(rid, record)
    bundle = out.finish()
    table = warc.seek_table(bundle)
    assert len(table) > 3 and struct.unpack("<I", bundle[-4:])[0] == 0x8F92EAB1
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(bundle, read_across_frames=True).read() for _ in range(1))
    assert whole == b"".join(r for r, _ in made.values())
    for rid, (record, payload) in made.items():
        assert warc.read_record(bundle, rid) == record
        assert warc.parse_record(record)["payload"] == payload
    with pytest.raises(KeyError):
        warc.read_record(bundle, "<urn:uuid:none>")
    with pytest.raises(ValueError):
        warc.parse_record(list(made.values())[20][0].replace(b"<p>20", b"<p>21"))


def test_archive_round_trip(spark, tmp_path):
    big, other = "ä" * 600, "b" * 999
    data = [(1, "u1", big), (2, "u2", big), (3, "u3", big), (4, None, other), (5, "u5", other), (6, "u\n6", None),
            (7, "u7", ""), (None, "u8", big), (3, "u3", big), (9, "u9", "x" * 300_000)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumnRenamed("html", "key")
    path = str(tmp_path / "archive")
    warc.write_archive(warc.plan_records(pages, html_col="key"), path, frame_bytes=2000, bundle_bytes=1000)
    got = warc.read_archive(spark, path).collect()
    digest = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = [(i, len((t or "").encode()), digest(t), "revisit" if i in (1, 2) else "response", 3 if i in (1, 2) else None)
            for i, _, t in data]
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got],
                  key=str) == sorted(want, key=str)
    texts = {i: t for i, _, t in data}
    assert all(bytes(r["payload"]).decode() == (texts[r["page_id"]] or "") for r in got if r["record_type"] == "response" and r["page_id"])
    empty = str(tmp_path / "empty")
    warc.write_archive(warc.plan_records(pages.limit(0), html_col="key"), empty)
    assert warc.read_archive(spark, empty).count() == 0


LONG = "long words that fill a paragraph of an article with text " * 6


@pytest.mark.parametrize("short", [
    "<div><p>Short one.</p><p>Short two.</p></div>", "<div><p>Q?</p><p>A.</p><p>Why?</p></div>", "<section><p>One.</p><p>Two.</p></section>",
    "<div><div><p>a</p></div><div><p>b</p><section><p>c</p></section></div></div>"])
def test_short_blocks_of_an_article_stay(short):
    got = html_extract.main_text(f"<article><h1>T</h1><p>{LONG}</p>{short}<p>{LONG}</p></article>").split("\n\n")
    lines = re.findall(r"<p>([^<]*)</p>", short)
    assert got == ["T", LONG.strip(), *lines, LONG.strip()]


def test_generated_articles_keep_every_line():
    """Random nests of div and section inside an article: all lines in order."""
    rng = random.Random(5)

    def nest(depth, lines):
        parts = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.choice(["p", "p", "div", "section"]) if depth < 4 else "p"
            if kind == "p":
                lines.append(f"w{len(lines)} " + "text " * rng.choice([1, 3, 60]))
                parts.append(f"<p>{lines[-1]}</p>")
            else:
                parts.append(f"<{kind}>{nest(depth + 1, lines)}</{kind}>")
        return "".join(parts)

    for _ in range(60):
        lines: list[str] = []
        html = f"<body><nav><p>menu</p></nav><article><h1>Title</h1><p>{LONG}</p>{nest(0, lines)}<p>{LONG}</p></article><footer>end</footer></body>"
        want = ["Title", LONG.strip(), *(x.strip() for x in lines), LONG.strip()]
        assert html_extract.main_text(html).split("\n\n") == want


def test_deep_and_long_pages_take_linear_time():
    start = time.perf_counter()
    assert html_extract.main_text("<div>text " * 20_000).count("text") == 20_000
    assert html_extract.main_text('<div class="sidebar"><p>text ' * 2_000 + f"<article><p>{LONG}</p></article>") == LONG.strip()
    assert len(html_extract.main_text(f"<article><p>{'x' * 3_000_000}</p></article>")) == 3_000_000
    assert time.perf_counter() - start < 10


def test_two_payloads_under_one_page_id_are_two_records(spark):
    big, other = "<p>" + "a" * 2_000, "<p>" + "b" * 2_000
    pages = spark.createDataFrame([(1, "u", big), (1, "u", other), (2, "v", big), (3, None, None), (4, "w", ""), (5, "w", "")],
                                  "page_id long, url string, html string")
    path = scratch_path(spark, "warc-ids")
    warc.write_archive(warc.plan_records(pages), path)
    rows = warc.read_archive(spark, path).collect()
    assert len({r.record_id for r in rows}) == len(rows) == 6
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in rows if r.payload_bytes and r.payload_digest == hashlib.sha1(big.encode()).hexdigest()) \
        == [(1, "revisit", 2), (2, "response", None)]
    assert all(r.record_type == "response" for r in rows if r.payload_bytes == 0)  # small payloads have no winner
