import gzip
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from kinfold.llm import crf_extract, markup, secret_scan, warc

PARTS = ["<", ">", "/", "a", "p", "div", " ", "\n", '"', "'", "=", "!", "?", "--", "<!--", "-->", "<a ", "<script>", "</script>", "</p>", "<p class='x'>", "<SCRIPT ", "é", "<br/>"]
PAGES = st.lists(st.sampled_from(PARTS), max_size=25).map("".join)


def tag_end(page, at):
    quote = ""
    for i in range(at, len(page)):
        c = page[i]
        if quote:
            quote = "" if c == quote else quote
        elif c == ">":
            return i + 1
        elif c in "\"'":
            quote = c
    return 0


def brute_tokens(page, raw):
    at = 0
    while at < len(page):
        end = 0
        name = re.match(r"""<(/?)([a-zA-Z][^\s/<>"']*)""", page[at:])
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4) + 3
            end = len(page) if end == 2 else end
            yield at, end, "", True
        elif page[at : at + 2] in ("<!", "<?"):
            end = page.find(">", at) + 1
            if end:
                yield at, end, "", False
        elif name:
            end = tag_end(page, at + name.end())
            tag = name[2].lower()
            skipped = bool(end) and not name[1] and tag in raw
            if skipped:
                close = re.search(rf"(?i)</{tag}\s*>", page[end:])
                end = end + close.end() if close else len(page)
            if end:
                yield at, end, tag, skipped
        at = end or at + 1


@given(PAGES)
@settings(max_examples=800, deadline=None)
def test_tokens_character_by_character(page):
    raw = frozenset(["script"])
    assert [(t.start, t.end, t.tag, t.skipped) for t in markup.tokens(page, raw)] == list(brute_tokens(page, raw))


def test_attributes_of_a_tag():
    assert list(markup.attributes(""" HREF = "/a>b" data-href='no' class=x checked id="é" """)) == [
        ("href", "/a>b"), ("data-href", "no"), ("class", "x"), ("checked", ""), ("id", "é")]


UNITS = {
    "assignments": lambda n: "token=abcdefgh9 " * n,
    "entropy spans": lambda n: "9fQz-Lk3_Xv7Rt1pWm8Yc2BnQ deadbeef0123456789abcdef01 " * n,
    "nested": lambda n: "<div>x" * n,
    "nested names": lambda n: "".join(f"<div class='c{'abcdefghij'[i % 10]}{'x' * (i % 50)}'>x" for i in range(n)),
    "nested and closed": lambda n: "<div>x" * n + "</div>" * n,
    "closed without opening": lambda n: "<div>" * n + "x</p>" * n,
    "unclosed tags": lambda n: "<p>x</p>" + "<a " * n,
    "unclosed quotes": lambda n: "<a x='" + '<a "' * n + ">",
    "unclosed names": lambda n: "<a" * n + ' "<p>',
    "unclosed titles": lambda n: "<title>" * n + "<a href=",
    "declarations": lambda n: "<p>" + "<!x <?y " * n,
    "comments": lambda n: "<!-- " * n + "<script>" * n,
    "links": lambda n: "<a href=x title='>'>y" * n,
    "closing raw": lambda n: "<script>" + "</script " * n,
}
MODEL = crf_extract.Field({"tag=div": np.array([0.1, 0.2]), "name=ca": np.array([0.3, 0.1]), "stop": np.array([0.0, 1.0])})


@pytest.mark.parametrize("kind", UNITS)
def test_time_is_linear_on_long_texts(kind):
    def seconds(work, n):
        text = UNITS[kind](n)
        best = 1e9
        for _ in range(2):
            start = time.process_time()
            work(text)
            best = min(best, time.process_time() - start)
        return best

    for work in (secret_scan.spans, warc.read_page, lambda page: crf_extract.main_text(page, MODEL), lambda page: crf_extract.article_labels(crf_extract.leaf_blocks(page))):
        assert seconds(work, 64_000) <= 27 * max(seconds(work, 8_000), 0.005)  # three doublings


@given(st.lists(st.sampled_from(["password=", "abcdef12", " ", "9fQz-Lk3_Xv7Rt1pWm8Yc2BnQ", "0123456789abcdef" * 2, "AKIA", "ABCD1234EFGH5678", "/"]), max_size=14).map("".join))
@settings(max_examples=300, deadline=None)
def test_entropy_spans_inside_base_spans_go(text):
    base, extra = secret_scan.spans(text)
    every = [s for s in secret_scan.entropy_spans(text) if not any(b[0] <= s[0] and s[1] <= b[1] for b in base)]
    assert extra == sorted(every, key=lambda s: (s[0], secret_scan.KINDS.index(s[2]), s[1]))


def flat(rows):
    """Every row with all its features written out."""
    return [sorted({*row, *(f for tag, *names in row.above for f in (f"tag={tag}", *(f"name={w}" for w in names)))}) for row in rows]


@given(st.lists(st.sampled_from(["<div class='a b'>", "<div class='b c'>", "<p id=a>", "<ul><li>", "</div>", "</p>", "</ul>", "x", "y 1.", "<br>"]), max_size=30).map("".join), st.integers(0, 99))
@settings(max_examples=200, deadline=None)
def test_shared_paths_give_the_sums_of_written_out_features(page, seed):
    rng = np.random.default_rng(seed)
    rows = crf_extract.features(crf_extract.leaf_blocks(page))
    written = flat(rows)
    model = crf_extract.Field({f: rng.normal(size=2) for f in {f for row in written for f in row} if rng.random() < 0.8})
    assert np.allclose(model.scores(rows), model.scores(written))
    values = rng.normal(size=(len(rows), 2))
    sums, plain = crf_extract.totals(rows, values), crf_extract.totals(written, values)
    assert sums.keys() == plain.keys() and all(np.allclose(sums[f], plain[f]) for f in sums)


def test_only_main_text_of_an_article_is_labelled():
    page = ("<nav><p>menu</p></nav><article class='post'><header><h1>Title</h1></header><p>One <b>two</b></p><aside class='ad'><p>advert</p></aside>"
            "<div class='text'><p>three</p></div><div class='share social'><p>share</p></div><form><label>mail</label></form>"
            "<section class='comments'><article><p>a reader</p></article></section><p>four</p><footer>tags</footer></article>"
            "<article class='comment'><p>another reader</p></article><p>rest</p>")
    blocks = crf_extract.leaf_blocks(page)
    assert [b.text for b, y in zip(blocks, crf_extract.article_labels(blocks), strict=True) if y] == ["Title", "One two", "three", "four"]


def test_extraction_leaves_adverts_and_comments_inside_the_article(spark):
    def page(i):
        paragraph = f"<p>Story {i} goes on with some longer sentences about the matter. {'More of it follows here. ' * (3 + i % 5)}</p>"
        return ("<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Story of the day</h1>" + paragraph * (2 + i % 3)
                + "<aside class='ad'><p>Buy now and save on all of our goods this week.</p></aside>" + paragraph
                + "<section class='comments'><div class='comment'><p>I read this with joy, thank you.</p></div></section></article><footer>Contact</footer></body></html>")

    rows = [(i, "u", page(i)) for i in range(60)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = crf_extract.fit(table.where("page_id < 40"))
    for r in crf_extract.extracted(table.where("page_id >= 40"), model).collect():
        i = r["page_id"]
        assert r["text"].startswith("Story of the day Story") and r["text"].count(f"Story {i} goes on") == 3 + i % 3
        assert "Buy now" not in r["text"] and "joy" not in r["text"] and "Home" not in r["text"]


def test_plain_text_title_and_links():
    page = ("<html><head><title>A &lt; B\n c</title><style>p{}</style></head><body><p title='a > b'>One<b> two</b>\nthree<!-- no --><script>if (a < b) no()</script>"
            "<a class=x href='/1?a&amp;b'>l</a><A data-href=no HREF = /2 >m</A><a name=n>o</a><li>1 < 2 &amp; 3<p")
    text, title, links = warc.read_page(page)
    assert (title, links) == ("A < B c", ["/1?a&b", "/2"])
    assert text == "A < B c\nOne two three lmo\n1 < 2 & 3<p"
    assert warc.read_page("<title>open") == ("open", None, []) and warc.read_page("") == ("", None, [])


def test_warc_files_of_others(spark, tmp_path):
    def record(uri, block):
        return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI:{uri}\r\ncontent-length:  {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    blocks = [b"", b"\r\n\r\nWARC/1.0\r\n", bytes(range(256)) * 50]
    records = [record(f"http://{i}/", b) for i, b in enumerate(blocks)]
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    for files in ("plain.warc", "*.warc.gz"):
        got = warc.read_warc(spark, str(tmp_path), files).collect()
        assert {r["fields"]["WARC-Target-URI"]: bytes(r["block"]) for r in got} == {f"http://{i}/": b for i, b in enumerate(blocks)}
    whole = b"".join(records)
    with pytest.raises(ValueError, match="cut short"):
        list(warc.parse_warc(whole[:-600]))
    with pytest.raises(ValueError, match="cut short"):
        warc.unpacked(gzip.compress(whole)[:-10])
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.parse_warc(whole + b"garbage"))
