import gzip
import random
import re
import time
import zlib

import brute
import pytest

from wattloom.llm import html_blocks, warc


@pytest.fixture(scope="module")
def tree(spark):
    return html_blocks.train(spark)


def test_tree_fits_its_pages(tree):
    for features, label in html_blocks.labelled_blocks():
        assert html_blocks.keeps(tree, features) == bool(label)


def test_marks_decide_where_there_are_any(tree):
    rng = random.Random(2)
    for _ in range(5_000):
        shape = [rng.choice([0, 1, 2, 5, 15, 60, 300]) if k % 2 == 0 else rng.random() for k in range(6)]
        rest = [rng.randint(0, 1) for _ in range(3)]
        assert html_blocks.keeps(tree, (*shape, html_blocks.IN_ARTICLE, *rest))
        assert not html_blocks.keeps(tree, (*shape, html_blocks.BESIDE, *rest))


def test_pages_without_their_marks(tree, spark, sf_dir):
    counts = {(a, b): 0 for a in (False, True) for b in (False, True)}
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect():
        marked = html_blocks.blocks_of(row["html"])
        bare = re.sub(r"<(/?)(?:article|nav|footer)\b[^>]*>", r"<\1div>", row["html"] or "").replace(' class="ad"', "")
        blocks = html_blocks.blocks_of(bare)
        assert [b.text for b in blocks] == [b.text for b in marked]
        for block, features in zip(marked, html_blocks.describe(blocks)):
            assert features[html_blocks.FEATURES.index("mark")] == html_blocks.UNMARKED
            counts[block.article and not block.boilerplate, html_blocks.keeps(tree, features)] += 1
    right = counts[True, True]
    assert right >= 0.85 * (right + counts[True, False]) and right >= 0.85 * (right + counts[False, True])


def test_wrapper_only_named_like_an_article(tree):
    menu = "<ul>" + "".join(f"<li><a href=x>Menu {k}</a>" for k in range(4)) + "</ul>"
    text = "<h1>A title</h1><p>{0}</p><p>{0}</p>".format("plain words " * 20)
    kept = "\n\n".join(["A title"] + [("plain words " * 20).strip()] * 2)
    assert html_blocks.extract(f"<div class=content>{menu}{text}{menu}</div>", tree) == kept


def test_deep_pages_take_linear_time(tree):
    started = time.monotonic()
    deep = 40_000
    assert html_blocks.extract("<article>" + "<div>" * deep + "x" + "</section>" * deep + "</div>" * deep, tree) == "x"
    assert time.monotonic() - started < 10


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head>
<body class="article-page"><header><a href=/>Home</a></header><nav><ul><li><a href="a">One</a><li><a>Two</a></ul></nav>
<!-- <p>gone</p> --><div class="cookie-notice">We use cookies &amp; more</div>
<article><h1>Title &eacute;</h1><p>First   <b>bold</b> line<br>second.<p>Short.</p><div class="ad">Buy now</div>
<aside>Look here</aside><p>A &lt;tag&gt; and&nbsp;more</p><form><input value=x> Name</form>
<section id="comments"><p>I disagree with all of this, said a reader at length.</p></section></article>
<footer>&copy; 2020</footer></body></html>"""


def test_article_without_the_rest(tree):
    assert html_blocks.extract(PAGE, tree) == "Title é\n\nFirst bold line second.\n\nShort.\n\nA <tag> and more"


def test_broken_pages(tree):
    assert html_blocks.extract(None, tree) == html_blocks.extract("", tree) == html_blocks.extract("<nav><a>x", tree) == ""
    assert html_blocks.extract("<article><p>One two</p><p>three <b", tree) == "One two\n\nthree"
    assert html_blocks.extract("<article>1 < 2 </b></i> and &am", tree) == "1 < 2 and &am"
    assert html_blocks.extract("<article><p>kept</p><script>never ends", tree) == "kept"
    assert html_blocks.extract("<article><p>kept</p><!-- never ends", tree) == "kept"
    assert html_blocks.extract('<article><p title="a > b">x</p></article>', tree) == "x"
    assert html_blocks.extract("<article><p title='open>still</p>", tree) == "still"
    long = "<article>" + "<p>" + "word " * 200_000 + "</article>" + "<" * 1000
    assert len(html_blocks.extract(long, tree)) == 999_999


def test_page_without_an_article_element(tree):
    body = "<div><p>{0}</p><p>{0}</p><p>{0}</p></div>".format("plain words " * 30)
    menu = "<div>" + "".join(f"<div><a href=x>Menu {k}</a></div>" for k in range(6)) + "</div>"
    assert html_blocks.extract(menu + body + menu, tree) == "\n\n".join([("plain words " * 30).strip()] * 3)


def test_captions_and_bylines_of_an_article(tree):
    page = "<article><address>By Ann</address><p>Text.</p><figure><img src=x><figcaption>A bridge</figcaption></figure></article>"
    assert html_blocks.extract(page, tree) == "By Ann\n\nText.\n\nA bridge"


def test_article_in_a_wrapper_with_a_boilerplate_name(tree):
    for wrapper in ('div class="layout has-sidebar"', "section id=with-header", 'div class="no-comments"', 'div class="login-page"'):
        for tag in ("article", "main"):
            end = wrapper.split()[0]
            page = f"<{wrapper}><p>Outside</p><{tag}><h1>Title</h1><p>Text.</p><div class=ad>Buy</div></{tag}><p>After</p></{end}>"
            assert html_blocks.extract(page, tree) == "Title\n\nText."
    assert html_blocks.extract("<p>One.</p><aside class=sidebar><article>Two</article></aside><article>Three</article>", tree) == "Three"
    thread = "<div id=comments><article class=comment>No<article class=comment>Yes</article></article></div>"
    assert html_blocks.extract(f"<article>Text.</article>{thread}", tree) == "Text."
    assert html_blocks.extract("<article>Text.<section class=related><article>More</article></section></article>", tree) == "Text."


def test_hidden_elements_without_an_end_tag(tree):
    article = "<article><p>One.</p>{}<p>Two.</p></article>"
    search = "<form><input list=x><datalist id=x><option value=a>a<option value=b>b</datalist></form>"
    assert html_blocks.extract(search + article.format(""), tree) == "One.\n\nTwo."
    for open_ in ("<button>Share", "<object data=x>", "<svg><path d=x>", "<select><option>a<option>b", "<video src=x>", "<iframe src=x>"):
        assert html_blocks.extract(open_ + article.format(""), tree) == "One.\n\nTwo."
        assert html_blocks.extract(article.format(open_), tree) == "One.\n\nTwo."
        assert html_blocks.extract(article.format(f"<div>{open_}</div>between"), tree) == "One.\n\nbetween\n\nTwo."
    assert html_blocks.extract(article.format("<!-- </button> --><button>A<p>x</p><button><p>B</p></button>"), tree) == "One.\n\nx\n\nTwo."


def test_hidden_elements_with_an_end_tag(tree):
    for hidden in (
        "<button><div>Icon</div>Share</button>",
        "<select><optgroup label=x><option>a<option>b</optgroup></select>",
        "<object><object><p>none</p></object><p>none</p></object>",
        "<svg><svg/><title>t</title><foreignObject><p>drawn</p></foreignObject></svg>",
        "<svg class=x /><math/>",
        "<noscript><ul><li>on</ul></noscript>",
    ):
        page = f"<article><h2>Title {hidden} rest</h2><ul><li>a {hidden} b</ul></article>"
        assert html_blocks.extract(page, tree) == "Title\n\nrest\n\na\n\nb"
        assert [(b.heading, b.item) for b in html_blocks.blocks_of(page)] == [(True, False)] * 2 + [(False, True)] * 2


def test_rows_of_a_table(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None), (None, "v", "<article>t", "y")]
    found = html_blocks.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), ["page_id", "url"])
    assert sorted((str(r["page_id"]), r["_text"][:5]) for r in found.collect()) == [("1", "Title"), ("1", "Title"), ("2", ""), ("None", "t")]


BIG = "<p>" + "payload é " * 200


def archive(*pages):
    return b"".join(warc.member(warc.page_record(k, f"http://x/{k}", p, r)) + warc.EMPTY_MEMBER for k, p, r in pages)


def parsed(content):
    found = list(warc.salvage(content))
    return [warc._page_number(f[3]["warc-record-id"]) for f in found if f[0] == "record"], [f[1:4] for f in found if f[0] == "gap"]


def test_salvage_of_members():
    parts = [archive((k, b"text %d " % k * 50, None)) for k in range(4)]
    assert parsed(b"".join(parts)) == ([0, 1, 2, 3], [])
    broken = bytearray(parts[1])
    broken[40] ^= 0xFF
    ids, gaps = parsed(parts[0] + bytes(broken) + parts[2])
    assert ids == [0, 2] and gaps[0][0] == len(parts[0]) and gaps[0][1] <= len(parts[0]) + len(parts[1])
    ids, gaps = parsed(b"noise" + parts[0] + parts[3][:60])
    assert ids == [0] and [g[:2] for g in gaps] == [(0, 5), (5 + len(parts[0]), 65 + len(parts[0]))]
    assert parsed(b"") == ([], []) and parsed(b"junk") == ([], [(0, 4, "no version line")])


def test_salvage_of_plain_records():
    records = [warc.page_record(k, "http://x/", b"WARC/1.1\r\nin the text " * 5, None) for k in range(3)]
    assert parsed(b"".join(records)) == ([0, 1, 2], [])
    wrong = records[1].replace(b"in the", b"IN the", 1)
    ids, gaps = parsed(records[0] + wrong + records[2])
    assert ids == [0, 2] and gaps[0][2] == "payload does not match its digest"
    longer = records[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    assert parsed(records[0] + longer + records[2])[0] == [0, 2]
    mixed = records[0] + warc.member(records[1] + records[2][:-4]) + records[2]
    ids, gaps = parsed(mixed)
    assert ids == [0, 1, 2] and len(gaps) == 1


def test_salvage_inside_a_member():
    records = [warc.page_record(k, "http://x/", b"text %d " % k * 50, None) for k in range(3)]
    for wrong in (
        records[1].replace(b"text 1", b"TEXT 1", 1),
        records[1].replace(b"Content-Length: ", b"Content-Length: 9", 1),
        records[1].replace(b"WARC/1.1", b"WARC/9.9", 1),
        records[1][:-20],
    ):
        one, after = warc.member(records[0] + wrong + records[2]), archive((3, b"after", None))
        ids, gaps = parsed(one + after)
        assert ids == [0, 2, 3] and [g[:2] for g in gaps] == [(0, len(one))]


def test_salvage_of_a_damaged_stream():
    rng = random.Random(1)
    records = [warc.page_record(k, "http://x/", rng.randbytes(9_000).hex().encode(), None) for k in range(6)]
    after = warc.member(warc.page_record(9, "http://x/", b"after", None))
    one = warc.member(b"".join(records))
    # Cut off at the end of the archive, and before another member.
    part = len(warc.member(b"".join(records[:4]))) + 2_000
    assert parsed(one[:part]) == ([0, 1, 2, 3], [(0, part, "member is cut off")])
    ids, gaps = parsed(one[:part] + after)
    assert ids == [0, 1, 2, 3, 9] and [g[:2] for g in gaps] == [(0, part)]
    # The checksum is wrong, the data are whole.
    wrong = one[:-8] + bytes(4) + one[-4:]
    ids, gaps = parsed(wrong + after)
    assert ids == [0, 1, 2, 3, 4, 5, 9] and [g[:2] for g in gaps] == [(0, len(one))] and "check" in gaps[0][2]
    # Stored without compression, records show in the bytes of the member, too.
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    stored = packer.compress(b"".join(records[:3])) + packer.flush()
    assert parsed(stored[:-30] + after)[0] == [0, 1, 9]


def test_archives_are_gzip(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write(spark.createDataFrame([(1, "http://a/b c\r\n", BIG)], "page_id long, url string, html string"), path)
    data = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "warc").glob("part-*"))
    assert data.startswith(b"WARC/1.1\r\n") and BIG.encode() in data
    row = warc.read(spark, path).first()
    assert row["url"] == "http://a/b c\r\n" and row["payload"] == BIG.encode()


def test_round_trip_and_revisits(spark):
    rows = [(1, "a", BIG), (5, "b", BIG), (3, None, BIG), (None, "n", BIG), (2, "c", "small"), (4, "d", "small"), (6, "e", None), (7, "f", BIG + "!"), (7, "g", BIG + "!")]
    found = warc.round_trip(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")).collect()
    assert {r["kind"] for r in found} == {"record"}
    got = sorted((str(r["page_id"]), r["url"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in found)
    refers = {1: 5, 3: 5, None: 5}
    kinds = [(k, u, h, refers.get(k)) for k, u, h in rows]
    assert got == sorted((str(k), u, "revisit" if r else "response", r, len((h or "").encode()), brute.sha1(h)) for k, u, h, r in kinds)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).collect() == []
    assert html_blocks.main_text(pages, ["page_id"]).collect() == []
