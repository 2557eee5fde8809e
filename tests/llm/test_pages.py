"""Web archives and main-text extraction."""

import base64
import gzip
import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from linkloom.llm import common, mincut, warc

SCHEMA = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({"archive": F.lit("x"), "offset": F.lit("y"), "urlkey": F.lit(1), "text": F.lit("z")})


ROWS = [
    (3, "http://www.b.example.com/x?q=1#top", "<p>same</p>"), (1, "http://a.example.com/", "<p>same</p>"), (2, None, None), (4, "", ""),
    (5, "https://user@a.example.com:443/y", "é" * 300_000), (5, "https://user@a.example.com:443/y", "é" * 300_000), (None, "http://a.example.com/", "<p>same</p>"),
    (None, "http://c.example.com", "alone"), (7, "http://a.example.com/\r\nX-Evil: 1", "line\r\n\r\nWARC/1.1\r\n"), (6, "not a url", "<p>SAME</p>"),
]


def expected(rows, least=0):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if p is not None and (h or "") == (html or "")]
        first = min(ids) if ids and len(data) >= least else None
        revisit = first is not None and page_id != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r))


@pytest.mark.parametrize("least", [0, 8])
def test_archives_round_trip(spark, least):
    index = warc.archive_pages(pages(spark, ROWS), least).collect()
    assert order((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index) == order(expected(ROWS, least))
    keys = [(r.urlkey, r.captured, r.page_id is not None, r.page_id or 0) for r in index]
    assert keys == sorted(keys)
    for r in index:
        member = gzip.decompress(common.read_file(r.archive)[r.offset:r.offset + r["size"]].to_pybytes())
        head, _, rest = member.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode()) and b"\nX-Evil" not in head
        if r.record_type == "response":
            payload = rest.partition(b"\r\n\r\n")[2][:-4]
            assert len(payload) == r.payload_bytes and base64.b32encode(hashlib.sha1(payload).digest()).decode() == r.payload_digest


def test_small_archives_and_no_pages(spark):
    decided = warc.decide(pages(spark, [(k, f"http://h{k % 3}.example.com/{k}", f"page {k % 40}") for k in range(200)]))
    manifest = warc.write_archives(decided, archive_bytes=2000)
    assert manifest.count() > 10 and manifest.agg(F.sum("n_records")).first()[0] == 200
    index = warc.merge_index(warc.read_runs(manifest), range_entries=30)
    keys = [(r.urlkey, r.captured, r.page_id) for r in index.collect()]
    assert len(keys) == 200 and keys == sorted(keys)
    assert warc.archive_pages(pages(spark, [])).collect() == []


def test_loser_tree_is_a_merge():
    rng = random.Random(2)
    for k in range(0, 12):
        runs = [sorted((rng.randrange(20), i) for _ in range(rng.randrange(6))) for i in range(k)]
        runs = [[(key, (key, i, j)) for j, (key, i) in enumerate(run)] for run in runs]
        got = [v for _, v in warc.loser_tree_merge(runs)]
        assert got == sorted(v for run in runs for _, v in run)


def test_url_keys():
    assert warc.url_key("http://www.Shop.Example.com:80/A?b=1#c") == "com,example,shop)/A?b=1"
    assert warc.url_key("https://a.example.com:8080") == "com,example,a:8080)/"
    assert warc.url_key(None) == warc.url_key("") == "" and warc.url_key("x#y") == "x"


def test_damaged_archives_are_noticed(spark):
    manifest = warc.write_archives(warc.decide(pages(spark, [(1, "http://a.example.com/", "<p>text</p>")])))
    data = common.read_file(manifest.first().archive).to_pybytes()
    with pytest.raises(ValueError):
        list(warc.read_archive(data[:-10], "cut"))


PAGE = """<html lang="en"><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1><div>A tagline here</div></header>
<nav><ul><li><a href="#">Home</a></li><li><a href="#">About us</a></li></ul></nav><div id="cookie-notice">We use cookies here. <button>OK</button></div>
<div class="post-content"><h1>Real &amp; true title</h1><p>First   paragraph with <b>several</b> words,<br>a break&nbsp;and more.</p><script>var x = "<p>no</p>";</script>
<div class="ad">Buy now!</div><p>Unclosed second paragraph<p>Third one ends the story.</p><!-- <p>hidden</p> --></div>
<aside><h3>Related</h3><p>Another story that is long, and has a full sentence.</p></aside><section id="comments"><div class="comment"><p>I think this is a great article, thank you!</p></div></section>
<form action="x"><p>Your name and your address, please.</p><input></form><footer>&copy; 2024 Site</footer></body></html>"""
TEXT = "Real & true title\n\nFirst paragraph with several words, a break and more.\n\nUnclosed second paragraph\n\nThird one ends the story."


def test_article_without_its_surroundings():
    assert mincut.main_text(PAGE) == TEXT


def test_extract_takes_any_page(spark):
    long = "<article>" + "<p>" + "word " * 40_000 + "</p>" + "<p>more text here.</p>" * 300 + "</article>"
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", PAGE), (1, "u", PAGE), (4, "u", long), (5, "u", "<"), (6, "u", "a < b"), (7, "u", "<div>" * 2000 + "deep &lt;b&gt; text")]
    got = mincut.extract(pages(spark, rows)).collect()
    assert [(r.page_id, r.url) for r in got] == [(r[0], r[1]) for r in rows]
    assert [r.text for r in got[:5]] == [TEXT, "", "", TEXT, TEXT]
    assert got[5].text.count("\n\n") == 300 and got[8].text == "deep <b> text"
    assert all(r.n_chars == len(r.text) for r in got)
    assert mincut.extract(pages(spark, [])).collect() == []


def cut_value(costs, edges, labels):
    return sum(-c if keep and c < 0 else c if not keep and c > 0 else 0 for c, keep in zip(costs, labels, strict=True)) + sum(w for a, b, w in edges if labels[a] != labels[b])


def test_labels_are_a_minimum_cut():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randrange(1, 9)
        costs = [rng.randrange(-9, 10) for _ in range(n)]
        edges = [(a, b, rng.randrange(1, 8)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        best = min(cut_value(costs, edges, labels) for labels in itertools.product([False, True], repeat=n))
        assert cut_value(costs, edges, mincut.label(costs, edges)) == best


ARTICLE = "<p>The first sentence of the article has words enough.</p><p>The second sentence ends the story here.</p>"
SENTENCES = "The first sentence of the article has words enough.\n\nThe second sentence ends the story here."


@pytest.mark.parametrize("before", [
    "<video-player src=x></video-player>", "<select-menu><p></p></select-menu>", "<button-group></button-group>", "<title-bar></title-bar>",
    "<svg viewBox='0 0 1 1'/>", "<math/>", "<svg><title/><style/><path d='M0'/></svg>", "<svg><path d='M0'>", "<button>OK", "<div><button>OK</div>", "<object data=x>",
    "<object data=x><object data=y></object>", "<canvas/>", "<video src=x><source src=y></video>", "<select><option>One<option>Two</select>",
    "<ul><li><button>One<li><button>Two</ul>", "<button><div>OK</div><svg><path></button>", "<svg><foreignObject><p>No</p></foreignObject></svg>",
    "<template><div>No <template>no</template> no</div></template>", "<!-- <button> --><script>'<button>'</script>",
])
def test_skipped_elements_end(before):
    for page in (f"<body>{before}<article>{ARTICLE}</article></body>", f"<body><div>{before}{ARTICLE}</div><button>OK</button></body>"):
        assert mincut.main_text(page) == SENTENCES


def test_inside_of_a_paragraph():
    page = "<article><p>The value of <math><mi>x</mi><mo>=</mo><mn>1</mn></math> is <button><b>copy</b></button>shown <svg><text>no</text></svg>here<canvas/> as well.</p></article>"
    assert mincut.main_text(page) == "The value of x=1 is shown here as well."
    assert mincut.main_text("<article><p>Text before it.</p><textarea>All the rest <p>of the page.</p>") == "Text before it."


REST = "<header><h1>Site</h1></header><nav><ul><li><a href='#'>Home</a></li></ul></nav>"


@pytest.mark.parametrize("page", [
    f"<body><form id='aspnetForm'>{REST}<article>{ARTICLE}</article></form></body>",
    f"<body><form id='aspnetForm'>{REST}<div>{ARTICLE}</div></form></body>",
    f"<body>{REST}<div id='page' class='layout sidebar-right'><article>{ARTICLE}</article><div class='sidebar'><p>Some words on us.</p></div></div></body>",
    f"<body>{REST}<div class='right-sidebar'><div>{ARTICLE}</div></div><footer>Site</footer></body>",
    f"<body>{REST}<div role='dialog'><main>{ARTICLE}</main></div><div role='search'><p>Words to look for.</p></div></body>",
    "<body><div class='comments-open'><h1>The first sentence of the article has words enough.</h1><p>The second sentence ends the story here.</p></div></body>",
    f"<body>{REST}<form><article>{ARTICLE}</article></form><form>{'<p>Your name and your address, please.</p>' * 5}</form></body>",
    f"<body>{REST}<div class='widget'><article>{ARTICLE}</article></div><form>{'<p>Your name and your address, please.</p>' * 5}</form></body>",
])
def test_wrappers_of_the_page(page):
    assert mincut.main_text(page) == SENTENCES


def test_markers_of_a_part_still_hold():
    teaser = "<article><p>Another story that is long, and has a full sentence.</p></article>"
    talk = "<article class='comment'><p>I think this is a great article, and I say so in a sentence that is far longer than the article itself, thank you!</p></article>" * 3
    page = f"<body>{REST}<article>{ARTICLE * 3}</article><div class='sidebar'>{teaser}</div><form><p>Your name and your address, please.</p></form></body>"
    assert mincut.main_text(page) == "\n\n".join([SENTENCES] * 3)
    assert mincut.main_text(f"<body>{REST}<article>{ARTICLE}</article><section id='comments'>{talk}</section></body>") == SENTENCES
    assert mincut.main_text(f"<body><div style='display:none'><main>{ARTICLE}</main></div><aside>{teaser}</aside></body>") == ""
