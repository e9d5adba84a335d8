"""Main text and the archive: a plain parse of known pages, and exact round trips."""

import base64
import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from govlens.llm import pages, queries, warc

ARTICLE = "<article><h1>Head line</h1><p><b>One &amp; two\n three<br>four</b></p><p>Five</p></article>"
PAGE = f"""<!DOCTYPE html><html><head><title>Head line</title><style>p{{x}}</style><script>var t="</p>";</script></head>
<body><nav><ul><li><a href="/x">Menu words that go on and on</a></li></ul></nav><!-- <p>note</p> --><div class="ad">Buy it now.</div>
{ARTICLE}<footer>&copy; someone</footer></body></html>"""
TEXT = "Head line\nOne & two three four\nFive"


def test_marked_page():
    assert pages.extract(PAGE, {}) == TEXT
    assert pages.extract(PAGE.split("</article>")[0], {}) == TEXT           # cut off
    assert pages.extract(PAGE.replace("<article>", "<main>").replace("</article>", "</main>"), {}) == TEXT


@pytest.mark.parametrize("inside", [
    '<aside>Note this</aside>', '<div class="comments"><p>I liked it a lot, really a lot, more than anything</p></div>',
    '<form><label>Mail</label><input name=a></form>', '<div id="cookie-notice">We use cookies</div>', '<script>if (a<b) "</p>"</script>',
    '<nav><a>next</a></nav>', '<div style="display:none">x</div>', '<p hidden>y</p>', '<!-- z > -->', '<iframe>w</iframe>', '<div role="navigation">q</div>',
])
def test_what_is_no_article_text(inside):
    assert pages.extract(PAGE.replace("<p>Five</p>", inside + "<p>Five</p>"), {}) == TEXT


def test_unmarked_page_by_weights(spark):
    rows = [(i, PAGE.replace("Five", " ".join(f"word{j}" for j in range(40 + i)))) for i in range(20)] + [(99, None), (98, "")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    w = pages.learn_weights(df)
    assert w["word"] > 0 and w["article"] > 0 and all(v < 0 for k, v in w.items() if k not in ("word", "article"))
    # the mark is one weight among others: without it, or around something short, the text is the same
    whole = rows[-3][1]
    assert pages.extract(whole, w) == pages.extract(whole.replace("article>", "div>"), w) == pages.extract(
        whole.replace("article>", "div>").replace("<div class=\"ad\">Buy it now.</div>", "<article><p>A teaser card.</p></article>"), w)
    body = " ".join(f"text{i}" for i in range(60))
    page = f"<body><header><b>Site name</b></header><table><tr><td>x</td></tr></table><h1>Title words</h1><p>{body}</p><p>{body} end</p><footer>f</footer></body>"
    assert pages.extract(page, w) == f"Title words\n{body}\n{body} end"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<article></article><p>other</p>", "other"), ("just words", "just words"), ("<p>a<b>c</p><p>d e f g</b>h</p>", "ac\nd e f gh"),
    ("<article><p>a&nbsp;&lt;b&gt; &#233;&eacute;</p></article>", "a <b> éé"), ("<article>x < y</article>", "x < y"),
    ("<article><p>" + "w " * 100_000 + "</p></article>", ("w " * 100_000).strip()), ("<nav>only a menu</nav>", ""), ("<article><p>a" + "<div>" * 3000 + "b", "a"), ("<p class='x>one</p><p>two</p>", "one\ntwo"),
    ('<p title="a>b">one</p>', "one"), ("<p title='a\">one</p>", "one"), ("<a href=x", ""),
])
def test_page_edges(page, text):
    assert pages.extract(page, {}) == text


def test_best_region():
    assert pages.best_region([-1, 2, -1, 2, -5, 2]) == (1, 4)
    assert pages.best_region([]) == pages.best_region([-1, 0]) == (0, 0)
    assert pages.best_region([1, -1, 1]) == (0, 1)


def test_best_region_is_the_best():
    rng = random.Random(6)
    for _ in range(400):
        s = [rng.choice([-2.0, -1.0, -0.5, 0.5, 1.0, 3.0]) for _ in range(rng.randrange(14))]
        sums = {(a, b): sum(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        most = max(sums.values(), default=0)
        if most <= 0:
            assert pages.best_region(s) == (0, 0)
            continue
        low, high = pages.best_region(s)
        first = min(b for (a, b), x in sums.items() if x == most)          # where a best range first ends
        assert sums[low, high] == most and high >= first and all(sums[low, high] > sums[a, b] for a, b in sums if b < first)


def test_region_of_random_tokens():
    """What is extracted is made of whole blocks, each touched by a best range of the tokens' scores."""
    rng, w = random.Random(7), {"word": 1.0, "p": -0.05, "/p": -0.05, "div": -2.0, "/div": -2.0, "li": -1.0, "/li": -1.0}
    for _ in range(300):
        parts = [rng.choice(["<p>", "</p>", "<div>", "</div>", "<li>", "</li>", "one two three", "four", "<nav>menu here</nav>", "<script>x y</script>"])
                 for _ in range(rng.randrange(12))]
        held = list(pages.tokens("".join(parts)))
        score = [0.0 if k == "word" and off else float(len(t.split())) if k == "word" else -0.05 if off or k in pages.RAW else w.get(k, -1.0)
                 for k, t, _, off, _ in held]
        best = max((sum(score[a:b]) for a in range(len(score)) for b in range(a + 1, len(score) + 1)), default=0)
        got = pages.extract("".join(parts), w)
        if best <= 0:
            assert got == ""
            continue
        blocks = {}
        for k, t, _, off, b in held:
            if k == "word" and not off and t.strip():
                blocks[b] = blocks.get(b, "") + t
        kept = got.split("\n")
        order = list(blocks.values())
        assert any(order[i:i + len(kept)] == kept for i in range(len(order)))          # consecutive blocks of text
        assert sum(len(x.split()) for x in kept) >= best - 1e-9


@pytest.mark.parametrize("page", ['<a "x ' * 170_000 + "'", "<a 'x" * 200_000, '<a href="x>' * 90_000, "<!--" * 250_000, "<" * 500_000, "</p" * 300_000])
def test_hostile_pages_take_linear_time(page):
    begun = time.process_time()
    pages.extract(page, {})
    assert time.process_time() - begun < 2


def test_query(spark, tmp_path):
    rows = [(i, f"http://h/{i}", PAGE) for i in range(5)] + [(7, None, None), (None, "u", ""), (8, "u", "<p>é 𝔘")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    out = queries.REGISTRY["op5_html_extraction"][0](spark, str(tmp_path))
    assert out.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    want = [(i, f"http://h/{i}", TEXT, len(TEXT)) for i in range(5)] + [(7, None, "", 0), (None, "u", "", 0), (8, "u", "é 𝔘", 3)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_pages_table(spark):
    df = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (None, None, None)], "page_id long, url string, html string") \
        .withColumn("_row", F.lit(1)).withColumn("_page", F.lit(2))
    out = pages.extract_text(df, {})
    assert out.columns == [*df.columns, "_text"]
    assert sorted(r._text for r in out.collect()) == ["", TEXT, TEXT]
    empty = df.limit(0)
    assert pages.learn_weights(empty) == {} and pages.extract_text(empty, {}).count() == 0


HOT = "<p>copy é</p>"
RECORDS = [(i, f"http://h/{i}", HOT) for i in range(12)] + [(20, "http://h/a\r\nX-Bad: 1", "own\r\n\r\nWARC/1.1"), (21, None, None), (22, "u", ""),
           (23, "u", "x" * 300_000), (24, "u", "x" * 300_000), (25, "u", "𝔘"), (None, "n", "no id"), (None, "n", HOT)]


def plain(rows, min_bytes=0):
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        ids = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        owner = max(ids, default=None)
        back = len(b) >= min_bytes and owner != i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if back else "response", owner if back else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 100])
def test_archive(spark, tmp_path, min_bytes):
    df = spark.createDataFrame(RECORDS, "page_id long, url string, html string").withColumn("sha256", F.lit("x")).withColumn("owner", F.lit(1)).repartition(4)
    path = str(tmp_path / "a")
    warc.write_archive(df, path, min_bytes=min_bytes)
    assert sorted(map(tuple, warc.resolve(spark, path).select("page_id", "n_bytes", "digest", "type", "refers_to").collect()), key=str) == plain(RECORDS, min_bytes)
    # payload bytes are stored once each, and original records come back whole
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in RECORDS})
    by = {r.page_id: warc.parse_record(bytes(r.record)) for r in warc.read_records(spark, path).collect() if r.page_id is not None}
    assert by[20]["body"] == b"own\r\n\r\nWARC/1.1" and by[20]["WARC-Target-URI"] == "http://h/a%0D%0AX-Bad: 1"
    assert "WARC-Target-URI" not in by[21] and by[25]["body"] == "𝔘".encode() and len(by[24]["body"]) == 300_000


def test_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "b")
    warc.write_archive(spark.createDataFrame([(1, "u", "good")], "page_id long, url string, html string"), path)
    store = spark.read.parquet(f"{path}/payloads").collect()
    other = spark.createDataFrame([("", "evil")], "u string, h string").select(warc._pack(F.encode("h", "UTF-8")).alias("z")).first().z
    spark.createDataFrame([(r.sha256, r.n_bytes, r.owner, other) for r in store], "sha256 binary, n_bytes long, owner long, packed binary") \
        .write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged record"):
        warc.resolve(spark, path).collect()


def test_empty_archive(spark, tmp_path):
    path = str(tmp_path / "c")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.resolve(spark, path).count() == 0
