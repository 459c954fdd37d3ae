"""Operators on pages, and the pipeline, against brute force."""

import base64
import hashlib
import random

import pytest

import corpus_pipeline
from compare import connect, differences
from remitlens.llm import htmltext, urlfilter, warc

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"
NASTY = [(1, "http://a.example/x", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://b.example/\r\nX: y", None), (4, "", ""), (None, "http://a.example/x", "<p>same</p>"),
         (5, "not a url", "<<<p <div class='x>broken & &amp; &#x41"), (5, "not a url", "<<<p <div class='x>broken & &amp; &#x41"), (6, "HTTP://User@WWW.B.Example.:80/a/b/c?q#f", "x" * 300_000),
         (None, None, None), (7, "http://c.example/é/漢", "<article><p>é&nbsp;漢 &copy; 😀</p></article>")]


@pytest.fixture(scope="module")
def pages(spark):
    mean = spark.createDataFrame([(*r, "k", 1, "h") for r in NASTY], f"{PAGES}, sha256 string, first long, kind string")
    return {"given": spark.read.parquet(f"{SF}/pages.parquet"), "mean": mean, "none": spark.createDataFrame([], PAGES)}


@pytest.mark.parametrize("name", ["given", "mean", "none"])
def test_archive_round_trip(spark, pages, name, tmp_path):
    warc.write_archive(pages[name], f"{tmp_path}/w")
    rows = [tuple(r[:3]) for r in pages[name].collect()]
    got = warc.read_archive(spark, f"{tmp_path}/w").collect()
    assert len(got) == len(rows)
    first = {}
    for p, _, h in rows:
        k = (p is None, p or 0)
        first[h or ""] = min(k, first.get(h or "", k))
    want = sorted((str(p), len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()) for p, _, h in rows)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == want
    assert sum(r.record_type == "response" for r in got) == len(first)
    assert spark.read.parquet(f"{tmp_path}/w/payloads").count() == len(first)
    texts = {base64.b32encode(hashlib.sha1(t.encode()).digest()).decode(): t for t in first}
    for r in got:
        text, record = texts[r.payload_digest], bytes(r.record)
        head, _, body = record.partition(b"\r\n\r\n")
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and f"Content-Length: {len(body) - 4}".encode() in head
        assert (text.encode() in body) if r.record_type == "response" else (r.refers_to == (None if first[text][0] else first[text][1]))


def test_archive_small_payloads_are_all_responses(spark, pages, tmp_path):
    warc.write_archive(pages["mean"], f"{tmp_path}/w", min_bytes=100)
    assert {r.record_type for r in warc.read_archive(spark, f"{tmp_path}/w", records=False).where("payload_bytes < 100").collect()} == {"response"}


def test_archive_notices_damage(spark, pages, tmp_path):
    warc.write_archive(pages["given"], f"{tmp_path}/w")
    kept = spark.read.parquet(f"{tmp_path}/w/payloads")
    one = kept.first()
    other = kept.where(kept.sha256 != one.sha256).first()
    bad = spark.createDataFrame([(one.sha256, other.packed)], kept.schema).unionByName(kept.where(kept.sha256 != one.sha256))
    bad.write.parquet(f"{tmp_path}/v/payloads")
    spark.read.parquet(f"{tmp_path}/w/headers").write.parquet(f"{tmp_path}/v/headers")
    with pytest.raises(Exception, match="disagree"):
        warc.read_archive(spark, f"{tmp_path}/v").collect()


def test_main_text(spark, pages):
    got = {r.page_id: r for r in htmltext.main_text(pages["given"]).collect()}
    for r in pages["given"].collect():
        text = got[r.page_id].text
        assert text and got[r.page_id].n_chars == len(text) and "&copy;" not in text and "<" not in text and "©" not in text
        page = htmltext.Page(r.html, labelled=True)
        assert text == "\n\n".join(t for k, t in page.blocks if page.labels[k])
    mean = htmltext.main_text(pages["mean"]).collect()
    assert len(mean) == len(NASTY) and all(r.n_chars == len(r.text) for r in mean)
    assert htmltext.main_text(pages["none"]).count() == 0


def test_marginals_equal_enumeration():
    page = htmltext.Page("<div><p>a</p><ul><li>b<li>c</ul></div><p>d", labelled=True)
    feats, rng = page.features(), random.Random(1)
    w = {f: rng.uniform(-1, 1) for fs in feats for f in fs} | {f"edge={k}{y}": rng.uniform(-1, 1) for k in ("text", "list", "box") for y in ("00", "01", "10", "11")}
    n, total, ones = len(feats), 0.0, [0.0] * len(feats)
    import math

    for code in range(1 << n):
        y = [code >> k & 1 for k in range(n)]
        s = sum(w[f] for k in range(n) if y[k] for f in feats[k]) + sum(w[f"edge={htmltext.edge_kind(page.tags[k])}{y[page.parents[k]]}{y[k]}"] for k in range(1, n))
        total += math.exp(s)
        for k in range(n):
            ones[k] += math.exp(s) * y[k]
    got, _ = htmltext.marginals(page, feats, w)
    assert got == pytest.approx([x / total for x in ones])


def test_held_out_layouts(pages):
    texts = [[t for _, t in htmltext.Page(r.html).blocks][6:16] for r in pages["given"].collect()]
    w = htmltext.fit(htmltext.labelled_pages([r.html for r in pages["given"].collect()]))
    rng, right, seen = random.Random(77), 0, 0
    for t in texts * 4:
        page = htmltext.Page(htmltext.layout(t, rng), labelled=True)
        got, _ = htmltext.marginals(page, page.features(), w)
        right += sum((got[k] > 0.5) == bool(page.labels[k]) for k, _ in page.blocks)
        seen += len(page.blocks)
    assert right / seen > 0.98


def test_url_lists_equal_sql(spark):
    assert differences(urlfilter.op5(spark, SF), connect(SF), urlfilter.SQL) == []


def test_url_lists_on_made_rows(spark, pages):
    entries = [("host", "b.example", "add", 5), ("host", "b.example", "add", 7), ("host", "b.example", "drop", 9), ("host", "b.example", "add", 9), ("prefix", "www.b.example/a", "add", 20), ("host", None, "add", 1), ("host", "c.example", "drop", 1)]
    url = NASTY[7][1]
    rows = [(k, url, d) for k, d in enumerate([4, 5, 8, 9, 20])] + [(10, None, 5), (11, "junk", 5), (12, url, None), (13, "http://c.example/", 5), (13, "http://c.example/", 5)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "capture_id long, url string, day int, host string, hits int").drop("host", "hits")
    got = [(r.capture_id, r.blocked, r.hits, r.rule) for r in urlfilter.judge(df, spark.createDataFrame(entries, "kind string, key string, action string, day int")).collect()]
    assert sorted(got) == [(0, False, 0, None), (1, True, 1, "b.example"), (2, True, 1, "b.example"), (3, False, 0, None), (4, True, 1, "www.b.example/a"),
                           (10, False, 0, None), (11, False, 0, None), (12, False, 0, None), (13, False, 0, None), (13, False, 0, None)]
    assert urlfilter.op5 and urlfilter.judge(urlfilter.page_captures(pages["none"]), urlfilter.page_lists(pages["none"])).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    out = corpus_pipeline.run(spark, SF)
    assert set(docs.columns) <= set(out.columns) and out.where("shard is null or slot is null").count() == 0
    assert 0 < out.select("doc_id").distinct().count() < docs.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0


def test_archive_payloads_are_unpacked_in_small_pieces():
    import pyarrow as pa

    from remitlens.llm import warc

    batch = pa.RecordBatch.from_pydict({"x": list(range(2 * warc.PIECE + 3))})
    got = list(warc.pieces(iter([batch, batch.slice(0, 0)])))
    assert [b.num_rows for b in got] == [warc.PIECE, warc.PIECE, 3]
    assert [v for b in got for v in b.column("x").to_pylist()] == batch.column("x").to_pylist()
