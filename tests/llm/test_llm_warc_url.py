"""WARC round trips and URL filtering."""

import base64
import gzip
import hashlib
import io
import re

import pytest

from delaylens.llm import url_filter, warc
from delaylens.llm.files import open_stream
from delaylens.llm.queries import URL_RULES

PAGES = [(4, "http://a/ b\n", "<p>x</p>"), (2, None, "<p>x</p>"), (9, "http://c", None), (1, "http://d", ""), (7, "http://e", "ü\r\n\r\ny" * 30_000),
         (None, "http://f", "<p>x</p>"), (None, "http://g", "nameless"), (3, "http://h", "nameless too"), (8, "http://e", "ü\r\n\r\ny" * 30_000)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def expected(rows, least=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = min(same) if same and len(data) >= least else i
        revisit = first is not None and first != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    manifest = warc.write_warc(pages(spark).repartition(3), min_bytes=least)
    assert sorted(map(tuple, warc.read_warc(manifest).collect()), key=str) == expected(PAGES, least)
    assert sum(r["n_records"] for r in manifest.collect()) == len(PAGES)


@pytest.mark.parametrize("few", [1, 3])
def test_round_trip_with_many_shared_digests(spark, monkeypatch, few):
    """Beyond the broadcast bound hot digests are broadcast and the others joined."""
    monkeypatch.setattr(warc, "SHARED_ROWS", few)
    rows = PAGES + [(100 + i, None, "hot") for i in range(60)] + [(200 + i, "http://x", f"cold {i % 9}") for i in range(20)]
    got = warc.read_warc(warc.write_warc(pages(spark, rows).repartition(3)))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_archives_are_gzip_members_with_payloads(spark):
    manifest = warc.write_warc(pages(spark).coalesce(1))
    [path] = [r["path"] for r in manifest.collect()]
    with open_stream(path) as f:
        raw = f.read()
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == len(PAGES)
    records = [warc.read_record(m, keep=True) for m in warc.members(io.BytesIO(raw))]
    found = {int(r["X-Page-Id"]): r["payload"] for r in records if "X-Page-Id" in r and r["WARC-Type"] == "response"}
    assert found[7] == ("ü\r\n\r\ny" * 30_000).encode() and found[2] == b"<p>x</p>" and found[1] == b""
    assert all(r["payload"] == b"" for r in records if r["WARC-Type"] == "revisit")


def test_no_pages(spark):
    manifest = warc.write_warc(pages(spark, []))
    assert manifest.count() == 0 and warc.read_warc(manifest).count() == 0


def _read(data):
    return [warc.read_record(m) for m in warc.members(io.BytesIO(data))]


def test_damage_is_noticed():
    good = warc.record(1, "http://a", b"payload" * 1000, None)
    assert len(_read(warc.gzip_member(good) * 3)) == 3
    with pytest.raises(ValueError, match="block digest"):
        _read(warc.gzip_member(good.replace(b"payloadpayload", b"payloadpaYload", 1)))
    with pytest.raises(ValueError, match="does not end"):
        _read(warc.gzip_member(good[:-50]))
    with pytest.raises(ValueError, match="inside a gzip member"):
        _read(warc.gzip_member(good)[:-30])
    wrong = re.sub(rb"WARC-Payload-Digest: sha1:.", b"WARC-Payload-Digest: sha1:0", good)
    with pytest.raises(ValueError, match="payload digest"):
        _read(warc.gzip_member(wrong))


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_members_at_any_block_size(monkeypatch, block):
    monkeypatch.setattr(warc, "BLOCK", block)
    data = b"".join(warc.gzip_member(warc.record(i, None, bytes([65 + i]) * i * 100, None)) for i in range(5))
    assert [int(r["X-Payload-Length"]) for r in _read(data)] == [0, 100, 200, 300, 400]


def test_many_members_across_blocks():
    """Members that end anywhere in a block, its last bytes included."""
    import random
    rnd = random.Random(4)
    records = [warc.record(i, None, rnd.randbytes(rnd.randint(0, 4000)).hex().encode(), None) for i in range(400)]
    data = b"".join(map(warc.gzip_member, records))
    for block in (997, 4096, 1 << 16):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(warc, "BLOCK", block)
            assert [int(r["X-Page-Id"]) for r in _read(data)] == list(range(400))


URLS = [None, "", "nothing", "http://Example.COM/en/x?y#z", "https://a.example.com/en", "https://www.Example.com/en/1", "http://x.net/es/1", "x://y.net/fr/",
        "http://com/", "http://com", "http://notcom/", "http://a.com?q=/en/", "http://a.org#f", "http://a.org/p/q?x=1&y=2", "://", "a://b://c/d",
        "http://exam\nple.com/en/\nx", "http://" + "a" * 50_000 + ".com/", "http://badexample.com/en/"]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def urls(spark, rows=URLS):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(rows)], "page_id long, url string, label string")


def test_rules(spark):
    got = {r["page_id"]: r for r in url_filter.judge(urls(spark, URLS + URLS[3:6] * 5), URL_RULES).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = plain(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")


def test_trees_learn_lexical_signs(spark):
    good = [(f"http://site{i % 30}.org/news/{i}", 0) for i in range(300)]
    bad = [(f"http://cheap-pills-{i % 9}.biz/{i * 7919}{i}?a={i}&b=1&c=2", 1) for i in range(300)]
    labelled = spark.createDataFrame(good[:200] + bad[:200], "url string, label int")
    test = urls(spark, [u for u, _ in good[200:] + bad[200:]])
    got = url_filter.judge(test, [], labelled).collect()
    right = sum(r["verdict"] == ("block" if r["page_id"] >= 100 else "allow") for r in got)
    assert right >= 0.95 * 200


def test_all_suffixes_are_known(spark):
    """Only the last label tells the urls apart, and there are more than 1,000 of them."""
    url = lambda i, k: f"http://h{i}.t{k:04d}/p"
    of = lambda k: hash_of(k) % 2
    hash_of = lambda k: int(hashlib.md5(str(k).encode()).hexdigest(), 16)
    labelled = spark.createDataFrame([(url(i, k), of(k)) for k in range(1200) for i in range(3)], "url string, label int")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(urls(spark, [url(7, k) for k in range(1200)]), [], labelled).collect()}
    assert got == {k: "block" if of(k) else "allow" for k in range(1200)}


def test_sample_is_of_distinct_urls(spark, monkeypatch):
    """A url that thousands of rows repeat takes one place of the sample."""
    seen = {}
    lexical = url_filter.lexical
    monkeypatch.setattr(url_filter, "lexical", lambda rows, *a: seen.setdefault("rows", rows) and lexical(rows, *a))
    monkeypatch.setattr(url_filter, "SAMPLE", 200)
    urls_of = [("http://hot.org/", 0)] * 3000 + [(f"http://a{i}.org/{i}", 0) for i in range(300)] + [(f"http://b{i}.net/?x={i}", 1) for i in range(300)]
    url_filter.fit(spark.createDataFrame(urls_of, "url string, label int"))
    picked = [tuple(r) for r in seen["rows"].select("url", "label").collect()]
    assert len(set(picked)) == len(picked) == 400


def test_suffix_statistics_leave_out_the_own_fold(spark):
    rows = spark.createDataFrame([(f"http://h{i}.{s}/", float(b), s) for i, (s, b) in enumerate(
        [("one", 1)] + [("many", i % 2) for i in range(200)])], "url string, label double, suffix string")
    host, path = url_filter.host_and_path("url")
    rows = rows.withColumns({"host": host, "path": path})
    known = url_filter.suffix_counts(rows)
    fold = {r["url"]: r["f"] for r in rows.select("url", url_filter._fold().alias("f")).collect()}
    plain_rows = rows.collect()
    for out in (True, False):
        for r in url_filter._with_suffix(rows, known, 0.25, out_of_fold=out).collect():
            kept = [x["label"] for x in plain_rows if x["suffix"] == r["suffix"] and not (out and fold[x["url"]] == fold[r["url"]])]
            assert r["suffix_rate"] == pytest.approx((sum(kept) + 5) / (len(kept) + 20))
            assert r["suffix_known"] == pytest.approx(len(kept) * (1.25 if out else 1))


def test_no_or_one_label(spark):
    assert {r["verdict"] for r in url_filter.judge(urls(spark), []).collect()} == {"allow"}
    assert {r["verdict"] for r in url_filter.judge(urls(spark), [("block", "net/fr/")]).collect()} == {"block"}
    assert url_filter.judge(urls(spark, []), URL_RULES).count() == 0


def test_main_path_is_native(spark):
    plan = url_filter.judge(urls(spark, URLS * 3), URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
