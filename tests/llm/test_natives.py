"""Shards, mixing, archive and url rules against plain loops."""

import base64
import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm.components import connected_components
from ledgerlens.llm.mixing import mix_sources
from ledgerlens.llm.sharding import shard_by_bytes
from ledgerlens.llm.urls import judge_urls, page_links
from ledgerlens.llm.warc import read_archive, sha1_base32, write_archive

DOCS = "doc_id long, text string, source string"


def docs(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def some(spark):
    rows = [(i, "wörd " * (i * 7 % 23) + "x" * (i % 5), f"s{min(i % 7, 3)}") for i in range(300)]
    rows += [(None, "no id", "s1"), (5, None, None), (5, "", "s0"), (7, "long " * 3000, "s2"), (7, "long " * 3000, "s2")]
    rows += [(9, f"tie {i}", "s1") for i in range(200)]
    return rows


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (300, 299)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 299: 299, 300: 299}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_shards(spark, some, shards):
    clash = docs(spark, some).withColumns({"shard": F.lit("old"), "_part": F.lit(1)})
    rows = shard_by_bytes(clash, shards).collect()
    assert len(rows) == len(some) and rows[0]["_part"] == 1
    size = lambda r: len((r["text"] or "").encode()) + 8
    assert all(r["size"] == size(r) for r in rows)
    total, at = sum(map(size, rows)), 0
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in order]
    assert ids == sorted(ids)
    slots = {}
    for r in order:
        assert r["shard"] == (2 * at + size(r)) * shards // (2 * total)
        assert r["slot"] == slots.get(r["shard"], 0)
        slots[r["shard"]] = r["slot"] + 1
        at += size(r)


def test_no_shards(spark):
    assert shard_by_bytes(docs(spark, []), 4).count() == 0
    with pytest.raises(ValueError):
        shard_by_bytes(docs(spark, []), 0)


def _share(rows):
    n = {}
    for r in rows:
        n[r["source"]] = n.get(r["source"], 0) + r["n_tokens"]
    total = sum(n.values())
    return {s: v / total for s, v in n.items() if v}


def _entropy(p):
    return -sum(x * math.log(x) for x in p)


def test_mix_entropy(spark):
    rows = [(i, "a b c " * (1 + i % 9), "big" if i % 10 else f"s{i % 30}") for i in range(2000)]
    rows += [(5000 + i, "", "hollow") for i in range(5)] + [(6000, None, "big")]
    out = mix_sources(docs(spark, rows), target_entropy=0.9, block_tokens=5000).collect()
    total = sum(3 * (1 + i % 9) for i in range(2000))
    assert out[0]["exponent"] < 1
    quotas = {r["source"]: r["quota"] for r in out}
    assert abs(_entropy([q / total for q in quotas.values() if q]) - 0.9 * math.log(4)) < 1e-3
    spent = {s: sum(r["n_tokens"] for r in out if r["source"] == s) for s in quotas}
    for s, q in quotas.items():
        assert q - 27 <= spent[s] <= q
    assert sorted(r["doc_id"] for r in out if r["source"] == "hollow") == [5000 + i for i in range(5)]
    by_block = {}
    for r in out:
        by_block.setdefault(r["block"], []).append(r)
    assert len(by_block) == math.ceil(total / 5000)
    for rows in by_block.values():
        assert sorted(r["position"] for r in rows) == list(range(len(rows)))
        share = _share(rows)
        for s, q in quotas.items():
            if q:
                assert abs(share[s] - q / total) < 0.02


def test_mix_repeat(spark):
    rows = [(i, "a b c d", "big" if i % 10 else "small") for i in range(1000)] + [(i, "a b c d", None) for i in range(2000, 2050)]
    frame = docs(spark, rows)
    out = mix_sources(frame, max_repeat=2.0, keep_all=True).collect()
    times = {}
    for r in out:
        times[(r["source"], r["doc_id"])] = times.get((r["source"], r["doc_id"]), 0) + 1
    assert {i for _, i in times} == {r[0] for r in rows} and max(times.values()) <= 2
    assert min(v for (s, _), v in times.items() if s is None) == 2
    assert {v for (s, _), v in times.items() if s == "big"} == {1}
    flat = mix_sources(frame, max_repeat=100.0).collect()
    assert flat[0]["exponent"] == 0 and len({r["quota"] for r in flat}) == 1
    for bad in ({}, {"target_entropy": 0.5, "max_repeat": 2}, {"max_repeat": 0.5}, {"max_repeat": 1.5, "budget": 10**9}):
        with pytest.raises(ValueError):
            mix_sources(frame, **bad)


def test_mix_edges(spark):
    assert mix_sources(docs(spark, []), target_entropy=0.5).count() == 0
    same = [(1, "a b", "x")] * 50 + [(2, "c", "x")]
    assert mix_sources(docs(spark, same), target_entropy=1.0).count() == 51
    assert mix_sources(docs(spark, [(1, None, None), (None, "", "y")]), max_repeat=1.0).count() == 2
    clash = docs(spark, [(1, "a b", "x")]).withColumns({"_t": F.lit(3), "Block": F.lit("b")})
    out = mix_sources(clash, target_entropy=1.0)
    assert out.columns == ["doc_id", "text", "source", "_t", "n_tokens", "quota", "exponent", "copy", "block", "position"]
    assert out.first()["_t"] == 3


def test_base32(spark):
    data = [b"", b"abc", bytes(range(256))]
    rows = spark.createDataFrame([(bytearray(x),) for x in data], "x binary").select(sha1_base32(F.col("x"))).collect()
    assert [r[0] for r in rows] == [base64.b32encode(hashlib.sha1(x).digest()).decode() for x in data]


PAGES = "page_id long, url string, html string"


def test_archive(spark):
    rows = [(3, "http://a/1", "<p>é</p>"), (1, "http://a/2", "<p>é</p>"), (2, None, None), (9, "http://a\r\nX: y", ""), (1, "http://a/2", "<p>é</p>"), (None, "u", "<p>é</p>"), (7, "u", "z" * 300_000)]
    path = write_archive(spark.createDataFrame(rows, PAGES))
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    got = read_archive(spark, path).collect()
    assert len(got) == len(rows)
    bodies = {(i, (h or "").encode()) for i, _, h in rows}
    assert {(r["page_id"], bytes(r["payload"])) for r in got} == bodies
    for r in got:
        digest = base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()
        assert r["payload_digest"] == r["stated_digest"] == digest and r["payload_bytes"] == len(r["payload"])
        record = bytes(r["record"])
        head, body = record.split(b"\r\n\r\n", 1)
        assert record.startswith(bytes(r["header"])) and record.endswith(b"\r\n\r\n")
        length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert length == len(body) - 4
        assert body[:-4] == (b"" if r["record_type"] == "revisit" else bytes(r["payload"]))
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in got)
    assert kinds == [(0, "revisit", 1), (1, "response", None), (1, "revisit", 1), (2, "response", None), (3, "revisit", 1), (7, "response", None), (9, "revisit", 2)]
    few = read_archive(spark, write_archive(spark.createDataFrame(rows, PAGES), min_bytes=1)).collect()
    assert {r["record_type"] for r in few if r["payload_bytes"] == 0} == {"response"}
    assert read_archive(spark, write_archive(spark.createDataFrame([], PAGES))).count() == 0


def test_damaged_archive(spark):
    path = write_archive(spark.createDataFrame([(1, "u", "text")], PAGES))
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other")).write.parquet(f"{path}/bad")
    import shutil

    shutil.copytree(f"{path}/bad".removeprefix("file:"), f"{path}-2/payloads".removeprefix("file:"))
    shutil.copytree(f"{path}/headers".removeprefix("file:"), f"{path}-2/headers".removeprefix("file:"))
    with pytest.raises(Exception, match="damaged payload"):
        read_archive(spark, f"{path}-2").collect()


def test_header_that_states_another_digest(spark):
    path = write_archive(spark.createDataFrame([(1, "u", "<p>one</p>"), (2, "u", "<p>two</p>")], PAGES))
    heads = spark.read.parquet(f"{path}/headers")
    other = F.encode(F.regexp_replace(F.decode("header", "UTF-8"), "sha1:.{4}", "sha1:AAAA"), "UTF-8")
    for n, header in enumerate((other, F.encode(F.regexp_replace(F.decode("header", "UTF-8"), "WARC-Payload-Digest: [^\r]*\r\n", ""), "UTF-8"))):
        bad = f"{path}-bad{n}"
        spark.read.parquet(f"{path}/payloads").write.parquet(f"{bad}/payloads")
        heads.withColumn("header", header).write.parquet(f"{bad}/headers")
        with pytest.raises(Exception, match="another digest"):
            read_archive(spark, bad).collect()


def test_archive_columns(spark):
    """Other columns with the operator's own names play no part."""
    df = spark.createDataFrame([(1, "u", "a"), (2, None, "a")], PAGES)
    for name in ("payload", "address", "sha1", "bytes", "row", "first", "header"):
        df = df.withColumn(name, F.lit("clash"))
    got = sorted((r["page_id"], r["record_type"], r["refers_to"], bytes(r["payload"])) for r in read_archive(spark, write_archive(df)).collect())
    assert got == [(1, "response", None, b"a"), (2, "revisit", 1, b"a")]


def test_url_links(spark):
    html = [
        (1, "http://A.com/x/y?q#f", '<link rel="canonical" href="/z?a=1&amp;b=2">'),
        (2, "http://a.com/x/y", "<LINK HREF='//b.com/p' REL=canonical>"),
        (3, "https://c.com", '<meta http-equiv="refresh" content="0; url=d.html">'),
        (4, "no scheme", '<link rel="canonical" href="http://e.com/">'),
        (5, "http://a.com/", "<link rel=stylesheet href=x>"),
        (6, None, '<link rel="canonical" href="http://e.com/">'),
    ]
    got = {(r["src"], r["dst"]) for r in page_links(spark.createDataFrame(html, PAGES)).collect() if r["src"] and r["dst"]}
    assert got == {("http://a.com/x/y?q", "http://a.com/z?a=1&b=2"), ("http://a.com/x/y", "http://b.com/p"), ("https://c.com", "https://c.com/d.html")}


def test_url_verdicts(spark):
    rules = spark.createDataFrame([("bad.com", "/", "block"), ("bad.com", "/good/", "allow"), ("org", "", "allow")], "host string, path string, verdict string")
    canon = lambda u: f'<link rel="canonical" href="{u}">'
    pages = [
        (1, "http://bad.com/x", ""), (2, "http://www.BAD.com/good/1?x", ""), (3, "http://notbad.com/", ""),
        (4, "http://alias.net/1", canon("http://bad.com/x")), (5, "http://alias.net/2#top", canon("http://alias.net/1")),
        (6, "http://free.org/a", canon("http://bad.com/x")), (7, None, None), (8, "plain", canon("http://bad.com/x")),
        (9, "http://moved.net/", ""), (9, "http://moved.net/", ""), (10, "http://bad.com", ""), (11, "http://alias.net/2", ""),
    ]
    frame = spark.createDataFrame(pages, PAGES).withColumns({"rule": F.lit("old"), "_node": F.lit(4)})
    moves = spark.createDataFrame([("http://moved.net/", "http://alias.net/2"), (None, "x")], "src string, dst string")
    out = judge_urls(frame, rules, moves)
    assert out.columns == ["page_id", "url", "html", "_node", "host", "path", "rule", "verdict"]
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.orderBy("page_id").collect()]
    assert got == [
        (1, "bad.com", "/x", "bad.com/", "block"), (2, "www.bad.com", "/good/1", "bad.com/good/", "allow"), (3, "notbad.com", "/", None, "allow"),
        (4, "alias.net", "/1", None, "block"), (5, "alias.net", "/2", None, "block"), (6, "free.org", "/a", "org", "allow"),
        (7, "", "", None, "allow"), (8, "", "", None, "allow"), (9, "moved.net", "/", None, "block"), (9, "moved.net", "/", None, "block"),
        (10, "bad.com", "", None, "allow"), (11, "alias.net", "/2", None, "block"),
    ]
    assert judge_urls(spark.createDataFrame([], PAGES), rules).count() == 0
    assert judge_urls(frame, rules.limit(0)).where("verdict != 'allow'").count() == 0


def test_crc_matches_python(spark):
    assert spark.range(5).select(F.crc32(F.col("id").cast("string"))).collect()[3][0] == zlib.crc32(b"3")
