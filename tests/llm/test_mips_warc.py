import hashlib
import math
import random

import pytest

from cadence.llm import mips, warc


def brute_top(rows, k, every):
    own = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(own):
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in own if i != q and len(b) == len(a))
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    rng = random.Random(1)
    vector = lambda n, size: [rng.gauss(0, size) for _ in range(n)]
    rows = [(i, vector(8, rng.choice([0.01, 0.3, 1, 40]))) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 460)]  # one vector many times: ties
    rows += [(500, None), (501, [1.0, None]), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (504, []), (510, []), (None, [1.0] * 8)]
    rows += [(i, vector(3, 1)) for i in (520, 521, 522)] + [(540, [0.0] * 8), (550, [1e9] * 8), (560, [1.0] * 5)]
    monkeypatch.setattr(mips, "BUCKET", 32)
    monkeypatch.setattr(mips, "BLOCK", 4)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, rank int")
    import struct
    single = [(i, None if v is None else [None if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in rows]
    assert sorted(map(tuple, mips.top_k(df, 5, 10).collect())) == brute_top(single, 5, 10)
    assert mips.top_k(df.limit(0)).collect() == []


def test_products_beyond_floats_and_longs(spark):
    rows = [(0, [1.0, 1.0]), (1, [5e9, 1.0]), (2, [1.0, 2.0]), (50, [2.0 ** 31, 2.0 ** 31]), (51, [2.0 ** 31, 2.0 ** 31 - 1]),
            (52, [2.0 ** 31, -2.0 ** 31]), (100, [1e200, -1e200]), (101, [1e200, -1e200]), (102, [-1e200, 1e200]), (150, [1.7e308, 0.0])]
    clip = lambda x: max(-mips.LONG, min(mips.LONG, x))
    whole = lambda x: math.floor(256 * x) if abs(x) < 1e300 else int(min(mips.LARGEST, 256 * x))
    own = [(i, [whole(x) for x in v]) for i, v in rows]
    expect = []
    for q, a in own:
        if q % 50 == 0:
            s = sorted((-clip(sum(x * y for x, y in zip(a, b))), i) for i, b in own if i != q)
            expect += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, mips.top_k(df, 3, 50).collect())) == sorted(expect)


ODD_PAGES = [(1, "http://Www.Example.com:80/A b?q#f", "x" * 100), (2, "https://example.com/", "x" * 100), (3, None, "x" * 100), (4, "", None), (5, "http://a.b.c", ""),
             (6, "http://a.b.c/é\r\nInjected: 1", "short"), (7, "http://a.b.c", "short"), (8, "http://z/1", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1 " * 30),
             (9, "http://z/2", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1 " * 30), (None, "http://n", "y" * 200), (10, "http://n", "y" * 200)]


def expected(rows):
    out, first = [], {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    for i, _, h in rows:
        b = (h or "").encode()
        again = h in first and first[h] != i and len(b) >= 100 and sum(x[2] == h for x in rows) > 1
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=repr)


def test_archives_and_index(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    df = spark.createDataFrame([(*r, 7, "z") for r in ODD_PAGES], "page_id long, url string, html string, size int, digest string").repartition(3)
    folder = warc.write_archives(df)
    captures = warc.read_archives(spark, folder)
    blocks = warc.build_index(captures, len(ODD_PAGES)).cache()
    for read in (warc.scan_index, warc.resolved):
        got = read(blocks).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted(map(tuple, got), key=repr) == expected(ODD_PAGES)
    assert all(r.captures <= 3 for r in blocks.collect())
    keys = {r.page_id: r.url_key for r in captures.collect()}
    assert keys[1] == "com,example)/a b?q" or keys[1] == "com,example)/a%20b?q"
    assert keys[2] == "com,example)/" and keys[5] == "c,b,a)/" and keys[3] == ")/"
    found = warc.lookup(blocks, ["c,b,a)/", "com,example)/", "no,such)/"])
    assert sorted(f["page_id"] for f in found) == [2, 5, 7]
    for f in found:
        (at, length, head, block), = warc.records(warc.read_record(spark, f) + b"\r\n\r\n")
        assert (at, length) == (0, f["length"]) and warc.page_of(head["WARC-Record-ID"]) == f["page_id"]
        if f["record_type"] == "response":
            assert hashlib.sha256(block.partition(b"\r\n\r\n")[2]).hexdigest() == f["payload_digest"]
    blocks.unpersist()


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.resolved(warc.archive_and_index(df)).collect() == []


def test_revisits_are_followed(spark, monkeypatch):
    """Hot url, hot payload, repeated ids, long urls and a payload of some megabytes; blocks of three captures."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    long = "http://long.example/" + "p" * 3000
    rows = [(i, None if i % 3 else f"http://h{i % 5}.example/{i % 7}", ("same " * 40) if i % 2 else f"own {i // 4} " * 30) for i in range(60)]
    rows += [(100, long + "a", "z" * 150), (101, long + "b", "z" * 150), (102, long + "a", "y" * 5_000_000), (103, None, "y" * 5_000_000)]
    rows += [(1, "http://again.example", "same " * 40), (1, "http://again.example", "other " * 40), (200, "http://x", "other " * 40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    blocks = warc.archive_and_index(df)
    got = warc.resolved(blocks).collect()
    assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=repr) == expected(rows)
    assert max(len(r.url_key) for r in got) == warc.KEY_CHARS and len({r.url_key for r in got if r.page_id in (100, 101)}) == 2
    asked = {(r.refers_key, r.refers_to, r.payload_digest) for r in got if r.record_type == "revisit"}
    found = warc.targets(blocks, warc.scan_index(blocks)).collect()
    assert sorted(tuple(r)[:3] for r in found) == sorted(asked)


def test_a_changed_response_is_seen(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a", "x" * 200), (2, "http://b", "x" * 200)], "page_id long, url string, html string").coalesce(1)
    folder = warc.write_archives(df, folder=str(tmp_path / "w"))
    blocks = warc.build_index(warc.read_archives(spark, folder), 2).persist()
    assert warc.resolved(blocks).count() == 2
    for part in (tmp_path / "w").glob("part-*"):
        part.write_bytes(part.read_bytes().replace(b"x" * 200, b"x" * 199 + b"y"))
    with pytest.raises(Exception, match="damaged"):
        warc.resolved(blocks).collect()
    blocks.unpersist()


def test_damage_is_seen():
    good = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [r[3] for r in warc.records(good * 2)] == [b"ab", b"ab"]
    for bad in (good[1:], good.replace(b": 2", b": 1")):
        with pytest.raises(ValueError):
            list(warc.records(bad))
