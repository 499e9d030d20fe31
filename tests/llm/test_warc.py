from strata.llm.common import Scratch
from strata.llm.warc import (chunked, digest, op8_warc, page_records, read_archives, records, unchunked,
                             write_archives)


def brute(rows, least=0):
    first = {}
    for i, h in rows:
        p = (h or "").encode()
        if i is not None and len(p) >= least:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, h in rows:
        p = (h or "").encode()
        to = first.get(p)
        same = to is None or to == i
        out.append((i, len(p), digest(p), "response" if same else "revisit", None if same else to))
    return sorted(out, key=str)


def read(spark, df, **kw):
    path = Scratch(spark, "warc-test").path
    write_archives(df, path, **kw)
    rows = read_archives(spark, path).collect()
    assert all(r.problem is None for r in rows)
    return sorted(((r.page_id and int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type,
                    r.refers_to and int(r.refers_to)) for r in rows), key=str)


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in op8_warc(spark, sf).collect()), key=str)
    assert got == brute(rows)


def test_copies_segments_and_edges(spark):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 900
    rows = [(1, "u", tricky), (2, None, tricky), (3, "u", None), (4, "u", ""), (None, "u", "zz"), (None, "u", "zz"),
            (7, "u\r\nX-Page-ID: 5", "zz"), (7, "q", "zz"), (8, "u", "é" * 30_000), (9, "u", "\x00\xff"), (10, "u", "one")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, payload int")
    plain = [(r[0], r[2]) for r in rows]
    assert read(spark, df) == brute(plain)
    assert read(spark, df, segment_bytes=100) == brute(plain)
    assert read(spark, df, least=3) == brute(plain, 3)


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = Scratch(spark, "warc-test").path
    write_archives(df, path)
    assert read_archives(spark, path).collect() == []


def test_one_hot_payload(spark):
    df = spark.range(3000).selectExpr("id page_id", "'u' url", "if(id % 3 = 0, 'hot', cast(id as string)) html")
    rows = [(r.page_id, r.html) for r in df.collect()]
    assert read(spark, df) == brute(rows)


def test_damage_is_told(spark):
    page = page_records("0.0", "5", "u", b"x" * 1000, None, segment_bytes=300)
    other = page_records("0.1", "6", "u", b"y" * 1000, None, segment_bytes=300)
    bad = page_records("0.2", "7", "u", b"z" * 50, None)[0].replace(b"zz", b"zy", 1)
    data = b"".join(r + b"\r\n\r\n" for r in [page[0], *page[2:], *reversed(other), bad])
    path = Scratch(spark, "warc-test").path
    one = spark.createDataFrame([(bytearray(data),)], "b binary").selectExpr("cast(b as string) value")
    one.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
    got = {r.page_id: r for r in read_archives(spark, path).collect()}
    assert "missing" in got["5"].problem and got["5"].payload_bytes is None
    assert got["6"].problem is None and got["6"].payload_bytes == 1000
    assert "digest" in got["7"].problem


def test_framing():
    for n in (0, 1, 4095, 4096, 4097, 20_000):
        assert unchunked(chunked(b"k" * n)) == b"k" * n
    parts = list(records(b"".join(r + b"\r\n\r\n" for r in page_records("0.0", "1", None, b"p" * 500, None, 100))))
    assert [f.get("warc-segment-number") for f, _, _ in parts] == [str(i + 1) for i in range(len(parts))]


def test_damaged_files_give_rows(spark, tmp_path):
    import gzip

    good = b"".join(r + b"\r\n\r\n" for i in range(3) for r in page_records(f"0.{i}", str(i), "u", bytes([97 + i]) * 40, None))
    packed = gzip.compress(good)
    records_of = [r for r in good.split(b"WARC/1.")][1:]
    cut = good[:good.rindex(b"Content-Length")]                       # ends inside the HTTP header of the last record
    files = {"flipped": packed[:len(packed) // 2] + bytes([packed[len(packed) // 2] ^ 255]) + packed[len(packed) // 2 + 1:],
             "short": packed[:-20], "members": gzip.compress(good[:0]) + packed + gzip.compress(good),
             "header": b"WARC/1." + records_of[0][:30], "cut": cut,
             "length": good.replace(b"Content-Length", b"Content-Size", 1), "number": good.replace(b"WARC-Type", b"WARC-Segment-Number: x\r\nWARC-Type", 1),
             "type": good.replace(b"WARC-Type", b"WARC-Tipe", 1)}
    got = {}
    for name, data in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.gz").write_bytes(data)
        got[name] = read_archives(spark, str(tmp_path / name)).collect()
    assert any("gzip" in (r.problem or "") for r in got["flipped"])
    assert any("early" in (r.problem or "") for r in got["short"])
    assert [r.problem for r in got["members"]] == [None] * 6
    assert [r.problem for r in got["header"]] == ["header ends early"]
    assert got["cut"][-1].problem and [r.problem for r in got["cut"][:2]] == [None, None]
    assert sum(r.problem == "no content length" for r in got["length"]) == 1 and sum(r.problem is None for r in got["length"]) == 2
    assert len(got["number"]) == len(got["type"]) == 3
