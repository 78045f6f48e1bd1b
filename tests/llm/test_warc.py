"""Archives: an exact round trip, and the files as other readers see them."""

import base64
import glob
import gzip
import hashlib
from collections import Counter

import pytest

from strata.llm import warc
from strata.llm.common import Scratch, prepare

SCHEMA = "page_id long, url string, html string, sha1 string, payload string, refers_to string"
ROWS = [(1, "http://a", "x" * 100), (2, "http://b", "x" * 100), (2, "http://b", "x" * 100), (3, None, None), (4, "u", ""), (5, "u\r\nv", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
        (6, "u", "\r\n\r\n"), (7, "u", "\n"), (8, "u", "tail\r\n"), (9, "u", "é🎉" * 5000), (10, "u", "no line end " * 4000), (11, "u", "é🎉" * 5000), (None, "u", "x" * 100), (None, "u", "lone"),
        (12, "u", "x" * 99 + "\r"), (13, "u", "  \x00 \x85 "), (1, "http://other", "other text of page 1"), (14, "u", "l\r\n" * 3000)]


def brute(rows, least=0):
    first = {}
    for p, _, h in rows:
        h = (h or "").encode()
        if p is not None and len(h) >= least:
            first[h] = min(first.get(h, p), p)
    out = Counter()
    for p, _, h in rows:
        h = (h or "").encode()
        again = p is not None and len(h) >= least and first[h] < p
        out[p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if again else "response", first[h] if again else None] += 1
    return out


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(2)


@pytest.mark.parametrize("least, chunk", [(0, 1 << 18), (0, 64), (100, 7)])
def test_round_trip(spark, least, chunk):
    assert Counter(map(tuple, warc.archive_pages(frame(spark, ROWS), least, chunk).collect())) == brute(ROWS, least)


def test_small_table_and_empty_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert Counter(map(tuple, warc.archive_pages(df).collect())) == brute([tuple(r) for r in df.select("page_id", "url", "html").collect()])
    assert warc.archive_pages(frame(spark, [])).collect() == []


def test_files_are_warc(spark, scratch):
    rows = [r for r in ROWS if r[0] != 1]
    warc.write_archives(frame(spark, rows), f"{scratch}/out", Scratch(spark, "t"), chunk=1000)
    payloads, names = {}, []
    for name in glob.glob(f"{scratch}/out/part-*.gz"):
        data = gzip.open(name).read()
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            version, *fields = head.decode().split("\r\n")
            fields = dict(f.split(": ", 1) for f in fields)
            n = int(fields["Content-Length"])
            block, end, data = data[:n], data[n:n + 4], data[n + 4:]
            assert version == "WARC/1.1" and end == b"\r\n\r\n"
            assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            names.append(fields["WARC-Record-ID"])
            if fields["WARC-Type"] == "response":
                payloads[fields["WARC-Record-ID"]] = block.split(b"\r\n\r\n", 1)[1]
            elif fields["WARC-Type"] == "continuation":
                assert n <= 1000
                payloads[fields["WARC-Segment-Origin-ID"]] += block
                assert fields["X-Digest-So-Far"][5:] == base64.b32encode(hashlib.sha1(payloads[fields["WARC-Segment-Origin-ID"]]).digest()).decode()
    want = {(p, h or "") for p, _, h in rows}
    got = {(int(k.split(":")[2]) if k.split(":")[2] else None, v.decode()) for k, v in payloads.items()}
    assert got <= want and {h for _, h in got} == {h for _, h in want} and len(names) >= len(rows)


def test_damage_is_found(spark, scratch):
    good = warc.chunk_table(warc.archive_records(frame(spark, ROWS[:1]), Scratch(spark, "t"))).collect()[0].value.decode()
    for bad in (good.replace("xxx", "xyx", 1), good[:-60], good.replace("WARC/1.1", "WARC/9")):
        folder = f"{scratch}/{hashlib.md5(bad.encode()).hexdigest()}"
        spark.createDataFrame([(bad,)], "value string").write.option("lineSep", "\n").option("compression", "gzip").text(folder)
        with pytest.raises(Exception, match="record|digest"):
            warc.read_archives(spark, folder).collect()
