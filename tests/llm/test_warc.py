"""WARC round trips, damaged archives, and split borders."""

import base64
import gzip
import hashlib
import os
import random
import re

import pytest

from barlake.llm import warc
from barlake.llm.bindings import op1_warc_salvage
from barlake.llm.warc import Gzip, Plain, Search, base32_sha1, member, parse, record, salvage, write_archive


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def rows():
    rnd = random.Random(4)
    out = [(i, f"http://h/{i}", rnd.choice([None, "", "same", "é" * 50, f"page {i}\r\n\r\n\x1f\x08WARC/1.1\r\n" + "x" * (i * 7)])) for i in range(120)]
    return out + [(120, None, "no uri"), (121, "http://sp ace/\nline", "z" * 300_000), (122, "http://h/é", "WARC/1.0\r\n\r\n" * 50)]


def want(pages):
    first = {}
    for i, _, html in pages:
        first[html or ""] = min(i, first.get(html or "", i))
    return sorted((i, len((h or "").encode()), digest(h), "response" if first[h or ""] == i else "revisit",
                   None if first[h or ""] == i else first[h or ""]) for i, _, h in pages)


def test_query_returns_every_page(spark, tmp_root):
    spark.createDataFrame(rows(), "page_id long, url string, html string").repartition(5).write.parquet(f"{tmp_root}/pages.parquet")
    assert sorted(map(tuple, op1_warc_salvage(spark, tmp_root).collect())) == want(rows())


def test_round_trip_of_texts_and_standard_readers(spark, tmp_root):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string").repartition(3)
    write_archive(pages, f"{tmp_root}/w", min_bytes=5)
    records, gaps = salvage(spark, f"{tmp_root}/w")
    assert gaps.count() == 0
    got = {int(r.record_id): r for r in records.collect()}
    assert {i for i, _, h in rows() if (h or "") == "same"} <= {i for i, r in got.items() if r.record_type == "response"}
    for i, _, html in rows():
        if got[i].record_type == "response":
            assert bytes(got[i].payload).decode() == (html or "") and got[i].payload_digest == digest(html)
    files = [f"{tmp_root}/w/{f}" for f in os.listdir(f"{tmp_root}/w") if f.startswith("part")]
    whole = b"".join(gzip.open(f).read() for f in files)
    assert whole.count(b"WARC-Record-ID: ") == len(rows())


def archive(compressed, n=40, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        html = f"record {i} ".encode() + bytes(rnd.randrange(256) for _ in range(rnd.randrange(3000)))
        data = record(str(i), b"http://h/", html, base32_sha1(html), None, "2020-01-01T00:00:00Z")
        out.append(member(data) if compressed else data)
    return out


def covered(records, gaps, size):
    spans = sorted((r.offset, r.length) for r in [*records, *gaps])
    at = 0
    for offset, length in spans:
        assert offset == at
        at += length
    assert at == size


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("split", ["1k", "128m"])
def test_damage_is_quarantined_and_later_records_recovered(spark, tmp_root, compressed, split):
    members = archive(compressed)
    damaged = list(members)
    damaged[3] = damaged[3][:200]                                             # cut short
    damaged[7] = damaged[7][:300] + b"\x00\xff" * 8 + damaged[7][316:]        # overwritten
    damaged[11] = b"\x00" * len(damaged[11])                                  # wiped
    damaged[20] += b"garbage"                                                 # bytes between records
    damaged[39] = damaged[39][:-30]                                           # end of file missing
    damaged.insert(0, b"junk at the start")
    data = b"".join(damaged)
    os.makedirs(f"{tmp_root}/in")
    open(f"{tmp_root}/in/a.bin", "wb").write(data)
    open(f"{tmp_root}/in/empty.bin", "wb").close()
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        records, gaps = (x.collect() for x in salvage(spark, f"{tmp_root}/in", compressed))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(int(r.record_id) for r in records) == [i for i in range(40) if i not in (3, 7, 11, 39)]
    assert gaps and {g.file for g in gaps} == {r.file for r in records}
    covered(records, gaps, len(data))


def test_wrong_digest_and_wrong_length_fail():
    good = record("1", None, b"payload", base32_sha1(b"payload"), None, "d")
    assert parse(good).payload == b"payload" and parse(good).uri is None
    for bad, why in ((good.replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n"), "digest"),
                     (re.sub(rb"WARC-Block-Digest[^\n]*\n", b"", good).replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n"), "digest"), (good[:-5] + b"\r\n\r\n", "length"), (b"x" + good, "header")):
        with pytest.raises(ValueError, match=why):
            parse(bad)


def test_a_plain_record_that_claims_the_rest_of_the_file_does_not_hide_it():
    a, b, c = archive(False, 3)
    lying = a.replace(b"\r\nContent-Length: %d\r\n\r\nHTTP" % (len(a) - a.index(b"HTTP") - 4), b"\r\nContent-Length: 99999\r\n\r\nHTTP", 1)
    search = Search(warc.VERSION, Plain)
    for part in (lying, b, c):
        search.put(0, part)
    search.end()
    assert [r.record_id for *_, r in search.found if r] == ["1", "2"]


def test_delimiter_inside_a_member():
    data = archive(True, 1)[0]
    search = Search(warc.MAGIC, Gzip)
    for k in range(0, len(data), 100):
        search.put(k, data[k:k + 100])
    assert [(o, n, why) for o, n, why, _ in search.found] == [(0, len(data), None)]


def test_large_member_ends_with_zero():
    assert member(b"")[-1] == member(b"a" * 100)[-1] == member(os.urandom(1 << 20) * 17)[-1] == 0


def test_null_ids_repeated_rows_and_empty_table(spark, tmp_root):
    pages = spark.createDataFrame([(None, "u", "p"), (5, "u", "p"), (5, "u", "p"), (9, "u", "p"), (None, "u", "q")], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_root}/pages.parquet")
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in op1_warc_salvage(spark, tmp_root).collect()), key=str)
    assert got == sorted([(None, "revisit", 5), (5, "response", None), (5, "response", None), (9, "revisit", 5), (None, "response", None)], key=str)
    write_archive(pages.limit(0), f"{tmp_root}/none")
    assert [x.count() for x in salvage(spark, f"{tmp_root}/none")] == [0, 0]
