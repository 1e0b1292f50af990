import base64
import hashlib
import io

import pytest

from textrec.llm import warc as W
from textrec.session import scratch_path


def expected(rows):
    """page_id, bytes, digest, type, refers_to by plain Python."""
    first = {}
    for i, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, html in rows:
        raw = (html or "").encode()
        revisit = i is not None and first[html or ""] != i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=str)


def run(spark, pages, range_bytes):
    manifest = W.write_archives(W.with_revisits(pages), scratch_path(spark, "w"))
    rows = W.read_archives(W.byte_ranges(manifest, range_bytes)).collect()
    assert all(r.payload_ok for r in rows)
    return manifest, rows


def digest(rows):
    return sorted([(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows], key=str)


@pytest.mark.parametrize("range_bytes", [50, 997, 1 << 30])
def test_every_split_gives_every_record_once(spark, range_bytes):
    rows = [(i, f"<p>page {i % 7}</p>" * (i % 5 * 30)) for i in range(60)] + [(60, None), (61, ""), (None, "x"), (62, "é\r\n\r\n\x00")]
    pages = spark.createDataFrame([(i, f"http://a/{i}\r\nX: y" if i != 3 else None, h, "z", "p") for i, h in rows],
                                  "page_id bigint, url string, html string, digest string, payload string").repartition(3)
    _, got = run(spark, pages, range_bytes)
    assert digest(got) == expected(rows)
    payloads = {r.record_id: bytes(r.payload) for r in got if r.record_type == "response"}
    assert payloads[0] == b"" and payloads[62] == "é\r\n\r\n\x00".encode()


def test_query(spark, sf):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = sorted([tuple(r)[:5] for r in W.op9_splittable_warc(spark, sf).collect()], key=str)
    assert got == expected(rows)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert run(spark, pages, 100)[1] == []


def test_ties_and_small_payloads(spark):
    pages = spark.createDataFrame([(1, "u", "same"), (1, "u", "same"), (2, "u", "same"), (3, "u", "same")],
                                  "page_id bigint, url string, html string")
    got = digest(run(spark, pages, 100)[1])
    assert [(g[0], g[3], g[4]) for g in got] == [(1, "response", None)] * 2 + [(2, "revisit", 1), (3, "revisit", 1)]
    assert {r.refers_to for r in W.with_revisits(pages, min_bytes=5).collect()} == {None}


def test_false_magic_and_damage_are_passed_over():
    good = [W.member(i, "u", b"x" * i, W.base32_sha1(b"x" * i), None) for i in range(5)]
    data = W.GZIP_MAGIC + b"junk" + good[0] + good[1][:-9] + b"\x00" + good[2] + W.GZIP_MAGIC * 3 + good[3] + good[4][:20]
    got = [h["warc-record-id"] for h, _ in W.RangeReader(io.BytesIO(data), len(data), 0, len(data)).records()]
    assert got == [W.record_urn(i) for i in (0, 2, 3)]


def test_ids_of_any_characters_and_clashing_columns(spark):
    ids = ["a", "b\r\nc: d", "None", "", "%41", "é 漢/<>", None, "null", " lead", "x" * 5000]
    pages = spark.createDataFrame([(i, f"u{n}", f"<p>{n % 3}</p>", "x", 1, "y", b"z", "r") for n, i in enumerate(ids)],
                                  "page_id string, url string, html string, record_id string, path int, digest string, "
                                  "payload binary, refers_to string").repartition(3)
    manifest = W.write_archives(W.with_revisits(pages), scratch_path(spark, "w"))
    rows = W.read_archives(W.byte_ranges(manifest, 100), "string")
    W.check_complete(rows, manifest)
    assert digest(rows.collect()) == expected([(i, f"<p>{n % 3}</p>") for n, i in enumerate(ids)])


def test_a_lost_record_is_noticed_and_ranges_are_spread(spark):
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(200)], "page_id bigint, url string, html string")
    manifest = W.write_archives(W.with_revisits(pages).coalesce(1), scratch_path(spark, "w"))
    ranges = W.byte_ranges(manifest, 2000)
    n = ranges.count()
    assert n > 8 and ranges.rdd.getNumPartitions() == 8 and min(map(len, ranges.rdd.glom().collect())) > 0
    rows = W.read_archives(ranges)
    W.check_complete(rows, manifest)
    with pytest.raises(RuntimeError, match="1 archives"):
        W.check_complete(rows.where("record_id != 7"), manifest)
    with pytest.raises(RuntimeError, match="1 archives"):
        W.check_complete(rows.limit(0), manifest)
