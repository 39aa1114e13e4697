import base64
import gzip
import hashlib
import io
import random

from conftest import SF_SMALL
from strivelake.llm import warc as w
from strivelake.llm.queries import op3_warc_salvage
from strivelake.session import scratch_path


def want(rows):
    first = {}
    for i, h in sorted((i, h or "") for i, h in rows if i is not None):
        first.setdefault(h, i)
    out = []
    for i, h in rows:
        data, f = (h or "").encode(), first.get(h or "")
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        later = i is not None and f != i
        out.append((i, len(data), digest, "revisit" if later else "response", f if later else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in df.collect()), key=str)


def test_query_matches_brute_force(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    assert rows_of(op3_warc_salvage(spark, SF_SMALL)) == want([(r.page_id, r.html) for r in pages.collect()])


def test_edges(spark):
    rows = [(3, "u", "same"), (1, None, "same"), (2, "a\r\nb", "same"), (4, "u", None), (5, "u", ""),
            (6, "u", "é" * 300000), (None, "u", "same"), (7, "u", "x\r\n\r\nWARC/1.0\r\n\r\ny"), (7, "u", "x\r\n\r\nWARC/1.0\r\n\r\ny")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    records, gaps = w.round_trip(pages)
    assert rows_of(records) == want([(r[0], r[2]) for r in rows])
    assert gaps.count() == 0
    records, gaps = w.round_trip(pages.limit(0))
    assert records.count() == 0 and gaps.count() == 0


def test_salvage_recovers_every_record_behind_damage():
    random.seed(3)
    parts = [w.record_bytes(i, f"http://x/{i}", random.randbytes(random.randint(0, 4000)), None) for i in range(30)]
    for packed in (True, False):
        data = [w._member(p) if packed else p for p in parts]
        starts = [0]
        for p in data:
            starts.append(starts[-1] + len(p))
        broken = bytearray(b"".join(data))
        for k in (0, 11):
            broken[(starts[k] + starts[k + 1]) // 2] ^= 0xFF
        broken = b"noise" + bytes(broken[:starts[20]]) + b"\x1f\x8b\x08 WARC/1.1 lies" + bytes(broken[starts[20]:]) + data[3][:-9]
        out = list(w.salvage(io.BytesIO(broken)))
        found = [r["record_id"] for r in out if r["kind"] == "record"]
        assert found == [f"urn:page:{k}" for k in range(30) if k not in (0, 11)]
        assert sum(r["end"] - r["start"] for r in out) == len(broken)      # every byte is accounted for
        assert all(r["reason"] for r in out if r["kind"] == "gap")
    assert list(w.salvage(io.BytesIO(b""))) == []


def test_reader_over_files(spark):
    folder = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame([(k, "http://x", f"<p>{k}</p>" * 50) for k in range(60)],
                                  "page_id long, url string, html string").repartition(3)
    made = w.write_archives(pages, folder, archive_bytes=2000)
    assert made.agg({"records": "sum"}).first()[0] == 60 and made.count() > 3
    got = w.read_archives(w.archive_list(spark, folder).filter("archive like '%.warc.gz'"))
    assert {bytes(r.payload).decode() for r in got.collect()} == {f"<p>{k}</p>" * 50 for k in range(60)}


def one_record(text):
    block = text.encode()
    return (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:{len(block)}>\r\n"
            f"WARC-Block-Digest: sha1:{w.digest32(block)}\r\nContent-Length: {len(block)}\r\n\r\n").encode() \
        + block + b"\r\n\r\n"


def test_several_records_in_a_member():
    texts = ["a", "bb", "ccc", "dddd", "eeeee"]
    parts = [one_record(x) for x in texts]
    member = gzip.compress(b"".join(parts))
    out = list(w.salvage(io.BytesIO(member + gzip.compress(parts[0]))))
    assert [r["payload"].decode() for r in out] == [*texts, "a"]
    assert {(r["start"], r["end"]) for r in out[:5]} == {(0, len(member))} and out[5]["start"] == len(member)
    for bad in range(5):  # one damaged record in the member: the others come back
        broken = [p.replace(texts[k].encode() + b"\r\n\r\n", b"?" * len(texts[k]) + b"\r\n\r\n") if k == bad else p
                  for k, p in enumerate(parts)]
        out = list(w.salvage(io.BytesIO(gzip.compress(b"".join(broken)))))
        assert [r["payload"].decode() for r in out if r["kind"] == "record"] == texts[:bad] + texts[bad + 1:]
        gaps = [r for r in out if r["kind"] == "gap"]
        assert len(gaps) == 1 and "digest differs" in gaps[0]["reason"]
    only = list(w.salvage(io.BytesIO(gzip.compress(b"no record in here"))))
    assert [r["kind"] for r in only] == ["gap"]
