import base64
import gzip
import hashlib
import io
import json
import struct
import zipfile

import pytest

from txengine.llm import zip_warc

from txengine.llm.zip_warc import (
    PackageOptions, decode_record, directory, encode_record, open_store, plan_records, read_package, read_packages, sort_key, stored_at,
    write_packages,
)
from txengine.session import scratch_path

HTML = [
    (1, "http://a/ \r\nx", "x" * 200), (2, None, "x" * 200), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""),
    (2, "again", "x" * 200), (None, "n", "x" * 200), (7, "é", "ü" * 50), (8, "v", "ü" * 50), (9, "w", "y" * 3_000_000), (10, "\r\n\r\n", "a\r\n\r\nb" * 30),
]


def test_round_trip(spark):
    df = spark.createDataFrame(HTML, "page_id long, url string, html string").selectExpr("*", "1 as payload")
    packages = write_packages(plan_records(df.repartition(3)), scratch_path(spark, "w"), PackageOptions(max_bytes=300, max_records=2))
    assert packages.count() >= 6
    got = sorted((tuple(r) for r in read_packages(packages).collect()), key=str)
    want = []
    for i, url, html in HTML:
        p = (html or "").encode()
        first = {"x": 1, "ü": 7}.get((html or " ")[0])
        copy = len(p) >= 100 and first is not None and i != first
        safe = None if url is None else "".join(f"%{ord(c):02X}" if ord(c) <= 32 else c for c in url)
        want.append((i, safe, len(p), hashlib.sha256(p).hexdigest(), "revisit" if copy else "response", first if copy else None, None if copy else p))
    assert got == sorted(want, key=str)
    empty = write_packages(plan_records(df.limit(0)), scratch_path(spark, "w"))
    assert read_packages(empty).count() == 0


def test_damage_is_reported(spark, tmp_path):
    raw = encode_record(1, "u", b"pay", hashlib.sha256(b"pay").hexdigest(), 3, None, "d")
    assert decode_record(raw)["payload"] == b"pay"
    with pytest.raises(ValueError):
        decode_record(raw.replace(b"pay", b"pax"))
    for name, method in (("deflated", zipfile.ZIP_DEFLATED), ("none", None)):
        path = tmp_path / f"{name}.wacz"
        with zipfile.ZipFile(path, "w", method or 0) as z:
            z.writestr("archive/data.warc.gz" if method else "other", b"x" * 100)
            z.writestr("indexes/index.cdxj", b'{"offset": 0, "length": 5}')
        with pytest.raises(ValueError, match=name):
            list(read_package(f"file://{path}"))
    cut = tmp_path / "cut.wacz"
    cut.write_bytes((tmp_path / "none.wacz").read_bytes()[:-30])
    with pytest.raises(ValueError):
        list(read_package(str(cut)))


def _zip64(members: list[tuple[str, bytes]]) -> bytes:
    """An archive whose sizes, offsets and counts all stand in ZIP64 fields."""
    out, entries = io.BytesIO(), []
    for name, data in members:
        at, n = out.tell(), name.encode()
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        out.write(struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0x800, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(n), len(extra)) + n + extra + data)
        entries.append((n, len(data), at))
    begin = out.tell()
    for n, size, at in entries:
        extra = struct.pack("<HHH", 0x5455, 2, 0) + struct.pack("<HHQQQ", 1, 24, size, size, at)
        out.write(struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0x800, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(n), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + n + extra)
    end = out.tell()
    out.write(struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, len(entries), len(entries), end - begin, begin))
    out.write(struct.pack("<4sIQI", b"PK\x06\x07", 0, end, 1))
    out.write(struct.pack("<4s4H2IH", b"PK\x05\x06", 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 4) + b"note")
    return out.getvalue()


def test_zip64_directory():
    raw = _zip64([("a", b"first"), ("dir/é", b""), ("b", b"second" * 9)])
    f = io.BytesIO(raw)
    members = directory(f, len(raw))
    assert [m.name for m in members] == ["a", "dir/é", "b"]
    assert [raw[(at := stored_at(f, m)) : at + m.size] for m in members] == [b"first", b"", b"second" * 9]
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr("x", b"1" * 10)
        z.comment = b"PK\x05\x06 in a comment" * 3
    assert zipfile.ZipFile(io.BytesIO(raw)).namelist() == [m.name for m in members]
    assert open_store("file:/tmp/x")[1] == "/tmp/x"


def _record(kind, block, **headers):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"Content-Length: {len(block)}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _foreign():
    """Records as other writers make them: (raw, what reading gives)."""
    page, reply = b"<p>page</p>" * 20, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: x\r\n\r\n"
    http = {"Content_Type": "application/http; msgtype=response"}
    sha1 = "sha1:" + base64.b32encode(hashlib.sha1(page).digest()).decode()
    own = hashlib.sha256(page).hexdigest()
    wide = "sha256:" + base64.b32encode(hashlib.sha256(page).digest()).decode().rstrip("=")
    made = [
        (_record("warcinfo", b"software: x\r\n", Content_Type="application/warc-fields"), ("warcinfo", None, b"software: x\r\n", hashlib.sha256(b"software: x\r\n").hexdigest())),
        (_record("request", b"GET / HTTP/1.1\r\n\r\n", Content_Type="application/http; msgtype=request"), ("request", None, b"GET / HTTP/1.1\r\n\r\n", hashlib.sha256(b"GET / HTTP/1.1\r\n\r\n").hexdigest())),
        (_record("response", reply + page, WARC_Payload_Digest=sha1, WARC_Target_URI="<http://a.org/x>", **http), ("response", "http://a.org/x", page, sha1)),
        (_record("response", reply + page, WARC_Payload_Digest=f"sha-256:{own.upper()}", **http), ("response", None, page, own)),
        (_record("response", reply + page, WARC_Payload_Digest=wide, **http), ("response", None, page, own)),
        (_record("response", reply + page, **http), ("response", None, page, own)),
        (_record("response", reply + page, WARC_Payload_Digest="blake3:abc", **http), ("response", None, page, "blake3:abc")),
        (_record("resource", page, Content_Type="text/html", WARC_Target_URI="urn:x"), ("resource", "urn:x", page, own)),
        (_record("revisit", b"HTTP/1.1 200 OK\r\nContent-Length: 220\r\n\r\n", WARC_Payload_Digest=sha1, **http), ("revisit", None, None, sha1)),
        (_record("revisit", b"", WARC_Payload_Digest=sha1), ("revisit", None, None, sha1)),
    ]
    return [m[0] for m in made], [m[1] for m in made]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("index", ["cdxj", "bare", "gz", None])
def test_packages_of_others(spark, tmp_path, packed, index):
    raw, want = _foreign()
    parts = [gzip.compress(r) if packed else r for r in raw]
    ending = ".warc.gz" if packed else ".warc"
    path, lines = tmp_path / "other.wacz", ['!meta {"format": "cdxj"}'] if index == "cdxj" else []
    with zipfile.ZipFile(path, "w") as z:
        for name, mine in (("one", parts[:4]), ("two", parts[4:])):
            at = 0
            for p in mine:
                place = {"url": "http://a.org/{x}", "filename": name + ending, "offset": at if index == "bare" else str(at), "length": len(p)}
                lines.append((f"org,a)/{at} 20240101000000 " if index != "bare" else "") + json.dumps(place))
                at += len(p)
            z.writestr(f"archive/{name}{ending}", b"".join(mine))
        z.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
        text = "\n".join(lines).encode()
        if index == "gz":
            z.writestr("indexes/index.cdx.gz", gzip.compress(text[:100]) + gzip.compress(text[100:]))
        elif index:
            z.writestr("indexes/index.cdxj", text)
    rows = read_packages(spark.createDataFrame([(f"file:{path}",)], "path string")).collect()
    assert [(r.record_type, r.url, r.payload and bytes(r.payload), r.payload_digest) for r in rows] == want
    assert [r.payload_bytes for r in rows][-2:] == [220, 0] and all(r.page_id is None for r in rows)


def test_wrong_digests_and_cut_records_are_reported():
    reply = b"HTTP/1.1 200 OK\r\n\r\n"
    for stated in ("sha1:" + "A" * 32, "md5:" + "0" * 32, "sha256:" + "0" * 64, "sha1:"):
        raw = _record("response", reply + b"page", WARC_Payload_Digest=stated, Content_Type="application/http")
        with pytest.raises(ValueError):
            decode_record(raw)
    with pytest.raises(ValueError):
        decode_record(_record("resource", b"page")[:-6])
    with pytest.raises(ValueError):
        decode_record(b"no record")


def test_index_lines_and_stores(spark, monkeypatch):
    assert sort_key("http://user@WWW.Example.Org:8080/A?b") == "org,example:8080)/a?b"
    assert sort_key("https://a.b") == "b,a)/" and sort_key(None) == sort_key("nothing") == "-"
    df = spark.createDataFrame([(1, "http://b.org/", "x"), (2, "http://a.org/", "y")], "page_id long, url string, html string")
    packages = write_packages(plan_records(df).coalesce(1), scratch_path(spark, "cdxj"))
    with zipfile.ZipFile(packages.first().path.replace("file:", "", 1)) as z:
        lines = z.read("indexes/index.cdxj").decode().splitlines()
    assert [x.split(" ", 2)[:2] for x in lines] == [["org,a)/", "19700101000000"], ["org,b)/", "19700101000000"]]
    assert {json.loads(x.split(" ", 2)[2])["filename"] for x in lines} == {"data.warc.gz"}
    asked = []
    monkeypatch.setattr(zip_warc, "pafs", type("P", (), {"FileSystem": type("F", (), {"from_uri": staticmethod(asked.append)})}))
    for uri in ("s3a://bucket/x", "s3n://bucket/x", "hdfs://host/x"):
        open_store(uri)
    assert asked == ["s3://bucket/x", "s3://bucket/x", "hdfs://host/x"]
