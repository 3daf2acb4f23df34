"""WARC records kept in ZIP packages of stored members (web-archive collections).

A package holds ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdxj`` (one line per record: sort key of the URL, time, JSON with its place),
both *stored*, so a record is one byte range of the package: package offset of the member plus
the record's offset. Reading parses the end record, the ZIP64 end record and the central
directory by hand, finds the members through their local headers, and then range-reads records;
nothing is unpacked.

Packages of others are read too: several archives (an index line names its own), plain or
gzipped records and indexes, index lines with or without key and time, ``!meta`` lines, and
packages without an index, whose archives are read from front to back. Files are reached through
Arrow file systems: local paths, ``hdfs``, ``s3`` (also as ``s3a`` or ``s3n``), ``gs``, ``abfs``.

Writing is one ``mapInPandas`` over the records: each task streams packages of bounded size
into the shared folder and returns their paths. A repeated or lost task leaves packages that
no returned path names; nobody reads them.

Defined results: a NULL payload is an empty one; a NULL URL leaves its header out; control
characters and blanks in a URL are percent-encoded. Records that are neither response nor revisit
(``warcinfo``, ``request``, ...) pass through with their block as payload. A SHA-256 digest is
given as bare lower-case hex, any other as it stands; a payload without a digest gets its
SHA-256. SHA-1, SHA-256 and MD5 digests, in hex or base32, are checked. A package that is cut
short, compresses a member that has to be read by range, or holds a record whose payload does not
match its digest raises ``ValueError`` with the package's path: records are never dropped silently.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.llm.common import table, written
from txengine.session import scratch_path

WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# ZIP structures (fixed values of the format)
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class PackageOptions:
    """Bounds of one package (payload bytes before compression, records), the gzip level and
    the date that every record states."""

    max_bytes: int = 64 << 20
    max_records: int = 50_000
    level: int = 6
    date: str = "1970-01-01T00:00:00Z"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI; Hadoop writes ``file:/x`` where Arrow wants three
    slashes, and ``s3a`` for what Arrow calls ``s3``."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri)))


# ------------------------------------------------------------------------------ ZIP
@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    packed: int
    header_at: int


def _read(f, at: int, n: int) -> bytes:
    f.seek(at)
    got = f.read(n)
    if len(got) != n:
        raise ValueError("cut short")
    return got


def _extra64(extra: bytes, fields: list[int]) -> list[int]:
    """Fields that read all ones, taken in order from the ZIP64 extra block."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            return [next(wide) if v == FULL32 else v for v in fields]
        at += 4 + n
    return fields


def directory(f, size: int) -> list[Member]:
    """Members of an open package, from its central directory (plain or ZIP64)."""
    tail_at = max(0, size - (22 + FULL16))
    tail = _read(f, tail_at, size - tail_at)
    end = tail.rfind(END)
    if end < 0 or len(tail) - end < 22:
        raise ValueError("no end of central directory")
    count, length, at = struct.unpack_from("<HII", tail, end + 10)
    if FULL16 == count or FULL32 in (length, at):
        lead = _read(f, tail_at + end - 20, 20)
        if lead[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        wide = _read(f, struct.unpack_from("<Q", lead, 8)[0], 56)
        if wide[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, at = struct.unpack_from("<QQQ", wide, 32)
    raw, pos, out = _read(f, at, length), 0, []
    for _ in range(count):
        if raw[pos : pos + 4] != ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", raw, pos + 8)
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", raw, pos + 20)
        header_at = struct.unpack_from("<I", raw, pos + 42)[0]
        name = raw[pos + 46 : pos + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[pos + 46 + n_name : pos + 46 + n_name + n_extra]
        plain, packed, header_at = _extra64(extra, [plain, packed, header_at])
        out.append(Member(name, method, plain, packed, header_at))
        pos += 46 + n_name + n_extra + n_note
    return out


def stored_at(f, m: Member) -> int:
    """Where a stored member's bytes begin."""
    if m.method != zipfile.ZIP_STORED:
        raise ValueError(f"{m.name} is compressed")
    head = _read(f, m.header_at, 30)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header of {m.name}")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return m.header_at + 30 + n_name + n_extra


# ----------------------------------------------------------------------------- WARC
def _safe_uri(uri: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)


def _urn(page_id) -> str:
    return f"<urn:page:{page_id}>"


def _from_urn(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def encode_record(page_id, uri, payload, digest, n, refers_to, date: str) -> bytes:
    """A response with its payload, or (``refers_to`` given) a revisit with headers only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn('none' if page_id is None else page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_safe_uri(uri)}")
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (x.partition(":") for x in raw.decode("utf-8").split("\r\n")[1:] if x)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _hex_digest(text: str, size: int) -> str:
    """A digest of ``size`` bytes in hex or base32 as lower-case hex."""
    if len(text) == 2 * size:
        return text.lower()
    return base64.b32decode(text.upper() + "=" * (-len(text) % 8)).hex()


def _checked(stated: str | None, payload: bytes | None, record: str) -> str | None:
    """The digest to give, after comparing it with the payload."""
    kind, _, text = (stated or "").partition(":")
    kind = kind.lower().replace("-", "")
    if kind in ("sha1", "sha256", "md5"):
        if not text:
            raise ValueError(f"digest of {record} is empty")
        own = hashlib.new(kind)
        text = _hex_digest(text, own.digest_size)
        if payload is not None:
            own.update(payload)
            if own.hexdigest() != text:
                raise ValueError(f"payload of {record} does not match its digest")
        return text if kind == "sha256" else stated
    if stated or payload is None:
        return stated
    return hashlib.sha256(payload).hexdigest()


def decode_record(raw: bytes) -> dict:
    """Fields of one record; a payload is checked against its digest."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/") or not gap:
        raise ValueError("no WARC record")
    warc = _headers(head)
    kind, record, size = warc["warc-type"], warc.get("warc-record-id", "a record"), int(warc["content-length"])
    if len(rest) < size:
        raise ValueError(f"{record} is cut short")
    block, payload, n = rest[:size], rest[:size], size
    if kind in ("response", "revisit") and warc.get("content-type", "").lower().startswith("application/http"):
        http_head, _, payload = block.partition(b"\r\n\r\n")
        n = len(payload)
    if kind == "revisit":
        # the payload is elsewhere; its length is what the reply said
        payload, n = None, int(_headers(http_head).get("content-length", 0)) if block else 0
    return {
        "page_id": _from_urn(record),
        "url": warc["warc-target-uri"].strip("<>") if "warc-target-uri" in warc else None,
        "payload": payload,
        "payload_bytes": n,
        "payload_digest": _checked(warc.get("warc-payload-digest"), payload, record),
        "record_type": kind,
        "refers_to": _from_urn(warc.get("warc-refers-to")),
    }


def sort_key(uri: str | None) -> str:
    """The URL with its host turned around, as index lines are sorted: ``org,example)/path``."""
    m = re.match(r"(?s)[^:/?#]+://(?:[^/?#@]*@)?([^/?#]*)(.*)", _safe_uri(uri or ""))
    if not m:
        return "-"
    host, _, port = m[1].lower().partition(":")
    return ",".join(reversed(host.removeprefix("www.").split("."))) + (f":{port}" if port else "") + ")" + (m[2].lower() or "/")


# -------------------------------------------------------------------------- packages
class _PackageWriter:
    """Streams records into one package."""

    def __init__(self, folder: str, opts: PackageOptions):
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        self.uri, self.opts = f"{folder}/{name}", opts
        self.out = store.open_output_stream(f"{path}/{name}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(WARC_MEMBER, "w", force_zip64=True)
        self.index: list[str] = []
        self.at = self.plain = 0

    def add(self, page_id, uri, payload, digest, n, refers_to) -> None:
        raw = encode_record(page_id, uri, payload, digest, n, refers_to, self.opts.date)
        packed = gzip.compress(raw, self.opts.level, mtime=0)
        self.member.write(packed)
        place = {"url": uri, "digest": f"sha256:{digest}", "filename": WARC_MEMBER.rpartition("/")[2], "offset": str(self.at), "length": str(len(packed))}
        self.index.append(f"{sort_key(uri)} {re.sub('[^0-9]', '', self.opts.date)[:14]} {json.dumps(place)}")
        self.at += len(packed)
        self.plain += len(raw)

    def full(self) -> bool:
        return self.plain >= self.opts.max_bytes or len(self.index) >= self.opts.max_records

    def close(self) -> dict:
        self.member.close()
        self.zip.writestr(INDEX_MEMBER, "".join(f"{x}\n" for x in sorted(self.index)))
        self.zip.close()
        self.out.close()
        return {"path": self.uri, "records": len(self.index)}


def _index_places(raw: bytes) -> Iterator[dict]:
    """The JSON part of every index line."""
    text = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    for line in text.decode("utf-8").splitlines():
        key, brace, rest = line.partition("{")
        if brace and not key.startswith("!"):
            yield json.loads(brace + rest)


def _front_to_back(f, begin: int, size: int, step: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive without an index, read in pieces."""
    at, held = 0, b""

    def more() -> bytes:
        nonlocal at
        got = _read(f, begin + at, min(step, size - at))
        at += len(got)
        return got

    while at < size or held:
        if len(held) < 2 and at < size:
            held += more()
        if held[:2] == b"\x1f\x8b":
            member, out = zlib.decompressobj(31), []
            while not member.eof:
                if not held and at == size:
                    raise ValueError("cut short")
                out.append(member.decompress(held or more()))
                held = member.unused_data
            yield b"".join(out)
            continue
        while b"\r\n\r\n" not in held and at < size:
            held += more()
        head = held.partition(b"\r\n\r\n")[0]
        if not head.strip():
            return
        whole = len(head) + 4 + int(_headers(head)["content-length"]) + 4
        while len(held) < whole and at < size:
            held += more()
        yield held[:whole]
        held = held[whole:]


def read_package(uri: str) -> Iterator[dict]:
    """The records of one package, each by one range read where there is an index."""
    try:
        store, path = open_store(uri)
        size = store.get_file_info(path).size
        with store.open_input_file(path) as f:
            members = {m.name: m for m in directory(f, size)}
            archives = {n: m for n, m in members.items() if re.fullmatch(r"archive/.*\.warc(\.gz)?", n)}
            indexes = [m for n, m in members.items() if re.fullmatch(r"indexes/.*\.cdxj?(\.gz)?", n)]
            if not archives:
                raise ValueError("no archive in the package")
            begin = {n: stored_at(f, m) for n, m in archives.items()}
            for index in indexes:
                for place in _index_places(_read(f, stored_at(f, index), index.size)):
                    name = f"archive/{place['filename']}" if "filename" in place else next(iter(archives))
                    at, length = int(place["offset"]), int(place["length"])
                    if at + length > archives[name].size:
                        raise ValueError("index points past the archive")
                    raw = _read(f, begin[name] + at, length)
                    yield decode_record(zlib.decompress(raw, 31) if raw[:2] == b"\x1f\x8b" else raw)
            if not indexes:
                for name, m in archives.items():
                    for raw in _front_to_back(f, begin[name], m.size):
                        yield decode_record(raw)
    except (ValueError, KeyError, struct.error, zlib.error, EOFError) as ex:
        raise ValueError(f"{uri}: {ex}") from ex


def plan_records(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(page_id, url, payload, payload_digest, payload_bytes, refers_to) of (page_id, url,
    html): of equal payloads of ``min_bytes`` or more the smallest page_id keeps its payload,
    the others refer to it. Rows that repeat that page_id are responses too; rows without a
    page_id never are the one referred to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )
    # counted first: the join's small side has one row per payload that really repeats
    firsts = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where((F.col("copies") > 1) & F.col("first_id").isNotNull())
        .select("payload_digest", "first_id")
    )
    joined = rows.join(firsts, "payload_digest", "left")
    is_copy = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", F.when(~is_copy, F.col("payload")).alias("payload"),
        "payload_digest", "payload_bytes", F.when(is_copy, F.col("first_id")).alias("refers_to"),
    )


def write_packages(
    records: DataFrame, folder: str, opts: PackageOptions = PackageOptions()
) -> DataFrame:
    """Packages of :func:`plan_records` rows in ``folder``: (path, records), materialised."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        package = None
        for b in batches:
            for page_id, url, payload, digest, n, refers_to in zip(
                *(b[c].tolist() for c in ("page_id", "url", "payload", "payload_digest", "payload_bytes", "refers_to"))
            ):
                package = package or _PackageWriter(folder, opts)
                whole = lambda v: None if pd.isna(v) else int(v)
                package.add(whole(page_id), url, payload, digest, int(n), whole(refers_to))
                if package.full():
                    yield pd.DataFrame([package.close()])
                    package = None
        if package:
            yield pd.DataFrame([package.close()])

    # ids as text: pandas would turn a column of ids with gaps into floats
    ids = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    done = records.withColumns(ids).mapInPandas(write, "path string, records bigint")
    return written(done, "packages")


def read_packages(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all packages in ``packages`` (path), one task per package or few."""
    fields = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    names = [x.split()[0] for x in fields.split(", ")]
    if payloads:
        fields, names = fields + ", payload binary", [*names, "payload"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                rows, size = [], 0
                for r in read_package(path):
                    rows.append([r[c] for c in names])
                    size += r["payload_bytes"] if payloads else 100
                    if size >= 16 << 20:
                        yield pd.DataFrame(rows, columns=names, dtype=object)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names, dtype=object)

    tasks = min(20_000, max(1, packages.count()))
    return packages.select("path").repartition(tasks).mapInPandas(read, fields)


def op10_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = plan_records(table(spark, sf_dir, "pages"))
    packages = write_packages(records, scratch_path(spark, "wacz"))
    return read_packages(packages, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


OP10_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS payload_digest,
         strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to, url
FROM p LEFT JOIN f USING (payload_digest)
"""
