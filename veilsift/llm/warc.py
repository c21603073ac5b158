"""WARC archives: writer, monolithic gzip normaliser with a sidecar offset index, and indexed reader.

``write_archives`` deals rows into archives of bounded size; each is one gzip stream over the whole
file, as many crawlers leave them. ``normalise`` inflates such a stream once, rewrites every record as
its own gzip member and writes a sidecar index of member offsets beside the archive. ``read_records``
opens an archive at the offsets of its index only. Archives lie in a folder that driver and executors
share, reached through ``pyarrow.fs``; a task writes under a name of its own, and only names that the
tasks' results tell (written to the shared folder) are read, so lost or repeated tasks do no harm.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_rows, own_folder

#: Bytes of records after which a task begins another archive; a longer record gets one of its own.
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 20
#: Payloads below it are never revisits.
LEAST_REVISIT = 100
LEVEL = 6
#: The profile of revisits (a fixed value of the standard).
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def record(headers: dict[str, str], payload: bytes) -> bytes:
    """A WARC/1.1 record. Line ends in header values become spaces; Content-Length is added."""
    lines = ["WARC/1.1"] + [f"{k}: {' '.join(v.splitlines())}" for k, v in headers.items()]
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of one record."""
    end = data.index(b"\r\n\r\n")
    head = data[:end].decode("utf-8", "surrogatepass").split("\r\n")
    if not head[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {head[0][:40]!r}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
    size = int(headers["content-length"])
    payload = data[end + 4 : end + 4 + size]
    if len(payload) != size or data[end + 4 + size :] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    return headers, payload


def records_of(stream: Iterator[bytes]) -> Iterator[bytes]:
    """The records of an inflated stream, which comes in pieces of any size."""
    held = bytearray()
    need = 0
    for piece in stream:
        held += piece
        while True:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                lines = bytes(held[:end]).split(b"\r\n")
                size = next(x for x in lines if x.lower().startswith(b"content-length:"))
                need = end + 4 + int(size.partition(b":")[2]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("the archive ends inside of a record")


def inflate(file) -> Iterator[bytes]:
    """A gzip file's content in pieces, one member or several."""
    unzip = zlib.decompressobj(31)
    while data := file.read(CHUNK):
        while data:
            out = unzip.decompress(data, CHUNK)
            if out:
                yield out
            if unzip.eof:
                data, unzip = unzip.unused_data, zlib.decompressobj(31)
            else:
                data = unzip.unconsumed_tail
    if tail := unzip.flush():
        yield tail


def deflate(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def record_id(page, digest: str) -> str:
    """The URN of a page's record: of its id and digest, so a revisit can name it without looking it up."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}:{digest}')}>"


def page_record(page, url: str | None, kind: str, digest: str, size: int, first, payload: bytes, date: str) -> bytes:
    """A response, or a revisit of the page ``first`` of equal payload, with the HTTP block that WARC asks for.

    The block of a revisit is the HTTP header alone. A page without a URL is told by a URN; ``Page-ID``
    is an extension field, as the standard allows.
    """
    headers = {"WARC-Type": kind, "WARC-Record-ID": record_id(page, digest), "WARC-Date": date, "WARC-Target-URI": url or f"urn:page:{quote(str(page), safe='')}"}
    if page is not None:
        headers["Page-ID"] = quote(str(page), safe="")
    if kind == "revisit":
        headers |= {"WARC-Profile": REVISIT, "WARC-Refers-To": record_id(first, digest), "Refers-To-Page-ID": quote(str(first), safe="")}
    headers |= {"WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http; msgtype=response"}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return record(headers, http + (payload if kind == "response" else b""))


def page_of(headers: dict[str, str], block: bytes) -> tuple:
    """record_id (the page's), url, kind, digest, size, refers_to and payload of a parsed record."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    url = headers["warc-target-uri"]
    page, first = (unquote(x) if (x := headers.get(n)) is not None else None for n in ("page-id", "refers-to-page-id"))
    return (page, None if url.startswith("urn:page:") else url, headers["warc-type"], headers["warc-payload-digest"].partition(":")[2], size, first, payload)


def write_archives(rows: DataFrame, folder: str, date: str | None = None) -> DataFrame:
    """(path, n_records) of monolithic archives of ``rows``: record_id, url, kind, digest, size, refers_to, payload.

    ``date`` is the WARC-Date of all records: by default the time of this call, told by the driver,
    so a repeated task writes the same bytes. Null and repeated ids are written like others.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches):
        out, made = None, {"path": [], "n_records": []}

        def close():
            stream, zipper, path, n, _ = out
            stream.write(zipper.flush())
            stream.close()
            made["path"].append(path)
            made["n_records"].append(n)

        for b in batches:
            for page, url, kind, digest, size, first, payload in zip(*(b[c] for c in columns), strict=True):
                data = page_record(page, url, kind, digest, size, first, payload or b"", date)
                if out and out[4] + len(data) > ARCHIVE_BYTES:
                    close()
                    out = None
                if not out:
                    files, base = _open(folder)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = [files.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(1, zlib.DEFLATED, 31), f"{folder}/{name}", 0, 0]
                out[0].write(out[1].compress(data))
                out[3] += 1
                out[4] += len(data)
        if out:
            close()
        yield made

    columns = ["record_id", "url", "kind", "digest", "size", "refers_to", "payload"]
    return cut(map_rows(rows, columns, "path string, n_records long", run, batch_rows=64))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """(path, index) of normalised archives; ``archives`` has the ``path`` of each monolithic one.

    Every record becomes a gzip member; the sidecar ``index`` is JSON lines with offset, length and
    record id of each member.
    """

    def run(batches):
        for b in batches:
            made = {"path": [], "index": []}
            for path in b["path"]:
                files, source = _open(path)
                to, base = _open(folder)
                name = f"{base}/{uuid.uuid4().hex}"
                at, lines = 0, []
                with files.open_input_stream(source, compression=None) as raw, to.open_output_stream(f"{name}.warc.gz", compression=None) as out:
                    for data in records_of(inflate(raw)):
                        member = deflate(data)
                        out.write(member)
                        head = data[: data.index(b"\r\n\r\n")].decode("utf-8", "surrogatepass")
                        rid = next(x for x in head.split("\r\n") if x.lower().startswith("warc-record-id:"))
                        lines.append(json.dumps({"offset": at, "length": len(member), "id": rid.partition(":")[2].strip()}))
                        at += len(member)
                with to.open_output_stream(f"{name}.idx.jsonl", compression=None) as out:
                    out.write("".join(x + "\n" for x in lines).encode())
                name = f"{folder}/{name.rpartition('/')[2]}"
                made["path"].append(f"{name}.warc.gz")
                made["index"].append(f"{name}.idx.jsonl")
            yield made

    return cut(map_rows(_one_by_one(archives), ["path"], "path string, index string", run, batch_rows=1))


def _one_by_one(archives: DataFrame) -> DataFrame:
    """Archives spread evenly over tasks."""
    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.repartition(n, F.xxhash64("path"))


def read_records(archives: DataFrame) -> DataFrame:
    """record_id, url, kind, digest, refers_to and payload of every record, member by member through the index."""

    def run(batches):
        names = ["record_id", "url", "kind", "digest", "size", "refers_to", "payload"]
        for b in batches:
            for path, index in zip(b["path"], b["index"], strict=True):
                files, source = _open(path)
                with files.open_input_stream(_open(index)[1], compression=None) as f:
                    entries = [json.loads(x) for x in f.read().splitlines()]
                made, held = {n: [] for n in names}, 0
                with files.open_input_file(source) as f:
                    for e in entries:
                        f.seek(e["offset"])
                        headers, block = parse(zlib.decompress(f.read(e["length"]), 31))
                        if headers["warc-record-id"] != e["id"]:
                            raise ValueError(f"{index} does not fit {path}")
                        row = page_of(headers, block)
                        for n, v in zip(names, row, strict=True):
                            made[n].append(v)
                        held += len(block)
                        if held > 8 << 20:
                            yield made
                            made, held = {n: [] for n in names}, 0
                yield made

    schema = "record_id string, url string, kind string, digest string, size long, refers_to string, payload binary"
    return map_rows(_one_by_one(archives), ["path", "index"], schema, run, batch_rows=1)


def plan_records(pages: DataFrame, id_col: str = "page_id", body_col: str = "html", url_col: str = "url") -> DataFrame:
    """The record of each row: response, or a revisit of the row with the smallest id of equal payloads.

    Null bodies are empty payloads. Payloads under 100 bytes are all responses, and so are rows with a
    null id. Rows out are rows in: a row is told by id and digest, so of repeated ids each goes by its
    own payload, and rows equal in both have one fate (both are the response, if their id is the
    smallest). Only digests that occur more than once are joined back, and those of more than ``hot``
    rows (of which there are 4096 at most) are broadcast, so that no join key holds many rows.
    """
    payload = F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).alias("record_id"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"),
    )
    slim = cut(rows.select("record_id", "digest", "size"))
    found = slim.where((F.col("size") >= LEAST_REVISIT) & F.col("record_id").isNotNull())
    firsts = cut(found.groupBy("digest").agg(F.min("record_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    hot = max(64, slim.count() // 4096)
    often = F.broadcast(firsts.where(F.col("n") > hot).select("digest", F.col("first").alias("often")))
    seldom = cut(
        found.join(often, "digest", "left_anti")
        .join(firsts.where(F.col("n") <= hot).select("digest", "first"), "digest")
        .where("record_id <> first")
        .select(F.col("record_id").alias("rid"), F.col("digest").alias("rdigest"), "first")
        .distinct()
    )
    rows = rows.join(often, "digest", "left")
    rows = rows.join(seldom, (rows["record_id"] == seldom["rid"]) & (rows["digest"] == seldom["rdigest"]), "left")
    big = (F.col("size") >= LEAST_REVISIT) & F.col("record_id").isNotNull()
    ref = F.when(big, F.coalesce("first", F.when(F.col("often") != F.col("record_id"), F.col("often"))))
    return rows.select(
        "record_id", "url", F.when(ref.isNull(), "response").otherwise("revisit").alias("kind"), "digest", "size", ref.alias("refers_to"), "payload"
    )


def round_trip(pages: DataFrame, id_col: str = "page_id", body_col: str = "html", url_col: str = "url") -> DataFrame:
    """All rows written to monolithic archives, normalised, and read back through the index.

    The folder of the archives goes when the driver's program ends.
    """
    folder = own_folder(pages.sparkSession, "warc")
    files, base = _open(folder)
    for name in ("raw", "members"):
        files.create_dir(f"{base}/{name}", recursive=True)
    raw = write_archives(plan_records(pages, id_col, body_col, url_col), f"{folder}/raw")
    members = normalise(raw, f"{folder}/members")
    files.delete_dir(f"{base}/raw")
    return read_records(members)


def report(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record that was read back.

    Digest and length of a response are computed from the payload that came back.
    """
    kind = pages.schema["page_id"].dataType
    back = round_trip(pages)
    got = F.col("kind") == "response"
    return back.select(
        F.col("record_id").cast(kind).alias("page_id"),
        F.when(got, F.octet_length("payload")).otherwise(F.col("size")).cast("long").alias("payload_bytes"),
        F.when(got, F.sha2("payload", 256)).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


#: The report in SQL.
REPORT_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
