"""WARC archives: written as monolithic gzip files, normalised to one member a record, read back.

A crawler may compress a whole WARC file as one gzip stream, which allows no access to a
single record.  The normaliser inflates such a stream once, from its start, in bounded
steps; every record that it cuts out is written again as a gzip member of its own, and a
sidecar file (JSON lines) next to the new archive lists each member's offset and length.
The same entries come back as the index table.  Readers then go from the index straight to
the members: any task can read any part of any archive.

``archive_pages`` writes one record for each page (payloads equal to another page's become
revisits of it), normalises the archives and reads them back.  Files go to the shared work
folder; each attempt of a task writes under a name of its own, and only files that a
finished task has listed are read, so lost executors and repeated attempts leave unread
files at most.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import fresh, materialise, shuffle_partitions

#: Payloads of fewer bytes are always stored in full.
LEAST = 1000
#: Groups of equal payloads that are looked up by broadcast: the largest, at most so many.
HOT_GROUPS = 1024
#: Parts in which rows that share a group's largest page_id are numbered.
PARTS = 256
#: Uncompressed bytes after which a task begins its next archive; bytes of a reading range.
ROLL, RANGE = 64 << 20, 16 << 20
#: Bytes that one step inflates at most.
STEP = 1 << 20
MOST_TASKS = 8192
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31  # zlib's window setting for a gzip header and trailer

LISTING = "path string, records long"
INDEX = ("path string, offset long, length long, record_id string, record_type string, "
         "target_uri string, payload_digest string, refers_to string")
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, target_uri string")


def page_of(name: str) -> int | None:
    """The page id in a record's name ``<urn:page:ID:TAG>``; the tag keeps repeated and missing ids apart."""
    digits = name.strip("<>").split(":")[2]
    return int(digits) if digits else None


def _escaped(uri: str) -> str:
    """The uri without characters that could end a header line; all other text stays."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in uri)


def build_record(name: str, kind: str, uri: str | None, date: str, payload: bytes, digest: str,
                 refers_to: str | None = None) -> bytes:
    """One uncompressed WARC record; a revisit keeps the HTTP headers and drops the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_escaped(uri)}")
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_headers(raw: bytes) -> dict[str, str]:
    """Header lines by lower-case name (the version line is left out)."""
    pairs = (line.split(":", 1) for line in raw.decode("utf-8").split("\r\n")[1:] if line)
    return {k.lower(): v.strip() for k, v in pairs}


def hex_digest(header: str) -> str:
    """The bare lower-case hex form of a ``sha1:BASE32`` digest."""
    return base64.b32decode(header.split(":", 1)[1]).hex()


def inflated(stream, step: int = STEP) -> Iterator[bytes]:
    """The stream's bytes, inflated once from its start in steps of at most ``step``.

    Takes one gzip member or several; a stream that ends within a member raises EOFError.
    """
    member, begun = zlib.decompressobj(GZIP), False
    while raw := stream.read(step):
        while raw:
            begun = True
            yield member.decompress(raw, step)
            if member.eof:
                raw, member, begun = member.unused_data, zlib.decompressobj(GZIP), False
            else:
                raw = member.unconsumed_tail
    while begun and (rest := member.decompress(b"", step)):
        yield rest
    if begun and not member.eof:
        raise EOFError("the archive ends within a gzip member")


def records_of(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of each record in a run of inflated bytes; one is held at a time."""
    held = bytearray()

    def need(n: int) -> bool:
        while len(held) < n:
            part = next(parts, None)
            if part is None:
                return False
            held.extend(part)
        return True

    while need(1):
        seen = 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not need(seen + 1):
                raise EOFError("the archive ends within a record's headers")
        headers = parse_headers(bytes(held[:end]))
        size = end + 4 + int(headers["content-length"]) + 4
        if not need(size):
            raise EOFError("the archive ends within a record")
        if held[size - 4:size] != b"\r\n\r\n":
            raise ValueError(f"{headers.get('warc-record-id')}: the record does not end where its length says")
        yield headers, bytes(held[:size])
        del held[:size]


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def equal_payloads(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """The pages as records to write: (name, page_id, url, payload, digest, record_type, refers_to).

    Of rows with equal payloads of at least ``least`` bytes the one with the largest page_id
    (null is smallest; of rows that share it any one) is the response, all others revisit it
    (refers_to: its name).  Groups are aggregated before they are shuffled.  The largest groups, a bounded
    number, meet their rows by broadcast; the rows of all others are joined by digest, and
    rows that need no partner are spread.  Rows that share the largest page_id are numbered in parts first.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("same", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    groups = materialise(rows.where(F.col("same").isNotNull()).groupBy("same", "page_id").agg(F.count("*").alias("n"))
                         .groupBy("same").agg(F.sum("n").alias("n"), F.max(F.struct("page_id", "n")).alias("first")).where("n > 1"),
                         "warc-groups")
    hot = groups.orderBy(F.desc("n"), "same").limit(HOT_GROUPS)
    cold = groups.join(F.broadcast(hot.select("same")), "same", "left_anti").select("same", F.col("first").alias("cold"))
    spread = F.monotonically_increasing_id().cast("string")
    found = (rows.join(F.broadcast(hot.select("same", F.col("first").alias("hot"))), "same", "left")
             .withColumn("key", F.when(F.col("hot").isNull() & F.col("same").isNotNull(), F.col("same")).otherwise(spread))
             .join(cold.withColumnRenamed("same", "key"), "key", "left")
             .withColumn("first", F.coalesce("hot", "cold")))
    top = F.col("first").isNotNull() & F.col("page_id").eqNullSafe(F.col("first.page_id"))
    twin = F.coalesce(top & (F.col("first.n") > 1), F.lit(False))
    judged = found.where(~twin).withColumn("response", F.col("first").isNull() | top)
    if not groups.where("first.n > 1").isEmpty():
        part = Window.partitionBy("same", F.pmod(F.monotonically_increasing_id(), F.lit(PARTS))).orderBy(F.lit(0))
        twins = found.where(twin).withColumn("nth", F.row_number().over(part))
        one = Window.partitionBy("same").orderBy(F.lit(0))
        firsts = twins.where("nth = 1").withColumn("response", F.row_number().over(one) == 1)
        judged = judged.unionByName(firsts.drop("nth")).unionByName(
            twins.where("nth > 1").withColumn("response", F.lit(False)).drop("nth"))

    def name(page_id: Column, tag: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), tag, F.lit(">"))

    own = F.when(F.col("response") & F.col("first").isNotNull(), F.col("same")).otherwise(F.monotonically_increasing_id().cast("string"))
    return judged.select(
        name(F.col("page_id"), own).alias("name"), "page_id", "url", "payload", F.sha1("payload").alias("digest"),
        F.when(F.col("response"), "response").otherwise("revisit").alias("record_type"),
        F.when(~F.col("response"), name(F.col("first.page_id"), F.col("same"))).alias("refers_to"))


def write_monolithic(records: DataFrame, folder: str, date: str = "2020-01-01T00:00:00Z", roll: int = ROLL) -> DataFrame:
    """(path, records) of ``.warc.gz`` files, each one gzip stream as a whole."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = None, []

        def close() -> None:
            out["file"].write(out["gzip"].flush())
            out["file"].close()
            done.append((out["path"], out["records"]))

        for b in batches:
            for at in range(0, b.num_rows, 64):
                for r in b.slice(at, 64).to_pylist():
                    if out is None:
                        path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                        files, name = _place(path)
                        files.create_dir(name.rsplit("/", 1)[0])
                        out = {"path": path, "file": files.open_output_stream(name, compression=None),
                               "gzip": zlib.compressobj(6, zlib.DEFLATED, GZIP), "bytes": 0, "records": 0}
                    raw = build_record(r["name"], r["record_type"], r["url"], date, r["payload"], r["digest"], r["refers_to"])
                    out["file"].write(out["gzip"].compress(raw))
                    out["records"] += 1
                    out["bytes"] += len(raw)
                    if out["bytes"] >= roll:
                        close()
                        out = None
        if out is not None:
            close()
        yield _batch(LISTING, done)

    return materialise(records.mapInArrow(write, LISTING), "warc-listing")


def normalise(listing: DataFrame, folder: str) -> DataFrame:
    """The index of the archives that hold the listed ones' records, a gzip member for each.

    Every listed file is inflated once, as a stream; next to each new archive a sidecar
    ``.idx`` holds its index entries as JSON lines.
    """
    names = [c.split()[0] for c in INDEX.split(", ")]

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                files, name = _place(path)
                target = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                out_files, out_name = _place(target)
                out_files.create_dir(out_name.rsplit("/", 1)[0])
                offset, entries = 0, []
                with files.open_input_stream(name, compression=None) as source, \
                        out_files.open_output_stream(out_name, compression=None) as out, \
                        out_files.open_output_stream(f"{out_name}.idx", compression=None) as sidecar:
                    for headers, raw in records_of(inflated(source)):
                        packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                        member = packer.compress(raw) + packer.flush()
                        out.write(member)
                        entry = (target, offset, len(member), headers["warc-record-id"], headers["warc-type"],
                                 headers.get("warc-target-uri"), headers.get("warc-payload-digest"),
                                 headers.get("warc-refers-to"))
                        sidecar.write(json.dumps(dict(zip(names[1:], entry[1:]))).encode() + b"\n")
                        entries.append(entry)
                        offset += len(member)
                        if len(entries) == 4096:
                            yield _batch(INDEX, entries)
                            entries = []
                yield _batch(INDEX, entries)

    tasks = max(1, min(MOST_TASKS, listing.count()))
    return materialise(listing.select("path").repartition(tasks).mapInArrow(rewrite, INDEX), "warc-index")


def read_member(files: fs.FileSystem, handle, offset: int, length: int) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of the member at ``offset``."""
    raw = zlib.decompress(handle.read_at(length, offset), GZIP)
    head, block = raw.split(b"\r\n\r\n", 1)
    http, payload = block[:-4].split(b"\r\n\r\n", 1)
    return parse_headers(head), parse_headers(http), payload


def read_records(index: DataFrame) -> DataFrame:
    """The records behind an index: (page_id, payload_bytes, payload_digest, record_type,
    refers_to, target_uri); length and digest are those of the full payload.

    A stored payload is hashed again and compared with its header; one that differs raises
    ValueError.  Index entries are dealt by ranges of their archives.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, handle, files = None, None, None
        for b in batches:
            for start in range(0, b.num_rows, 256):
                rows = []
                for e in b.slice(start, 256).to_pylist():
                    if e["path"] != at:
                        at = e["path"]
                        files, name = _place(at)
                        handle = files.open_input_file(name)
                    warc, http, payload = read_member(files, handle, e["offset"], e["length"])
                    digest, length = hex_digest(warc["warc-payload-digest"]), int(http["content-length"])
                    if warc["warc-type"] == "response" and (
                            hashlib.sha1(payload).hexdigest() != digest or len(payload) != length):
                        raise ValueError(f"{warc['warc-record-id']}: the payload differs from its digest")
                    refers = warc.get("warc-refers-to")
                    rows.append((page_of(warc["warc-record-id"]), length, digest, warc["warc-type"],
                                 page_of(refers) if refers else None, warc.get("warc-target-uri")))
                yield _batch(RECORDS, rows)

    part = fresh("range")
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(shuffle_partitions(index.sparkSession), min(MOST_TASKS, size // RANGE + 1))
    dealt = (index.select("path", "offset", "length", F.expr(f"offset div {RANGE}").alias(part))
             .repartition(int(tasks), "path", part).sortWithinPartitions("path", "offset").drop(part))
    return dealt.mapInArrow(read, RECORDS)


def archive_pages(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri) of every page,
    as read back from the normalised archives.

    Null html is an empty payload, a null url leaves the target header out, null and repeated
    page ids give a record for each row (a revisit of a response without id has a null
    refers_to).  Other columns are ignored; an empty table gives an empty table.
    """
    spark = pages.sparkSession
    listing = write_monolithic(equal_payloads(pages, least), scratch_path(spark, "warc-monolithic"))
    return read_records(normalise(listing, scratch_path(spark, "warc-records")))
