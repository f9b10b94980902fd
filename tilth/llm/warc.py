"""WARC archives: a deterministic sharded writer and a streaming reader.

Records are compressed one by one where they are read, so only compressed
bytes are shuffled, once, into ranges of the key.  A second, slim input names
for every repeated payload the record that others revisit; it joins its range
by union and sort, not by another shuffle of the payloads.  Each task writes its
sorted range to files under temporary names and starts a new file when the
next record would pass the size limit.  The tasks' rows, written once, are the
manifest: only files that it names are renamed, the rest of a lost or
repeated attempt is removed, and the manifest is stored beside the files.

Headers and digests are made anew: record ids derive from the key and the payload,
the date is a parameter, and the same input gives the same records in the same
order.

Defined results: a null payload is empty; rows with the same key are each
written, and if their payloads are equal too the first in order of URL is the
one that the others revisit; rows without a key are dealt out by a hash, come first in their file and are never revisited
by others; an empty table gives a manifest without files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.llm.text import bound_batches, range_cuts, range_shard
from tilth.scratch import materialize

ROLL_BYTES = 1 << 30
SHARD_ROWS = 20_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "temporary string, name string, records long, bytes long, sha1 string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def store(uri: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else uri
    return fs.FileSystem.from_uri(uri)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{key}/{digest}')}>"


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))]) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode("utf-8", "surrogatepass")) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def _fields(kind: str, key: int | None, url: str, digest: str, size: int, block: bytes, date: str) -> list[tuple[str, str]]:
    return [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(key, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("X-Payload-Length", str(size)),
        *([] if key is None else [("X-Key", str(key))]),
    ]


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def _responses(date: str):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, urls, digests, sizes, members = batch.column("key").to_pylist(), [], [], [], []
            for key, url, html in zip(keys, batch.column("url").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                payload = (html or "").encode("utf-8", "surrogatepass")
                digest, block = base32_sha1(payload), _http(len(payload)) + payload
                members.append(_member(_fields("response", key, url or "", digest, len(payload), block, date), block))
                urls.append(url or "")
                digests.append(digest)
                sizes.append(len(payload))
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array([1] * len(keys), pa.int32()), batch.column("key"), pa.array(urls, pa.string()), pa.array(digests, pa.string()), pa.array(sizes, pa.int64()), pa.nulls(len(keys), pa.int64()), pa.array(members, pa.binary())], ["shard", "kind", "key", "url", "digest", "size", "refers_to", "member"])

    return made


def _writer(folder: str, roll: int, date: str):
    """Merges the slim and the full rows of each sorted range and writes its files."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = store(folder)
        out, part = None, 0
        attempt = uuid.uuid4().hex
        seen: set[str] = set()
        refers: dict[str, int] = {}
        last_key: object = files  # equals no key
        now: dict = {}

        def close() -> pa.RecordBatch | None:
            nonlocal out
            if out is None:
                return None
            out.close()
            out = None
            return pa.RecordBatch.from_pylist([now | {"sha1": now["sha1"].hexdigest()}], pa.schema([("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())]))

        def put(member: bytes, shard: int) -> Iterator[pa.RecordBatch]:
            nonlocal out, part
            if out is not None and (now["bytes"] + len(member) > roll or now["shard"] != shard):
                part = part + 1 if now["shard"] == shard else 0
                yield close()
            if out is None:
                name = f"part-{shard:05d}-{part:05d}.warc.gz"
                info = f"software: tilth\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n".encode()
                first = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", f"sha1:{base32_sha1(info)}")], info)
                temporary = f"_tmp-{attempt}-{name}"
                out = files.open_output_stream(f"{path}/{temporary}")
                now.clear()
                now.update(temporary=temporary, name=name, records=0, bytes=0, sha1=hashlib.sha1(), shard=shard)
                out.write(first)
                now["bytes"] += len(first)
                now["sha1"].update(first)
            out.write(member)
            now["records"] += 1
            now["bytes"] += len(member)
            now["sha1"].update(member)

        for batch in batches:
            for row in batch.to_pylist():
                key, digest = row["key"], row["digest"]
                if key != last_key:
                    refers, seen, last_key = {}, set(), key
                if row["kind"] == 0:
                    refers[digest] = row["refers_to"]
                    continue
                target = refers.get(digest)
                if target is None or (target == key and digest not in seen):
                    member = row["member"]
                    seen.add(digest)
                else:
                    head = _http(row["size"])
                    fields = [*_fields("revisit", key, row["url"], digest, row["size"], head, date), ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(target, digest)), ("X-Refers-To-Key", str(target))]
                    member = _member(fields, head)
                yield from put(member, row["shard"])
        if (rest := close()) is not None:
            yield rest

    return written


def _renamer(folder: str):
    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, path = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source = f"{path}/{row['temporary']}"
                if files.get_file_info(source).type != fs.FileType.NotFound:  # else an earlier attempt did it
                    files.move(source, f"{path}/{row['name']}")
            yield batch

    return renamed


def write_warc(pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", payload: str = "html", min_revisit: int = 0, roll_bytes: int = ROLL_BYTES, shard_rows: int = SHARD_ROWS, date: str = DATE) -> DataFrame:
    """Write one record per row under ``folder`` and return the manifest.

    Records with equal payloads of at least ``min_revisit`` bytes are written once,
    as the response of the smallest key; the others revisit it.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    page = pages.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload"))
    cuts = range_cuts(page.select("key"), "key", shard_rows)
    # rows without a key have no place in the order, so a hash deals them out
    spread = F.pmod(F.xxhash64("url", "payload"), F.lit(len(cuts) + 1)).cast("int")
    shard = range_shard(F.col("key"), cuts)

    slim = page.select("key", F.sha1(F.encode("payload", "utf-8")).alias("hex"), F.octet_length("payload").cast("long").alias("size")).filter((F.col("size") >= min_revisit) & F.col("key").isNotNull())
    first = slim.groupBy("hex").agg(F.min("key").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("hex", "refers_to")
    again = slim.join(first, "hex").select("key", "hex", "refers_to").distinct()
    slim_rows = again.select(shard.alias("shard"), F.lit(0).alias("kind"), "key", F.lit("").alias("url"), F.col("hex").alias("digest"), F.lit(0).cast("long").alias("size"), "refers_to", F.lit(None).cast("binary").alias("member"))
    slim_rows = slim_rows.mapInArrow(_base32, slim_rows.schema)
    full = page.select(F.when(F.col("key").isNull(), spread).otherwise(shard).alias("shard"), "key", "url", "payload").mapInArrow(_responses(date), slim_rows.schema)
    ranged = full.unionByName(slim_rows).repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "kind", "digest", "url")

    files, path = store(folder)
    files.create_dir(path, recursive=True)
    manifest = materialize(ranged.mapInArrow(_writer(folder, roll_bytes, date), MANIFEST), "warc-manifest")
    manifest = materialize(manifest.mapInArrow(_renamer(folder), MANIFEST), "warc-committed")
    _settle(spark, manifest, folder)
    return manifest.drop("temporary")


def _base32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("digest")
        yield batch.set_column(at, "digest", pa.array([base64.b32encode(bytes.fromhex(x)).decode() for x in batch.column(at).to_pylist()], pa.string()))


def _settle(spark: SparkSession, manifest: DataFrame, folder: str) -> None:
    """Removes what failed attempts left and stores the manifest; files are few: one per roll."""
    from pyarrow import fs

    files, path = store(folder)
    for info in files.get_file_info(fs.FileSelector(path)):
        if info.base_name.startswith("_tmp-"):
            files.delete_file(info.path)
    manifest.drop("temporary").coalesce(1).write.mode("overwrite").json(f"{folder}/_manifest")
    with files.open_output_stream(f"{path}/_COMMITTED") as out:
        out.write(json.dumps({"manifest": "_manifest"}).encode())


def _members(stream) -> Iterator[bytes]:
    """The members of a gzip file one by one; one record is in memory at a time."""
    data, unzip, got = b"", zlib.decompressobj(31), []
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                break
        got.append(unzip.decompress(data))
        data = unzip.unused_data
        if unzip.eof:
            yield b"".join(got)
            unzip, got = zlib.decompressobj(31), []


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    return fields, block[: int(fields["Content-Length"])]


def _reader(folder: str, with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = store(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{path}/{name}") as stream:
                    for raw in _members(stream):
                        fields, block = parse_record(raw)
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        if f"sha1:{base32_sha1(block)}" != fields["WARC-Block-Digest"]:
                            raise ValueError(f"{name}: block of {fields['WARC-Record-ID']} is damaged")
                        body = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                        digest = base32_sha1(body) if body is not None else fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if f"sha1:{digest}" != fields["WARC-Payload-Digest"]:
                            raise ValueError(f"{name}: payload of {fields['WARC-Record-ID']} is damaged")
                        key, refers = fields.get("X-Key"), fields.get("X-Refers-To-Key")
                        rows.append({"page_id": key and int(key), "url": fields.get("WARC-Target-URI"), "payload_bytes": int(fields["X-Payload-Length"]) if body is None else len(body), "payload_digest": digest, "record_type": kind, "refers_to": refers and int(refers), "payload": body if with_payload else None})
                        held += len(raw)
                        if len(rows) >= 2000 or held > 1 << 25:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def read_warc(manifest: DataFrame, folder: str, *, with_payload: bool = True) -> DataFrame:
    """The records of the files that a manifest names, a file to a task, streamed."""
    names = manifest.select("name")
    parts = max(1, min(100_000, names.count()))
    return names.repartition(parts, "name").mapInArrow(_reader(folder, with_payload), RECORD)
