"""Web archives with a two-level capture index.

Archives: WARC 1.1 files in which each record is a gzip member of its own (a record above MEMBER_BYTES takes several in a row), written by Spark's
text writer, so that a lost task is written again and only committed files are seen. The writer must end each row with a separator; it is
a zero byte, which is the last byte of any member that holds less than 16 MB, and is left off the row.

Of rows with equal payloads of at least ``min_bytes`` the one with the smallest id is a `response`; the others are `revisit` records without payload that
refer to it and carry its digest and size.

Index: one line for each capture, keyed by the reversed host, the rest of the url and the id. The first level are compressed blocks
of sorted lines, the second a sparse directory with the first and last key of each block. A lookup finds a key's blocks by binary search in
the directory, the lines by binary search in the block, and then reads those byte ranges of the archives and nothing else.

The directory is broadcast if it is measured to be within BROADCAST_BYTES; beyond that keys meet the blocks' lines in a join. Ranges are read
through pyarrow where it knows the store, otherwise from files that Spark reads whole.

Defined cases: a null payload is empty; a null url is the key of an empty host; null ids count as the largest; rows that repeat an id and its
payload are all responses if that id is the smallest; every row has a record of its own; line breaks in a url are percent-encoded;
an empty table gives an archive without records and an index without blocks; other columns are ignored.
"""
from __future__ import annotations

import io
import json
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import BROADCAST_BYTES, parts_for, small, stored
from llm.encoding import batches, release
from tidemart.session import work_path

#: Lines and their bytes in a block; lines in a sorted part, at most so many parts; keys looked up in a block at once; bytes of ranges in a task.
BLOCK_LINES, BLOCK_BYTES, PART_LINES, MOST_PARTS, KEYS_AT_ONCE, RANGE_BYTES = 3000, 1 << 20, 1 << 17, 10_000, 1 << 16, 64 << 20
#: Bytes of a record in one gzip member; below 2**24, so that the member ends with a zero byte.
MEMBER_BYTES = 8 << 20
NO_ID = 2**63 - 1
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Fixed value of the format: the profile of a revisit whose payload is the same.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = "key string, id long, url string, kind string, digest string, file string, at long, size long"


def base32(hexadecimal: Column) -> Column:
    """A SHA-1 of 40 hexadecimal digits as 32 letters: five digits are four letters."""
    digits = lambda h, g: F.conv(F.substring(h, g * 5 + 1, 5), 16, 10).cast("int")
    letters = lambda h: F.concat(*[F.substring(F.lit(ALPHABET), F.shiftright(digits(h, g), s).bitwiseAND(31) + 1, F.lit(1)) for g in range(8) for s in (15, 10, 5, 0)])
    return F.transform(F.array(hexadecimal), letters)[0]  # the digest is bound once


def one_line(url: Column) -> Column:
    return F.replace(F.replace(url.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def capture_key(url: Column, id_: Column) -> Column:
    """Reversed host, then what follows it, then the id, so that captures of a site lie side by side."""
    url = F.coalesce(one_line(url), F.lit(""))
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(url, r"^[^:]*://([^/?#]*)", 1)), r"\.")), ",")
    return F.concat(host, F.lit(")"), F.regexp_replace(url, r"^[^:]*://[^/?#]*", ""), F.lit(" "), F.lpad(F.coalesce(id_.cast("string"), F.lit("-")), 20, "0"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Per row: id, url, payload (null for revisits), payload_bytes, digest, kind, refers_to."""
    rows = (pages.select(F.col(id_col).cast("long").alias("id"), one_line(F.col(url_col)).alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha", F.sha1("payload")))
    known = F.coalesce("id", F.lit(NO_ID))
    several = (rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("sha", "payload_bytes").agg(F.min(known).alias("first"), F.count(F.lit(1)).alias("n"))
               .filter("n > 1").drop("n"))
    again = F.col("first").isNotNull() & (F.col("first") != known)
    return (rows.join(small(stored(several, "warc-repeated"), "octet_length(sha) + 32"), ["sha", "payload_bytes"], "left")
            .select("id", "url", F.when(~again, F.col("payload")).alias("payload"), "payload_bytes", base32(F.col("sha")).alias("digest"),
                    F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("first")).alias("refers_to")))


def name_of(id_: int | None) -> str:
    return f"<urn:page:{'-' if id_ is None else id_}>"


def record_bytes(row: dict) -> bytes:
    """One WARC record."""
    payload = row["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http + (payload.encode() if payload is not None else b"")
    head = [("WARC-Type", row["kind"]), ("WARC-Record-ID", name_of(row["id"]))]
    if row["url"] is not None:
        head.append(("WARC-Target-URI", row["url"]))
    head.append(("WARC-Payload-Digest", f"sha1:{row['digest']}"))
    if row["kind"] == "revisit":
        head += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", name_of(row["refers_to"] if row["refers_to"] != NO_ID else None))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def members(record: bytes, size: int = MEMBER_BYTES) -> bytes:
    out = []
    for at in range(0, len(record), size):
        gz = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += [gz.compress(record[at:at + size]), gz.flush()]
    return b"".join(out)


def write(rows: DataFrame, purpose: str = "warc") -> str:
    """Write ``records`` as archives; returns their folder."""
    def build(it):
        release()
        for part in batches(it, "payload"):
            coded = [members(record_bytes(r)) for r in part.to_pylist()]
            assert all(c[-1] == 0 for c in coded)
            yield pa.RecordBatch.from_arrays([pa.array([c[:-1] for c in coded], pa.binary())], ["record"])
    path = work_path(rows.sparkSession, purpose)
    rows.mapInArrow(build, "record binary").select(F.col("record").cast("string")).write.option("lineSep", "\0").text(path)
    return path


def parse(record: bytes) -> dict:
    head, _, block = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, number = fields["WARC-Type"], lambda name: fields[name][10:-1]
    whole = lambda x: None if x == "-" else int(x)
    return {"id": whole(number("WARC-Record-ID")), "url": fields.get("WARC-Target-URI"), "kind": kind, "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "payload": payload if kind == "response" else None, "payload_bytes": size, "refers_to": whole(number("WARC-Refers-To")) if kind == "revisit" else None}


def scan(stream, chunk: int = 1 << 20):
    """(offset, length, record) of all records of an open archive; holds one record at a time."""
    data, at = b"", 0
    record, begin, end = b"", 0, None
    while data or (data := stream.read(chunk)):
        gz, out, size = zlib.decompressobj(31), [], 0
        while not gz.eof:
            if not data and not (data := stream.read(chunk)):
                raise ValueError(f"the archive ends inside the member at byte {at}")
            out.append(gz.decompress(data))
            size += len(data) - len(gz.unused_data)
            data = gz.unused_data
        record, at = record + b"".join(out), at + size
        if end is None:
            head = record.partition(b"\r\n\r\n")[0]
            length = next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))
            end = len(head) + 4 + int(length[16:]) + 4
        if len(record) >= end:
            yield begin, at - begin, record
            record, begin, end = b"", at, None


def filesystem(uri: str):
    """(store, path in it) for pyarrow, or None if it doesn't know the store."""
    from pyarrow import fs

    at = urlparse(uri)
    if at.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(at.path)
    try:
        return fs.FileSystem.from_uri(uri)
    except Exception:  # noqa: BLE001  no driver, no library or no credentials for that store: Spark's reader is used
        return None


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder (path, length, content), of which Spark reads what is selected."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)


def captures(spark: SparkSession, folder: str, direct: bool = True) -> DataFrame:
    """An index line (key, id, url, kind, digest, file, at, size) for each record, from a scan of the archives. ``direct``: through pyarrow if it knows the store."""
    direct = direct and filesystem(folder) is not None
    entry = pa.schema([("id", pa.int64()), ("url", pa.string()), ("kind", pa.string()), ("digest", pa.string()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])

    def run(it):
        for batch in it:
            for k in range(batch.num_rows):
                path = batch.column("path")[k].as_py()
                if direct:
                    store, inside = filesystem(path)
                    stream = store.open_input_stream(inside)
                else:
                    stream = io.BytesIO(batch.column("content")[k].as_py())
                rows = []
                for at, size, record in scan(stream):
                    r = parse(record)
                    rows.append({"file": path.rsplit("/", 1)[1], "at": at, "size": size} | {c: r[c] for c in ("id", "url", "kind", "digest")})
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_pylist(rows, entry)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, entry)
    files = archives(spark, folder).select("path", *([] if direct else ["content"]))
    lines = files.mapInArrow(run, "id long, url string, kind string, digest string, file string, at long, size long")
    return lines.select(capture_key(F.col("url"), F.col("id")).alias("key"), "*")


def build_index(lines: DataFrame) -> DataFrame:
    """Compressed blocks of sorted lines: part, block, first, last, n, data."""
    lines = stored(lines, "warc-lines")
    parts = min(parts_for(lines.count(), PART_LINES), MOST_PARTS)
    columns = ["key", "id", "url", "kind", "digest", "file", "at", "size"]

    def blocks(it):
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block():
            return pa.RecordBatch.from_pylist([{"part": part, "block": number, "first": held[0][0], "last": held[-1][0], "n": len(held),
                                                "data": zlib.compress("\n".join(text for _, text in held).encode())}], schema)
        for batch in it:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                held.append((row[0], json.dumps(row, ensure_ascii=False)))
                size += len(held[-1][1])
                if len(held) == BLOCK_LINES or size >= BLOCK_BYTES:
                    yield block()
                    number, held, size = number + 1, [], 0
        if held:
            yield block()
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("n", pa.int32()), ("data", pa.binary())])
    ordered = lines.select(columns).repartitionByRange(parts, "key", "file", "at").sortWithinPartitions("key", "file", "at")
    return stored(ordered.mapInArrow(blocks, "part int, block int, first string, last string, n int, data binary"), "warc-index")


def lines_of(data: bytes) -> list[list]:
    return [json.loads(line) for line in zlib.decompress(data).decode().split("\n")]


_ENTRY = pa.schema([("key", pa.string()), ("id", pa.int64()), ("url", pa.string()), ("kind", pa.string()), ("digest", pa.string()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])


def _entries(rows: list[list]) -> pa.Table:
    return pa.Table.from_pydict({f.name: [r[k] for r in rows] for k, f in enumerate(_ENTRY)}, _ENTRY)


def lookup(index: DataFrame, keys: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The index lines of all distinct values of ``keys.key``; keys that no capture has give none."""
    spark = index.sparkSession
    keys = keys.select("key").filter("key IS NOT NULL").distinct()
    directory = index.select("first", "last", "part", "block")
    size = directory.agg(F.sum(F.octet_length("first") + F.octet_length("last") + 64)).first()[0] or 0
    if size > limit:
        def every(it):
            for batch in it:
                for data in batch.column("data").to_pylist():
                    yield from _entries(lines_of(data)).to_batches()
        return index.select("data").mapInArrow(every, LINE).join(keys, "key", "left_semi")
    sparse = spark.sparkContext.broadcast(sorted(map(tuple, directory.collect())))  # measured above

    def places(it):
        blocks = sparse.value
        firsts, lasts = [b[0] for b in blocks], [b[1] for b in blocks]
        for batch in it:
            rows = [(key, *blocks[b][2:]) for key in batch.column("key").to_pylist() for b in range(bisect_left(lasts, key), bisect_right(firsts, key))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int32()))], ["key", "part", "block"])
    chunk = F.floor((F.row_number().over(Window.partitionBy("part", "block").orderBy("key")) - 1) / KEYS_AT_ONCE)
    placed = stored(keys.mapInArrow(places, "key string, part int, block int").withColumn("chunk", chunk), "warc-places")
    chunks = placed.select(*[F.col(c).alias(c) for c in ("part", "block", "chunk")]).distinct()  # aliases: the two sides of the cogroup are told apart
    wanted = chunks.join(index.select("part", "block", "data"), ["part", "block"])

    def search(asked: pa.Table, block: pa.Table) -> pa.Table:
        rows = []
        for data in block.column("data").to_pylist():  # one block
            lines = lines_of(data)
            at = [line[0] for line in lines]
            for key in asked.column("key").to_pylist():
                rows += lines[bisect_left(at, key):bisect_right(at, key)]
        return _entries(rows)
    by = ("part", "block", "chunk")
    return placed.groupBy(*by).cogroup(wanted.groupBy(*by)).applyInArrow(search, LINE)


def read_ranges(found: DataFrame, folder: str, direct: bool = True) -> DataFrame:
    """The records at the byte ranges of index lines: key, id, url, kind, digest, payload, payload_bytes, refers_to."""
    spark = found.sparkSession
    schema = pa.schema([("key", pa.string()), ("id", pa.int64()), ("url", pa.string()), ("kind", pa.string()), ("digest", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("refers_to", pa.int64())])
    out = "key string, id long, url string, kind string, digest string, payload binary, payload_bytes long, refers_to long"

    def record(raw: bytes) -> dict:
        data = b""
        while raw:
            gz = zlib.decompressobj(31)
            data, raw = data + gz.decompress(raw), gz.unused_data
        return parse(data)

    def emit(rows):
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row["payload"] or b"") + 256
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema)
    found = stored(found.select("key", "file", "at", "size"), "warc-found")
    if direct and filesystem(folder) is not None:
        def ranges(it):
            name = stream = None
            for batch in it:
                for key, file, at, size in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "at", "size"))):
                    if file != name:
                        store, inside = filesystem(f"{folder}/{file}")
                        name, stream = file, store.open_input_file(inside)
                    yield record(stream.read_at(size, at)) | {"key": key}
        parts = min(parts_for(found.agg(F.sum("size")).first()[0], RANGE_BYTES), MOST_PARTS)
        return found.repartitionByRange(parts, "file", "at").sortWithinPartitions("file", "at").mapInArrow(lambda it: emit(ranges(it)), out)

    def slices(it):
        for batch in it:
            for content, asked in zip(batch.column("content"), batch.column("asked").to_pylist()):
                data = content.as_buffer()
                for r in asked:
                    yield record(data[r["at"]:r["at"] + r["size"]].to_pybytes()) | {"key": r["key"]}
    # a file has a bounded number of ranges: one for each of its records
    asked = found.groupBy("file").agg(F.collect_list(F.struct("key", "at", "size")).alias("asked"))
    files = archives(spark, folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.join(asked, "file").mapInArrow(lambda it: emit(slices(it)), out)
