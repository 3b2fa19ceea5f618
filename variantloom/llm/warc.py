"""WARC archives as seekable Zstandard bundles."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tables import run_dir
from .shared import bounded_batches, id_text, stored, tidy

#: Fixed values of the seekable format and of its skippable frame.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "record_id string, page_id long, file string, frame int, offset int, length int"
RECORD = "record_id string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload string"


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Footer for frames of these (compressed, plain) sizes."""
    body = b"".join(struct.pack("<II", c, d) for c, d in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the end of an open file."""
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    file.seek(size - 9 - 8 * n)
    body, out, at = file.read(8 * n), [], 0
    for c, d in struct.iter_unpack("<II", body):
        out.append((at, c, d))
        at += c
    return out


def record_id(page_id: int | None, url: str | None, digest: str, copy: int = 0) -> str:
    """The id of a record: of what makes its row, and the number of the copy if a table holds that row several times."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, repr((page_id, url, digest, copy)))}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str, refers_url: str | None = None, copy: int = 0) -> bytes:
    """One WARC record: a response with the payload, or a revisit that names the response's page and record."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    uri = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "about:blank")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, url, digest, copy)}", f"WARC-Target-URI: {uri}", f"WARC-Date: {date}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
            f"X-Page-Id: {'' if page_id is None else page_id}", f"X-No-Uri: {int(url is None)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, refers_url, digest)}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record back as fields of RECORD; the payload of a response is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload, kind, digest = block.partition(b"\r\n\r\n")[2], fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(fields["X-Payload-Length"])
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of page {fields['X-Page-Id']} is damaged")
    to = fields.get("X-Refers-To-Page", "")
    return {"record_id": fields["WARC-Record-ID"], "page_id": int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None, "url": None if fields["X-No-Uri"] == "1" else fields["WARC-Target-URI"],
            "record_type": kind, "payload_bytes": size, "payload_digest": digest, "refers_to": int(to) if to else None,
            "payload": payload.decode("utf-8") if kind == "response" else None}


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    """Tuples as a table whose integer columns may hold nulls."""
    cols = [x.split() for x in schema.split(", ")]
    data = zip(*rows, strict=True) if rows else ((),) * len(cols)
    return pd.DataFrame({c: pd.array(list(v), "Int64") if k in ("long", "int") else pd.Series(list(v), dtype=object) for (c, k), v in zip(cols, data, strict=True)})


def with_revisits(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """(page_id, url, html) -> page_id, url, payload, payload_bytes, payload_digest, refers_to, refers_url, copy.

    Of equal payloads of at least min_bytes bytes, the row with the largest page_id is kept and the others refer to it
    (rows that repeat that page_id are kept, too). A null html is empty. Groups are counted by digest before the join;
    smaller payloads, the empty ones above all, do not meet there. A row that the table holds several times is counted,
    shuffled once and comes out with its copies numbered.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1(F.encode("payload", "utf-8")), "copy": F.lit(0).cast("long")})
    own = F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce("url", F.lit("-")), "payload_digest")
    again = stored(rows.groupBy(own.alias("row")).agg(F.count("*").alias("n")).where("n > 1"), "again")
    if again.limit(1).count():
        keyed = rows.withColumn("row", own)
        held = keyed.join(again, "row").groupBy("row").agg(F.first("n").alias("n"), F.first(F.struct(*rows.columns)).alias("x"))
        held = held.withColumn("copy", F.explode(F.expr("sequence(0L, n - 1)"))).select(*[F.col(f"x.{c}") if c != "copy" else F.col(c) for c in rows.columns])
        rows = keyed.join(again, "row", "left_anti").select(rows.columns).unionByName(held)
    groups = (rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.max(F.struct("page_id", "url")).alias("keep"), F.count("*").alias("n"))
              .where("n > 1 and keep.page_id is not null").select(F.col("payload_digest").alias("met"), "keep"))
    met = F.when(F.col("payload_bytes") >= min_bytes, F.col("payload_digest")).otherwise(own.cast("string"))
    joined = rows.withColumn("met", met).join(groups, "met", "left").drop("met")
    to = "keep is not null and not page_id <=> keep.page_id"
    return joined.withColumns({"refers_to": F.expr(f"if({to}, keep.page_id, null)"), "refers_url": F.expr(f"if({to}, keep.url, null)")}).drop("keep")


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 1000, frame_bytes: int = 1 << 18,
                   file_bytes: int = 1 << 26, level: int = 3, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row to .warc.zst bundles below folder (a new one in the shared folder by default).

    Records are grouped in independent Zstandard frames of about frame_bytes plain bytes, files hold about file_bytes
    and end in a seek table. Returns the index, one row per record: record_id, page_id, file, frame, offset and length in
    the plain frame. Each task names its files anew and the index is a written table, so what a lost task left is never read.
    An empty table gives an empty index and no files.
    """
    base = (folder or run_dir(pages.sparkSession)).rstrip("/") + "/warc-" + uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(base)
        pack = zstandard.ZstdCompressor(level=level)
        frame, size, sizes, index, out, path, written = [], 0, [], [], None, "", 0

        def flush() -> None:
            nonlocal frame, size, out, path, written
            if not frame:
                return
            if out is None:
                store.create_dir(root, recursive=True)
                path = f"bundle-{uuid.uuid4().hex}.warc.zst"
                out = store.open_output_stream(f"{root}/{path}", compression=None)  # pyarrow would pack .zst once more
            data = pack.compress(b"".join(x[2] for x in frame))
            out.write(data)
            at = 0
            for name, page_id, x in frame:
                index.append((name, page_id, f"{base}/{path}", len(sizes), at, len(x)))
                at += len(x)
            sizes.append((len(data), size))
            written += size
            frame, size = [], 0

        def close() -> pd.DataFrame:
            nonlocal out, sizes, index, written
            flush()
            if out is not None:
                out.write(seek_table(sizes))
                out.close()
            rows = _frame(index, INDEX)
            out, sizes, index, written = None, [], [], 0
            return rows

        for b in batches:
            for r in b.to_dict("records"):
                page, to = (None if r[k] is None else int(r[k]) for k in ("page_id", "refers_to"))
                x = record(page, r["url"], r["payload"].encode(), r["payload_digest"], to, date, r["refers_url"], r["copy"])
                frame.append((record_id(page, r["url"], r["payload_digest"], r["copy"]), page, x))
                size += len(x)
                if size >= frame_bytes:
                    flush()
                if written >= file_bytes:
                    yield close()
        yield close()

    rows = bounded_batches(with_revisits(pages, min_bytes)).withColumns({c: id_text(c) for c in ("page_id", "refers_to")})
    return stored(rows.mapInPandas(tidy(run), INDEX), "warc-index")


def read_archives(index: DataFrame, payloads: bool = True, part_bytes: int = 1 << 25) -> DataFrame:
    """Index -> records by seeking: each frame that holds a wanted record is read and unpacked once per group.

    The index is small beside what it points to, so it is dealt out by the plain bytes of the records, about part_bytes
    for a task; within a task the records are read in chunks of bounded size."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard
        from pyarrow import fs

        out, name, file, table, plain, at = [], None, None, [], b"", -1
        for r in rows.sort_values(["file", "frame", "offset"]).itertuples():
            if r.file != name:
                store, path = fs.FileSystem.from_uri(r.file)
                name, at, file = r.file, -1, store.open_input_file(path)
                table = read_seek_table(file, file.size())
            if r.frame != at:
                start, packed, size = table[r.frame]
                file.seek(start)
                plain, at = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=size), r.frame
            out.append(tuple(parse(plain[r.offset : r.offset + r.length]).values()))
        found = _frame(out, RECORD)
        return found if payloads else found.drop(columns="payload")

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, part in b.groupby(b["length"].cumsum() // (1 << 25)):
                yield run(part)

    schema = RECORD if payloads else RECORD.rpartition(", ")[0]
    parts = 1 + (index.agg(F.sum("length")).first()[0] or 0) // part_bytes
    return index.repartition(parts, "file", "frame").sortWithinPartitions("file", "frame", "offset").mapInPandas(tidy(pages), schema)


WARC_SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS keep FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keep IS NULL OR page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keep THEN keep END AS refers_to FROM p LEFT JOIN g USING (payload_digest)
"""
