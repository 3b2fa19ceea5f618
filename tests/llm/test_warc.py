import hashlib
import io

import zstandard
from pyarrow import fs

from variantloom.llm.warc import parse, read_archives, read_seek_table, record_id, write_archives


def test_archives_read_back(spark, tmp_path):
    big = "<p>é</p>" * 400
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, None, big), (3, "http://a/b c\r\nX: y", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (None, "u", "none"), (7, "u", "z" * 300000), (7, "u", "z" * 300000), (7, "v", "z" * 300000), (None, "u", "none"), (20, "w", "y" * 1_500_000), (2**60 + 1, "v", "w" * 2000), (2**60 + 3, "w", "w" * 2000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, offset int").repartition(3)
    index = write_archives(df, folder=f"file://{tmp_path}", frame_bytes=5000, file_bytes=20000)
    got = read_archives(index).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.url): r for r in got}
    assert {i: by[(i, u)].refers_to for i, u in ((1, "http://a/1"), (2, "http://a/2"), (9, None))} == {1: 9, 2: 9, 9: None}
    assert by[(2**60 + 1, "v")].refers_to == 2**60 + 3
    for r in got:
        source = next(h or "" for p, _, h in rows if p == r.page_id)
        assert r.payload_bytes == len(source.encode()) and r.payload_digest == hashlib.sha1(source.encode()).hexdigest()
        assert r.record_type == ("revisit" if r.refers_to else "response") and r.payload == (None if r.refers_to else source)
    ids = [r.record_id for r in got]
    assert len(set(ids)) == len(rows) and set(ids) == {r.record_id for r in index.collect()}
    raw = {r.page_id: r for r in got if r.page_id is not None}
    assert raw[9].record_id == record_id(9, None, raw[9].payload_digest)
    files = {r.file for r in index.collect()}
    assert len(files) > 1
    n = 0
    for f in files:
        store, path = fs.FileSystem.from_uri(f)
        data = store.open_input_file(path).read()
        table = read_seek_table(io.BytesIO(data), len(data))
        plain = b"".join(zstandard.ZstdDecompressor().decompress(data[s : s + c], max_output_size=p) for s, c, p in table)
        assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == plain
        n += plain.count(b"WARC/1.1\r\n")
    assert n == len(rows)
    r = index.where("page_id = 3").first()
    store, path = fs.FileSystem.from_uri(r.file)
    with store.open_input_file(path) as file:
        start, packed, size = read_seek_table(file, file.size())[r.frame]
        file.seek(start)
        plain = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=size)
    assert parse(plain[r.offset : r.offset + r.length])["payload"] == "small"


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_archives(write_archives(df, folder=f"file://{tmp_path}")).collect() == []
