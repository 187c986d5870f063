"""Files read in blocks."""

import hashlib

import numpy as np

from leafmill.sources import files as S


def test_digests_of_files_read_in_blocks(spark, tmp_path, monkeypatch):
    """MD5 of whole files, however they are cut: no content, no line feed, one at the end, a byte order mark, odd names."""
    rnd = np.random.default_rng(4)
    data = {
        "a.bin": rnd.bytes(300_000), "b c%20.bin": b"", "d.bin": b"no line feed", "e.bin": b"one\n", "f.bin": b"\n", "g.bin": b"\r\n\n\r",
        "h.bin": b"\xef\xbb\xbfmark", "i.bin": b"\xef\xbb\xbfmark\n", "j.bin": b"\xef\xbb\xbf\xef\xbb\xbf\n", "sub/a.bin": b"\x00\xff" * 5000,
        "sub/k.bin": rnd.bytes(70_000) + b"\n", "left out.txt": b"text"}
    (tmp_path / "sub").mkdir()
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    monkeypatch.setattr(S, "BLOCK_BYTES", 1000)
    for split in ("128m", "7k"):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            files = S.read_files(spark, str(tmp_path), "*.bin", blocks=True)
            got = S.digests(S.require_content(files)).collect()
            largest = max(len(r["content"]) for r in files.select("content").collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert {(r["document_name"], r["document_type"], r["length"], r["digest"]) for r in got} == {
            (k, "unknown", len(v), hashlib.md5(v).hexdigest()) for k, v in data.items() if k.endswith(".bin") and v}
        assert len(got) == 10 and largest < 100_000
