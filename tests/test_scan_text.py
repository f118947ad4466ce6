import random

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import corpus as io


def _write(folder, name, raw):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(raw)


@pytest.fixture()
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in zip(keys, ("1000", "1", "64")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _text(rng, lines, last=True):
    out = [rng.choice(("", "é" * rng.randrange(40), "日本語 " * rng.randrange(9), "plain words", "tail\r", "x" * rng.randrange(2500), "\ufffd mark")) for _ in range(lines)]
    return "\n".join(out) + "\n" * last


def _read(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.source_file, r.offset)):
        name = r.source_file.rsplit("/", 1)[1]
        before = got.setdefault(name, "")
        assert r.offset == len(before.encode()) + (3 if name == "mark" else 0)
        got[name] = before + r.text
    return got


@pytest.mark.parametrize("piece", [1, 700, 1 << 20])
def test_pieces_in_order_are_the_file(spark, small_splits, tmpdir_fresh, piece):
    rng = random.Random(piece)
    texts = {"a": _text(rng, 90), "b": _text(rng, 60, last=False), "c": "no line end at all", "d": "\n", "mark": _text(rng, 20), "crlf": "one\r\ntwo\r\n" * 300, "empty": ""}
    for name, t in texts.items():
        _write(tmpdir_fresh, name, (b"\xef\xbb\xbf" if name == "mark" else b"") + t.encode())
    df = io.scan_text(spark, tmpdir_fresh, piece_bytes=piece)
    assert _read(df) == {n: t for n, t in texts.items() if t}
    assert df.select("source_file", F.floor(F.col("offset") / 1000)).distinct().count() > 5


def test_documents_between_separators(spark, small_splits, tmpdir_fresh):
    rng = random.Random(5)
    docs = [_text(rng, rng.randrange(1, 6)) for _ in range(40)]
    _write(tmpdir_fresh, "f", "<|endoftext|>".join(docs).encode())
    rows = sorted(io.scan_text(spark, tmpdir_fresh, separator="<|endoftext|>").collect(), key=lambda r: r.offset)
    assert [r.text for r in rows] == docs and rows[0].source_size == len("<|endoftext|>".join(docs).encode())


def test_bad_bytes_raise_with_file_and_offset(spark, small_splits, tmpdir_fresh):
    good = "é fine \ufffd line\n".encode() * 200
    _write(tmpdir_fresh, "f", good + "x\ufffdé".encode() + b"\xc3(" + b" end\n" + good)
    with pytest.raises(Exception, match=rf"not UTF-8: .*/f, byte {len(good) + 6}"):
        io.scan_text(spark, tmpdir_fresh).collect()
    lax = io.scan_text(spark, tmpdir_fresh, strict=False).collect()
    assert "x\ufffdé\ufffd( end" in "".join(r.text for r in sorted(lax, key=lambda r: r.offset))


def test_corpus_of_lines_has_ordered_keys(spark, small_splits, tmpdir_fresh):
    from corpusmill.operators import dataset as ds

    _write(tmpdir_fresh, "f", b"ab\r\ncd\r" * 600)
    d = io.read_corpus(spark, tmpdir_fresh, fmt="lines")
    whole = ("ab\ncd\n" * 600)
    off = ds.prefix_offsets(d.withColumn("n", F.length("text")), "doc_id", "n").collect()
    assert "".join(r.text for r in sorted(off, key=lambda r: r.start_pos)) == whole
    with pytest.raises(ValueError):
        io.read_corpus(spark, tmpdir_fresh, fmt="nope")
