"""TIFF, packing, token files, license scans: exact round trips and brute force."""

import random
import struct
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixframe.llm import license_scan, media_tiff, packing, token_files
from llm.conftest import make_docs


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=700), st.integers(0, 3))
def test_codecs_round_trip(data, repeat):
    data = data * (1 + 9 * repeat)
    assert media_tiff.lzw_decode(media_tiff.lzw_encode(data)) == data
    assert not data or media_tiff.packbits_decode(media_tiff.packbits_encode(data)) == data


def test_lzw_clears_its_table():
    data = random.Random(1).randbytes(30_000)
    assert media_tiff.lzw_decode(media_tiff.lzw_encode(data)) == data


def test_lzw_of_the_format_description():
    """The worked example of the TIFF 6.0 text: 7 7 7 8 8 7 7 6 6."""
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    packed = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert media_tiff.lzw_encode(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])) == packed
    assert media_tiff.lzw_decode(packed) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])


def big_endian_rgb():
    """Two by two pixels, big-endian, uncompressed, predictor 2."""
    pixels = bytes([1, 2, 3, 9, 9, 9, 0, 0, 0, 5, 5, 5])
    tags = [(256, 3, 2 << 16), (257, 3, 2 << 16), (259, 3, 1 << 16), (273, 4, 8), (277, 3, 3 << 16), (278, 3, 2 << 16), (279, 4, 12), (317, 3, 2 << 16)]
    ifd = struct.pack(">H", len(tags)) + b"".join(struct.pack(">HHII", t, k, 1, v) for t, k, v in tags) + b"\0\0\0\0"
    return b"MM" + struct.pack(">HI", 42, 20) + pixels + ifd


def test_pages(spark):
    big = media_tiff.encode_tiff(media_tiff.payload_of(random.Random(2).randbytes(150_000)))
    rows = [(1, big), (2, big_endian_rgb()), (3, b"nothing"), (4, None), (5, b"II*\0\0\0\0\0")]
    got = media_tiff.tiff_pages(spark.createDataFrame(rows, "doc_id long, media binary")).collect()
    by = {k: [r for r in got if r.doc_id == k] for k in range(1, 6)}
    assert len(by[1]) == 3 and b"".join(bytes(r.pixels) for r in sorted(by[1], key=lambda r: r.page)) == media_tiff.payload_of(random.Random(2).randbytes(150_000))
    assert bytes(by[2][0].pixels) == bytes([1, 2, 3, 10, 11, 12, 0, 0, 0, 5, 5, 5]) and by[2][0].samples == 3
    assert by[3][0].error and not by[4] and not by[5]


def test_payload_digests(spark, odd_docs, odd_rows, no_docs):
    got = media_tiff.payload_digests(odd_docs).collect()
    want = []
    for i, t, _ in odd_rows:
        b = (t or "").encode()
        p = b + b"\0" * (-len(b) % 64 or (0 if b else 64))
        want.append((i, len(b), len(p), sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    assert media_tiff.payload_digests(no_docs).count() == 0


def test_ids_equal_the_tokenizer():
    rng = random.Random(5)
    texts = ["", "'stop 're 'l 'll", "''s !!'t don't ½ ª", "Straße ÄÖ İ ǅ", "日本語", "<|endoftext|> x", "– “q” …€5×÷", "x\x1cy\x85z"]
    texts += ["".join(rng.choices("ab s'tremvldSTÉéß×÷’“ \n\t019_!<|¡¿ªµœ", k=rng.randint(0, 50))) for _ in range(500)]
    bpe = packing.WordBpe(packing.tokenizer_path())
    raw = [t.encode() for t in texts]
    ids, at = bpe.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))))
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == bpe.full.encode(t, add_special_tokens=False).ids, t


def test_packing(spark, odd_docs, odd_rows, no_docs):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.pack(odd_docs).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 4096 for r in rows)
    assert all(r.sequence_id >> 56 == r.bucket and 1 << r.bucket == r.length for r in rows)
    want = sorted((i is not None, i or 0, full.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in odd_rows)
    pieces: dict = {}
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.start)):
        pieces.setdefault((r.doc_id is not None, r.doc_id or 0), []).append(r)
    for k, ids in {(a, b): x for a, b, x in want}.items():
        copies = sum((a, b) == k for a, b, _ in want)
        own = pieces[k][::copies]
        assert np.frombuffer(b"".join(bytes(r.ids) for r in own), "<u4").tolist() == ids and all(r.doc_tokens == len(ids) for r in own)
        assert len(own) == len(packing.pieces_of(len(ids)))
    assert packing.pack(no_docs).count() == 0
    crc = packing.piece_digests(odd_docs).where("doc_id = 8").first()
    assert crc.ids_crc32 == zlib.crc32(np.array(full.encode("one two three").ids + [2], "<u4").tobytes()[: 4 * crc.length])


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_token_counts_stitch_blocks(spark, odd_docs, odd_rows, no_docs, block):
    docs = odd_docs.where("doc_id is null or doc_id <> 90") if block < 64 else odd_docs
    blocks, manifest = token_files.write_stream(docs, block)
    got = token_files.token_counts(blocks).join(manifest, ["file", "ordinal"]).collect()
    want = [(i, len((t or "").encode().split())) for i, t, _ in odd_rows if block == 64 or i != 90]
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    assert token_files.document_token_counts(no_docs).count() == 0


def test_token_files_without_index(spark, tmp_path):
    ids = [5, 6, 0, 0, 7] + [9] * 700 + [0, 4, 4]
    (tmp_path / "a.bin").write_bytes(np.array(ids, "<u2").tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    got = token_files.token_counts(token_files.read_token_files(spark, str(tmp_path), 4)).orderBy("ordinal").collect()
    assert [(r.ordinal, r.n_tokens, r.closed) for r in got] == [(0, 2, True), (1, 0, True), (2, 701, True), (3, 2, False)]


def test_token_files_of_wide_ids(spark, tmp_path):
    ids = [5, 70_000, 0, 65_536, 1 << 31, 9, 0, 4]
    (tmp_path / "a b.bin").write_bytes(np.array(ids, "<u4").tobytes())
    for block in (1, 3, 64):
        got = token_files.token_counts(token_files.read_token_files(spark, str(tmp_path), block, 4), id_bytes=4).orderBy("ordinal").collect()
        assert [(r.ordinal, r.n_tokens, r.closed) for r in got] == [(0, 2, True), (1, 3, True), (2, 1, False)]
    (tmp_path / "a b.bin").write_bytes(b"12345")
    with pytest.raises(Exception, match="multiple of element size"):
        token_files.token_counts(token_files.read_token_files(spark, str(tmp_path), 3, 4), id_bytes=4).collect()


def test_token_files_of_over_2_gib(spark, tmp_path):
    size = 2**31 + 2**20
    with open(tmp_path / "large.bin", "wb") as f:  # all separators but the last id, and mostly a hole
        f.truncate(size - 2)
        f.seek(size - 2)
        f.write(b"\7\0")
    blocks = token_files.read_token_files(spark, str(tmp_path))
    assert blocks.rdd.getNumPartitions() > 100
    last = blocks.where("block >= 4095").selectExpr("block", "octet_length(data) AS n", "hex(right(data, 2)) AS end").orderBy("block").collect()
    assert [tuple(r) for r in last][-1] == (size // 2**19 - 1, 2**19, "0700") and len(last) == size // 2**19 - 4095


def test_token_counts_scan_flat_files(spark, odd_docs, odd_rows, tmp_path):
    manifest = token_files.write_files(odd_docs, f"file://{tmp_path}/out")
    files = sorted((tmp_path / "out").glob("*.bin"))
    assert {r.name for r in manifest.select("name").distinct().collect()} == {f.name for f in files}
    assert sum(f.stat().st_size for f in files) == 2 * sum(len((t or "").encode().split()) + 1 for _, t, _ in odd_rows)
    got = token_files.document_token_counts(odd_docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, len((t or "").encode().split())) for i, t, _ in odd_rows), key=repr)


def test_license_scan(spark, no_docs):
    texts = {
        1: "Released under the MIT License. Apache License, Version 2.0; under-the mit licensé",
        2: "CC BY-NC 4.0 and cc by nc cc by nc",
        3: None,
        4: "under the mit licenseX under the mıt license",
        5: "Permission is hereby granted, free of charge, ... WITHOUT WARRANTY OF ANY KIND",
        6: "Permission is hereby granted, free of charge",
        7: "",
        8: "The Kernel",
    }
    docs = make_docs(spark, [(k, v, "a") for k, v in texts.items()] + [(2, texts[2], "a")])
    rows = {r.doc_id: r for r in license_scan.labels(license_scan.scan(docs)).collect()}
    assert (rows[1].n_base, rows[1].first_word, rows[1].last_word, rows[1].base_labels) == (2, 1, 5, "apache-2,mit")
    assert (rows[2].n_base, rows[2].labels, rows[2].n_words) == (3, "cc-by-nc", 12)
    assert (rows[3].n_words, rows[3].n_base, rows[3].first_word, rows[3].labels, rows[3].score) == (0, 0, None, "", 0.0)
    assert rows[4].n_base == 0 and rows[5].labels == "mit" and rows[5].base_labels == "" and rows[6].labels == ""
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert license_scan.labels(license_scan.scan(docs)).count() == len(texts) + 1
    assert license_scan.labels(license_scan.scan(no_docs)).count() == 0
    plan = license_scan.labels(license_scan.scan(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_queries_match_sql(spark, duck):
    from conftest import SMALL, same_rows
    from helixframe.llm.registry import ORACLES, QUERIES

    for name, sql in ORACLES.items():
        same_rows(QUERIES[name](spark, SMALL).toPandas(), duck.sql(sql).df())
    assert {f"op{n}_" for n in range(1, 14)} == {n[: n.index("_") + 1] for n in QUERIES}


def tiff(width, height, entries, blocks=b""):
    """A little-endian file of one page with these tags (tag, type, value); blocks begin at byte 8."""
    tags = sorted({256: (4, width), 257: (4, height), 258: (3, 8), **entries}.items())
    ifd = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, k, 1, v) for t, (k, v) in tags) + b"\0\0\0\0"
    return struct.pack("<2sHI", b"II", 42, 8 + len(blocks)) + blocks + ifd


def test_hostile_tiff():
    """Headers that claim too much, missing or short blocks, and bombs are errors, and cost no memory."""
    bomb = zlib.compress(bytes(50_000_000), 9)
    cases = [
        tiff(10**6, 10**6, {273: (4, 8), 279: (4, 4)}),
        tiff(4, 4, {}),
        tiff(4, 4, {273: (4, 8), 279: (4, 3)}, b"abc"),
        tiff(4, 4, {322: (4, 10**6), 323: (4, 10**6), 324: (4, 8), 325: (4, 3)}, b"abc"),
        b"II*\0", b"", tiff(4, 4, {273: (4, 8), 279: (4, 3), 259: (3, 8)}, b"abc"),
    ]
    for content in cases:
        rows = list(media_tiff.page_rows(content))
        assert len(rows) == 1 and rows[0]["error"] and rows[0]["pixels"] is None
    (row,) = media_tiff.page_rows(tiff(4, 4, {273: (4, 8), 279: (4, len(bomb)), 259: (3, 8)}, bomb))
    assert row["error"] is None and row["pixels"] == bytes(16)
    (row,) = media_tiff.page_rows(tiff(4, 4, {273: (4, 8)}, bytes(range(16))))
    assert row["pixels"] == bytes(range(16))  # without counts


@pytest.mark.parametrize("mode", range(4))
def test_each_coding_of_a_page(mode):
    pixels = np.frombuffer(random.Random(mode).randbytes(64 * 300), np.uint8).reshape(-1, 64) // 16
    blocks, tags = media_tiff.encode_page(pixels, mode)
    assert tags[259][1] == (5, 32773, 8, 8)[mode] and (317 in tags) == (mode != 1)
    turn = next(b for b in range(1000) if media_tiff.TURNS[zlib.crc32(pixels.tobytes()[:-64] + bytes([b % 256] * 64)) % 8] == mode)
    payload = pixels.tobytes()[:-64] + bytes([turn % 256] * 64)
    pages = list(media_tiff.page_rows(media_tiff.encode_tiff(payload)))
    assert [p["compression"] for p in pages] == [(5, 32773, 8, 8)[mode]] and pages[0]["pixels"] == payload


def test_batches_of_equal_length(spark, odd_docs, no_docs):
    pieces = packing.pack(odd_docs).cache()
    batches = packing.length_batches(pieces, 64).collect()
    assert all(len(b.ids) == 4 * b.n * b.length and len(b.doc_ids) == b.n and b.length == 1 << b.bucket for b in batches)
    assert sum(b.n for b in batches) == pieces.count() and sum(b.n * b.length for b in batches) == sum(r.length for r in pieces.collect())
    assert all(b.n * b.length < 64 + b.length for b in batches) and packing.length_batches(packing.pack(no_docs)).count() == 0
