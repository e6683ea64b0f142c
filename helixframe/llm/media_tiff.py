"""TIFF media columns: walk image directories, decode strips and tiles, one row per page.

``tiff_pages`` reads a binary column. Supported: both byte orders; 8-bit samples of any number per
pixel; strips and tiles; no compression, PackBits, LZW and deflate; horizontal predictor. Null content
gives no rows; a file that cannot be read gives one row with ``error`` set and null pixels; a file that
holds no page gives none. Extra columns are dropped, all names are given by the caller.

``store_payloads`` is the inverse for texts: whole UTF-8 bytes, padded, as pages of a TIFF file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the TIFF 6.0 format.
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
TYPE_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
LZW_CLEAR, LZW_END = 256, 257

#: Samples of a page or block at most, which is what a binary value can hold.
MOST_PIXELS = (1 << 31) - 64
#: Bytes that one byte of a block can stand for, at most; a header that claims more is refused before anything is allocated.
EXPANSION = {NONE: 1, PACKBITS: 64, LZW: 3072, DEFLATE: 1032, OLD_DEFLATE: 1032}

#: Pages of stored payloads: 64 samples a row, 1024 rows at most, strips of 128 rows.
WIDTH, PAGE_ROWS, STRIP_ROWS = 64, 1024, 128
#: The codings that pages take in turn, see encode_page; LZW costs most and comes once in eight.
TURNS = (0, 1, 2, 3, 2, 3, 1, 3)


# --- codecs -----------------------------------------------------------------------------------


def packbits_decode(data: bytes, most: int = 1 << 62) -> bytes:
    out, i, n, made = [], 0, len(data), 0
    while i < n and made < most:
        c = data[i]
        if c < 128:
            out.append(data[i + 1 : i + 2 + c])
            made += c + 1
            i += c + 2
        elif c > 128:
            out.append(data[i + 1 : i + 2] * (257 - c))
            made += 257 - c
            i += 2
        else:
            i += 1
    return b"".join(out)


def packbits_encode(data: bytes) -> bytes:
    """Runs of three and more as repeats, the rest as literals."""
    a = np.frombuffer(data, np.uint8)
    begin = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    length = np.diff(np.append(begin, len(a)))
    out, at = [], 0

    def literal(to: int) -> None:
        for i in range(at, to, 128):
            piece = data[i : min(i + 128, to)]
            out.append(bytes((len(piece) - 1,)) + piece)

    for s, m in zip(begin[length >= 3].tolist(), length[length >= 3].tolist()):
        literal(s)
        for i in range(0, m, 128):
            k = min(128, m - i)
            out.append(bytes((257 - k if k > 1 else 0, data[s])))
        at = s + m
    literal(len(data))
    return b"".join(out)


def _lzw_widths(n: int) -> np.ndarray:
    """Bits of the n codes that follow a clear code, one code early as TIFF has it."""
    size = 258 + np.arange(n)
    return np.where(size >= 2048, 12, np.where(size >= 1024, 11, np.where(size >= 512, 10, 9)))


_LZW_WIDTHS = _lzw_widths(4096)
_LZW_ENDS = np.cumsum(_LZW_WIDTHS)


def lzw_encode(data: bytes) -> bytes:
    fresh = {bytes((i,)): i for i in range(256)}
    codes, widths = [LZW_CLEAR], [np.array([9])]
    table, segment, n = dict(fresh), 0, 258
    at, size = 0, len(data)
    while at < size:
        end = at + 1
        code = data[at]
        while end < size:
            c = table.get(data[at : end + 1])
            if c is None:
                break
            code = c
            end += 1
        codes.append(code)
        segment += 1
        if end < size:
            table[data[at : end + 1]] = n
            n += 1
            if n == 4094:
                codes.append(LZW_CLEAR)
                widths.append(_LZW_WIDTHS[: segment + 1])
                table, segment, n = dict(fresh), 0, 258
        at = end
    codes.append(LZW_END)
    widths.append(_LZW_WIDTHS[: segment + 1])
    w = np.concatenate(widths)
    c = np.array(codes, np.int64)
    shift = w[:, None] - 1 - np.arange(12)
    bits = ((c[:, None] >> np.maximum(shift, 0)) & 1).astype(np.uint8)
    return np.packbits(bits[shift >= 0]).tobytes()


def lzw_decode(data: bytes, most: int = 1 << 62) -> bytes:
    """Between clear codes the place of every code is known beforehand, so codes are cut out at once."""
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.int64)
    total = len(data) * 8
    out, bit, made = [], 0, 0
    singles = [bytes((i,)) for i in range(256)] + [b"", b""]
    while bit + 9 <= total:
        ends = bit + _LZW_ENDS
        k = int(np.searchsorted(ends, total, "right"))
        begin = ends[:k] - _LZW_WIDTHS[:k]
        at = begin >> 3
        word = (raw[at] << 16) | (raw[at + 1] << 8) | raw[at + 2]
        codes = (word >> (24 - (begin & 7) - _LZW_WIDTHS[:k])) & ((1 << _LZW_WIDTHS[:k]) - 1)
        stop = np.flatnonzero((codes == LZW_CLEAR) | (codes == LZW_END))
        m = int(stop[0]) if len(stop) else k
        table, before = list(singles), None
        for code in codes[:m].tolist():
            if code < len(table):
                now = table[code]
                if before is not None:
                    table.append(before + now[:1])
            else:
                if before is None or code > len(table):
                    raise ValueError("LZW code out of range")
                now = before + before[:1]
                table.append(now)
            out.append(now)
            made += len(now)
            if made >= most:
                return b"".join(out)
            before = now
        if m == k or codes[m] == LZW_END:
            break
        bit = int(ends[m])
    return b"".join(out)


def _decompress(kind: int, data: bytes, most: int) -> bytes:
    """The first `most` bytes that a block holds; what a block claims beyond them is never made."""
    if kind == NONE:
        return data
    if kind == PACKBITS:
        return packbits_decode(data, most)
    if kind == LZW:
        return lzw_decode(data, most)
    if kind in (DEFLATE, OLD_DEFLATE):
        return zlib.decompressobj().decompress(data, most)
    raise ValueError(f"compression {kind} is not supported")


# --- reader -----------------------------------------------------------------------------------


def iter_pages(content: bytes) -> Iterator[dict]:
    """The pages of one file in the order of its image directories."""
    order = {b"II": "<", b"MM": ">"}.get(content[:2])
    if order is None or len(content) < 8 or struct.unpack_from(order + "H", content, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen, page = struct.unpack_from(order + "I", content, 4)[0], set(), 0
    while at:
        if at in seen or at + 2 > len(content):
            raise ValueError("broken chain of image directories")
        seen.add(at)
        tags = {}
        n = struct.unpack_from(order + "H", content, at)[0]
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", content, at + 2 + 12 * i)
            size = TYPE_SIZES.get(kind, 1) * count
            place = at + 10 + 12 * i
            if size > 4:
                place = struct.unpack_from(order + "I", content, place)[0]
            if kind in (1, 3, 4):
                tags[tag] = struct.unpack_from(f"{order}{count}{'_B_HI'[kind]}", content, place)
        at = struct.unpack_from(order + "I", content, at + 2 + 12 * n)[0]
        one = lambda tag, default: tags.get(tag, (default,))[0]
        width, height, spp = one(256, 0), one(257, 0), one(277, 1)
        if any(b != 8 for b in tags.get(258, (8,))):
            raise ValueError("only 8-bit samples are supported")
        if spp > 1 and one(284, 1) != 1:
            raise ValueError("planar samples are not supported")
        compression, predictor = one(259, 1), one(317, 1)
        if predictor not in (1, 2):
            raise ValueError(f"predictor {predictor} is not supported")
        if width * height * spp > MOST_PIXELS:
            raise ValueError(f"a page of {width} x {height} x {spp} samples is too large")
        tiled = 324 in tags
        if tiled:
            bw, bh = one(322, width), one(323, height)
            offsets, counts = tags[324], tags[325]
        else:
            bw, bh = width, min(one(278, height) or height, height)
            offsets, counts = tags.get(273, ()), tags.get(279, ())
        if bw * bh * spp > MOST_PIXELS:
            raise ValueError(f"a block of {bw} x {bh} x {spp} samples is too large")
        across = -(-width // bw) if bw else 0
        needed = across * (-(-height // bh) if bh else 0)
        if not counts and compression == NONE and not tiled and len(offsets) == needed:
            # files without compression may leave them out
            counts = [min(bh, height - k * bh) * bw * spp for k in range(needed)]
        if len(offsets) < needed or len(counts) < needed:
            raise ValueError(f"{min(len(offsets), len(counts))} of {needed} blocks are there")
        offsets, counts = offsets[:needed], counts[:needed]
        stored = sum(max(0, min(c, len(content) - o)) for o, c in zip(offsets, counts))
        if width * height * spp > stored * EXPANSION.get(compression, 1):
            raise ValueError(f"{stored} stored bytes can't hold a page of {width} x {height} x {spp} samples")
        pixels = np.zeros((height, width, spp), np.uint8)
        for k, (o, c) in enumerate(zip(offsets, counts)):
            y, x = k // across * bh, k % across * bw
            rows = bh if tiled else min(bh, height - y)
            block = np.frombuffer(_decompress(compression, content[o : o + c], rows * bw * spp), np.uint8)
            if len(block) < rows * bw * spp:
                raise ValueError(f"block {k} holds {len(block)} of {rows * bw * spp} samples")
            block = block[: rows * bw * spp].reshape(rows, bw, spp)
            if predictor == 2:
                block = np.cumsum(block, axis=1, dtype=np.uint8)
            pixels[y : y + rows, x : x + bw] = block[: height - y, : width - x]
        yield {"page": page, "width": width, "height": height, "samples": spp, "compression": compression, "predictor": predictor, "tiled": tiled, "pixels": pixels.tobytes()}
        page += 1


#: What a file that can't be read raises.
UNREADABLE = (ValueError, struct.error, zlib.error, IndexError, ZeroDivisionError, MemoryError, OverflowError)


def page_rows(content: bytes) -> Iterator[dict]:
    """A row per page; at the first that can't be read, one with its error, and no more."""
    try:
        for p in iter_pages(content):
            yield {**p, "error": None}
    except UNREADABLE as e:
        yield {**dict.fromkeys(x.split()[0] for x in PAGE_FIELDS.split(", ")), "error": str(e)[:200] or type(e).__name__}


PAGE_FIELDS = "page int, width int, height int, samples int, compression int, predictor int, tiled boolean, pixels binary, error string"


def tiff_pages(df: DataFrame, key: str = "doc_id", content: str = "media") -> DataFrame:
    """One row per page of each file in `content`: key, page, shape, coding, pixels (row-major), error."""
    kind = df.schema[key].dataType.simpleString()

    def walk(batches):
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not data.is_valid:
                    continue
                for row in page_rows(data.as_py()):
                    yield pa.RecordBatch.from_pylist([{"key": k, **row}], schema=out)

    source = df.select(F.col(key).alias("key"), F.col(content).cast("binary").alias("content"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string as parse

    out = to_arrow_schema(parse(f"key {kind}, {PAGE_FIELDS}"))
    return source.mapInArrow(walk, f"key {kind}, {PAGE_FIELDS}").withColumnRenamed("key", key)


# --- writer -----------------------------------------------------------------------------------


def encode_page(pixels: np.ndarray, mode: int) -> tuple[list[bytes], dict[int, tuple[int, int]]]:
    """Blocks and tags of one page; mode 0: LZW strips, 1: PackBits strips, 2: deflate strips, 3: deflate tiles; all but 1 with predictor."""
    height, width = pixels.shape
    tags = {254: (4, 2), 256: (4, width), 257: (4, height), 258: (3, 8), 262: (3, 1), 277: (3, 1), 284: (3, 1)}
    if mode == 3:
        padded = np.zeros((-(-height // 64) * 64, width), np.uint8)
        padded[:height] = pixels
        parts = [padded[i : i + 64] for i in range(0, len(padded), 64)]
        tags |= {322: (4, width), 323: (4, 64)}
    else:
        parts = [pixels[i : i + STRIP_ROWS] for i in range(0, height, STRIP_ROWS)]
        tags |= {278: (4, STRIP_ROWS)}
    code = (LZW, PACKBITS, DEFLATE, DEFLATE)[mode]
    tags |= {259: (3, code)}
    if mode != 1:
        tags |= {317: (3, 2)}
        parts = [np.concatenate((p[:, :1], np.diff(p, axis=1)), axis=1) for p in parts]
    encode = {LZW: lzw_encode, PACKBITS: packbits_encode, DEFLATE: lambda b: zlib.compress(b, 1)}[code]
    return [encode(p.tobytes()) for p in parts], tags


def encode_tiff(payload: bytes) -> bytes:
    """A little-endian file of `payload`, whose length is a multiple of the width; pages take turns in their coding."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    out, patches, pointer, at = [struct.pack("<2sHI", b"II", 42, 0)], [], 4, 8
    turn = zlib.crc32(payload)
    for page, y in enumerate(range(0, len(rows), PAGE_ROWS)):
        mode = TURNS[(turn + page) % len(TURNS)]
        blocks, tags = encode_page(rows[y : y + PAGE_ROWS], mode)
        places = []
        for b in blocks:
            places.append(at)
            b += b"\0" * (len(b) % 2)
            out.append(b)
            at += len(b)
        sizes = [len(b) for b in blocks]
        for tag, values in ((324 if mode == 3 else 273, places), (325 if mode == 3 else 279, sizes)):
            if len(values) == 1:
                tags[tag] = (4, values[0])
            else:
                tags[tag] = (-len(values), at)
                out.append(struct.pack(f"<{len(values)}I", *values))
                at += 4 * len(values)
        patches.append((pointer, at))
        pointer = at + 2 + 12 * len(tags)
        entries = b"".join(struct.pack("<HHII", t, 4 if k < 0 else k, -k if k < 0 else 1, v) for t, (k, v) in sorted(tags.items()))
        ifd = struct.pack("<H", len(tags)) + entries + b"\0\0\0\0"
        out.append(ifd)
        at += len(ifd)
    data = bytearray(b"".join(out))
    for place, target in patches:
        struct.pack_into("<I", data, place, target)
    return bytes(data)


def payload_of(text: bytes) -> bytes:
    return text + b"\0" * (-len(text) % 64 or (0 if text else 64))


def digest(doc_id: int, n_bytes: int, media: bytes) -> dict:
    """What the stored form holds, read back page by page."""
    pages = list(page_rows(media))
    if pages[-1]["error"]:
        raise ValueError(pages[-1]["error"])
    payload = b"".join(p["pixels"] for p in pages)
    count = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    mean = int((count * np.arange(256)).sum()) * 1000 // len(payload)
    return {
        "doc_id": doc_id, "n_bytes": n_bytes, "payload_bytes": len(payload), "payload_sha256": sha256(payload).hexdigest(),
        "tail_crc32": zlib.crc32(payload[-64:]), "media_bytes": len(media), "media_sha256": sha256(media).hexdigest(),
        "feature": f"pages={len(pages)};rows={sum(p['height'] for p in pages)};mean={mean};distinct={int((count > 0).sum())};top={int(count.argmax())};coding={'+'.join(str(p['compression']) + ('t' if p['tiled'] else 's') for p in pages)}",
    }


STORED = "doc_id long, n_bytes long, media binary"
DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _store(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for lo in range(0, len(batch), 256):
            t = [x or b"" for x in texts[lo : lo + 256].to_pylist()]
            yield pa.record_batch([ids[lo : lo + 256], pa.array([len(x) for x in t], pa.int64()), pa.array([encode_tiff(payload_of(x)) for x in t], pa.binary())], schema=schema)


def _digest(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
    for batch in batches:
        rows = [digest(d, n, m) for d, n, m in zip(*(batch.column(i).to_pylist() for i in range(3)))]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def store_payloads(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the TIFF file of each whole text; a null text counts as empty."""
    return _texts(docs).mapInArrow(_store, STORED)


def payload_digests(docs: DataFrame) -> DataFrame:
    """Store every text as a TIFF file, read the files back and describe them; both in the same pass over a batch."""
    return _texts(docs).mapInArrow(lambda batches: _digest(_store(batches)), DIGEST)
