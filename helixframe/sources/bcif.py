"""Binary CIF files: the atom table of each, as rows; the structure text then comes from the same operators as for text files.

The format is a MessagePack document whose columns are chains of encodings. Decoding one file is one task's
work; files are spread by Spark.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mmcif import FIELDS, NEEDED

# Fixed values of the format: numbers of the array types.
TYPES = {1: "<i1", 2: "<i2", 3: "<i4", 4: "<u1", 5: "<u2", 6: "<u4", 32: "<f4", 33: "<f8"}


#: Decimals that a field has at least; more stay as they are.
PLACES = {"Cartn_x": 3, "Cartn_y": 3, "Cartn_z": 3, "occupancy": 2, "B_iso_or_equiv": 2}


def unpack(data: bytes, at: int = 0):
    """One MessagePack value and where it ends."""
    c = data[at]
    at += 1
    if c < 0x80:
        return c, at
    if c >= 0xE0:
        return c - 256, at
    sized = lambda fmt: (struct.unpack_from(">" + fmt, data, at)[0], at + struct.calcsize(fmt))
    if c in (0xC0, 0xC2, 0xC3):
        return {0xC0: None, 0xC2: False, 0xC3: True}[c], at
    if 0xCA <= c <= 0xD3:
        return sized("fdBHIQbhiq"[c - 0xCA])
    if c < 0x90 or c in (0xDE, 0xDF):
        n, at = (c & 15, at) if c < 0x90 else sized("H" if c == 0xDE else "I")
        out = {}
        for _ in range(n):
            k, at = unpack(data, at)
            out[k], at = unpack(data, at)
        return out, at
    if c < 0xA0 or c in (0xDC, 0xDD):
        n, at = (c & 15, at) if c < 0xA0 else sized("H" if c == 0xDC else "I")
        items = []
        for _ in range(n):
            v, at = unpack(data, at)
            items.append(v)
        return items, at
    if c < 0xC0 or 0xD9 <= c <= 0xDB:
        n, at = (c & 31, at) if c < 0xC0 else sized("BHI"[c - 0xD9])
        return data[at : at + n].decode(), at + n
    if 0xC4 <= c <= 0xC6:
        n, at = sized("BHI"[c - 0xC4])
        return data[at : at + n], at + n
    raise ValueError(f"unknown MessagePack byte {c:#x}")


def _integers(packed: np.ndarray, byte_count: int, unsigned: bool) -> np.ndarray:
    """Integers whose bytes at the type's limits add up with the next."""
    high = (1 << 8 * byte_count) - 1 if unsigned else (1 << 8 * byte_count - 1) - 1
    low = -1 if unsigned else -high - 1
    v = packed.astype(np.int64)
    done = (v != high) & (v != low)
    start = np.concatenate(([0], np.flatnonzero(done)[:-1] + 1)) if done.any() else np.zeros(0, int)
    return np.add.reduceat(v, start) if len(start) else v[:0]


def decode(data, encodings: list[dict]):
    for e in reversed(encodings):
        kind = e["kind"]
        if kind == "ByteArray":
            data = np.frombuffer(data, TYPES[e["type"]])
        elif kind == "FixedPoint":
            data = data / e["factor"]
        elif kind == "IntervalQuantization":
            data = e["min"] + data * (e["max"] - e["min"]) / (e["numSteps"] - 1)
        elif kind == "RunLength":
            data = np.repeat(data[::2], data[1::2])
        elif kind == "Delta":
            data = np.cumsum(data.astype(np.int64)) + e["origin"]
        elif kind == "IntegerPacking":
            data = _integers(data, e["byteCount"], e["isUnsigned"])
        elif kind == "StringArray":
            cuts = decode(e["offsets"], e["offsetEncoding"])
            words = [e["stringData"][a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            data = np.array([words[i] if i >= 0 else None for i in decode(data, e["dataEncoding"])], object)
        else:
            raise ValueError(f"unknown encoding {kind}")
    return data


def skip(data: bytes, at: int) -> int:
    """Where a MessagePack value ends, without making it."""
    left = 1  # values still to pass
    while left:
        c = data[at]
        at += 1
        left -= 1
        if c < 0x80 or c >= 0xE0 or c in (0xC0, 0xC2, 0xC3):
            continue
        if 0xCA <= c <= 0xD3:
            at += (4, 8, 1, 2, 4, 8, 1, 2, 4, 8)[c - 0xCA]
        elif c < 0x90:
            left += 2 * (c & 15)
        elif c < 0xA0:
            left += c & 15
        elif c < 0xC0:
            at += c & 31
        elif 0xC4 <= c <= 0xC6 or 0xD9 <= c <= 0xDB:
            width = 1 << (c - 0xC4 if c < 0xD9 else c - 0xD9)
            at += width + int.from_bytes(data[at : at + width], "big")
        elif 0xDC <= c <= 0xDF:
            width = 4 if c & 1 else 2
            left += int.from_bytes(data[at : at + width], "big") * (2 if c >= 0xDE else 1)
            at += width
        else:
            raise ValueError(f"unknown MessagePack byte {c:#x}")
        if at > len(data):
            raise ValueError("the document ends within a value")
    return at


def _count(data: bytes, at: int, short: int, long: int) -> tuple[int, int]:
    """Entries of a map or array at a place, and where they begin."""
    c = data[at]
    if c & 0xF0 == short:
        return c & 15, at + 1
    if c not in (long, long + 1):
        raise ValueError(f"another kind of value than expected: {c:#x}")
    width = 2 if c == long else 4
    return int.from_bytes(data[at + 1 : at + 1 + width], "big"), at + 1 + width


def places(data: bytes, at: int) -> dict[str, int]:
    """Where the value of each key of a map begins."""
    n, at = _count(data, at, 0x80, 0xDE)
    out = {}
    for _ in range(n):
        key, at = unpack(data, at)
        out[key] = at
        at = skip(data, at)
    return out


def elements(data: bytes, at: int):
    """Where each element of an array begins."""
    n, at = _count(data, at, 0x90, 0xDC)
    for _ in range(n):
        yield at
        at = skip(data, at)


def atom_columns(data: bytes) -> dict[str, dict] | None:
    """The fields of the first `_atom_site` category; all other categories and columns are leapt over. None if there is no such category."""
    value = lambda at: unpack(data, at)[0]
    for block in elements(data, places(data, 0)["dataBlocks"]):
        for category in elements(data, places(data, block)["categories"]):
            parts = places(data, category)
            if value(parts["name"]) == "_atom_site":
                columns = (places(data, c) for c in elements(data, parts["columns"]))
                return {name: {k: value(c[k]) for k in ("data", "mask") if k in c} for c in columns if (name := value(c["name"])) in FIELDS}
    return None


def atom_table(content: bytes) -> pd.DataFrame:
    """The fields of the atoms of the first data block that has any, as text; what is masked is missing."""
    found = atom_columns(content)
    if found is None:
        return pd.DataFrame({f: [] for f in FIELDS}, dtype=object)
    cols = {}
    for name, c in found.items():
        v = decode(c["data"]["data"], c["data"]["encoding"])
        text = [np.format_float_positional(x, min_digits=PLACES.get(name, 0), trim="k") if isinstance(x, (float, np.floating)) else str(x) for x in v]
        if c.get("mask"):
            text = [None if m else x for x, m in zip(text, decode(c["mask"]["data"], c["mask"]["encoding"]))]
        cols[name] = text
    return pd.DataFrame({f: cols.get(f) for f in FIELDS})


def to_cif(files: DataFrame) -> DataFrame:
    """(file, text) with the atoms of (file, content) as an mmCIF loop; a file that can't be decoded has a null text.

    Atoms whose needed fields are missing are left out, as mmcif.chains(strict=True) does with what it can see in the text.
    """

    def run(frames):
        for pdf in frames:
            out = []
            for name, content in zip(pdf["file"], pdf["content"]):
                try:
                    rows = atom_table(content).dropna(subset=list(NEEDED)).fillna("?").astype(str).agg(" ".join, axis=1)
                    out.append((name, "loop_\n" + "\n".join(f"_atom_site.{f}" for f in FIELDS) + "\n" + "\n".join(rows) + "\n"))
                except (ValueError, KeyError, IndexError, TypeError, struct.error):
                    out.append((name, None))
            yield pd.DataFrame(out, columns=["file", "text"])

    return files.select("file", "content").mapInPandas(run, "file string, text string")


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of the .bcif files in a folder."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.bcif").option("recursiveFileLookup", "true").load(path)
    return to_cif(found.select(F.regexp_extract("path", r"([^/]+)\.bcif$", 1).alias("file"), "content"))
