"""Binary CIF: every encoding, and a file through to structure text."""

import struct

import numpy as np

from helixframe.operators import mmcif
from helixframe.sources import bcif


def pack(v) -> bytes:
    """A small MessagePack writer for the tests."""
    if v is None:
        return b"\xc0"
    if isinstance(v, bool):
        return b"\xc3" if v else b"\xc2"
    if isinstance(v, int):
        return bytes([v]) if 0 <= v < 128 else b"\xd3" + struct.pack(">q", v)
    if isinstance(v, float):
        return b"\xcb" + struct.pack(">d", v)
    if isinstance(v, str):
        return b"\xdb" + struct.pack(">I", len(v.encode())) + v.encode()
    if isinstance(v, bytes):
        return b"\xc6" + struct.pack(">I", len(v)) + v
    if isinstance(v, list):
        return b"\xdd" + struct.pack(">I", len(v)) + b"".join(map(pack, v))
    return b"\xdf" + struct.pack(">I", len(v)) + b"".join(pack(k) + pack(x) for k, x in v.items())


def raw(values, kind):
    return np.array(values, bcif.TYPES[kind]).tobytes(), {"kind": "ByteArray", "type": kind}


def strings(values):
    distinct = sorted(set(values))
    offsets, byte = raw(np.cumsum([0] + [len(x) for x in distinct]), 3)
    data, byte2 = raw([distinct.index(v) for v in values], 3)
    return {"data": data, "encoding": [{"kind": "StringArray", "stringData": "".join(distinct), "offsets": offsets, "offsetEncoding": [byte], "dataEncoding": [byte2]}]}


def test_encodings():
    data, byte = raw([1, 3, 2, 2], 3)
    assert bcif.decode(data, [{"kind": "RunLength"}, byte]).tolist() == [1, 1, 1, 2, 2]
    data, byte = raw([0, 3, 2, 1], 3)
    assert bcif.decode(data, [{"kind": "Delta", "origin": 1000}, byte]).tolist() == [1000, 1003, 1005, 1006]
    data, byte = raw([1, 2, -3, 127, 1, -128, -128, -5], 1)
    assert bcif.decode(data, [{"kind": "IntegerPacking", "byteCount": 1, "isUnsigned": False, "srcSize": 5}, byte]).tolist() == [1, 2, -3, 128, -261]
    data, byte = raw([120, 123], 3)
    assert bcif.decode(data, [{"kind": "FixedPoint", "factor": 100}, byte]).tolist() == [1.2, 1.23]
    data, byte = raw([0, 2, 4], 3)
    assert bcif.decode(data, [{"kind": "IntervalQuantization", "min": 1.0, "max": 2.0, "numSteps": 5}, byte]).tolist() == [1.0, 1.5, 2.0]


def test_file_to_structure(spark, tmp_path):
    number = lambda v, k=33: dict(zip(("data", "encoding"), (raw(v, k)[0], [raw(v, k)[1]])))
    columns = {
        "group_PDB": strings(["ATOM"] * 3), "id": number([1, 2, 3], 3), "label_atom_id": strings(["N", "CA", "CA"]), "label_comp_id": strings(["ALA", "ALA", "MSE"]), "auth_asym_id": strings(["A", "A", "B"]),
        "label_seq_id": number([1, 1, 1], 3), "pdbx_PDB_ins_code": strings(["?"] * 3), "Cartn_x": number([1.0, 2.0, 3.0]), "Cartn_y": number([1.0, 2.0, 3.0]), "Cartn_z": number([1.0, 2.0, 3.0]),
        "occupancy": number([1.0, 1.0, 0.5]), "B_iso_or_equiv": number([9.0, 9.0, 9.0]), "type_symbol": strings(["N", "C", "C"]), "pdbx_formal_charge": strings(["?"] * 3), "pdbx_PDB_model_num": number([1, 1, 1], 3),
    }
    doc = {"version": "0.3.0", "dataBlocks": [{"header": "1XYZ", "categories": [{"name": "_atom_site", "rowCount": 3, "columns": [{"name": k, "data": v, "mask": None} for k, v in columns.items()]}]}]}
    (tmp_path / "1xyz.bcif").write_bytes(pack(doc))
    (tmp_path / "bad.bcif").write_bytes(b"\xc1")
    files = bcif.binary_files(spark, str(tmp_path))
    assert {r.file: r.text is None for r in files.collect()} == {"1xyz": False, "bad": True}
    got = {r.protein_id: r.pdb_text.split("\n") for r in mmcif.chains(files.where("text is not null")).collect()}
    assert set(got) == {"1xyz_A", "1xyz_B"} and len(got["1xyz_A"]) == 2 and "MET" in got["1xyz_B"][0] and "3.000" in got["1xyz_B"][0]
