"""Structures by id: pushed filters, errors as rows, ranged archive members, and binary CIF that is only entered where asked."""

import io
import tarfile
import zipfile

import pyarrow as pa
import pytest

from helixframe.sources import bcif, fetch, readers, structure_source
from test_bcif import pack


@pytest.fixture
def pushing(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield spark
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


@pytest.fixture
def folder(tmp_path):
    for name, content in {"a.cif": b"1", "a.pdb": b"2", "b.bcif": b"3", "c.pdb": b"4", "note.txt": b"5"}.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "d.cif").mkdir()
    return str(tmp_path)


def test_folder(pushing, folder, capsys):
    structure_source.register(pushing)
    every = pushing.read.format("structures").option("partitions", 2).load(folder)
    assert sorted((r.protein_id, r.kind, bytes(r.content), r.error) for r in every.collect()) == [("a", "cif", b"1", None), ("b", "bcif", b"3", None), ("c", "pdb", b"4", None)]
    asked = every.where("protein_id IN ('a', 'c', 'd', 'x', '../a') AND kind IS NOT NULL")
    assert sorted(r.protein_id for r in asked.collect()) == ["a", "c"]
    every.where("protein_id IN ('a', 'x')").explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [In(protein_id, [a,x])]" in plan and ") Filter" not in plan
    errors = {r.protein_id: r.error for r in every.where("protein_id IN ('a', 'x', '../a')").collect()}
    assert errors["a"] is None and "FileNotFoundError" in errors["x"] and "names no folder" in errors["../a"]
    assert every.where("protein_id = 'c'").count() == 1 and every.where("protein_id = 'c' AND protein_id = 'a'").count() == 0
    assert every.where("protein_id > 'a'").count() == 2


def test_store(pushing):
    def factory():
        def get(name):
            if name == "lost":
                raise OSError("gone")
            return name.encode()

        return get

    structure_source.register(pushing, ("shelf", fetch.Store(factory, "pdb", attempts=2, delay_s=0.0)))
    rows = pushing.read.format("shelf").load().where("protein_id IN ('x', 'lost')").collect()
    assert sorted((r.protein_id, r.kind, r.content and bytes(r.content), r.error) for r in rows) == [("lost", None, None, "OSError: gone"), ("x", "pdb", b"x", None)]
    with pytest.raises(Exception, match="read by id"):
        pushing.read.format("shelf").load().collect()


class Counting(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        data = super().read(n)
        self.read_bytes += len(data)
        return data


def archive(kind, files):
    out = io.BytesIO()
    if kind == "zip":
        with zipfile.ZipFile(out, "w") as z:
            for k, (name, content) in enumerate(files.items()):
                z.writestr(zipfile.ZipInfo(name), content, zipfile.ZIP_DEFLATED if k % 2 else zipfile.ZIP_STORED)
            z.writestr("bz.cif", b"coded", zipfile.ZIP_BZIP2)
            z.mkdir("folder")
    else:
        with tarfile.open(fileobj=out, mode=kind) as t:
            for name, content in files.items():
                info = tarfile.TarInfo(name)
                info.size = len(content)
                t.addfile(info, io.BytesIO(content))
    return out.getvalue()


FILES = {f"f{k}/{k}.cif": bytes([65 + k]) * (200_000 + k) for k in range(12)} | {"x" * 150 + ".pdb": b"long name", "empty.pdb": b""}


@pytest.mark.parametrize("kind", ["zip", "w"])
def test_a_task_reads_no_more_than_its_members(monkeypatch, kind):
    data = archive(kind, FILES)
    whole = Counting(data)
    listed = readers.member_table(whole)
    assert whole.read_bytes < 100_000 and {r[0] for r in listed} >= set(FILES)
    opened = []

    def counted(path):
        opened.append(Counting(data))
        return opened[-1]

    monkeypatch.setattr(readers, "_open", counted)
    some = [r for r in listed if r[0] in ("f3/3.cif", "f8/8.cif", "empty.pdb", "x" * 150 + ".pdb")]
    batch = pa.record_batch([pa.array(["p"] * len(some)), *(pa.array(c) for c in zip(*some))], names=["path", "name", "at", "size", "packing"])
    got = {n: c for b in readers._read([batch]) for n, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist())}
    assert got == {r[0]: FILES[r[0]] for r in some}
    assert len(opened) == 1 and opened[0].read_bytes < sum(r[2] for r in some) + 1000


@pytest.mark.parametrize("kind,name", [("zip", "x.zip"), ("w", "x.tar"), ("w:gz", "x.tar.gz"), ("w:xz", "x.tar.xz")])
def test_archives_through_spark(spark, tmp_path, monkeypatch, kind, name):
    (tmp_path / name).write_bytes(archive(kind, FILES))
    want = {(n.split("/")[-1].rpartition(".")[0], bytes(c)) for n, c in FILES.items()} | ({("bz", b"coded")} if kind == "zip" else set())
    assert {(r.stem, bytes(r.content)) for r in readers.archives(spark, str(tmp_path)).collect()} == want
    chosen = readers.archives(spark, str(tmp_path), lambda stems: stems.where("stem IN ('3', 'empty')"))
    assert {(r.stem, bytes(r.content)) for r in chosen.collect()} == {("3", FILES["f3/3.cif"]), ("empty", b"")}
    assert {m for b in readers._unpacked([pa.record_batch([pa.array(["p"]), pa.array([archive(kind, FILES)])], names=["path", "content"])]) for m in zip(b.column(1).to_pylist(), b.column(2).to_pylist())} >= set(FILES.items())


def test_only_the_atoms_are_entered(monkeypatch):
    column = lambda name, values: {"name": name, "data": {"data": bytes(values), "encoding": [{"kind": "ByteArray", "type": 4}]}, "mask": None}
    other = {"name": "_other", "columns": [column("id", range(200)), {"deep": [1.5, -3, 300, None, True, "ü" * 40, {"a": [[], {}]}]}]}
    atoms = {"columns": [column("other_field", range(100)), column("id", [1, 2]), column("auth_asym_id", [7, 8])], "name": "_atom_site"}
    doc = {"version": 1, "dataBlocks": [{"categories": [other]}, {"header": "h", "categories": [other, atoms, other]}]}
    data = pack(doc)
    seen = []
    unpack = bcif.unpack
    monkeypatch.setattr(bcif, "unpack", lambda d, at=0: seen.append((at, (r := unpack(d, at))[1])) or r)
    found = bcif.atom_columns(data)
    assert set(found) == {"id", "auth_asym_id"} and found["id"]["data"]["data"] == b"\x01\x02"
    inside = [at for k in range(len(data)) if data.startswith(bytes(range(200)), k) for at in range(k, k + 200)]
    assert not any(a <= i < b for a, b in seen for i in (inside[0], inside[200], inside[-1]))
    for value in (doc, other, [1, -1, 40000, 2.5], "s", b"b", None):
        assert bcif.skip(pack(value), 0) == len(pack(value))
    assert bcif.atom_columns(pack({"dataBlocks": [{"categories": [other]}]})) is None
    with pytest.raises(ValueError):
        bcif.skip(pack(b"abc")[:-1], 0)
