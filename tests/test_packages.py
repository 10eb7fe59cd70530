"""Zip files in memory, batches of bounded size, and parsing done once."""

import io
import random
import zipfile

import pyarrow as pa

from doctables.operators import corpus as K
from doctables.plans import packages as G
from doctables.plans.convert import _workbook_cells
from doctables.sources import packages as S
from doctables.sources.split import SMALL_PART, Parts

NAMES = {"a/b.xml": "<x>å</x>" * 30, "ü.bin": b"\0" * 10, "empty": b""}


def written(method):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in NAMES.items():
            z.writestr(name, data)
    return out.getvalue()


def outcome(opened, data):
    try:
        with opened(data) as z:
            return [(n, z.read(n), z.open(n).read()) for n in z.namelist()]
    except Exception as e:
        return f"{type(e).__name__}: {e}"


def test_zip_bytes_is_a_zip_file():
    with zipfile.ZipFile(io.BytesIO(G.zip_bytes(NAMES))) as z:
        assert z.testzip() is None
        assert {n: z.read(n) for n in z.namelist()} == {n: d.encode() if isinstance(d, str) else d for n, d in NAMES.items()}


def test_parts_are_read_as_zipfile_reads_them():
    chance = random.Random(7)
    good = [written(zipfile.ZIP_STORED), written(zipfile.ZIP_DEFLATED), G.zip_bytes(NAMES)]
    for data in good:
        assert Parts(data).entries is not None
    for _ in range(3000):
        data = bytearray(chance.choice(good))
        for _ in range(chance.choice([0, 1, 2])):
            data[chance.randrange(len(data))] = chance.randrange(256)
        data = bytes(data[: chance.randrange(len(data)) if chance.random() < 0.2 else len(data)])
        assert outcome(Parts, data) == outcome(lambda d: zipfile.ZipFile(io.BytesIO(d)), data)


def test_large_parts_are_streamed():
    with Parts(G.zip_bytes({"big": b"x" * (SMALL_PART + 1)})) as package:
        assert isinstance(package.open("big"), zipfile.ZipExtFile)
        assert len(package.read("big")) == SMALL_PART + 1


def test_packages_come_in_frames_of_bounded_size():
    rows = [(f"p{i}", "docx", 1 << 20, b"") for i in range(20)]
    frames = list(G._frames(iter(rows)))
    assert sum(len(f) for f in frames) == 20
    assert all(f.length.sum() <= G.FRAME_BYTES + (1 << 20) for f in frames)


def test_batches_by_bytes_keep_lists_and_maps():
    rows = [("p", "docx", f"n{i}", "x" * (1 << 20), None, None, "r", "t", v) for i, v in enumerate([None, [], [("o", "1"), ("o", None)]] * 4)]
    batches = list(S._batches(iter(rows), S._PART_ARROW, S.BATCH_ROWS, S.BATCH_BYTES))
    assert len(batches) > 1
    via = pa.Table.from_batches(batches)["via"].to_pylist()
    assert via[:3] == [None, [], [{"owner": "o", "rel_id": "1"}, {"owner": "o", "rel_id": None}]]


def test_census_by_kind_is_one_pass(spark):
    tags = spark.createDataFrame([("a", "docx", "u", "x", 2), ("a", "xlsx", "u", "x", 1), ("a", "docx", "u", "y", 4), ("b", "pdf", "u", "x", 3), ("c", "docx", "v", "x", 1)], "path string, kind string, ns string, tag string, n long")
    got = K.unhandled_census(tags, {"docx": {"u": ["y"]}, "xlsx": {}}, {"docx": "u", "xlsx": "v"}, "n")
    assert sorted(map(tuple, got.collect())) == [("a", "u#x", 1), ("a", "x", 2), ("c", "v#x", 1)]


def test_worksheets_are_parsed_once(spark):
    data = G.xlsx_bytes([("S", None, '<row r="1"><c r="A1"><v>1</v></c></row>')], [])
    part = S.unpack(spark.createDataFrame([("a.xlsx", "xlsx", len(data), data)], G.SCHEMA))
    for table in _workbook_cells(part):
        assert table.inputFiles()
