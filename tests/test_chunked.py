"""Chunked array stores: both versions of the metadata, codecs, holes, partitions and filters."""

import gzip
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.sources import chunked


def store(folder, a, chunks, version=2, codec=None, leave_out=(), separator=None):
    """Write an array as the formats describe it, by plain files."""
    folder.mkdir(parents=True, exist_ok=True)
    pack = {None: lambda b: b, "zlib": zlib.compress, "gzip": gzip.compress}[codec]
    sep = separator or ("." if version == 2 else "/")
    if version == 2:
        meta = {"zarr_format": 2, "shape": a.shape, "chunks": chunks, "dtype": a.dtype.str, "compressor": {"id": codec, "level": 1} if codec else None, "fill_value": 7, "order": "C", "filters": None, "dimension_separator": sep}
        (folder / ".zarray").write_text(json.dumps(meta))
    else:
        endian = "big" if a.dtype.byteorder == ">" else "little"
        meta = {"zarr_format": 3, "node_type": "array", "shape": a.shape, "data_type": a.dtype.name, "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": chunks}}, "fill_value": 7, "chunk_key_encoding": {"name": "default", "configuration": {"separator": sep}}, "codecs": [{"name": "bytes", "configuration": {"endian": endian}}, *([{"name": codec}] if codec else [])]}
        (folder / "zarr.json").write_text(json.dumps(meta))
    for at in np.ndindex(*(-(-n // c) for n, c in zip(a.shape, chunks, strict=True))):
        if at in leave_out:
            continue
        whole = np.zeros(chunks, a.dtype)
        part = a[tuple(slice(k * c, (k + 1) * c) for k, c in zip(at, chunks, strict=True))]
        whole[tuple(slice(0, n) for n in part.shape)] = part
        path = folder / ("c/" if version == 3 else "") / sep.join(map(str, at)) if version == 3 else folder / sep.join(map(str, at))
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(pack(whole.tobytes()))


@pytest.mark.parametrize("version", [2, 3])
@pytest.mark.parametrize("codec", [None, "zlib", "gzip"])
def test_arrays_of_both_versions(spark, tmp_path, version, codec):
    a = np.arange(11 * 7, dtype=">i4" if version == 3 else "<f4").reshape(11, 7)
    store(tmp_path / "a", a, [4, 3], version, codec, leave_out=[(1, 2)])
    a[4:8, 6:] = 7
    rows = chunked.read(spark, str(tmp_path / "a"))
    assert rows.rdd.getNumPartitions() == 3
    assert [r["values"] for r in rows.orderBy("row").collect()] == a.astype(float).tolist()


def test_other_shapes(spark, tmp_path):
    one, three = np.arange(10, dtype="u2"), np.arange(24, dtype="<i8").reshape(4, 2, 3)
    store(tmp_path / "one", one, [3])
    store(tmp_path / "three", three, [2, 2, 2], separator="/")
    store(tmp_path / "none", np.empty((0, 5)), [2, 5])
    read = lambda n: [r["values"] for r in chunked.read(spark, str(tmp_path / n)).orderBy("row").collect()]
    assert read("one") == [[float(x)] for x in range(10)] and read("three") == three.reshape(4, 6).astype(float).tolist() and read("none") == []
    meta = json.loads((tmp_path / "one/.zarray").read_text())
    (tmp_path / "one/.zarray").write_text(json.dumps(meta | {"compressor": {"id": "blosc"}}))
    with pytest.raises(Exception, match="blosc"):
        read("one")


def test_filters_read_no_other_chunks(spark, tmp_path):
    a = np.arange(40.0).reshape(20, 2)
    store(tmp_path / "a", a, [5, 2])
    (tmp_path / "a/0.0").write_bytes(b"broken"), (tmp_path / "a/3.0").write_bytes(b"broken")
    rows = chunked.read(spark, str(tmp_path / "a"))
    assert [r.row for r in chunked.read(spark, str(tmp_path / "a"), first=6, last=13).orderBy("row").collect()] == list(range(6, 14))
    assert [r["values"] for r in chunked.read(spark, str(tmp_path / "a"), first=9, last=10).orderBy("row").collect()] == a[9:11].tolist()
    with pytest.raises(Exception, match="buffer|reshape|Error"):
        rows.collect()


@pytest.mark.parametrize("entries", [1, 7, 50, 10_000])
@pytest.mark.parametrize("tall", [3, 64])
def test_sparse_rows_are_whole(spark, tmp_path, entries, tall):
    r = np.random.default_rng(3)
    lists = [sorted(r.choice(90, n, replace=False).tolist()) for n in [*r.integers(0, 9, 60), 0, 80, 0, 0, 3]]
    rows = [(k, i, [float(x) / 4 for x in i]) for k, i in enumerate(lists)]
    df = spark.createDataFrame([x for x in rows if x[1]], "row bigint, indices array<int>, values array<float>")
    folder = str(tmp_path / "csr")
    chunked.write_csr(df, folder, len(rows), tall)
    back = chunked.read(spark, folder, "csr", entries=entries)
    assert [(x.row, x.indices, x["values"]) for x in back.orderBy("row").collect()] == rows
    by_task = [[(x.row, len(x.indices)) for x in t] for t in back.rdd.glom().collect()]
    assert all(sum(n for _, n in t) <= entries or len([n for _, n in t if n]) == 1 for t in by_task)
    assert all([i for i, _ in t] == list(range(t[0][0], t[0][0] + len(t))) for t in by_task if t)
    assert back.filter("row > 10 AND row <= 61").count() == 51 and back.count() == len(rows)
    some = chunked.read(spark, folder, "csr", entries=entries, first=11, last=61).orderBy("row").collect()
    assert [(x.row, x.indices) for x in some] == [(k, i) for k, i, _ in rows[11:62]]


def test_a_written_array_is_read_back(spark, tmp_path):
    a = np.random.default_rng(1).normal(size=(37, 5))
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(a)], "row bigint, values array<double>").repartition(4)
    for level in (0, 6):
        folder = str(tmp_path / f"a{level}")
        chunked.write_array(rows, folder, a.shape, tall=8, level=level)
        back = chunked.read(spark, folder)
        assert [r["values"] for r in back.orderBy("row").collect()] == a.tolist() and back.rdd.getNumPartitions() == 5
    assert chunked.read(spark, folder).agg(F.count("*")).first()[0] == 37
