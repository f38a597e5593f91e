"""Shards as a data source: ranges of records, filters, commits and packages without loss."""

import io
import json
import os
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.operators import manifest, overlays, pipelines
from spotloom.sources import shard_source, shards, tiles


def built(spark, samples=("A", "B"), n=7, size=3):
    rows = [(s, f"c{k}", k, f"{k:07d}", f"shard-{k // size:06d}.tar", f"{s}:{k}".encode() * (k + 1)) for s in samples for k in range(n)]
    cells = spark.createDataFrame(rows, "sample_id string, cell_id string, sample_index bigint, sample_key string, shard_path string, image binary")
    return cells, shards.build_shards(cells)


def files_of(folder):
    return sorted(os.path.relpath(f"{d}/{f}", folder) for d, _, names in os.walk(folder) for f in names if not f.endswith(".crc"))


SHARDS = sorted(f"{s}/shard-{k:06d}.{x}" for s in "AB" for k in range(3) for x in ("tar", "idx"))


@pytest.mark.parametrize("cells", [1, 2, 500])
def test_cells_are_read_by_ranges(spark, tmp_path, cells):
    made, rows = built(spark)
    listed = shards.write_shards(rows, str(tmp_path))
    assert files_of(tmp_path) == sorted([*SHARDS, "_SUCCESS"]) and listed.count() == 12
    read = shard_source.read_cells(spark, str(tmp_path), cells=cells)
    got = {(r.sample_id, r.shard_path, r.sample_index, bytes(r.image), json.loads(r.meta)["cell_id"]) for r in read.collect()}
    assert got == {(r.sample_id, r.shard_path, r.sample_index, bytes(r.image), r.cell_id) for r in made.collect()}
    assert read.rdd.getNumPartitions() == {1: 14, 2: 10, 500: 6}[cells]


def test_filters_open_no_other_files(spark, tmp_path):
    _, rows = built(spark)
    shards.write_shards(rows, str(tmp_path))
    for k in range(3):  # what a filter leaves out can't be read any more
        for x in ("tar", "idx"):
            (tmp_path / f"B/shard-{k:06d}.{x}").write_bytes(b"broken")
            (tmp_path / f"B/.shard-{k:06d}.{x}.crc").unlink(missing_ok=True)
    read = lambda **options: shard_source.read_cells(spark, str(tmp_path), **options)
    assert sorted(r.sample_index for r in read(samples=["A", "none"]).collect()) == list(range(7)) and read(samples=["none"]).collect() == []
    (tmp_path / "A/shard-000000.tar").write_bytes(b"broken")  # the index alone tells that it has none of these
    assert sorted(r.sample_index for r in read(samples=["A"], low=3, high=5).collect()) == [3, 4, 5]
    with pytest.raises(Exception, match="no index file"):
        read(samples=["B"]).collect()


def test_one_frame_is_read_with_and_without_filters(spark, tmp_path):
    _, rows = built(spark)
    shards.write_shards(rows, str(tmp_path))
    every = shard_source.read_cells(spark, str(tmp_path))
    n = [every.filter("sample_id = 'A' AND sample_index > 4").count(), every.count(), every.filter("sample_index = 0").count(), every.count()]
    assert n == [2, 14, 2, 14]


def test_a_failed_job_leaves_no_file(spark, tmp_path):
    _, rows = built(spark)
    fails = F.udf(lambda s: 1 / 0 if s == "B" else s)
    with pytest.raises(Exception, match="ZeroDivisionError"):
        shards.write_shards(rows.repartition(6).withColumn("sample_id", fails("sample_id")), str(tmp_path / "out"))
    assert files_of(tmp_path / "out") == []


def test_an_attempt_that_is_not_committed_leaves_no_file(tmp_path, spark):
    """Two attempts of one task, as after speculation: Spark commits one of them."""
    _, rows = built(spark)
    own = rows.collect()
    writer = shard_source.ShardWriter(str(tmp_path), False)
    writer.write(iter(own[:2]))  # killed after it had written
    messages = [writer.write(iter(own[:3])), writer.write(iter(own[3:])), None]
    assert not [f for f in files_of(tmp_path) if not f.startswith("_staging")]
    writer.commit(messages)
    assert files_of(tmp_path) == sorted([*SHARDS, "_SUCCESS"])
    again = shard_source.ShardWriter(str(tmp_path), False)
    again.abort([again.write(iter(own)), None])
    assert files_of(tmp_path) == sorted([*SHARDS, "_SUCCESS"])


def test_overwrite_and_clashes(spark, tmp_path):
    _, rows = built(spark)
    shards.write_shards(rows, str(tmp_path))
    shard_source.write(rows.filter("sample_id = 'A'"), str(tmp_path), "append")
    assert files_of(tmp_path) == sorted([*SHARDS, "_SUCCESS"])
    with pytest.raises(Exception, match="two tasks"):
        shard_source.write(rows.union(rows), str(tmp_path / "twice"))
    assert files_of(tmp_path / "twice") == []
    shard_source.write(rows.filter("sample_id = 'A'"), str(tmp_path), "overwrite")
    assert files_of(tmp_path) == sorted([x for x in SHARDS if x[0] == "A"] + ["_SUCCESS"])


@pytest.mark.parametrize("form", ["bare", "sample"])
@pytest.mark.parametrize("given", ["folder", "rows"])
def test_packages_hold_every_shard(spark, tmp_path, form, given):
    """Shards of one name in two samples stay two, however the manifest writes their paths."""
    made, rows = built(spark)
    shards.write_shards(rows, str(tmp_path / "in"))
    path = F.col("shard_path") if form == "bare" else F.concat_ws("/", "sample_id", "shard_path")
    listed = manifest.dense_index(made, "sample_id", "sample_index").drop("image").withColumn("shard_path", path)
    folder = str(tmp_path / "package")
    source = str(tmp_path / "in") if given == "folder" else rows
    card = pipelines.package(listed, ["g"], folder, task="t", defer_split=True, source=source)
    assert card["n_shards"] == 6 and files_of(f"{folder}/shards") == sorted(f"shard-{k:06d}.{x}" for k in range(6) for x in ("tar", "idx"))
    cells = {(r.shard_path, json.loads(r.meta)["sample_id"], json.loads(r.meta)["cell_id"]): bytes(r.image) for r in shard_source.read_cells(spark, folder, ["shards"]).collect()}
    told = spark.read.parquet(f"{folder}/manifest.parquet").collect()
    assert len(told) == 14 and all(cells[r.shard_path, r.sample_id, r.cell_id] == f"{r.sample_id}:{r.cell_id[1:]}".encode() * (int(r.cell_id[1:]) + 1) for r in told)


def test_a_package_without_a_shard_is_an_error(spark, tmp_path):
    made, rows = built(spark)
    shards.write_shards(rows.filter("NOT (sample_id = 'B' AND shard_path = 'shard-000001.tar')"), str(tmp_path / "in"))
    listed = manifest.dense_index(made, "sample_id", "sample_index").drop("image")
    with pytest.raises(KeyError, match="B/shard-000001"):
        pipelines.package(listed, ["g"], str(tmp_path / "package"), task="t", defer_split=True, source=str(tmp_path / "in"))
    assert not os.path.exists(tmp_path / "package")


def test_executors_need_no_copy_of_the_package(sf_dir, tmp_path):
    """Sources, readers and figures from a folder where Python workers find no package."""
    import subprocess
    import sys
    from pathlib import Path

    here = Path(__file__).resolve().parent.parent
    code = f"""
import sys
sys.path.insert(0, {str(here)!r})
from spotloom.session import local_session
from spotloom import registry
spark = local_session(4, 4, "2g")
for name in ("q_shard_source", "q_read_ranges", "q_csr_store", "q_overlay_png"):
    print(name, registry.QUERIES[name](spark, {sf_dir!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    found = dict(x.split() for x in out.stdout.splitlines() if x.startswith("q_"))
    assert len(found) == 4 and all(int(n) > 0 for n in found.values()), out.stderr[-2000:]


def test_many_ranges_share_a_bounded_number_of_partitions(spark, tmp_path, monkeypatch):
    made, rows = built(spark, n=40)
    shards.write_shards(rows, str(tmp_path))
    monkeypatch.setattr(shard_source, "PARTS", 5)
    parts = shard_source.ShardReader({"path": str(tmp_path), "cells": "1"}).partitions()
    assert len(parts) == 5 and sum(len(p.value) for p in parts) == 80
    reader = shard_source.ShardReader({"path": str(tmp_path), "cells": "1", "low": "3", "high": "38"})
    got = sorted((s, i, bytes(image)) for p in reader.partitions() for s, _, i, image, _ in reader.read(p))
    assert got == sorted((r.sample_id, r.sample_index, bytes(r.image)) for r in made.collect() if 3 <= r.sample_index <= 38)


def test_tar_is_byte_for_byte_that_of_the_library():
    members = [(f"{k:07d}.jpg", b"x" * n) for k, n in enumerate((0, 1, 511, 512, 513, 9000))] + [("d" * 80 + "/" + "f" * 60 + ".json", b"{}")]
    for some in ([], members[:1], members):
        buffer = io.BytesIO()
        with tarfile.open(fileobj=buffer, mode="w", format=tarfile.USTAR_FORMAT) as tar:
            for name, data in some:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        content, at = shards._tar(some)
        assert content == buffer.getvalue() and all(content[at[n][0] : sum(at[n])] == d for n, d in some)


def test_headers_are_those_of_tarfile():
    for name, size in (("0000001.jpg", 0), ("x" * 99, 123_456), ("x" * 100, 5), ("é.json", 7), ("a.expr.npz", 8**10)):
        info = tarfile.TarInfo(name)
        info.size = size
        assert shards._header(name, size) == info.tobuf(tarfile.USTAR_FORMAT)
    given = [("a.jpg", b""), ("b.expr.npz", b"x" * 1023), ("c.json", b"{}")]
    content, at = shards._tar(given)
    assert shards.untar(memoryview(content)) == given and all(content[o : o + n] == dict(given)[k] for k, (o, n) in at.items())
    # Headers of other kinds, by other programs.
    for kind in (tarfile.GNU_FORMAT, tarfile.PAX_FORMAT, tarfile.USTAR_FORMAT):
        out, long = io.BytesIO(), ("d/" + "n" * 150 if kind != tarfile.USTAR_FORMAT else "d" * 120 + "/n") + ".jpg"
        with tarfile.open(fileobj=out, mode="w", format=kind) as tar:
            for name in ("é.json", long):
                info = tarfile.TarInfo(name)
                info.size = 3
                tar.addfile(info, io.BytesIO(b"abc"))
        assert shards.untar(memoryview(out.getvalue())) == [("é.json", b"abc"), (long, b"abc")]
    with pytest.raises(tarfile.ReadError):
        shards.untar(memoryview(content[:2600]))


def test_sparse_rows_are_npz():
    for indices, values in (([], []), ([3], [1.5]), (list(range(300)), [0.25] * 300)):
        data, other = shards.pack_sparse(indices, values), io.BytesIO()
        np.savez(other, indices=np.asarray(indices, np.int32), values=np.asarray(values, np.float32))
        with np.load(io.BytesIO(data)) as z:
            assert z["indices"].tolist() == indices and z["values"].tolist() == values and (z["indices"].dtype, z["values"].dtype) == (np.int32, np.float32)
        for form in (data, other.getvalue()):
            got = shards.unpack_sparse(form)
            assert got[0].tolist() == indices and got[1].tolist() == values


def test_payloads_and_checks_read_every_shard_once(spark):
    cells, rows = built(spark)
    rows, read = rows.localCheckpoint(), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    seen = lambda: rows.mapInPandas(counted, rows.schema)
    wanted = cells.select("sample_id", "shard_path", "sample_key")
    got = shards.payloads(wanted, seen())
    assert got.count() == 14 and got.filter("payload IS NULL").count() == 0 and read.value == 6
    with pytest.raises(KeyError, match="none"):
        shards.payloads(wanted.union(spark.createDataFrame([("A", "shard-000000.tar", "none")], wanted.schema)), seen())
    before = read.value
    counts = overlays.qc_counts(wanted, seen(), 20)
    assert counts.first() == counts.first() and counts.first()["n_checked"] == 14 and read.value == before + 6


def test_images_are_converted_in_parts(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 7 > 0, F.encode(F.col("id").cast("string"), "UTF-8")).alias("image"), F.lit("x").alias("after"))
    done = tiles.convert(rows.coalesce(1), lambda x: x + b"!")
    assert "MapInArrow" in done._jdf.queryExecution().executedPlan().toString() and done.columns == rows.columns
    assert {r.id: (r.image and bytes(r.image), r.after) for r in done.collect()} == {k: (f"{k}!".encode() if k % 7 else None, "x") for k in range(1000)}
