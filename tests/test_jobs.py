"""The jobs: two runs over growing input, reruns, command lines, and the queries against their SQL."""

import hashlib
import json
import random
from collections import Counter

import pytest

from jobs import corpus_manifest, panel_expression, queries
from spotloom.operators import splits

from .oracle import assert_same, connect


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_job_equals_its_sql(spark, sf_dir, name):
    before = dict(spark.conf.getAll)
    assert_same(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name])
    assert dict(spark.conf.getAll) == before


SCHEMA = "doc_id bigint, text string, source string, batch_id int"


def land(spark, folder, rows):
    """More documents, as a file beside those that are there."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stands(spark, out):
    return {(r.sample_id, r.cell_id): r.asDict() for r in corpus_manifest.read(spark, out).collect()}


def test_manifest_grows(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("documents", "out", "mark"))
    r = random.Random(3)
    text = lambda: " ".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 6)))
    first = [(i, text(), r.choice(["s", "t", None]), 1) for i in range(0, 400, 2)] + [(1000, None, "s", 1), (1001, " \n", "t", 1), (None, "a b", "s", 1), (0, "again", None, 1), (0, "again", None, 1)]
    land(spark, src, first)
    told = corpus_manifest.run(spark, src, out, mark, {"files_per_batch": 1})
    one = stands(spark, out)
    keys = {(s or "", str(i)) for i, t, s, _ in first if i is not None and t and t.strip()}
    assert set(one) == keys and told["read"] == len(first) and told["written"] == len(keys)
    assert sorted(x["global_idx"] for x in one.values()) == list(range(len(keys)))

    # Nothing new: nothing is read and nothing changes.
    assert corpus_manifest.run(spark, src, out, mark) == {"batches": 0, "read": 0, "written": 0}
    assert stands(spark, out) == one

    # More documents, some of which are known, smaller ids among them, and a new source.
    more = [(i, text(), r.choice(["s", "t", "u"]), 2) for i in range(1, 300, 2)] + [(i, t, s, 2) for i, t, s, _ in first[:20]]
    land(spark, src, more)
    told = corpus_manifest.run(spark, src, out, mark)
    two = stands(spark, out)
    new = {(s or "", str(i)) for i, _, s, _ in more} - keys
    assert told["batches"] == 1 and told["read"] == len(more) and told["written"] == len(new)
    assert {k: two[k] for k in one} == one and set(two) == keys | new
    assert sorted(x["global_idx"] for x in two.values()) == list(range(len(two)))
    for s in ("", "s", "t", "u"):
        own = [x for k, x in two.items() if k[0] == s]
        assert sorted(x["sample_index"] for x in own) == list(range(len(own)))
        assert all(x["sample_key"] == f"{x['sample_index']:07d}" and x["shard_path"] == f"{s}/shard-{x['sample_index'] // 500:06d}.tar" for x in own)
    # A text is in one split, whichever batch it came with.
    texts = {}
    for x in two.values():
        assert texts.setdefault(x["group_id"], x["split"]) == x["split"]
    assert {x["batch_id"] for x in two.values()} == {0, 1}
    report = {(x.batch_id, x.sample_id): x for x in spark.read.parquet(f"{out}/report").collect()}
    assert report[0, "s"].without_id == 1 and report[0, "s"].too_short == 1 and report[0, "t"].too_short == 1
    # Document 0 of the first file may be of any source; two rows of the empty source repeat it.
    assert report[0, ""].repeated in (1, 2) and sum(x.known for k, x in report.items() if k[0] == 1) == len(set((s or "", i) for i, _, s, _ in first[:20]))


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    batch = spark.createDataFrame([(i, f"text {i % 7}", "s", 1) for i in range(50)], SCHEMA)
    conf = corpus_manifest.DEFAULTS
    corpus_manifest.take(batch.filter("doc_id < 20"), 0, out, conf)
    corpus_manifest.take(batch, 1, out, conf)
    once = stands(spark, out)
    assert corpus_manifest.take(batch, 1, out, conf)["written"] == 30
    assert stands(spark, out) == once and len(once) == 50


def test_split_by_hash(spark):
    rows = spark.range(4000).selectExpr("id AS global_idx", "'s' AS sample_id", "CAST(id AS STRING) AS cell_id", "CAST(id % 1000 AS STRING) AS g")
    got = splits.hash_by_group(rows, "t", "g", (0.5, 0.3, 0.2), 7).collect()
    limit = lambda x: int(hashlib.md5(f"7:{x.g}".encode()).hexdigest()[:8], 16) / 2**32
    assert all(x.split == ("train" if limit(x) < 0.5 else "val" if limit(x) < 0.8 else "test") for x in got)
    share = Counter(x.split for x in got)
    assert abs(share["train"] - 2000) < 250 and abs(share["test"] - 800) < 200
    with pytest.raises(ValueError, match="sum to 1"):
        splits.hash_by_group(rows, "t", "g", (0.5, 0.5, 0.5))


def test_panel_expression_replaces_only_the_samples_it_computes(spark, tmp_path):
    counts, out = str(tmp_path / "counts"), str(tmp_path / "out")
    rows = [(s, c, g, v) for s in ("a", "b") for c in ("1", "2") for g, v in (("x", 1.0), ("y", 2.0), ("x", 3.0), (s + "only", 9.0))]
    rows += [("a", "3", "aonly", 1.0), ("a", "4", "y", 1.0), ("a", "4", "x", 0.0), (None, "9", "x", 1.0), ("b", "5", None, 1.0)]
    spark.createDataFrame(rows, "sample_id string, cell_id string, gene string, value double").write.parquet(counts)
    told = panel_expression.run(spark, counts, out)
    assert told == {"genes": 2, "read": len(rows), "incomplete": 2, "written": 5}
    read = lambda: sorted((r.sample_id, r.cell_id, r.indices, r["values"]) for r in panel_expression.read(spark, out).collect())
    full = read()
    assert full == sorted([(s, c, [0, 1], [4.0, 2.0]) for s in "ab" for c in "12"] + [("a", "4", [1], [1.0])])
    assert {(r.sample_id, r.n_cells_in, r.n_cells, r.n_entries_in, r.n_entries) for r in spark.read.parquet(f"{out}/report").collect()} == {("a", 4, 3, 8, 5), ("b", 2, 2, 6, 4)}
    panel_expression.run(spark, counts, out, {"samples": ["b"]})  # alone it has a gene more
    assert [x for x in read() if x[0] == "a"] == [x for x in full if x[0] == "a"]
    assert all(x[2] == [0, 1, 2] for x in read() if x[0] == "b")
    panel_expression.run(spark, counts, out)
    assert read() == full
    with pytest.raises(ValueError, match="no gene in common"):
        panel_expression.run(spark, counts, out, {"samples": []})
    with pytest.raises(ValueError, match="unknown settings"):
        panel_expression.run(spark, counts, out, {"sampels": []})


@pytest.mark.parametrize("job", [corpus_manifest, panel_expression])
def test_config_files_name_known_settings(job):
    from pathlib import Path

    given = json.loads((Path(job.__file__).with_suffix(".json")).read_text())
    assert set(given) == set(job.DEFAULTS)
