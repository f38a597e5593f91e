"""Near duplicates by shingles against brute force, long passages, and columns with clashing names."""

import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from spotloom.llm import lines, mixing, pii, simhash

from .test_corpus import ODD, WORD


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id bigint, text string, source string")


def shingles(text, k=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def alike(a, b):
    return not a | b or len(a & b) >= 0.8 * len(a | b)


def brute(rows):
    """Components over all pairs of texts."""
    texts = sorted({t or "" for _, t in rows})
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if alike(sets[i], sets[j]):
            root[find(i)] = find(j)
    least = defaultdict(list)
    for i, t in rows:
        least[find(texts.index(t or ""))].append(i)
    return {t: min((i for i in least[find(k)] if i is not None), default=None) for k, t in enumerate(texts)}


def words(r, n):
    return [r.choice("badekilomura") + r.choice("aeiou") + r.choice("bcdfg") + str(r.randrange(60)) for _ in range(n)]


def edited(r, text, n):
    own = list(text)
    for _ in range(n):
        own[r.randrange(len(own))] = words(r, 1)[0]
    return own


@pytest.mark.parametrize("group", [4, 256])
def test_near_copies_against_brute_force(spark, monkeypatch, group):
    """Groups of copies with a few words edited, one of them a crowd, among other texts."""
    monkeypatch.setattr(simhash, "GROUP", group)
    r, rows = random.Random(group), []
    for n in (2, 3, 5, 60):
        base = words(r, 120)
        rows += [" ".join(edited(r, base, r.randrange(3))) for _ in range(n)]
    rows += [" ".join(words(r, r.randrange(5, 90))) for _ in range(60)] + ["a b", "A  B", "a b c", "", None, " ", rows[0], rows[0].upper()]
    rows = list(enumerate(rows, 1))
    got = {i: c for i, c in simhash.similar_components(documents(spark, rows)).collect()}
    expected = brute(rows)
    assert got == {i: expected[t or ""] for i, t in rows}
    kept = {x.doc_id for x in simhash.near_dedup(documents(spark, rows)).collect()}
    assert kept == set(expected.values())


def test_rest_of_a_crowd_is_compared_whole(spark, monkeypatch):
    """Members of a key in different components meet in groups; none is left out and none meets twice."""
    monkeypatch.setattr(simhash, "GROUP", 3)
    members = spark.createDataFrame([(1, t, t % 4) for t in range(20)] + [(2, 50, 1), (2, 51, 1), (3, 60, 0), (3, 61, 1)], "key bigint, t bigint, root bigint")
    got = [tuple(x) for x in simhash._rest(members).collect()]
    assert sorted(got) == [(a, b) for a, b in combinations(range(20), 2) if a % 4 != b % 4]


def test_texts_of_one_band_meet_in_its_own_key_alone(spark):
    rows = [(key, 8, t, t % 5) for key in (8, 9, 10, 12) for t in range(12)] + [(9, 11, 50, 50)]
    members = spark.createDataFrame(rows, "key bigint, band bigint, t bigint, root bigint")
    pairs = lambda key: {tuple(x) for x in simhash._rest(members.filter(members.key == key)).collect()}
    assert pairs(8) == {(a, b) for a in range(12) for b in range(a + 1, 12) if a % 5 != b % 5}
    assert pairs(9) == {(t, 50) for t in range(12)} and pairs(10) == pairs(12) == set()


def test_near_dedup_on_odd_rows(spark):
    rows = spark.createDataFrame([(i, t, s) for i, t, s in ODD], "doc_id bigint, text string, source string")
    got = simhash.near_dedup(rows)
    expected = brute([(i, t) for i, t, _ in ODD])
    ids = {i for i, t, _ in ODD if expected[t or ""] == i}
    assert got.columns == rows.columns and sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(str(i) for i, _, _ in ODD if i in ids)
    assert simhash.near_dedup(rows.limit(0)).collect() == []


def test_long_passages_are_lines(spark):
    """A passage of over 50 words in one line, of several sentences, goes where it comes again; its neighbours stay."""
    r = random.Random(1)
    sentence = lambda n: " ".join(words(r, n)) + "."
    passage = " ".join(sentence(15) for _ in range(4))
    short = " ".join(sentence(9) for _ in range(4))
    rows = [(1, f"{sentence(5)}\n{passage}\n{sentence(6)}"), (2, f"Before it. {sentence(4)} {passage} After {sentence(4)}"), (3, passage), (4, short), (5, f"x\n{short}")]
    got = {x.doc_id: x.text for x in lines.dedup_lines(documents(spark, rows), counts=()).collect()}
    kept = {i: t for i, t in rows}
    assert got[1] == kept[1] and got[3] == "" and got[4] == short and got[5] == kept[5]
    assert got[2].startswith("Before it.") and " After " in got[2] and passage not in got[2] and not any(s in got[2] for s in passage.split(". ")[:3])


CLASH = ["__id", "__at", "__doc", "__l", "__all", "__stay", "__kept", "__lines", "__removed", "__key", "__copy", "__copies", "__entities", "__kinds", "__new", "__goes", "a.b", "`", "key", "t", "size", "p", "rank", "c0", "c1", "Text", "one"]


@pytest.mark.parametrize("run", [lambda d: lines.dedup_lines(d), lambda d: lines.dedup_lines(d, counts=()), mixing.mixed, simhash.near_dedup, lambda d: pii.replace(d, "k")])
def test_clashing_names(spark, run):
    rows = [(1, "a b c d e", "s"), (2, "a b c d e x", "s"), (None, None, None), (4, "mail a@b.io", "t")]
    d = spark.createDataFrame([(i, t, s, *range(len(CLASH))) for i, t, s in rows], ["doc_id", "text", "source", *CLASH])
    out = run(d)
    got = out.toDF(*(f"x{k}" for k in range(len(out.columns)))).collect()
    assert out.columns[: len(d.columns)] == d.columns and len(set(out.columns)) == len(out.columns)
    assert got and all(tuple(r)[3 : 3 + len(CLASH)] == tuple(range(len(CLASH))) for r in got)


def test_repeated_ids_lose_no_lines_to_each_other(spark):
    """Rows without an id are documents of their own: a place repeated in one of them doesn't cut the other."""
    rows = [(None, "a\nb\nc\na\nb\nc"), (None, "p\nq\nr\ns\nt\nu"), (7, "p\nq\nr")]
    got = sorted((str(x.doc_id), x.text) for x in lines.dedup_lines(documents(spark, rows), counts=()).collect())
    assert got == [("7", ""), ("None", "a\nb\nc"), ("None", "p\nq\nr\ns\nt\nu")]


def test_hot_keys_are_split(spark):
    """A window that a third of the rows share: its join is divided by adaptive execution."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("p\nq\nr")).otherwise(F.concat_ws("\n", "id", F.col("id") + 1, F.col("id") + 2)).alias("text"))
        out = lines.dedup_lines(hot, counts=())
        assert out.filter("text = ''").count() == 1999
        found = lines.later(hot)
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_keys_of_the_same_texts_propose_once(spark):
    """The variants of a band have the same texts and make one star; keys of other texts, and of one component, are told apart."""
    rows = [(k, t, t) for k in range(33) for t in (5, 6, 7)] + [(50, t, t) for t in (5, 6)] + [(51, t, t) for t in (5, 6, 7, 8)] + [(52, t, 1) for t in (5, 6)]
    got = simhash._hubs(spark.createDataFrame(rows, "key bigint, t bigint, root bigint"), "key").collect()
    assert sorted(map(tuple, got)) == [(0, 5, 5), (50, 5, 5), (51, 5, 5)]


def test_far_members_make_no_rows(spark):
    """Of members with fingerprints only those within ``FAR`` bits make a pair."""
    rows = [(1, 1, 1, 0, 0, 0, 0), (1, 2, 2, 1, 0, 0, 0), (1, 3, 3, 0, -1, -1, 0)]
    got = simhash._rest(spark.createDataFrame(rows, "key bigint, t bigint, root bigint, f0 bigint, f1 bigint, f2 bigint, f3 bigint")).collect()
    assert sorted(map(tuple, got)) == [(1, 2)]
