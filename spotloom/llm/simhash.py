"""SimHash near-duplicate detection by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at 3 or fewer differing bits have a half (32 bits) at 1 or fewer
differing bits, half the radius. So every distinct fingerprint emits, for either half, all
33 variants within half the radius, and the variants are shuffled and counted:

* a variant that two fingerprints share is a candidate pair, verified by its Hamming
  distance;
* of a variant that more share, each member is verified against the owners, the fingerprints
  that have the variant itself for a half, as long as that makes fewer rows than the next;
* in a crowd (copies with small edits) the owners emit, in the same way, the variants of their
  *other* half within two bits, and a member one bit short of the variant its other half alone.
  Two fingerprints that meet in one such point with costs c and d differ in c + d bits or
  fewer, and every link of the crowd meets in a point with c + d <= 3. A point is near a
  bounded number of fingerprints (561) and links each of them to its nearest one: the work
  is linear in the crowd, not square.

Everything before the last join works on distinct fingerprints, so a text with many copies
counts once. Components come from alternating large-star and small-star rounds, whose state
is cut in the shared checkpoint folder.

``near_dedup`` links texts by the Jaccard similarity of five-word shingles instead, with ball
hashing of a longer fingerprint as its search for candidates (see ``similar_components``).

Joins on the fingerprint, which all blank texts share, rely on Spark's adaptive splitting of
skewed partitions; their other side has one row for each fingerprint.

Defined cases: a null or blank text has no words and fingerprint zero, linked like any
other; a text of one or two words has one shingle, the whole sequence; null ids get their
component like others but never name one, unless all its ids are null; repeated rows are
returned as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import cut
from .common import WORD, bounded, by_place, content, named, slices

SEED = 42
SHINGLE = 3
#: Variants of a half within two bits: what an owner emits around itself in a crowd.
BALL = 529


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles (ASCII lower case, white space split)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    one = xxhash.xxh64_intdigest
    h = np.array([one(joined[a:z], SEED) for a, z in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):
        part = h[at : at + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 512):
        fp = np.fromiter((fingerprint(x) for x in b.column(1).to_pylist()), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp), the fingerprint as a signed long."""
    return docs.select(named(id_col).cast("bigint").alias("doc_id"), content(text_col).alias("text")).mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def _half(fp: Column, side: Column) -> Column:
    """The 32 bits of one side, tagged with the side in bit 32."""
    return F.when(side == 0, F.shiftrightunsigned(fp, 32)).otherwise(fp.bitwiseAND(0xFFFFFFFF).bitwiseOR(1 << 32))


def _balls(width: int, most: int) -> list[int]:
    """Masks of ``most`` or fewer of ``width`` bits, by weight."""
    out = [0]
    if most >= 1:
        out += [1 << i for i in range(width)]
    if most >= 2:
        out += [1 << i | 1 << j for i in range(width) for j in range(i)]
    return out


def _masks(most: int) -> Column:
    return F.lit(np.array(_balls(32, most), np.int64).tolist())


def edges(fps: DataFrame) -> DataFrame:
    """(u, v) with u > v: links between distinct fingerprints that connect whatever is within 3 bits."""
    sides = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    halves = fps.select("fp", sides).select("fp", _half(F.col("fp"), F.col("side")).alias("half"))
    # Of two halves one bit apart, only the one without the bit emits the other: each such pair meets once.
    emitted = halves.select("fp", "half", F.explode(_masks(1)).alias("mask")).filter(F.col("half").bitwiseAND(F.col("mask")) == 0)
    emitted = emitted.select("fp", F.col("half").bitwiseOR(F.col("mask")).alias("key"), (F.col("mask") == 0).cast("bigint").alias("own"))
    shared = emitted.groupBy("key").agg(F.count("*").alias("n"), F.sum("own").alias("own"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("own >= 1 and n > 1")
    shared = cut(shared)
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = shared.filter("n = 2").select("a", "b").filter(far <= 3)

    def members(keys: DataFrame) -> DataFrame:
        """A shared variant's fingerprints: those that have the half, at cost 0, and those a bit short of it, at cost 1."""
        near = keys.select("key", F.explode(_masks(1)).alias("mask")).filter(F.col("key").bitwiseAND(F.col("mask")) == F.col("mask"))
        near = near.select("key", F.col("key").bitwiseXOR(F.col("mask")).alias("half"), F.bit_count("mask").alias("cost"))
        return near.join(halves, "half").select("key", "fp", "cost")

    # Pairs of an owner and a member, or points around the owners: whichever are fewer.
    direct = F.expr(f"own * n <= {BALL} * own + n and own <= {BALL}")
    some = members(shared.filter("n > 2").filter(direct))
    owners = some.filter("cost = 0").select("key", F.col("fp").alias("b"))
    close = some.select("key", F.col("fp").alias("a")).join(owners, "key").select("a", "b").filter(F.col("a") != F.col("b")).filter(far <= 3)
    many = members(shared.filter("n > 2").filter(~direct))
    other = _half(F.col("fp"), F.when(F.col("key") < 1 << 32, 1).otherwise(0)).bitwiseAND(0xFFFFFFFF)
    reach = F.when(F.col("cost") == 0, _masks(2)).otherwise(_masks(0))
    points = many.select("key", "fp", "cost", other.alias("other"), F.explode(reach).alias("mask"))
    points = points.select("key", "fp", F.col("other").bitwiseXOR(F.col("mask")).alias("point"), (F.col("cost") + F.bit_count("mask")).alias("cost"))
    nearest = F.min(F.struct("cost", "fp")).over(Window.partitionBy("key", "point"))
    meets = points.select("fp", nearest.alias("hub")).filter("hub.cost <= 1 and hub.fp <> fp").select(F.col("hub.fp").alias("a"), F.col("fp").alias("b"))
    links = pairs.union(close).union(meets)
    return links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``links`` (u, v)."""
    state = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    seen = None
    for _ in range(rounds):
        # Large star: each node's larger neighbours go to the smallest node around it.
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node's smaller neighbours go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        state = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        state = cut(state)
        # Equal counts and sums of hashes in two rounds: nothing moved.
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): the smallest id reachable over links of 3 or fewer bits."""
    rows = cut(fingerprints(docs, id_col, text_col))
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(edges(fps.select("fp"))).withColumnRenamed("node", "fp")
    placed = fps.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(names, "fp").select("doc_id", "fp", "component_id")


#: The long fingerprint of ``similar``: 64-bit words over word pairs, and its bits by which a pair may differ.
LONGS = 4
PAIRED = 2
FAR = 64
#: Texts of a crowd that are compared in one group, about.
GROUP = 256


def long_fingerprint(text: bytes) -> np.ndarray:
    """256 bits of SimHash over a text's word pairs: one edited word changes two of these, and five of the shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(LONGS, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    one, k = xxhash.xxh64_intdigest, min(PAIRED, len(words))
    h = np.array([one(joined[a:z], SEED) for a, z in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64)
    out = np.zeros(LONGS, np.uint64)
    for j in range(LONGS):
        # The hash's j-th successor: a multiplication and a fold make independent bits of it.
        g = (h + np.uint64(j)) * np.uint64(0x9E3779B97F4A7C15 + 2 * j)
        g = (g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        g ^= g >> np.uint64(32)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(g), 8192):
            ones += np.unpackbits(g[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[j] = np.packbits(2 * ones > len(g), bitorder="little").view(np.uint64)[0]
    return out


def _long_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "t", *(f"f{j}" for j in range(LONGS))]
    for b in slices(batches, 512):
        fp = np.array([long_fingerprint(x) for x in b.column(2).to_pylist()]).reshape(-1, LONGS).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(np.ascontiguousarray(fp[:, j])) for j in range(LONGS))], names)


def _shingles(text: Column, shingle: int) -> tuple[Column, Column]:
    """The words of a text, and over these, as ``__w``, its distinct shingles as 64-bit hashes.

    Fewer words than a shingle's are one shingle, no words are none.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), upper, upper.lower()), F.lit(f"({WORD})"), F.lit(1))
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.size("__w") - (shingle - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("__w", i, F.lit(shingle))))
    return words, F.when(F.size("__w") > 0, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))


def _spread(texts: DataFrame, rows: int = 10_000, most: int = 20_000) -> DataFrame:
    """The texts dealt to tasks of about ``rows``, each of which emits some hundred variants a text."""
    return texts.repartition(max(1, min(most, -(-texts.count() // rows))), "t")


def _bands(texts: DataFrame, *more: str) -> DataFrame:
    """(t, band): the 32-bit parts of the long fingerprint, tagged with their number."""
    part = lambda j: _half(F.col(f"f{j // 2}"), F.lit(j % 2)).bitwiseAND(0xFFFFFFFF).bitwiseOR(F.lit(j << 32))
    return texts.select("t", *more, F.explode(F.array(*(part(j) for j in range(2 * LONGS)))).alias("band"))


class _Verifier:
    """Candidate pairs of texts held against their shingle sets."""

    def __init__(self, docs: DataFrame, texts: DataFrame, shingle: int, similarity: float, id_col: str, text_col: str):
        self.texts, self.shingle, self.similarity = texts, shingle, similarity
        self.docs = docs.select(named(id_col).cast("bigint").alias("doc_id"), F.xxhash64(content(text_col)).alias("t"), named(text_col).cast("string").alias("text"))

    def links(self, pairs: DataFrame) -> DataFrame:
        """(a, b) of the pairs whose Jaccard similarity reaches the bound."""
        bits = [f"f{j}" for j in range(LONGS)]
        side = lambda x: self.texts.select(F.col("t").alias(x), F.col("least").alias(f"{x}_least"), *(F.col(c).alias(f"{x}_{c}") for c in bits))
        near = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(side("a"), "a").join(side("b"), "b")
        apart = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in bits), F.lit(0))
        near = cut(near.filter(apart <= FAR).select("a", "a_least", "b", "b_least"))
        need = near.select(F.col("a").alias("t"), F.col("a_least").alias("least")).union(near.select("b", "b_least")).distinct()
        need = bounded(need.select(F.col("t").alias("__t"), F.col("least").alias("__least")))
        some = self.docs.join(need, (F.col("t") == F.col("__t")) & F.col("doc_id").eqNullSafe(F.col("__least")), "left_semi")
        words, hashes = _shingles(F.col("text"), self.shingle)
        sets = some.select("t", words.alias("__w")).select("t", hashes.alias("s")).groupBy("t").agg(F.first("s").alias("s"))
        sets = cut(sets)
        both = near.select("a", "b").join(sets.select(F.col("t").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("t").alias("b"), F.col("s").alias("sb")), "b")
        common = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - common
        return cut(both.filter((union == 0) | (common >= union * F.lit(float(self.similarity)))).select("a", "b"))


def similar_components(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id): the smallest id reachable over links of texts at the Jaccard similarity of word shingles, or more.

    Candidates come from ball hashing of a longer fingerprint: 256 bits over word pairs in eight
    bands of 32 bits, each of which emits all variants within one bit, half the radius of two.
    Texts that share a variant are compared in three steps, each of which leaves out what the
    former has joined: with the smallest of those that share a whole band; with the smallest of
    those that share a variant; and, where texts of several components still share one, with each
    other, in groups of about ``GROUP``. So no candidate is lost, and a crowd of copies costs a row
    for each. What a band proposes is verified by the exact similarity.

    A pair of texts with b of 256 bits apart is proposed with the probability that one of eight
    bands has two or fewer of them: 99.6 % at 21 bits, 94 % at 28 and 80 % at 34, the most that any
    pair at 0.8 had in the test tables. Texts are named by 64-bit hashes.
    """
    rows = docs.select(named(id_col).cast("bigint").alias("doc_id"), F.xxhash64(content(text_col)).alias("t"), content(text_col).alias("text"))
    fields = ", ".join(f"f{j} bigint" for j in range(LONGS))
    rows = cut(rows.mapInArrow(_long_fingerprints, f"doc_id bigint, t bigint, {fields}"))
    texts = cut(rows.groupBy("t").agg(F.min("doc_id").alias("least"), *(F.first(f"f{j}").alias(f"f{j}") for j in range(LONGS))))
    verifier = _Verifier(docs, texts, shingle, similarity, id_col, text_col)

    def joined(placed: DataFrame, found: DataFrame) -> DataFrame:
        """The roots after new links: components of the roots that the links join."""
        root = placed.select("t", "root")
        ends = found.join(root.select(F.col("t").alias("a"), F.col("root").alias("u")), "a").join(root.select(F.col("t").alias("b"), F.col("root").alias("v")), "b")
        new = components(ends.select("u", "v")).select(F.col("node").alias("root"), F.col("root").alias("to"))
        return cut(placed.join(new, "root", "left").select("t", F.coalesce("to", "root").alias("root"), *[c for c in placed.columns if c not in ("t", "root")]))

    def stars(members: DataFrame, key: str) -> DataFrame:
        """(a, b): every member with the smallest of its key, if that is in another component."""
        hub = cut(_hubs(members, key))  # cut, so that the join reads two plain shuffles, whose hot partitions can be split
        pairs = members.select(key, F.col("t").alias("b"), F.col("root").alias("v")).join(hub, key)
        return pairs.filter("u <> v").select("a", "b")

    placed = texts.withColumn("root", F.col("t"))
    placed = joined(placed, verifier.links(stars(_bands(placed, "root"), "band")))
    # Variants of all bands; only keys that texts of several components share go on.
    bands = _bands(_spread(placed), "root")
    emitted = bands.select("root", "band", F.explode(_masks(1)).alias("mask")).select("root", F.col("band").bitwiseXOR(F.col("mask")).alias("key"))
    shared = emitted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    near = shared.select("key", F.explode(_masks(1)).alias("mask")).select("key", F.col("key").bitwiseXOR(F.col("mask")).alias("band"))
    members = cut(near.join(_bands(placed), "band").select("key", "band", "t"))
    placed = joined(placed, verifier.links(stars(members.join(placed.select("t", "root"), "t"), "key")))
    bits = texts.select("t", *(f"f{j}" for j in range(LONGS)))
    placed = joined(placed, verifier.links(_rest(members.join(placed.select("t", "root").join(bits, "t"), "t"))))
    names = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("t", "component_id")
    return rows.select("doc_id", "t").join(names, "t").select("doc_id", "component_id")


def _hubs(members: DataFrame, key: str) -> DataFrame:
    """(key, a, u): the smallest text and its root, of keys whose texts are of several components.

    Of keys with the same texts, as the variants of one band often are, one stays: the others would make the same pairs.
    """
    each = members.groupBy(key).agg(
        F.min(F.struct("t", "root")).alias("hub"), F.min("root").alias("lo"), F.max("root").alias("hi"),
        F.count("*").alias("n"), F.max("t").alias("z"), F.bit_xor("t").alias("x"), F.bit_xor(F.xxhash64("t")).alias("y"),
    )
    return each.filter("lo <> hi").groupBy("hub", "n", "z", "x", "y").agg(F.min(key).alias(key)).select(key, F.col("hub.t").alias("a"), F.col("hub.root").alias("u"))


def _rest(members: DataFrame) -> DataFrame:
    """(a, b) of all members of a key in different components, in groups of two blocks each.

    Those of a key's largest component meet the other members alone, not each other. Texts of one band, which share
    all its variants, meet in the key that is the band; in others those of different bands do. Without ``band`` all meet. Of
    members with fingerprints, pairs that differ in more than ``FAR`` bits, which are not compared, are not made.
    """
    members = members if "band" in members.columns else members.withColumn("band", F.col("key"))
    bits = [c for c in members.columns if c in {f"f{j}" for j in range(LONGS)}]
    sizes = members.groupBy("key", "root").agg(F.count("*").alias("k"), F.min("band").alias("low"), F.max("band").alias("high"), F.max((F.col("band") == F.col("key")).cast("int")).alias("owned"))
    several = sizes.groupBy("key").agg(F.sum("k").alias("n"), F.max(F.struct("k", "root")).alias("most"), F.count("*").alias("c"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("owned").alias("owned"))
    several = several.filter("c > 1 and n > 2 and (low <> high or owned = 1)")
    dealt = members.join(cut(several.select("key", F.ceil(F.col("n") / GROUP).cast("int").alias("m"), F.col("most.root").alias("big"))), "key")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("t"), "m").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    one = F.struct("t", "root", "band", "own", *bits, (F.col("root") == F.col("big")).alias("big")).alias("one")
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), one)
    each = dealt.repartition("key", "i", "j").groupBy("key", "i", "j").agg(F.collect_list("one").alias("all"))
    few = each.select("key", "i", "j", F.explode(F.filter("all", lambda x: ~x["big"])).alias("x"), "all")
    x = F.col("x")
    apart = lambda y: (x["root"] != y["root"]) & (y["big"] | (x["t"] < y["t"])) & ((F.col("i") == F.col("j")) | (x["own"] != y["own"]))
    near = lambda y: sum((F.bit_count(x[c].bitwiseXOR(y[c])) for c in bits), F.lit(0)) <= FAR
    both = few.select("x", F.explode(F.filter("all", lambda y: apart(y) & ((x["band"] != y["band"]) | (x["band"] == F.col("key"))) & near(y))).alias("y"))
    return both.select(F.least("x.t", "y.t").alias("a"), F.greatest("x.t", "y.t").alias("b")).distinct()


def near_dedup(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents less those whose id is not the smallest of their component; columns unchanged.

    Of rows that repeat an id that stays, all stay; rows without an id stay only where their
    component has no id at all; blank texts are copies of each other; an empty table stays empty.
    """
    rows, (i, t) = by_place(docs, id_col, text_col)
    found = similar_components(rows, shingle, similarity, i, t)
    stays = F.max(F.col("doc_id").eqNullSafe(F.col("component_id")).cast("int"))
    goes = bounded(cut(found.groupBy("doc_id").agg(stays.alias("stays")).filter("stays = 0").select(F.col("doc_id").alias("__goes"))))
    return rows.join(goes, F.col(i).cast("bigint").eqNullSafe(F.col("__goes")), "left_anti").toDF(*docs.columns)


def hexed(fp: str = "fp") -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp).cast(T.LongType())), 16, "0"))
