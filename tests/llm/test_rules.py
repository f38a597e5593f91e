"""The cascade of quality rules and the audit of filters against brute force."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from spotloom.llm import audit, rules

from .test_corpus import LONG, ODD, WORD, table


def counted(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    t = text or ""
    words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    earlier, again = set(), 0
    for x in lines:
        again += x in earlier
        earlier.add(x)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), again, len(covered)


def texts(seed, n):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "bb", "ccc", "dé", "😀", "#x", "|", "THE", "12", "...", "-"])
    line = lambda: r.choice([" ", "  ", "\t"]).join(word() for _ in range(r.randrange(12)))
    return ["\n".join(line() for _ in range(r.randrange(9))) for _ in range(n)]


def test_statistics_against_brute_force(spark):
    given = texts(1, 300) + [t for _, t, _ in ODD] + ["x y z x y z", "x y x y x", "a\n\n\na\n \n \na ", "\x1c\x1f a b c", LONG + " " + LONG]
    docs = table(spark, [(k, t, "s") for k, t in enumerate(given)])
    got = {r.doc_id: r for r in rules.quality_rules(docs, rules.RULES).collect()}
    assert [tuple(got[k][1:6]) for k in range(len(given))] == [counted(t) for t in given]
    for k, t in enumerate(given):
        n, _, _, _, repeated = counted(t)
        assert got[k].base_failed == (n < 50 or 100 * repeated > 50 * n) and not (got[k].base_failed and got[k].kept)


PROSE = " ".join(f"wordy{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120))
REJECTED = {
    "mean_word_length": " ".join("x" * 30 + str(k) for k in range(60)),
    "symbols": PROSE + " #" * 20,
    "duplicate_lines": "\n".join(f"{PROSE[:40]}\nsame here\n\nother {k}" for k in range(6)) + "\n" + PROSE,
    "bullets": "\n".join(f"- {w}" for w in PROSE.split()),
    "ellipses": "\n".join(f"{w}..." for w in PROSE.split()),
    "exclamations": PROSE.replace(" ", "! "),
    "digits": " ".join(f"a{k:06d}" for k in range(90)),
    "capitals": PROSE.upper(),
    "words_with_letters": PROSE + " " + " ".join(f"{k}," for k in range(70)),
}


def test_every_rule_rejects_what_it_is_for_and_keeps_prose(spark):
    assert set(REJECTED) == {r.name for r in rules.RULES}
    docs = table(spark, [(k, t, "s") for k, t in enumerate([PROSE, *REJECTED.values()])])
    got = {r.doc_id: r.rejected_by for r in rules.judged(docs, rules.RULES).collect()}
    assert got[0] is None
    for k, name in enumerate(REJECTED, 1):
        alone = rules.judged(docs.filter(F.col("doc_id") == k), tuple(r for r in rules.RULES if r.name == name)).first()
        assert alone.rejected_by == name, (name, alone)
        assert got[k] is not None


def test_order_is_by_rejections_per_second_of_what_is_left():
    a, b, c, d = (rules.Rule(x, lambda: F.lit(True)) for x in "abcd")
    found = rules.Estimate({"a": 1.0, "b": 2.0, "c": 4.0, "d": 0.5}, {frozenset("ab"): 60, frozenset("a"): 40, frozenset("bc"): 30, frozenset("c"): 10, frozenset(): 500})
    # a: 100 a second; then b: 30 / 2 against c: 40 / 4; then c: 10 / 4 against nothing of d.
    assert "".join(r.name for r in rules.ordered(found, (d, c, b, a))) == "abcd"
    assert "".join(r.name for r in rules.ordered(rules.Estimate(found.seconds, {}), (a, b, c, d))) == "dabc"


def test_later_rules_are_not_evaluated(spark):
    fails = rules.Rule("fails", lambda: F.col("__n_words") < 0)
    raises = rules.Rule("raises", lambda: F.raise_error(F.concat(F.lit("evaluated "), F.col("__text"))).cast("string") == "")
    docs = table(spark, [(1, PROSE, "s"), (2, "short", "s")])
    assert {r.rejected_by for r in rules.judged(docs, (fails, raises)).collect()} == {"fails", "base"}
    with pytest.raises(Exception, match="evaluated"):
        rules.judged(docs, (raises, fails)).collect()


def test_verdict_does_not_depend_on_the_order(spark, docs_small):
    one = {tuple(r) for r in rules.quality_rules(docs_small).collect()}
    assert one == {tuple(r) for r in rules.quality_rules(docs_small, rules.RULES[::-1]).collect()}


@pytest.fixture(scope="module")
def docs_small(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_rules_on_odd_rows(spark):
    odd, empty = table(spark, ODD), table(spark, [])
    out = rules.judged(odd)
    assert out.columns[: len(odd.columns)] == odd.columns and out.count() == len(ODD)
    assert rules.judged(empty).collect() == [] and rules.keep(empty).columns == empty.columns
    clash = table(spark, [*ODD, (20, PROSE, None)]).withColumnsRenamed({"fp": "N_Words", "key": "__text", "label": "base_failed"})
    got = rules.judged(clash)
    assert got.columns[-7:] == ["n_words_", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed_", "rejected_by"]
    assert {r.doc_id for r in rules.keep(clash).collect()} == {20}  # the long texts are a third digits
    assert rules.keep(clash).columns == clash.columns


def test_rules_run_no_python_and_shuffle_nothing(docs_small):
    plan = rules.quality_rules(docs_small, rules.RULES)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange", "Generate"))


# The audit.


def slow_audit(docs, labels):
    """Every order is run, document by document."""
    least: dict = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}

    def failing(i, text):
        t = text or ""
        words = WORD.findall(t)
        bad = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i}
        return {k for k, v in bad.items() if v}

    rows = [(s or "", i, failing(i, t)) for i, t, s in docs]
    out, shapley = {}, Counter()
    for part in {p for p, _, _ in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [(i, f) for p, i, f in rows if p == part]
            gone: list = []
            for step, letter in enumerate(order, 1):
                removed = [(i, f) for i, f in left if letter in f]
                redundant = sum(letter in f for _, f in gone)
                left, gone = [x for x in left if letter not in x[1]], gone + removed
                unique = sum(p == part and f == {letter} for p, _, f in rows)
                out[part, order, step] = [len(left), len(removed), redundant, unique, sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed)]
                shapley[part, letter] += len(removed)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_against_brute_force(spark):
    r = random.Random(5)
    long = [" ".join(r.choice("abcdefghijkl") + str(r.randrange(m)) for _ in range(210)) for m in (2, 30, 300)]
    pool = [None, "", *texts(2, 12), *long, *(t + " $" for t in long), *(t.upper() for t in long), "ABC " * 220, "ABC# " * 220]
    docs = [(r.choice([None, *range(90)]), r.choice(pool), r.choice(["a", "b", None, ""])) for _ in range(160)] + [(3, pool[2], "a")] * 3
    labels = [(r.choice([None, *range(90)]), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(80)]
    table_of = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {(x.part, x.filter_order, x.step): tuple(x)[3:] for x in audit.audit(table(spark, docs), table_of).collect()}
    assert got == slow_audit(docs, labels)
    assert len(got) == 3 * 120 * 5


def test_audit_on_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = {(x.part, x.filter_order, x.step): tuple(x)[3:] for x in audit.audit(table(spark, ODD), none).collect()}
    assert got == slow_audit(ODD, [])
    assert audit.audit(table(spark, []), none).collect() == []


def test_lattice(spark):
    counts = spark.createDataFrame([("p", 0b101, 1, 0, 7)], "part string, failed int, good int, toxic int, n bigint")
    got = audit.edges(counts, 3).collect()
    assert len(got) == 3 * 4 and len({(x.applied, x.next) for x in got}) == 12
    assert {x.next: x.shapley for x in got} == {0: 7 * math.factorial(3) // 2, 1: 0, 2: 7 * math.factorial(3) // 2}
    assert audit.steps(spark, "ABCDE").count() == 600


def test_filters_above_the_statistics_stay_there(spark, docs_small):
    """A filter that moved below the projections would compute the sorted windows anew for each of them."""
    out = rules.quality_rules(docs_small, rules.RULES)
    for condition in ("kept", "n_words > 60", "n_repeat_words = 0"):
        plan = out.filter(condition).select("doc_id")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("sort_array") <= 1 and plan.count("regexp_extract_all") <= 2, condition  # one of them counts words without letters
