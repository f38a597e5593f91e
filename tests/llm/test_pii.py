"""Surrogates against what a plain Python reading of the results says: one to one, and the same wherever an entity stands."""

import random
import re

from pyspark.sql import functions as F

from spotloom.llm import pii


def names(r, n, letters):
    out = set()
    while len(out) < n:
        out.add("".join(r.choice(letters) for _ in range(r.randrange(4, 9))).capitalize())
    return sorted(out)


def test_thousands_of_entities_keep_apart_and_together(spark):
    """Families, given names, phones, cards and addresses in several forms: a map from each to its surrogate, one to one."""
    r = random.Random(2)
    latin, greek, cyrillic = names(r, 3000, "abcdefghijklmnoprstuvwz"), names(r, 1500, "αβγδεικλμνοπρστ"), names(r, 1500, "абвгдеклмнопрст")
    firsts = names(r, 300, "abcdefghijklmnoprstuvwz")
    rows, expected = [], []
    for k, family in enumerate(latin):
        title, other = [("Mr.", "Dr."), ("Mrs.", "Prof.")][k % 2]
        phone, card, mail = f"{r.randrange(200, 999)}-{r.randrange(200, 999)}-{k:04d}", f"4{r.randrange(10**10):010d}{k:05d}", f"user{k}@host{k % 9}.org"
        first = firsts[k % 300]
        rows.append((k, f"{title} {first} {family}; {title} {family}; {other} {family.upper()}; {other} {first} {family}. T +1 {phone} or {phone}. C {card}. M {mail}, {mail.upper()}."))
        expected.append((family, first, phone, card, mail))
    for k, family in enumerate(greek + cyrillic):
        rows.append((3000 + k, f"{'Κύριος' if k < 1500 else 'Г-н'} {family}"))
    out = {x.doc_id: x for x in pii.replace(spark.createDataFrame(rows, "doc_id bigint, text string"), "key").collect()}
    form = re.compile(r"(Mr|Mrs)\. (\w+) (\w+); \1\. (\w+); (Dr|Prof)\. (\w+); \5\. (\w+) (\w+)\. T \+1 (\S+) or (\S+)\. C (\d+)\. M (\S+), (\S+)\.")
    family, given, phones, cards, mails = {}, {}, {}, {}, {}
    for k, (old_family, old_given, old_phone, old_card, old_mail) in enumerate(expected):
        m = form.fullmatch(out[k].text)
        assert m, out[k].text
        assert m[3] == m[4] == m[8] and m[6] == m[3].upper() and m[2] == m[7] and m[9] == m[10] and m[12] == m[13]
        assert out[k]["__entities"] == 9 and out[k]["__kinds"] == "card,email,name,phone"
        assert re.sub("[0-9]", "0", m[9]) == "000-000-0000" or len(m[9]) > 12
        for seen, old, new in ((family, old_family, m[3]), (given, old_given, m[2]), (phones, old_phone, m[9]), (cards, old_card, m[11]), (mails, old_mail, m[12])):
            assert seen.setdefault(old, new) == new
    for k, old in enumerate(greek + cyrillic):
        new = out[3000 + k].text.split(" ")[1]
        assert family.setdefault(old, new) == new and re.fullmatch("[Ͱ-Ͽ]+" if k < 1500 else "[Ѐ-ӿ]+", new)
    for seen in (family, given, phones, cards, mails):
        assert len(set(seen.values())) == len(seen) and not set(map(str.lower, seen.values())) & set(map(str.lower, seen))
    men = {new for k, (_, old, *_) in enumerate(expected) for new in [given[old]] if k % 2 == 0}
    assert all(any(n.lower().startswith(g.lower()) for g in pii.GIVEN["latin"]["m"] + pii.GIVEN["latin"]["u"]) for n in men)


def test_same_in_every_order(spark):
    d = spark.createDataFrame([(k, f"Mr. Name{chr(97 + k % 26)}{chr(97 + k // 26)} and {k:03d}-{k % 100:02d}-{k:04d}") for k in range(400)], "doc_id bigint, text string")
    got = [sorted(map(tuple, pii.replace(x, "k").collect())) for x in (d, d.repartition(7), d.orderBy(F.desc("doc_id")))]
    assert got[0] == got[1] == got[2] and got[0] != sorted(map(tuple, pii.replace(d, "other").collect()))


def test_entities_of_mentions(spark):
    rows = ["Mr. John Smith", "Dr. Smith", "Frau Müller", "Г-жа Анна Иванова", "+1 (316) 555-2121", "316-555-2121", "A@B.io"]
    d = spark.createDataFrame([(x,) for x in rows], "m string").withColumn("kind", pii.kind_of(F.col("m")))
    got = {x.m: [tuple(e)[1:] for e in x.e] for x in d.select("m", pii.entities_of(F.col("kind"), F.col("m")).alias("e")).collect()}
    assert got["Mr. John Smith"] == [("family_latin", "smith", None), ("given_latin", "john", "m")] and got["Dr. Smith"] == [("family_latin", "smith", None)]
    assert got["Frau Müller"] == [("family_latin", "müller", None)] and got["Г-жа Анна Иванова"] == [("family_cyrillic", "иванова", None), ("given_cyrillic", "анна", "f")]
    assert got["+1 (316) 555-2121"] == got["316-555-2121"] == [("phone", "3165552121", None)] and got["A@B.io"] == [("email", "a@b.io", None)]


TITLES = ["Mr.", "Mrs.", "Dr.", "Prof. Dr.", "Herr Doktor", "Frau", "Monsieur", "Ms"]
STARTS = ["He", "The", "Yesterday", "But", "They"]


def test_no_piece_of_a_name_is_left(spark):
    """Names of one to four words with initials, hyphens and apostrophes, possessives and the next sentence after them: all their words go, and no others."""
    r = random.Random(9)
    families = names(r, 400, "abcdefghijklmnoprstuvwz")
    firsts = names(r, 60, "abcdefghijklmnoprstuvwz")
    rows, told = [], []
    for k in range(1500):
        family = r.choice(families)
        family = r.choice([family, family, f"O'{family}", f"{family}-{r.choice(families)}", family.upper()])
        given = [r.choice([r.choice(firsts), f"{r.choice('ABCDEFG')}."]) for _ in range(r.randrange(4))]
        if family.isupper():
            given = [g.upper() for g in given]
        after = r.choice(["'s dog barked", "’s dog barked", f" {r.choice(STARTS)} went home", ", it said.", ".", " went on", "; then"])
        title = r.choice(TITLES)
        before = r.choice(["so ", "", "(", "Then "])
        rows.append((k, f"{before}{title} {' '.join([*given, family])}{after}"))
        told.append((before, title, given, family, after))
    out = {x.doc_id: x.text for x in pii.replace(spark.createDataFrame(rows, "doc_id bigint, text string"), "key").select("doc_id", "text").collect()}
    seen: dict = {}
    for k, (before, title, given, family, after) in enumerate(told):
        text = out[k]
        assert text.startswith(f"{before}{title} ") and text.endswith(after), (rows[k], text)
        new = text[len(f"{before}{title} ") : len(text) - len(after)].split(" ")
        assert len(new) == len(given) + 1, (rows[k], text)
        assert seen.setdefault(("family", family.lower()), new[-1].lower()) == new[-1].lower() != family.lower()
        for old, one in zip(given, new, strict=False):
            if old.endswith("."):
                assert re.fullmatch(r"[A-Z]\.", one)
            else:
                assert seen.setdefault(("given", old.lower()), one.lower()) == one.lower() != old.lower()
        if family.isupper():
            assert all(w.isupper() for w in new)
    for part in ("family", "given"):
        new = [v for (p, _), v in seen.items() if p == part]
        assert len(new) == len(set(new))


def test_phones_by_country(spark):
    rows = ["+33 6 12 34 56 78", "+44 316 555 2121", "+1 316 555 2121", "316-555-2121", "+44-316-555-2121", "(316) 555-2121"]
    d = spark.createDataFrame([(k, f"call {t} now") for k, t in enumerate(rows)], "doc_id bigint, text string")
    got = {x.doc_id: x.text[5:-4] for x in pii.replace(d, "k").collect()}
    digits = {k: re.sub(r"\D", "", t) for k, t in got.items()}
    assert re.fullmatch(r"\+33 \d \d\d \d\d \d\d \d\d", got[0]) and re.fullmatch(r"\+44 \d{3} \d{3} \d{4}", got[1]) and re.fullmatch(r"\+1 \d{3} \d{3} \d{4}", got[2])
    assert digits[1] == digits[4] and digits[2][1:] == digits[3] == digits[5] and digits[1][2:] != digits[3]
    assert all(re.sub(r"\D", "", rows[k]) != v for k, v in digits.items())
