"""Personal data: detection and keyed surrogates, in DataFrame functions alone.

One pattern finds the mentions of a text. A mention's entity is its kind and canonical form
(lower case, or its letters and digits alone; of a phone number the national digits, with the country if
that isn't 1), so that differently written mentions are one entity. A name is an entity for its family and one
for each given name, so that "Mr. John Paul Smith", "Dr. John Smith" and "Mr. J. Smith" keep the family in common; the
s of a possessive and the word that begins the next sentence are no part of it, and initials become other letters. A
given name has the gender of the titles that it stands with anywhere in the corpus, if these
agree. Every distinct entity of the corpus gets a surrogate of its kind, drawn from a
SHA-256 of a secret key, the kind and the canonical form: digits stay digits and letters
letters, card numbers with a valid check digit get one, names keep gender, script and
capitals. Surrogates are checked over the whole corpus, all families together, all given names
together, and every other kind by itself: one that two entities share, or that is itself an
entity of the corpus, is drawn again with the next attempt for all but the first of them, until
all are distinct. After ``SAME`` attempts surrogates grow with every attempt (a syllable, letters
or digits more), so that the space has no end. Then every mention is written in its own format.

Plan: mentions are narrow rows; entities are aggregated partially before their shuffle; the
mapping, one row for each entity, is joined to the mentions, a join whose hot partitions
Spark can split. The pattern is tried on each text once to find mentions and once more where
there are some, to write them; only texts with a hint of one are joined to what is written.

Defined cases: a null text stays null; texts without mentions are unchanged; mentions that
touch or overlap are taken from left to right, the longest alternative first in the
pattern's order; rows that repeat id and text get equal texts; null ids are kept; an empty
table gives an empty result; other columns are kept, whatever their names. Names are found
after a title only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut
from .common import by_place, named, unused

_FREE = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_MALE, _FEMALE, _ANY = r"Mr|Herr|Señor|Sr|Monsieur|Г-н|Κύριος", r"Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Г-жа|Κυρία", r"Dr|Prof|Doktor|Doctor|Professor|Профессор"
_TITLE = rf"(?:(?:{_FEMALE}|{_MALE}|{_ANY})\.? )+"
#: Words that begin sentences and are no names, though they stand after one.
_STARTS = "A|An|And|But|The|This|That|There|He|She|It|They|We|You|In|On|At|As|When|Then|After|Before|However|Yesterday|Today|Tomorrow|Der|Die|Das|Er|Sie|Es|Und|Aber|Gestern|Heute|El|La|Los|Las|Y|Pero|Ayer|Hoy|Le|Les|Il|Elle|Et|Mais|Hier"
#: A word of a name, without the s of a possessive; before it may stand initials. Beyond the first, no word that begins a sentence.
_WORD = r"\p{Lu}(?:\p{L}|-(?=\p{L})|['’](?=\p{L})(?!s(?!\p{L})))++"
_INITIALS = r"(?:(?:\p{Lu}\.)++ )*+"
_NEXT = rf" {_INITIALS}(?!(?:{_STARTS})(?![\p{{L}}'’\-])){_WORD}"

#: Kinds in the order in which they are tried.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "phone": _FREE[0] + r"(?:\+?\d{1,3}[ .\-]?)?\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}" + _FREE[1] + r"|\+\d{1,3}(?:[ .\-]\d{1,4}){2,6}" + _FREE[1] + "|" + _FREE[0] + r"\d{3}[.\-]\d{3}[.\-]\d{4}" + _FREE[1],
    "card": _FREE[0] + r"(?:\d{4}[ \-]?\d{4}[ \-]?\d{4}[ \-]?\d{4}|3[47]\d{2}[ \-]?\d{6}[ \-]?\d{5})" + _FREE[1],
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?[\p{L}\p{N}])",
    "ssn": _FREE[0] + r"\d{3}-\d{2}-\d{4}" + _FREE[1],
    "iban": _FREE[0] + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _FREE[1],
    "name": _FREE[0] + _TITLE + _INITIALS + _WORD + f"(?:{_NEXT}){{0,4}}",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every mention holds; cheap to look for.
HINTS = "[0-9@]", rf"(?:{_MALE}|{_FEMALE}|{_ANY})\.? \p{{Lu}}"

#: Given names by script and gender; families are spelt from the syllables.
GIVEN = {
    "latin": {"m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Oscar"], "f": ["Anna", "Clara", "Diana", "Elena", "Flora", "Ida", "Maria", "Vera"], "u": ["Alex", "Kim", "Robin", "Sascha"]},
    "cyrillic": {"m": ["Антон", "Борис", "Виктор", "Иван"], "f": ["Анна", "Вера", "Ирина", "Ольга"], "u": ["Саша", "Женя"]},
    "greek": {"m": ["Νίκος", "Πέτρος"], "f": ["Ελένη", "Μαρία"], "u": ["Αλέξ"]},
}
SYLLABLES = {
    "latin": ["ba", "den", "ker", "lo", "mar", "nis", "ro", "tel", "va", "win", "sol", "gar", "fen", "hol", "pra", "zu"],
    "cyrillic": ["ба", "вин", "гор", "де", "ков", "лу", "мар", "нов"],
    "greek": ["δα", "κο", "λι", "μα", "νο", "πα", "ρι", "τε"],
}


def kind_of(mention: Column) -> Column:
    """The first kind whose pattern takes the whole mention."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return F.coalesce(out, F.lit("other"))


def _title(mention: Column) -> Column:
    return F.regexp_extract(mention, f"^{_TITLE}", 0)


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}[\p{L}'\-]*$"), "cyrillic").when(word.rlike(r"\p{IsGreek}[\p{L}'\-]*$"), "greek").otherwise("latin")


def canonical_of(kind: Column, mention: Column) -> Column:
    """Lower case for addresses, letters and digits alone for numbers.

    A phone number is its digits; with a country other than 1 that country, a hyphen and the national digits, without or with country 1 the last ten.
    """
    plain = F.regexp_replace(mention, "[^A-Za-z0-9]", "")
    country = F.regexp_extract(mention, r"^\+(\d+)", 1)
    national = F.substring(plain, F.greatest(F.length(plain) - 9, F.lit(1)), F.lit(10))
    abroad = F.concat(country, F.lit("-"), F.substring(plain, F.length(country) + 1, F.length(plain)))
    phone = F.when((country != "") & (country != "1") & (F.length(country) <= 3), abroad).otherwise(national)
    return F.when(kind == "email", F.lower(mention)).when(kind == "ip", mention).when(kind == "phone", phone).otherwise(plain)


def _words(mention: Column) -> Column:
    """The words of a name after its titles."""
    return F.split(F.substring(mention, F.length(_title(mention)) + 1, F.length(mention)), " ", -1)


def entities_of(kind: Column, mention: Column) -> Column:
    """array<struct<part, kind, canonical, gender>> of a mention: one entity, or the family and the given names of a name.

    ``part``: ``whole``, ``family``, or ``given`` with the number of the word. Initials are no entities.
    """
    title = _title(mention)
    gender = F.when(title.rlike(rf"^(?:{_FEMALE})\.? "), "f").when(title.rlike(rf"^(?:{_MALE})\.? "), "m")
    entity = lambda part, kind, canonical, gender: F.struct(part.alias("part"), kind.alias("kind"), canonical.alias("canonical"), gender.cast("string").alias("gender"))
    words = _words(mention)
    last = F.element_at(words, -1)
    family = entity(F.lit("family"), F.concat(F.lit("family_"), _script(last)), F.lower(last), F.lit(None))
    one = lambda w, k: F.when((k < F.size(words) - 1) & ~w.endswith("."), entity(F.concat(F.lit("given"), k.cast("string")), F.concat(F.lit("given_"), _script(w)), F.lower(w), gender))
    given = F.array_compact(F.transform(words, one))
    return F.when(kind != "name", F.array(entity(F.lit("whole"), kind, canonical_of(kind, mention), F.lit(None)))).otherwise(F.concat(F.array(family), given))


def _byte(seed: Column, i: Column | int) -> Column:
    """The i-th byte of a digest in hex, counted around."""
    at = F.pmod(i if isinstance(i, Column) else F.lit(i), F.lit(32)) * 2 + 1
    return F.conv(F.substring(seed, at, F.lit(2)), 16, 10).cast("int")


def _pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.lit(values), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))


def _shape(text: Column, seed: Column, keep: Column | int = 0) -> Column:
    """Digits to digits and letters to letters, but for the first ``keep`` characters."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(seed, i)
        return (
            F.when(i < keep, c)
            .when(c.rlike("[0-9]"), F.pmod(b, F.lit(10)).cast("string"))
            .when(c.rlike("[a-z]"), F.char(F.lit(97) + F.pmod(b, F.lit(26))))
            .when(c.rlike("[A-Z]"), F.char(F.lit(65) + F.pmod(b, F.lit(26))))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def luhn_digit(digits: Column) -> Column:
    """The check digit that follows ``digits``."""
    each = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.pmod(-F.aggregate(each, F.lit(0), lambda a, x: a + x), F.lit(10)).cast("string")


#: Attempts at an entity's own length.
SAME = 3


def _more(seed: Column, attempt: Column, values: list[str]) -> Column:
    """One of ``values`` for each attempt after the first ``SAME``."""
    each = F.transform(F.sequence(F.lit(0), F.greatest(attempt - SAME, F.lit(0))), lambda i: F.when(i > 0, _pick(values, _byte(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256), 0))).otherwise(""))
    return F.array_join(each, "")


def surrogate(kind: Column, canonical: Column, gender: Column, attempt: Column, key: str) -> Column:
    """An entity's canonical surrogate at an attempt."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), canonical), 256)
    local = F.substring_index(canonical, "@", 1)
    host = F.array_join(F.transform(F.sequence(F.lit(20), F.lit(27)), lambda i: F.char(F.lit(97) + F.pmod(_byte(seed, i), F.lit(26)))), "")
    letters, digits = _more(seed, attempt, [chr(97 + i) for i in range(26)]), _more(seed, attempt, [str(i) for i in range(10)])
    email = F.concat(_shape(local, seed), F.lit("@"), host, letters, F.lit(".example"))
    n = F.length(canonical)
    number = _shape(canonical, seed, 1)
    head = F.substring(number, F.lit(1), n - 1)
    valid = luhn_digit(F.substring(canonical, F.lit(1), n - 1)) == F.substring(canonical, n, F.lit(1))
    card = F.when(valid, F.concat(head, luhn_digit(head))).otherwise(number)
    ip = F.concat_ws(".", *(F.lit(1) + F.pmod(_byte(seed, i), F.lit(223 if i == 0 else 254)) for i in range(4)))
    out = F.when(kind == "email", email).when(kind == "card", card).when(kind == "ip", ip).when(kind == "iban", _shape(canonical, seed, 2))
    for script, by in GIVEN.items():
        family = F.concat(*(_pick(SYLLABLES[script], _byte(seed, i)) for i in range(2, 6)))
        first = {g: F.lower(_pick(names, _byte(seed, 1))) for g, names in by.items()}
        out = out.when(kind == f"family_{script}", family).when(kind == f"given_{script}", F.when(gender == "m", first["m"]).when(gender == "f", first["f"]).otherwise(first["u"]))
    # What stands before a hyphen of a phone number is its country, which stays.
    out = out.when(kind == "phone", _shape(canonical, seed, F.locate("-", canonical))).otherwise(_shape(canonical, seed))
    more = F.when(kind == "email", "").when(kind == "ip", F.concat(F.lit("."), digits))
    for script, syllables in SYLLABLES.items():
        more = more.when(kind.isin(f"family_{script}", f"given_{script}"), _more(seed, attempt, syllables))
    return F.when(attempt > SAME, F.concat(out, more.otherwise(digits))).otherwise(out)


def _written(kind: Column, mention: Column, new: Column, canonical: Column | None = None, given: Column | None = None) -> Column:
    """A canonical surrogate in a mention's own format; what a phone number has before its last ten digits stays.

    ``given``: array<struct<part, new>> of a name's given names; initials become letters that hang on the key and the family.
    """
    plain = F.when(kind == "phone", F.replace(new, F.lit("-"), F.lit(""))).otherwise(new)
    chars = F.filter(F.split(mention, ""), lambda c: c != "")
    own = F.lit("") if canonical is None else F.when(kind == "phone", F.replace(canonical, F.lit("-"), F.lit(""))).otherwise(canonical)
    kept = F.lit(0) if canonical is None else F.greatest(F.length(F.regexp_replace(mention, "[^A-Za-z0-9]", "")) - F.length(own), F.lit(0))
    nth = lambda i: F.length(F.regexp_replace(F.substring(mention, F.lit(1), i + 1), "[^A-Za-z0-9]", "")) - kept
    filled = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[A-Za-z0-9]") & (nth(i) > 0), F.substring(plain, nth(i), F.lit(1))).otherwise(c)), "")
    # What a grown surrogate has beyond the mention's format.
    filled = F.concat(filled, F.substring(plain, nth(F.length(mention)) + 1, F.length(plain)))
    words = _words(mention)
    rest = F.array_join(words, " ")
    letter = lambda w: F.concat(F.char(F.lit(65) + F.pmod(F.xxhash64(new, w), F.lit(26))), F.lit("."))
    of = lambda k: F.filter(given, lambda g: g["part"] == F.concat(F.lit("given"), k.cast("string")))
    first = lambda w, k: F.when(w.endswith("."), letter(w)) if given is None else F.when(w.endswith("."), letter(w)).otherwise(F.get(of(k), 0)["new"])
    written = F.transform(words, lambda w, k: F.when(k == F.size(words) - 1, F.initcap(new)).otherwise(F.initcap(first(w, k))))
    name = F.array_join(written, " ")
    name = F.concat(_title(mention), F.when((rest == F.upper(rest)) & (F.length(rest) > 2), F.upper(name)).otherwise(name))
    return F.when(kind.isin("email", "ip"), new).when(kind == "name", name).otherwise(filled)


def _hint(text: Column) -> Column:
    """Whether a text may have a mention: cheaper than the pattern."""
    return F.coalesce(text.rlike(HINTS[0]) | text.rlike(HINTS[1]), F.lit(False))


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, idx, mention, kind) of every mention; ``key`` is a hash of the text."""
    text = named(text_col).cast("string")
    rows = docs.filter(_hint(text)).select(named(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("key"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)).alias("m"))
    each = rows.select("id", "key", F.posexplode("m").alias("idx", "mention"))
    return each.withColumn("kind", kind_of(F.col("mention")))


def space_of(kind: Column) -> Column:
    """What surrogates must be distinct in: all families, all given names, or a kind."""
    return F.when(kind.startswith("family_"), "family").when(kind.startswith("given_"), "given").otherwise(kind)


def assign(entities: DataFrame, key: str, rounds: int = 200) -> DataFrame:
    """(kind, canonical, new): distinct surrogates for distinct entities (kind, canonical[, gender]), none of them an entity.

    Each attempt after the first few multiplies the space by a syllable, a letter or a digit, so that the
    rounds follow the logarithm of the number of entities.
    """
    gender = F.col("gender") if "gender" in entities.columns else F.lit(None).cast("string")
    # A given name has a gender if all titles that tell one agree.
    lo, hi = F.min(gender), F.max(gender)
    entities = cut(entities.groupBy("kind", "canonical").agg(F.when(lo == hi, lo).alias("gender")))
    space = space_of(F.col("kind")).alias("space")
    # What a surrogate must not be: an entity of the corpus, or a surrogate given before.
    taken = entities.select(space, F.col("canonical").alias("new")).distinct()
    todo, done = entities, []
    for attempt in range(rounds):
        drawn = todo.withColumn("new", surrogate(F.col("kind"), F.col("canonical"), F.col("gender"), F.lit(attempt), key)).withColumn("space", space)
        first = F.row_number().over(Window.partitionBy("space", "new").orderBy("kind", "canonical")) == 1
        drawn = drawn.withColumn("first", first).join(taken.withColumn("taken", F.lit(True)), ["space", "new"], "left")
        drawn = cut(drawn.select("kind", "canonical", "gender", "space", "new", (F.col("first") & F.col("taken").isNull()).alias("ok")))
        done.append(drawn.filter("ok").select("kind", "canonical", "new"))
        todo = drawn.filter("not ok").select("kind", "canonical", "gender")
        if todo.isEmpty():
            return reduce(DataFrame.unionByName, done)
        taken = cut(taken.unionByName(drawn.filter("ok").select("space", "new")))
    raise RuntimeError(f"surrogates still collide after {rounds} attempts")


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] = ("__entities", "__kinds")) -> DataFrame:
    """The documents with surrogates; ``counts`` names two columns: the number of mentions, and their kinds.

    Where the documents have a column of such a name, the count's name gets an underscore more.
    """
    rows, (i, t) = by_place(docs, id_col, text_col)
    text = F.col(t).cast("string")
    found = cut(mentions(rows, i, t))
    parts = found.select("id", "key", "idx", "mention", F.col("kind").alias("of"), F.explode(entities_of(F.col("kind"), F.col("mention"))).alias("e"))
    parts = parts.select("id", "key", "idx", "mention", "of", "e.*")
    mapping = assign(parts.select("kind", "canonical", "gender"), key)
    placed = parts.join(mapping, ["kind", "canonical"])
    # A name's parts side by side again; all others are alone. A family alone in its mention has no given names.
    is_given = F.col("part").startswith("given")
    given = F.collect_list(F.when(is_given, F.struct("part", "new")))
    main = F.when(~is_given, F.col("new"))
    one = placed.groupBy("id", "key", "idx").agg(F.first("mention").alias("mention"), F.first("of").alias("of"), F.max(main).alias("new"), given.alias("given"), F.max(F.when(~is_given, F.col("canonical"))).alias("canonical"))
    one = one.select("id", "key", "of", F.struct("idx", _written(F.col("of"), F.col("mention"), F.col("new"), F.col("canonical"), F.col("given")).alias("new")).alias("one"))
    by_row = one.groupBy(F.col("id").alias("__id"), F.col("key").alias("__key")).agg(F.array_sort(F.collect_list("one")).alias("__new"), F.array_sort(F.collect_set("of")).alias("__kinds"))
    clean = rows.filter(~_hint(text)).withColumns({"__entities": F.lit(0).cast("bigint"), "__kinds": F.lit("")})
    joined = rows.filter(_hint(text)).join(by_row, (F.xxhash64(text) == F.col("__key")) & F.col(i).cast("bigint").eqNullSafe(F.col("__id")), "left")
    written = F.zip_with(F.split(text, PATTERN, -1), F.concat(F.col("__new.new"), F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    names = [F.col(c) if c != t else F.when(F.col("__new").isNull(), F.col(t)).otherwise(F.array_join(written, "")).alias(t) for c in rows.columns]
    out = joined.select(*names, F.coalesce(F.size("__new"), F.lit(0)).cast("bigint").alias("__entities"), F.coalesce(F.array_join("__kinds", ","), F.lit("")).alias("__kinds"))
    return out.unionByName(clean).toDF(*docs.columns, *unused(docs, *counts))
