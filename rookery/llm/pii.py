"""PII surrogates: detected entities get keyed replacements of the same type.

A mention is found by pattern; its core (letters and digits, in one case) names
the entity, so all mentions of it, in any format, get the same surrogate: a phone
is its number without the country code, which stays as it is written, and a name
is two entities, the given name (with its gender) and the family name. So "Mr.
John Smith" and "Mr. Smith" share a surname afterwards, and in a document that
names a person with a title, the bare given or family name follows.

The surrogate's characters come from SHA-256 of key, type, core and a counter;
they keep the character classes (digit for digit, letter for letter, hexadecimal
for hexadecimal; vowels and consonants in names), the script and the mention's
separators. Cards keep their first digit and a right check digit, e-mails move to
the reserved domain example.com, access keys keep their prefix, names their title,
a given name of the title's gender, the script and (in Cyrillic) the ending.

Collision checks over all entities of the corpus: two entities with one
surrogate, or a surrogate that is itself an entity of the corpus, raise the
counter of one of them, round after round, until none is left; names grow by a
syllable when short ones are used up. So different entities stay different.

DataFrame functions only. The long pattern runs once over each text, which is
written as pieces, alternately plain and found. Entities are joined to their
mentions, not broadcast; a frequent entity is one row of the mapping, and adaptive
execution splits its mentions. Texts without an entity are not shuffled.

Defined results: a null text stays null; a text without entities is unchanged;
repeated rows get the same text; 13 to 19 digits count as a card only if their
check digit is right; an empty table gives an empty result; an input column
named like the count is replaced, and other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.session import cut_lineage

MOST_ROUNDS = 200    # of raised counters; beyond, the entities fill their format
MARK = "\uE000\uE001"  # set around mentions to cut a text; one that holds it is cut by a second pass

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
MALE, FEMALE = r"Mr|Herr|Señor|Monsieur|Господин", r"Mrs|Ms|Miss|Frau|Señora|Madame|Госпожа"
SECRET_KEY = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
#: Type and pattern, in the order in which they are tried.
PATTERNS = [
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"),
    ("secret", r"(?<![\p{L}\p{N}])" + SECRET_KEY + r"[A-Za-z0-9/+_-]{8,}"),
    ("access_key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("phone", r"(?<![\d+])\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
              r"|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])|(?<![\d+])\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)"),
    ("national_id", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", r"(?<![\p{L}\d])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7})(?![\p{L}\d])"),
    ("ip", r"(?<![\d.])(?:" + OCTET + r"\.){3}" + OCTET + r"(?!\d|\.\d)"),
    ("name", r"(?<!\p{L})(?:" + MALE + "|" + FEMALE + r")\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?"),
]
ANY = "|".join(p for _, p in PATTERNS)
TITLE = r"^(?:" + MALE + "|" + FEMALE + r")\.? "
#: Words that may repeat a name, in documents with one.
WORD = r"(?<!\p{L})\p{Lu}\p{Ll}+(?!\p{L})"
#: Digits of a phone's country code.
COUNTRY = r"^\+?(\d{1,3})[ .-]?\(|^\+(\d{1,3})[ .-]"
#: A text without any of these has no entity: each pattern needs one of them.
QUICK = r"[\d@]|(?i:pass|pwd|secret|token|api)|AKIA|ASIA|(?:" + MALE + "|" + FEMALE + r")\.? "

# Given names to draw from, by script and gender.
GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Jonas", "Leo", "Martin", "Oscar", "Paul", "Robert", "Simon", "Victor"],
    ("latin", "f"): ["Alice", "Bella", "Clara", "Diana", "Emma", "Flora", "Helena", "Julia", "Laura", "Maria", "Nora", "Olivia", "Paula", "Rosa", "Sara"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Иван", "Кирилл", "Максим", "Олег", "Павел"],
    ("cyrillic", "f"): ["Алла", "Вера", "Дарья", "Елена", "Жанна", "Ирина", "Лидия", "Мария", "Ольга", "Софья"],
}
CLASSES = [("0", "9", "0123456789"), ("a", "z", "abcdefghijklmnopqrstuvwxyz"), ("A", "Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
           ("а", "я", "абвгдежзиклмнопрстуфхц"), ("А", "Я", "АБВГДЕЖЗИКЛМНОПРСТУФХЦ")]
# Lower-case vowels and consonants by script; those drawn from.
SOUNDS = [("[aeiouyäöüáéíóúàèâêîôûãõåæø]", "aeiou"), ("[bcdfghjklmnpqrstvwxzßçñš]", "bcdfghklmnprstvw"),
          ("[аеёиоуыэюя]", "аеиоу"), ("[бвгджзйклмнпрстфхцчшщъь]", "бвгдзклмнпрст")]
HEX = [("0", "9", "0123456789"), ("a", "f", "abcdef"), ("A", "F", "ABCDEF")]


def type_of(mention: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS):
        out = F.when(mention.rlike(rf"^(?:{pattern})$"), name).otherwise(out)
    return out


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _luhn(digits: Column, odd_doubles: bool) -> Column:
    """Sum of the digits, every other one doubled; counted from the right, the
    second and so on (or, if ``odd_doubles``, the first and so on)."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda x, i: F.when(
        (i % 2 == (0 if odd_doubles else 1)), F.when(x.cast("int") > 4, x.cast("int") * 2 - 9).otherwise(x.cast("int") * 2))
        .otherwise(x.cast("int")))
    return F.aggregate(F.filter(d, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x)


def core_of(kind: Column, mention: Column) -> Column:
    """What names the entity; null for what is no entity after all."""
    number = _digits(mention)
    return (F.when(kind == "email", F.lower(mention))
            .when(kind == "secret", F.regexp_replace(mention, "^" + SECRET_KEY, ""))
            .when(kind == "card", F.when(F.length(number).between(13, 19) & (_luhn(number, False) % 10 == 0), number))
            .when(kind == "phone", F.substring(number, country_of(kind, mention) + 1, F.length(number)))
            .when(kind == "national_id", number)
            .otherwise(mention))


def country_of(kind: Column, mention: Column) -> Column:
    """Digits of a phone's country code, which stay; else 0."""
    code = F.concat(F.regexp_extract(mention, COUNTRY, 1), F.regexp_extract(mention, COUNTRY, 2))
    return F.when(kind == "phone", F.length(code)).otherwise(F.lit(0))


def parts_of(kind: Column, mention: Column) -> Column:
    """The entities of a mention: ``pos, kind, core``; a name's given name has its
    gender before it. None for what is no entity after all."""
    title = F.regexp_extract(mention, TITLE, 0)
    words = F.split(F.substring(mention, F.length(title) + 1, F.length(mention)), " ")
    gender = F.when(mention.rlike("^(?:" + FEMALE + r")\.? "), "f ").otherwise("m ")
    part = lambda pos, k, core: F.struct(F.lit(pos).alias("pos"), k.alias("kind"), core.alias("core"))
    name = F.array(F.when(F.size(words) > 1, part(1, F.lit("given"), F.concat(gender, F.element_at(words, 1)))),
                   part(2, F.lit("family"), F.element_at(words, -1)))
    return F.filter(F.when(kind == "name", name).otherwise(F.array(part(1, kind, core_of(kind, mention)))), lambda x: x["core"].isNotNull())


def _stream(key: str, kind: Column, core: Column, counter: Column) -> Column:
    """Numbers below 65536, at least one a character of the core and 16 more."""
    blocks = F.sequence(F.lit(0), F.ceil((F.length(core) + 16) / 16).cast("int"))
    text = F.array_join(F.transform(blocks, lambda b: F.sha2(
        F.concat_ws("\u0000", F.lit(key), kind, core, counter.cast("string"), b.cast("string")), 256)), "")
    n = F.length(core) + 16
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.conv(F.substring(text, i * 4 + 1, F.lit(4)), 16, 10).cast("int"))


def _mapped(core: Column, numbers: Column, classes: list[tuple[str, str, str]]) -> Column:
    """Each character replaced by one of its class."""
    def one(c: Column, i: Column) -> Column:
        v = F.element_at(numbers, i + 1)
        out = c
        for low, high, pool in reversed(classes):
            out = F.when((c >= low) & (c <= high), F.substring(F.lit(pool), v % len(pool) + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.filter(F.split(core, ""), lambda c: c != ""), one), "")


def _named(word: Column, numbers: Column) -> Column:
    """A word of the same length and case whose vowels and consonants are others."""
    def one(c: Column, i: Column) -> Column:
        low, v = F.lower(c), F.element_at(numbers, i + 1)
        out = low
        for sounds, pool in SOUNDS:
            out = F.when(low.rlike(sounds), F.substring(F.lit(pool), v % len(pool) + 1, F.lit(1))).otherwise(out)
        return F.when(c != low, F.upper(out)).otherwise(out)

    return F.array_join(F.transform(F.filter(F.split(word, ""), lambda c: c != ""), one), "")


def surrogate_of(kind: Column, core: Column, s: Column, counter: Column) -> Column:
    """Core of the surrogate; ``s``: the entity's numbers."""
    plain = _mapped(core, s, CLASSES)
    local = _mapped(F.regexp_replace(core, "@.*$", ""), s, CLASSES)
    host = _mapped(F.regexp_extract(core, r"@([^.]*)", 1), F.slice(s, 14, F.length(core)), CLASSES)
    card = F.concat(F.substring(core, 1, 1), F.substring(plain, F.lit(2), F.length(core) - 2))
    check = ((F.lit(10) - _luhn(card, True) % 10) % 10).cast("string")
    octets = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (F.element_at(s, i) % 223 + 1).cast("string")), ".")
    female, cyrillic = F.startswith(core, F.lit("f ")), core.rlike(r"\p{IsCyrillic}")
    more = F.floor(counter / 4).cast("int")  # syllables added once the short names are used up

    def syllables(vowels: str, consonants: str) -> Column:
        at = F.sequence(F.lit(1), more)
        both = F.transform(at, lambda i: F.concat(
            F.substring(F.lit(consonants), F.element_at(s, -(i % 5) - 1) % len(consonants) + 1, F.lit(1)),
            F.substring(F.lit(vowels), F.element_at(s, -(i % 5) - 6) % len(vowels) + 1, F.lit(1))))
        return F.when(more > 0, F.array_join(both, "")).otherwise(F.lit(""))

    extra = F.when(cyrillic, syllables(SOUNDS[2][1], SOUNDS[3][1])).otherwise(syllables(SOUNDS[0][1], SOUNDS[1][1]))
    mapped = _named(core, s)
    family = F.when(cyrillic & (F.length(core) > 3), F.concat(F.substring(mapped, F.lit(1), F.length(core) - 2), extra, F.substring(core, -2, 2))).otherwise(
        F.concat(mapped, extra))

    def given(script: str, gender: str) -> Column:
        pool = GIVEN[script, gender]
        return F.element_at(F.array(*[F.lit(x) for x in pool]), F.element_at(s, 1) % len(pool) + 1)

    first = F.when(cyrillic, F.when(female, given("cyrillic", "f")).otherwise(given("cyrillic", "m"))).otherwise(
        F.when(female, given("latin", "f")).otherwise(given("latin", "m")))
    return (F.when(kind == "email", F.concat(local, F.lit("@"), host, F.lit(".example.com")))
            .when(kind == "card", F.concat(card, check))
            .when(kind == "ip", octets)
            .when(kind == "national_id", F.concat(F.lit("9"), F.substring(plain, F.lit(2), F.length(core))))
            .when(kind == "access_key", F.concat(F.substring(core, 1, 4), F.substring(plain, F.lit(5), F.length(core))))
            .when(kind == "secret", F.when(core.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), _mapped(core, s, HEX)).otherwise(plain))
            .when(kind == "given", F.concat(F.substring(core, 1, 2), first, extra))
            .when(kind == "family", family)
            .otherwise(plain))


def written(kind: Column, mention: Column, core: Column) -> Column:
    """The surrogate in the mention's format."""
    chars = F.filter(F.split(mention, ""), lambda c: c != "")
    skipped = country_of(kind, mention)

    def put(acc: Column, c: Column) -> Column:
        """Digits of the mention taken from the core, but for the country code's."""
        digit = (c >= "0") & (c <= "9")
        n = acc["n"] + F.when(digit, 1).otherwise(0)
        out = F.when(digit & (n > skipped), F.substring(core, n - skipped, F.lit(1))).otherwise(c)
        return F.struct(n.cast("int").alias("n"), F.concat(acc["s"], out).alias("s"))

    filled = F.aggregate(chars, F.struct(F.lit(0).alias("n"), F.lit("").alias("s")), put, lambda a: a["s"])
    loud = (mention == F.upper(mention)) & (mention != F.lower(mention))
    return (F.when(kind.isin("phone", "card", "national_id"), filled)
            .when(kind == "secret", F.concat(F.regexp_extract(mention, "^" + SECRET_KEY, 0), core))
            .when(kind == "email", F.when(loud, F.upper(core)).otherwise(core))
            .when(kind == "given", F.substring(core, F.lit(3), F.length(core)))
            .otherwise(core))


def entity_map(entities: DataFrame, key: str) -> DataFrame:
    """``kind, core, surrogate`` for each entity (``kind, core``, distinct).

    The entities are dealt out evenly first: few bytes, but much work each. An
    entity's numbers are a column of their own, made once."""
    kind, core = F.col("kind"), F.col("core")
    parts = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by a hash of its own, as a partitioning that is there already would be packed by bytes
    entities = cut_lineage(entities.select("kind", "core").withColumn("deal", F.xxhash64("kind", "core")).repartition(parts, "deal").drop("deal"))

    def draw(df: DataFrame) -> DataFrame:
        df = df.withColumn("__numbers", _stream(key, kind, core, F.col("counter")))
        return df.withColumn("surrogate", surrogate_of(kind, core, F.col("__numbers"), F.col("counter"))).drop("__numbers")

    current = cut_lineage(draw(entities.withColumn("counter", F.lit(0))))
    for _ in range(MOST_ROUNDS):
        first = current.groupBy("kind", "surrogate").agg(F.min(F.struct("counter", "core")).alias("first"), F.count(F.lit(1)).alias("n"))
        clash = (current.join(first.where("n > 1"), ["kind", "surrogate"])
                 .where(F.struct("counter", "core") != F.col("first")).select("kind", "core"))
        real = (current.join(entities.select("kind", F.col("core").alias("surrogate")), ["kind", "surrogate"], "left_semi")
                .select("kind", "core"))
        again = cut_lineage(clash.union(real).distinct().withColumn("again", F.lit(1)))
        if again.isEmpty():
            return current.select("kind", "core", "surrogate")
        raised = current.join(again, ["kind", "core"], "left")
        moved = draw(raised.where("again = 1").select("kind", "core", (F.col("counter") + 1).alias("counter")))
        current = cut_lineage(raised.where("again IS NULL").drop("again").unionByName(moved))
    raise ValueError("surrogates still collide; the entities fill their format")


def pieces_of(text: Column, pattern: str) -> Column:
    """The text cut at the pattern's matches: plain, match, plain, and so on."""
    marked = F.split(F.regexp_replace(text, "(" + pattern + ")", MARK + "$1" + MARK), MARK, -1)
    plain, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    twice = F.flatten(F.zip_with(plain, found, lambda p, m: F.array_compact(F.array(p, m))))
    return F.when(text.contains(MARK[0]), twice).otherwise(marked)


def replace_pii(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_entities") -> DataFrame:
    """All rows and columns with the text's entities replaced, and their count."""
    names = [c for c in df.columns if c.lower() != count_col.lower()]
    at = {c: f"c{i}" for i, c in enumerate(names)}  # own names would clash with some
    rows = df.select(*[F.col(f"`{c}`").alias(at[c]) for c in names])
    text, ident = F.col(at[text_col]), F.col(at[id_col])
    may = F.coalesce(text.rlike(QUICK), F.lit(False))
    cut = F.when(may, pieces_of(text, ANY))
    rows = rows.withColumn("pieces", cut).withColumn("pieces", F.when(F.size("pieces") > 1, F.col("pieces")))
    # where a person is named, words that may repeat the name are pieces too
    odd = lambda x, i: i % 2 == 1
    named = F.exists(F.filter("pieces", odd), lambda x: x.rlike(TITLE))
    finer = F.flatten(F.transform("pieces", lambda x, i: F.when(i % 2 == 1, F.array(x)).otherwise(pieces_of(x, WORD))))
    rows = cut_lineage(rows.withColumn("pieces", F.when(named, finer).otherwise(F.col("pieces"))))
    some = rows.where("pieces IS NOT NULL").withColumn("check", F.xxhash64(text))
    mentions = cut_lineage(
        some.select(ident.alias("id"), "check", F.explode(F.array_distinct(F.filter("pieces", odd))).alias("mention"))
        .withColumn("kind", type_of(F.col("mention"))).where("kind IS NOT NULL")
        .select("id", "check", "mention", F.explode(parts_of(F.col("kind"), F.col("mention"))).alias("part"))
        .select("id", "check", "mention", "part.*"))
    mapping = entity_map(mentions.select("kind", "core").distinct(), key)
    drawn = mentions.join(mapping, ["kind", "core"]).withColumn("as", written(F.col("kind"), F.col("mention"), F.col("surrogate")))
    whole = (drawn.groupBy("id", "check", "mention").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "as"))), lambda x: x["as"]), " ").alias("as"))
             .select("id", "check", "mention", F.concat(F.regexp_extract("mention", TITLE, 0), "as").alias("as")))
    # a name without its title; of a man's and a woman's given name the least
    bare = (drawn.where(F.col("kind").isin("given", "family"))
            .select("id", "check", F.when(F.col("kind") == "given", F.substring("core", F.lit(3), F.length("core"))).otherwise(F.col("core")).alias("mention"), "kind", "as")
            .groupBy("id", "check", "mention").agg(F.min(F.struct("kind", "as")).alias("first")).select("id", "check", "mention", "first.as"))
    replaced = (whole.unionByName(bare).groupBy("id", "check")
                .agg(F.map_from_entries(F.collect_list(F.struct("mention", "as"))).alias("map"))
                .select(F.col("id").alias("found_id"), F.col("check").alias("found_check"), "map"))
    joined = some.join(replaced, ident.eqNullSafe(F.col("found_id")) & (F.col("check") == F.col("found_check")), "left")
    new = F.array_join(F.transform("pieces", lambda x, i: F.when(i % 2 == 1, F.coalesce(F.element_at(F.col("map"), x), x)).otherwise(x)), "")
    known = F.size(F.filter("pieces", lambda x, i: (i % 2 == 1) & F.map_contains_key(F.col("map"), x)))
    with_map = F.col("map").isNotNull()
    own = [F.when(with_map, new).otherwise(text).alias(at[c]) if c == text_col else F.col(at[c]) for c in names]
    done = joined.select(*own, F.when(with_map, known).otherwise(0).cast("long").alias("n"))
    none = rows.where("pieces IS NULL").select(*at.values(), F.lit(0).cast("long").alias("n"))
    return done.unionByName(none).toDF(*names, count_col)
