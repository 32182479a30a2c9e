"""Personal data replaced by surrogates, in DataFrame operations alone.

Detected entities get keyed replacements of their own type and form: digits for digits in the same layout,
card numbers that pass or fail the check sum as before, names of the same gender and script. A replacement
follows from the key, the type and the entity's identity (an address without case, a number without layout,
a name word by itself), so one person or number is replaced alike in every document and spelling; a phone
number's country is told by its calling code, whatever separates it. Over the whole corpus no two identities
of a type may share a replacement, and none may be another's original; those that do are derived again with
the next attempt until none is left.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import picked, stored

# Titles by gender (m, f, none) in the languages served.
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа"),
    "n": ("Dr", "Prof", "Capt", "Rev"),
}
NO_WORD_BEFORE = r"(?<![\p{L}\p{N}])"
# A mark belongs to the word if a letter follows, but for a possessive 's. Scripts without case have no capitals.
NAME_WORD = r"[\p{Lu}\p{Lo}](?:[\p{L}\p{M}]|['’-](?=\p{L})(?![sS](?!\p{L})))++"
MENTION = NO_WORD_BEFORE + NAME_WORD
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}(?<![.-])",
    "iban": NO_WORD_BEFORE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![\p{L}\p{N}])",
    "card": NO_WORD_BEFORE + r"(?:\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -]?)\d{6}\2\d{5})(?![\p{L}\p{N}])",
    "ssn": NO_WORD_BEFORE + r"\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}+])\+\d{9,14}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}+])(?:\+\d{1,3} ?\(0\) ?\d{2,4}|\+\d{1,3}[ .-]\d{2,4}|\(?0\d{2,4}\)?)[ ./-]\d{5,8}(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{L}\p{N}.])(?:" + OCTET + r"\.){3}" + OCTET + r"(?!\.?[\p{L}\p{N}])",
    # Eight groups, or fewer around one gap; three colons and a digit at least, which names of program scopes have not.
    "ip6": r"(?<![\p{L}\p{N}:.])(?=(?:[0-9A-Fa-f]*:){3})(?=[A-Fa-f:]*[0-9])"
           r"(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
           r"|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\p{L}\p{N}:])",
    "name": NO_WORD_BEFORE + "(?:" + "|".join(t for own in TITLES.values() for t in own) + rf")\.? {NAME_WORD}(?: {NAME_WORD})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

# What surrogate names are made of, by script.
LATIN = {
    "syllables": ("ba", "de", "ki", "lo", "mu", "ne", "po", "ra", "si", "tu", "va", "ze", "fo", "ga", "hi", "jo"),
    "m": ("n", "rd", "s", "ro"), "f": ("a", "na", "lia", "ine"), "n": ("y", "en", "is", "el"), "family": ("ton", "man", "sen", "field"),
    "letters": "abcdefghijklmnopqrstuvwxyz",
}
CYRILLIC = {
    "syllables": ("ба", "де", "ки", "ло", "му", "не", "по", "ра", "си", "ту", "ва", "зе", "фо", "га", "хи", "жо"),
    "m": ("н", "р", "слав", "мир"), "f": ("а", "на", "ия", "ина"), "n": ("я", "ша", "ни", "ля"), "family": ("енко", "ук", "ых", "ян"),
    "letters": "абвгдежзиклмнопрстуфхцчшэюя",
}
GREEK = {
    "syllables": ("βα", "δε", "κι", "λο", "μυ", "νε", "πο", "ρα", "σι", "τυ", "φα", "ζε", "χο", "γα", "θι", "ξο"),
    "m": ("ς", "νος", "ρης", "κος"), "f": ("α", "να", "λια", "νη"), "n": ("ω", "ρι", "λι", "τη"), "family": ("ιδης", "ακης", "οπουλος", "ου"),
    "letters": "αβγδεζηθικλμνξοπρστυφχψω",
}
ARABIC = {
    "syllables": ("با", "دي", "كي", "لو", "مو", "ني", "بو", "را", "سي", "تو", "فا", "زي", "حا", "جا", "هي", "شو"),
    "m": ("د", "ر", "م", "ن"), "f": ("ة", "اء", "ى", "ين"), "n": ("ي", "و", "ا", "ل"), "family": ("اني", "اوي", "ري", "لي"),
    "letters": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
}
HEBREW = {
    "syllables": ("בא", "דה", "קי", "לו", "מו", "נה", "פו", "רא", "סי", "טו", "וא", "זה", "חו", "גא", "הי", "יו"),
    "m": ("ן", "ר", "ד", "ל"), "f": ("ה", "ית", "נה", "לה"), "n": ("י", "ו", "א", "ת"), "family": ("זון", "מן", "ברג", "אלי"),
    "letters": "אבגדהוזחטיכלמנסעפצקרשת",
}
SCRIPTS = {r"\p{IsCyrillic}": CYRILLIC, r"\p{IsGreek}": GREEK, r"\p{IsArabic}": ARABIC, r"\p{IsHebrew}": HEBREW}
# The country calling codes in use or reserved; none is the beginning of another.
CALLING_CODE = (r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
                r"|2[1-689]\d|3[578]\d|42\d|5[09]\d|6[7-9]\d|8[03578]\d|9[679]\d")
MOST_ATTEMPTS = 30


def by_script(text: Column, choose: Callable[[dict], Column]) -> Column:
    """What ``choose`` makes of the script of the first character, Latin where the script is no other of ours."""
    cases = reduce(lambda case, own: case.when(text.rlike(f"^{own}"), choose(SCRIPTS[own])), list(SCRIPTS)[1:],
                   F.when(text.rlike(f"^{list(SCRIPTS)[0]}"), choose(CYRILLIC)))
    return cases.otherwise(choose(LATIN))


def may_hold_entities(text: Column) -> Column:
    """Whether a text has what every pattern needs somewhere: a digit, an at sign, or a title. Far cheaper
    than the patterns, and most texts go no further."""
    titles = [text.contains(t) for own in TITLES.values() for t in own]
    return reduce(Column.__or__, titles, text.rlike("[0-9@]"))


def kind_of(entity: Column) -> Column:
    """The first pattern that is the whole entity, in the order in which they were looked for."""
    kinds = [F.when(entity.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()]
    return F.coalesce(*kinds, F.lit("name"))


def pieces_of(entity: Column, kind: Column) -> Column:
    """What is replaced one by one: (kind, identity, gender, surface); a name is its title and words."""
    def piece(kind: Column, identity: Column, gender: Column, surface: Column) -> Column:
        return F.struct(kind.alias("kind"), identity.alias("identity"), gender.alias("gender"), surface.alias("surface"))

    none = F.lit(None).cast("string")
    digits = F.regexp_replace(F.regexp_replace(entity, r"\(0\)", ""), "[^0-9]", "")
    country = F.when(entity.startswith("+"), F.regexp_extract(digits, f"^(?:{CALLING_CODE})", 0)).otherwise("")
    rest = F.substring(digits, F.length(country) + 1, 100)
    identity = (
        F.when(kind.isin("email", "ip6"), F.lower(entity)).when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "phone", F.concat(country, F.lit(":"), rest)).when(kind == "ip", entity).otherwise(digits))
    words = F.split(entity, " ")
    title = F.regexp_replace(words[0], r"\.$", "")
    gender = F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f").otherwise("n")
    number = F.size(words)
    named = F.transform(words, lambda w, i: piece(
        F.when(i == 0, none).when(i == number - 1, F.lit("family")).otherwise(F.lit("given")), F.lower(w), gender, w))
    return F.when(kind == "name", named).otherwise(F.array(piece(kind, identity, none, entity)))


def byte_at(digest: Column, i: Column) -> Column:
    return F.conv(F.substring(digest, (i * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def of_list(values: tuple[str, ...] | str, number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.pmod(number, F.lit(len(values))) + 1)


def reshaped(text: Column, digest: Column) -> Column:
    """Each digit and letter changed for a keyed one of its kind, case and script; the rest stays."""
    def change(c: Column, i: Column) -> Column:
        number = byte_at(digest, F.pmod(i, F.lit(64)))
        letter = by_script(c, lambda script: of_list(script["letters"], number))
        return (F.when(c.rlike("^[0-9]$"), F.pmod(number, F.lit(10)).cast("string"))
                .when(c.rlike(r"^\p{Lu}$"), F.upper(letter)).when(c.rlike(r"^\p{L}$"), letter).otherwise(c))

    return F.array_join(F.transform(F.split(text, ""), change), "")


def luhn(digits: Column) -> Column:
    """The check sum of a card number, 0 if it passes."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.pmod(F.aggregate(doubled, F.lit(0), lambda a, d: a + d), F.lit(10))


def iban_rest(text: Column) -> Column:
    """The number that an account's characters, country behind them, leave modulo 97."""
    def step(a: Column, c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), (a * 10 + c.try_cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def replacement(key: str) -> Column:
    """The replacement of (kind, identity, gender, attempt), without layout."""
    kind, identity, attempt = F.col("kind"), F.col("identity"), F.col("attempt")
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, identity, attempt), 512)
    shaped = reshaped(identity, digest)
    body = F.concat(F.substring(identity, 1, 1), F.expr("substring(identity, 2, length(identity) - 2)"))
    body = F.concat(F.substring(identity, 1, 1), F.substring(reshaped(body, digest), 2, 100))
    good = F.pmod(10 - luhn(F.concat(body, F.lit("0"))), F.lit(10))
    last = F.when(luhn(identity) == 0, good).otherwise(F.pmod(good + 1 + F.pmod(byte_at(digest, F.lit(63)), F.lit(9)), F.lit(10)))
    country, account = F.substring(identity, 1, 2), F.substring(shaped, 5, 100)
    rest = 98 - iban_rest(F.concat(account, country, F.lit("00")))
    prefix = F.substring_index(identity, ":", 1)
    local, domain = F.substring_index(shaped, "@", 1), F.substring_index(identity, "@", -1)
    longer = F.substring(F.sha2(digest, 256), F.lit(1), F.greatest(F.lit(0), attempt - 3))
    host = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 256), 1, 12)

    def word(script: dict, ending: Column) -> Column:
        syllables = F.transform(F.sequence(F.lit(0), attempt + 1), lambda i: of_list(script["syllables"], byte_at(digest, F.pmod(i, F.lit(60)))))
        return F.initcap(F.concat(F.array_join(syllables, ""), ending))

    def ending(script: dict) -> Column:
        number, gender = byte_at(digest, F.lit(62)), F.col("gender")
        return (F.when(kind == "family", of_list(script["family"], number)).when(gender == "m", of_list(script["m"], number))
                .when(gender == "f", of_list(script["f"], number)).otherwise(of_list(script["n"], number)))

    groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.substring(digest, (i * 4 + 1).cast("int"), F.lit(4))), ":")
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.pmod(byte_at(digest, i), F.lit(254)) + 1).cast("string")), ".")
    return (
        F.when(kind == "email", F.concat(local, longer, F.lit("@h"), host, F.lit(".example.com")))
        .when(kind == "iban", F.concat(country, F.lpad(rest.cast("string"), 2, "0"), account))
        .when(kind == "card", F.concat(body, last.cast("string")))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(shaped, 2, 100)))
        .when(kind == "phone", F.concat(prefix, F.lit(":"), F.substring_index(shaped, ":", -1)))
        .when(kind == "ip", octets)
        .when(kind == "ip6", F.concat(F.lit("2001:db8:"), groups))
        .otherwise(by_script(identity, lambda script: word(script, ending(script)))))


def dictionary(pieces: DataFrame, key: str) -> DataFrame:
    """(kind, identity, replacement), one to one within a kind and apart from all identities of the kind.

    A name word's gender is the one that most of its titles have over the whole corpus.
    """
    votes = F.sum(F.when(F.col("gender") == "m", 1).when(F.col("gender") == "f", -1).otherwise(0))
    identities = stored(
        pieces.filter("kind is not null").groupBy("kind", "identity").agg(votes.alias("votes")).select(
            "kind", "identity", F.when(F.col("votes") > 0, "m").when(F.col("votes") < 0, "f").otherwise("n").alias("gender"),
            F.lit(0).alias("attempt")),
        "identities")
    taken = identities.select("kind", F.lower("identity").alias("lowered"), F.lit(True).alias("real"))
    for _ in range(MOST_ATTEMPTS):
        given = identities.withColumn("replacement", replacement(key)).withColumn("lowered", F.lower("replacement"))
        nth = F.row_number().over(Window.partitionBy("kind", "lowered").orderBy("attempt", "identity"))
        judged = stored(given.withColumn("nth", nth).join(taken, ["kind", "lowered"], "left"), "surrogates")
        again = (F.col("nth") > 1) | F.col("real").isNotNull()
        if judged.filter(again).isEmpty():
            return judged.select("kind", "identity", "replacement")
        identities = judged.select("kind", "identity", "gender", (F.col("attempt") + again.cast("int")).alias("attempt"))
    raise RuntimeError(f"surrogates still collide after {MOST_ATTEMPTS} attempts")


def rendered(kind: Column, surface: Column, replacement: Column) -> Column:
    """The replacement in the surface's layout and case."""
    # A trunk zero in brackets is no part of the number and stays.
    characters = F.regexp_replace(replacement, ":", F.when(surface.contains("(0)"), "0").otherwise(""))
    gaps = F.split(surface, "[A-Z0-9]", -1)
    laid_out = F.array_join(F.zip_with(gaps, F.split(characters, ""), lambda g, c: F.concat(g, F.coalesce(c, F.lit("")))), "")
    upper = (surface == F.upper(surface)) & (F.length(surface) > 1)
    return (F.when(kind.isNull(), surface).when(kind.isin("iban", "card", "ssn", "phone"), laid_out).when(kind.isin("ip", "ip6"), replacement)
            .when(upper, F.upper(replacement)).otherwise(replacement))


def is_named(entity: Column) -> Column:
    """Whether an entity is a title and a name."""
    return kind_of(entity) == "name"


def untitled(found: DataFrame, named: DataFrame) -> DataFrame:
    """(row, said, n_said): the parts of texts between entities with the words of the same row's names replaced.

    ``named`` has row, kind, identity and replacement of name words. Only rows that have a mention are here.
    """
    own = F.flatten(F.transform(F.filter("entities", is_named), lambda e: F.slice(F.split(F.lower(e), " "), 2, 2)))
    words = F.flatten(F.transform("parts", lambda p: F.regexp_extract_all(p, F.lit(MENTION), F.lit(0))))
    titles = [t.lower() for all_of in TITLES.values() for t in all_of]
    known = named.filter(~F.col("identity").isin(titles)).groupBy("row", F.col("identity").alias("word")).agg(
        F.min(F.struct("kind", "replacement")).alias("known"))
    tokens = found.filter(F.arrays_overlap(own, F.transform(words, F.lower))).select("row", F.posexplode("parts").alias("part", "text")).select(
        "row", "part", F.posexplode(F.arrays_zip(
            F.split("text", MENTION, -1).alias("gap"), F.regexp_extract_all("text", F.lit(MENTION), F.lit(0)).alias("surface"))).alias("nth", "token"))
    tokens = tokens.select("row", "part", "nth", "token.*").withColumn("word", F.lower("surface"))
    new = F.coalesce(rendered(F.col("known.kind"), F.col("surface"), F.col("known.replacement")), F.lit(""))
    by_part = tokens.join(known, ["row", "word"], "left").groupBy("row", "part").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", F.concat("gap", new).alias("new")))), lambda t: t["new"]), "").alias("new"),
        F.count("known").alias("n"))
    return by_part.groupBy("row").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("part", "new"))), lambda p: p["new"]).alias("said"), F.sum("n").alias("n_said"))


def replace_personal_data(
    docs: DataFrame, key: str, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text with surrogates, n_entities, kinds (sorted, distinct).

    ``n_entities`` counts what the patterns find, and each further mention of a name's word without a title.
    Texts without entity come back as they are, a null as null. Rows without id and repeated rows are treated
    like others; equal entities get equal surrogates in all of them. Extra columns are left out; an empty
    table gives an empty result.

    Texts are never shuffled as a whole: only those with entities are stored, and those are joined with their
    own replacements; those that repeat a name without its title are joined word by word. An entity that very many rows hold is one row a task in the dictionary; when it is
    joined back, Spark splits it.
    """
    texts = picked(docs, id_column, text_column)
    has = F.coalesce(may_hold_entities(F.col("text")) & F.col("text").rlike(ANY), F.lit(False))
    found = stored(
        texts.filter(has).select(
            "doc_id", F.split("text", ANY, -1).alias("parts"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("entities"))
        .withColumn("row", F.monotonically_increasing_id()),
        "texts-with-entities")
    occurrences = found.select("row", F.posexplode("entities").alias("at", "entity")).withColumn("whole", kind_of(F.col("entity")))
    pieces = stored(
        occurrences.select("row", "at", "whole", F.posexplode(pieces_of(F.col("entity"), F.col("whole"))).alias("nth", "piece"))
        .select("row", "at", "whole", "nth", "piece.*"),
        "pieces")
    known = dictionary(pieces, key)
    joined = pieces.join(known, ["kind", "identity"], "left")
    replaced = joined.select(
        "row", "at", "whole", "nth", rendered(F.col("kind"), F.col("surface"), F.col("replacement")).alias("new"))
    entities = replaced.groupBy("row", "at").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "new"))), lambda p: p["new"]), " ").alias("new"),
        F.first("whole").alias("whole"))
    by_row = entities.groupBy("row").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "new"))), lambda p: p["new"]).alias("new"),
        F.sort_array(F.collect_set("whole")).alias("kinds"))
    said = untitled(found, joined.filter(F.col("kind").isin("given", "family")).select("row", "kind", "identity", "replacement"))
    parts = F.coalesce("said", "parts")
    text = F.array_join(F.zip_with(parts, "new", lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    changed = found.select("row", "doc_id", "parts").join(by_row, "row").join(said, "row", "left").select(
        "doc_id", text.alias("text"), (F.size("new") + F.coalesce("n_said", F.lit(0))).cast("long").alias("n_entities"), F.array_join("kinds", ",").alias("kinds"))
    return texts.filter(~has).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds")).unionByName(changed)
