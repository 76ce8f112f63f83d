"""Surrogates for personal data, as DataFrame expressions only.

Every detected entity is replaced by another of its kind, made from a key.
Each character moves within its own class (digits, vowels and consonants of a
script) by a step that a keyed hash draws from all characters before it, and
then once more from all after it. Then one character moves by a step that is
never zero, and both passes are undone. So different entities of a kind and
format get different surrogates, none keeps its own, and the same entity gets
the same one in every document, without a table of entities. Known given names
move within the list of their script and gender.

Numbers are compared by their digits and e-mail addresses without regard to
case, so an entity written in two ways keeps being one. After rewriting, the
entities found are checked: where two share a surrogate, or a surrogate equals
its original, these entities are drawn again until none does.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

from querylens.sources.scratch import materialize

# Replaced in production by a secret of the deployment.
KEY = "surrogate"
# Draws of an entity whose surrogate is another's; a format with hardly a free surrogate left may need more.
ROUNDS = 100

# Characters move within their class; all others stay.
CLASSES = (
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "àáâäèéêëìíîïòóôöùúûü",
    "çñß",
    "аеиоуыэюя",
    "бвгджзклмнпрстфхцчшщ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
)
HEX_CLASSES = ("0123456789", "abcdef")


def _other_letters() -> str:
    """A line for the small letters of each script that are in none of the classes, those with a capital apart from the rest."""
    known, found = set("".join(CLASSES)), {}
    for code in range(128, 0x1F000):
        letter = chr(code)
        if letter in known or unicodedata.category(letter) != "Ll":
            continue
        upper = letter.upper()
        paired = upper != letter and len(upper) == 1 and upper.lower() == letter
        script = re.split(" (?:SMALL|LETTER|CAPITAL) ", unicodedata.name(letter))[0]
        found.setdefault((script, paired), []).append(letter)
    return "\n".join("".join(x) for x in found.values())


# Only names have such letters.
OTHER_LETTERS = _other_letters()
NAME_CLASSES = (*CLASSES, OTHER_LETTERS)

# Given names by script and gender.
GIVEN_NAMES = {
    ("latin", "female"): "Alice Anna Carmen Claire Emma Helena Julia Laura Lucia Maria Sarah Sophie".split(),
    ("latin", "male"): "Antonio Carlos David Hans James John Louis Michael Paul Peter Robert Thomas".split(),
    ("cyrillic", "female"): "Анна Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "male"): "Александр Алексей Андрей Дмитрий Иван Михаил Николай Сергей".split(),
}
# Titles before a name, and endings that tell the gender of a Cyrillic surname; both stay as they are.
TITLES = r"(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|г-н|г-жа)"
ENDINGS = r"(?:ова|ева|ина|ская|ов|ев|ин|ский)$"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
_KNOWN = "|".join(name for names in GIVEN_NAMES.values() for name in names)
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])",
    "token": r"(?<![A-Za-z0-9])(?:sk|pk|ghp|gho|xox[bp]|AKIA)[-_]?[A-Za-z0-9]{16,}+(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": (
        r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,5}"
        r"|\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])"
    ),
    "name": (
        rf"(?<!\p{{L}})(?:{TITLES}\.? {_NAME}(?: {_NAME})?|(?:{_KNOWN}) {_NAME})(?!\p{{L}})"
    ),
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _char(text: Column, at: Column) -> Column:
    return F.substring(text, at, F.lit(1))


def _class_of(char: Column, classes: tuple[str, ...]) -> Column:
    """All characters of a character's class, NULL without one."""
    out = F.lit(None).cast("string")
    if classes is NAME_CLASSES:
        lines, place = F.lit(OTHER_LETTERS), F.instr(F.lit(OTHER_LETTERS), char)
        before = F.substring_index(F.substring(lines, F.lit(1), place), "\n", -1)
        after = F.substring_index(F.substring(lines, place + 1, F.lit(len(OTHER_LETTERS))), "\n", 1)
        out = F.when((F.ascii(char) > 127) & (place > 0), F.concat(before, after))
        classes = CLASSES
    for members in classes:
        out = F.when(F.instr(F.lit(members), char) > 0, F.lit(members)).otherwise(out)
    return out


def _moved(char: Column, draw: Column, classes: tuple[str, ...], always: bool = False, back: bool = False) -> Column:
    """A character of the same class, ``draw`` places on or back; ``always`` another one."""

    def on(members: Column) -> Column:
        size = F.char_length(members).cast("long")
        step = F.pmod(draw, size - 1) + 1 if always else F.pmod(draw, size)
        place = F.pmod(F.instr(members, char) - 1 + (-step if back else step), size) + 1
        return F.when(members.isNull(), char).otherwise(F.substring(members, place.cast("int"), F.lit(1)))

    return _let(_class_of(char, classes), on)


def _draw(text: Column, rest: Column, key: str, forward: bool) -> Column:
    return F.xxhash64(F.lit(key), F.lit(forward), F.char_length(text), rest, F.sha2(F.concat(F.lit(key), rest), 256))


def _pass(text: Column, key: str, classes: tuple[str, ...], forward: bool) -> Column:
    def move(i: Column) -> Column:
        rest = F.substring(text, F.lit(1), i - 1) if forward else F.substring(text, i + 1, F.char_length(text))
        return _moved(_char(text, i), _draw(text, rest, key, forward), classes)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(text)), move), "")


def _undone(text: Column, key: str, classes: tuple[str, ...], forward: bool) -> Column:
    """What ``_pass`` made ``text`` of; each character needs those that were before it in the pass."""
    size = F.char_length(text)

    def back(made: Column, i: Column) -> Column:
        char = _moved(_char(text, i), _draw(text, made, key, forward), classes, back=True)
        return F.concat(made, char) if forward else F.concat(char, made)

    places = F.sequence(F.lit(1), size) if forward else F.sequence(size, F.lit(1), F.lit(-1))
    return F.aggregate(places, F.lit(""), back)


def _another(text: Column, key: str, classes: tuple[str, ...]) -> Column:
    """``text`` with its last character that is in a class moved on, by a step that the others draw."""

    def place(i: Column) -> Column:
        before, after = F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.char_length(text))
        draw = F.xxhash64(F.lit(key), F.char_length(text), F.sha2(F.concat_ws("\n", F.lit(key), before, after), 256))
        return F.when(i > 0, F.concat(before, _moved(_char(text, i), draw, classes, True), after)).otherwise(text)

    movable = F.filter(F.sequence(F.lit(1), F.char_length(text)), lambda i: _class_of(_char(text, i), classes).isNotNull())
    return _let(F.coalesce(F.array_max(movable), F.lit(0)), place)


def permuted(text: Column, key: str, classes: tuple[str, ...] = CLASSES) -> Column:
    """A keyed one-to-one image of a lower-case text in the same format, never the text itself if a character has a class.

    An empty text stays empty.
    """
    image = text
    for step in (
        lambda t: _pass(t, key, classes, True),
        lambda t: _pass(t, key, classes, False),
        lambda t: _another(t, key, classes),
        lambda t: _undone(t, key, classes, False),
        lambda t: _undone(t, key, classes, True),
    ):
        image = _let(image, step)
    return F.when(F.char_length(text) > 0, image).otherwise(text)


def _cased(image: Column, original: Column) -> Column:
    """``image`` with capitals where ``original`` has them."""

    def letter(i: Column) -> Column:
        was, now = _char(original, i), _char(image, i)
        return F.when(was != F.lower(was), F.upper(now)).otherwise(now)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(original)), letter), "")


def _keeping_case(text: Column, key: str, classes: tuple[str, ...] = CLASSES) -> Column:
    return _let(text, lambda t: _cased(permuted(F.lower(t), key, classes), t))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _with_digits(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced by ``digits``, in order."""

    def place(i: Column) -> Column:
        number = F.char_length(_digits(F.substring(text, F.lit(1), i)))
        return F.when(_char(text, i).rlike("[0-9]"), F.substring(digits, number, F.lit(1))).otherwise(_char(text, i))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(text)), place), "")


def _luhn(digits: Column) -> Column:
    """The digit that makes a card number out of the digits before it."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.char_length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(i % 2 == 0, digit * 2).otherwise(digit)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    total = F.aggregate(F.sequence(F.lit(0), F.char_length(digits) - 1), F.lit(0), add)
    return F.pmod(F.lit(10) - total % 10, F.lit(10))


def _card(text: Column, key: str) -> Column:
    """Another number whose check digit is right if, and only if, it was right before."""

    def image(digits: Column) -> Column:
        body = F.substring(digits, F.lit(1), F.char_length(digits) - 1)
        off = F.substring(digits, F.char_length(digits), F.lit(1)).cast("int") - _luhn(body)
        return _let(permuted(body, key), lambda b: F.concat(b, F.pmod(_luhn(b) + off, F.lit(10)).cast("string")))

    return _with_digits(text, _let(_digits(text), image))


def _phone(text: Column, key: str) -> Column:
    """Another subscriber; digits before the last ten, the country's, stay."""

    def image(digits: Column) -> Column:
        ahead = F.greatest(F.char_length(digits) - 10, F.lit(0))
        own = F.substring(digits, ahead + 1, F.lit(10))
        return F.concat(F.substring(digits, F.lit(1), ahead), permuted(own, key))

    return _with_digits(text, _let(_digits(text), image))


def _ip(text: Column, key: str) -> Column:
    """Another address: each octet moves by a step drawn from those before it, then from those after it.

    Then the last one moves by a step that is never zero, and both passes are undone.
    """

    def draw(rest: Column, forward: bool) -> Column:
        return F.xxhash64(F.lit(key), F.lit(forward), F.array_join(rest, "."))

    def one(octets: Column, forward: bool) -> Column:
        def move(i: Column) -> Column:
            rest = F.slice(octets, F.lit(1), i - 1) if forward else F.slice(octets, i + 1, F.lit(4))
            return F.pmod(F.get(octets, i - 1).cast("int") + draw(rest, forward) % 256, F.lit(256)).cast("string")

        return F.transform(F.sequence(F.lit(1), F.lit(4)), move)

    def another(octets: Column) -> Column:
        step = F.pmod(F.xxhash64(F.lit(key), F.array_join(F.slice(octets, F.lit(1), F.lit(3)), ".")), F.lit(255)) + 1
        last = F.pmod(F.get(octets, F.lit(3)).cast("int") + step, F.lit(256)).cast("string")
        return F.concat(F.slice(octets, F.lit(1), F.lit(3)), F.array(last))

    def undone(octets: Column, forward: bool) -> Column:
        def back(made: Column, i: Column) -> Column:
            was = F.pmod(F.get(octets, i - 1).cast("int") - draw(made, forward) % 256, F.lit(256)).cast("string")
            return F.concat(made, F.array(was)) if forward else F.concat(F.array(was), made)

        places = F.sequence(F.lit(1), F.lit(4)) if forward else F.sequence(F.lit(4), F.lit(1), F.lit(-1))
        return F.aggregate(places, F.array().cast("array<string>"), back)

    image = F.split(text, r"\.")
    for step in (lambda o: one(o, True), lambda o: one(o, False), another, lambda o: undone(o, False), lambda o: undone(o, True)):
        image = _let(image, step)
    return F.array_join(image, ".")


def _email(text: Column, key: str) -> Column:
    """Another address; the same domain stays the same one, the top-level domain stays as it is."""
    local = F.substring_index(text, "@", 1)
    domain = F.substring_index(text, "@", -1)
    top = F.substring_index(domain, ".", -1)
    own = F.substring(domain, F.lit(1), F.char_length(domain) - F.char_length(top) - 1)
    return F.concat(_keeping_case(local, f"{key}/local"), F.lit("@"), _keeping_case(own, f"{key}/domain"), F.lit("."), top)


def _word_of_name(word: Column, key: str) -> Column:
    """A given name of the same list, or a surname with the same pattern and ending."""
    ending = F.regexp_extract(word, ENDINGS, 0)
    stem = F.substring(word, F.lit(1), F.char_length(word) - F.char_length(ending))
    every = [name for names in GIVEN_NAMES.values() for name in names]

    def made(stem: Column) -> Column:
        return F.concat(_keeping_case(stem, f"{key}/surname", NAME_CLASSES), ending)

    # A given name, or a word with another ending, is the image of another word: on to the next one, which keeps images apart.
    def settled(image: Column) -> Column:
        other = image.isin(every) | (F.regexp_extract(image, ENDINGS, 0) != ending)
        return F.when(other, made(F.substring(image, F.lit(1), F.char_length(stem)))).otherwise(image)

    out = _let(made(stem), settled)
    for (script, gender), names in GIVEN_NAMES.items():
        listed = F.array(*[F.lit(n) for n in names])
        place = F.array_position(listed, word)
        # From 1 on, so that no name stays; the same step for all, so that no two meet.
        step = F.pmod(F.xxhash64(F.lit(f"{key}/{script}/{gender}")), F.lit(len(names) - 1)) + 1
        out = F.when(place > 0, F.get(listed, F.pmod(place - 1 + step, F.lit(len(names))).cast("int"))).otherwise(out)
    return out


def _name(text: Column, key: str) -> Column:
    words = F.split(text, " ")
    title = F.lit(rf"^{TITLES}\.?$")
    made = F.transform(words, lambda w: F.when(F.rlike(w, title), w).otherwise(_word_of_name(w, key)))
    return F.array_join(made, " ")


def kind_of(entity: Column) -> Column:
    """The kind of a detected entity."""
    tests = [F.when(entity.rlike(f"^(?:{p})$"), k) for k, p in PATTERNS.items()]
    return F.coalesce(*tests)


def canonical(entity: Column, kind: Column) -> Column:
    """What an entity is compared by: digits of numbers, e-mail addresses in lower case, others as written."""
    number = _digits(entity)
    return (
        F.when(kind.isin("card", "ssn"), number)
        .when(kind == "phone", F.substring(number, F.greatest(F.char_length(number) - 9, F.lit(1)), F.lit(10)))
        .when(kind == "email", F.lower(entity))
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
        .otherwise(entity)
    )


def _iban(text: Column, key: str) -> Column:
    """Another account in the same country and grouping."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    country = F.substring(plain, F.lit(1), F.lit(2))
    image = F.concat(country, F.upper(permuted(F.lower(F.substring(plain, F.lit(3), F.char_length(plain))), key)))

    def place(made: Column) -> Column:
        def one(i: Column) -> Column:
            at = F.char_length(F.replace(F.substring(text, F.lit(1), i), F.lit(" "), F.lit("")))
            return F.when(_char(text, i) == " ", F.lit(" ")).otherwise(F.substring(made, at, F.lit(1)))

        return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(text)), one), "")

    return _let(image, place)


def surrogate(entity: Column, kind: Column, key: str = KEY) -> Column:
    """The replacement of an entity of a kind."""
    return (
        F.when(kind == "email", _email(entity, f"{key}/email"))
        .when(kind == "ip", _ip(entity, f"{key}/ip"))
        .when(kind == "secret", _keeping_case(entity, f"{key}/secret", HEX_CLASSES))
        .when(kind == "token", _keeping_case(entity, f"{key}/token"))
        .when(kind == "iban", _iban(entity, f"{key}/iban"))
        .when(kind == "card", _card(entity, f"{key}/card"))
        .when(kind == "ssn", _with_digits(entity, permuted(_digits(entity), f"{key}/ssn")))
        .when(kind == "phone", _phone(entity, f"{key}/phone"))
        .otherwise(_name(entity, f"{key}/name"))
    )


def _rewritten(docs: DataFrame, text: str, key: str, instead: DataFrame | None = None) -> DataFrame:
    """``docs`` with surrogates; those of the entities in ``instead`` (kind, entity, new) come from there."""
    found = docs.withColumn("_found", F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)))
    if instead is not None:
        pairs = F.collect_list(F.struct(F.concat_ws(" ", "kind", "entity"), F.col("new")))
        found = found.crossJoin(F.broadcast(instead.agg(F.map_from_entries(pairs).alias("_instead"))))

    def replacement(kind: Column, entity: Column) -> Column:
        if instead is None:
            return F.lit(None).cast("string")
        return F.try_element_at(F.col("_instead"), F.concat_ws(" ", kind, entity))

    def replaced(entity: Column) -> Column:
        return _let(
            kind_of(entity),
            lambda kind: F.struct(
                kind.alias("kind"),
                entity.alias("entity"),
                canonical(entity, kind).alias("canonical"),
                F.coalesce(replacement(kind, entity), surrogate(entity, kind, key)).alias("surrogate"),
            ),
        )

    found = found.withColumn("entities", F.transform("_found", replaced))
    # What stands between the entities, one piece more than there are entities.
    between = F.split(F.col(text), ANY, -1)
    pieces = F.zip_with(between, "entities", lambda part, e: F.concat(part, F.coalesce(e["surrogate"], F.lit(""))))
    return found.withColumn(text, F.when(F.size("_found") > 0, F.array_join(pieces, "")).otherwise(F.col(text))).drop("_found", "_instead")


def collisions(rows: DataFrame) -> DataFrame:
    """(kind, surrogate) that different entities share, or that equals its entity, in ``entities`` of ``rows``."""
    each = rows.select(F.explode("entities").alias("e")).select("e.kind", "e.canonical", "e.surrogate")
    same = each.withColumn("image", canonical(F.col("surrogate"), F.col("kind"))).groupBy("kind", "image")
    meeting = same.agg(F.min("canonical").alias("first"), F.max("canonical").alias("last"))
    return meeting.where((F.col("first") != F.col("last")) | (F.col("first") == F.col("image")))


def _redrawn(rows: DataFrame, key: str) -> DataFrame:
    """(kind, entity, new) for the entities in ``rows`` whose surrogate is another's or their own, with one that is free."""
    each = rows.select(F.explode("entities").alias("e")).select("e.*").distinct()
    each = each.withColumn("image", canonical(F.col("surrogate"), F.col("kind")))
    met = collisions(rows).withColumnRenamed("first", "keeps").drop("last")
    each = materialize(each.join(met, ["kind", "image"], "left"), "images")
    # The first of those that share an image keeps it.
    again = F.col("keeps").isNotNull() & ((F.col("canonical") != F.col("keeps")) | (F.col("canonical") == F.col("image")))
    taken = each.where(~again).select("kind", "image").distinct()
    left, done = each.where(again).select("kind", "entity", "canonical"), None
    for number in range(1, ROUNDS + 1):
        drawn = left.withColumn("new", surrogate(F.col("entity"), F.col("kind"), f"{key}#{number}"))
        drawn = drawn.withColumn("image", canonical(F.col("new"), F.col("kind")))
        drawn = materialize(drawn.join(taken.withColumn("held", F.lit(True)), ["kind", "image"], "left"), "redrawn")
        first = drawn.groupBy("kind", "image").agg(F.min("canonical").alias("keeps"))
        drawn = drawn.join(first, ["kind", "image"])
        bad = F.col("held").isNotNull() | (F.col("canonical") == F.col("image")) | (F.col("canonical") != F.col("keeps"))
        # All ways to write an entity are drawn again if one of them meets another.
        failed = drawn.where(bad).select("kind", "canonical").distinct()
        left = materialize(drawn.join(failed, ["kind", "canonical"], "left_semi").select("kind", "entity", "canonical"), "left")
        good = drawn.join(failed, ["kind", "canonical"], "left_anti")
        good = materialize(good.select("kind", "entity", "new", "image"), "drawn")
        done = good if done is None else done.unionByName(good)
        if left.isEmpty():
            return done.select("kind", "entity", "new")
        taken = taken.unionByName(good.select("kind", "image").distinct())
    raise ValueError(f"{left.count()} entities have no free surrogate in {ROUNDS} draws, such as {left.first()}")


def replace_entities(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``entities``: kind, entity, canonical form and surrogate of each, in order.

    A text without entities stays as it is, an empty one too; NULL stays NULL
    and has NULL ``entities``. Equal texts get equal results, and results don't
    depend on the other documents, except those of entities that share a
    surrogate; then all but the first of them are drawn again until none
    does. A column of ``docs`` named ``entities`` is replaced.
    """
    rows = materialize(_rewritten(docs, text, f"{key}#0"), "surrogates")
    if collisions(rows).isEmpty():
        return rows
    return materialize(_rewritten(docs, text, f"{key}#0", _redrawn(rows, f"{key}#0")), "surrogates")
