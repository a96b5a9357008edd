"""Private data replaced by keyed surrogates, in DataFrame functions only.

Entities are found by pattern.  An entity's canonical value (case folded, or
its digits) gets a surrogate from a keyed hash, of the same kind: names of the
same gender and script, numbers of the same form and check digit, addresses
that look alike.  Surrogates are poured into the entity's own writing, so
``+1 (017) 555-7713`` stays a number written like that.  Equal canonical
values get equal surrogates throughout the corpus.  Surrogates that collide,
with each other or with a value that really occurs, are drawn again.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import own_columns, written

#: Given names by script and gender, family names by script.
GIVEN = {
    ("latin", "f"): ("Agatha", "Bettina", "Camille", "Deborah", "Felicity", "Gabriela", "Hannelore", "Josephine", "Katharina", "Lucinda",
                     "Margaret", "Nathalie", "Ottilie", "Patricia", "Rosalind", "Sabrina", "Theodora", "Ursula", "Veronica", "Wilhelmina"),
    ("latin", "m"): ("Ambrose", "Bernard", "Christoph", "Dominic", "Ferdinand", "Gregory", "Humphrey", "Jonathan", "Konstantin", "Leopold",
                     "Matthew", "Nicholas", "Oswald", "Patrick", "Reginald", "Sebastian", "Thaddeus", "Ulrich", "Vincent", "Wolfgang"),
    ("latin", "x"): ("Alexis", "Blair", "Cameron", "Dakota", "Emerson", "Finley", "Harper", "Jordan", "Kendall", "Logan", "Morgan", "Noel",
                     "Parker", "Quinn", "Reese", "Riley", "Rowan", "Sidney", "Taylor", "Winter"),
    ("cyrillic", "f"): ("Алевтина", "Варвара", "Галина", "Евгения", "Людмила", "Маргарита", "Надежда", "Полина", "Светлана", "Тамара"),
    ("cyrillic", "m"): ("Аркадий", "Валентин", "Геннадий", "Дмитрий", "Константин", "Леонид", "Николай", "Родион", "Станислав", "Тимофей"),
}
#: Further given names that announce a name, by gender.
COMMON = {
    "f": ("Alice", "Ana", "Anna", "Barbara", "Carmen", "Charlotte", "Claire", "Elena", "Elizabeth", "Emily", "Emma", "Eva", "Hannah", "Helen",
          "Ingrid", "Isabel", "Jane", "Jennifer", "Jessica", "Julia", "Karen", "Laura", "Linda", "Lisa", "Lucia", "Maria", "Marie", "Mary",
          "Monika", "Olivia", "Petra", "Rosa", "Sandra", "Sarah", "Sofia", "Sophie", "Susan", "Анна", "Елена", "Мария", "Ольга", "Татьяна"),
    "m": ("Alexander", "Andreas", "Antonio", "Benjamin", "Carlos", "Charles", "Daniel", "David", "Diego", "Edward", "Emil", "Felix", "François",
          "Frank", "George", "Hans", "Henry", "Jacques", "James", "Jean", "John", "José", "Juan", "Klaus", "Louis", "Luis", "Michael", "Michel",
          "Miguel", "Pablo", "Paul", "Peter", "Pierre", "Richard", "Robert", "Stefan", "Thomas", "William", "Алексей", "Иван", "Михаил", "Сергей"),
}
FAMILY = {
    "latin": ("Ashdown", "Bramwell", "Castellan", "Dunmore", "Eastbrook", "Falkner", "Greenhalgh", "Hollings", "Inverness", "Jardine",
              "Kingsley", "Lockhart", "Merriman", "Northcote", "Oakhurst", "Pemberton", "Quennell", "Ravenscroft", "Stanwick", "Thornbury"),
    "cyrillic": ("Абрамов", "Воронцов", "Голубев", "Данилов", "Ермолов", "Журавлев", "Зайцев", "Калинин", "Лаврентьев", "Морозов"),
}
#: Titles that announce a name, by gender; "x" leaves it open.
TITLES = {"Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Господин": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f",
          "Madame": "f", "Señora": "f", "Госпожа": "f", "Dr": "x", "Prof": "x"}

_W, _WU = r"[\p{L}\p{N}]", r"[\p{L}\p{N}_]"
_NAME = r"\p{Lu}[\p{L}'’-]+"
_TITLE = "|".join(TITLES)
_KNOWN = "|".join(n for names in (*GIVEN.values(), *COMMON.values()) for n in names)
#: Kind to pattern, in order of precedence where they begin at one place.
PATTERNS = {
    "email": rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}._%+-]*@(?:[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}-]*[\p{{L}}\p{{N}}])?\.)+\p{{L}}{{2,24}}(?!{_W})",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": rf"(?<![\p{{N}}\p{{L}}-])\d{{3}}-\d{{2}}-\d{{4}}(?![\p{{N}}\p{{L}}]|-\d)",
    "card": rf"(?<![\p{{N}}\p{{L}}.-])(?:(?:\d{{4}}[ -]){{3}}\d{{4}}|\d{{4}}[ -]\d{{6}}[ -]\d{{5}})(?![\p{{N}}\p{{L}}]|-\d)|(?<![\p{{N}}\p{{L}}.-])\d{{13,19}}(?![\p{{N}}\p{{L}}]|[.-]\d)",
    "phone": rf"(?<!{_WU})\+\d{{1,3}}(?:[ .-]?\(\d{{1,4}}\)|[ .-]\d{{1,4}})(?:[ .-]?\d{{2,4}}){{1,4}}(?!{_WU})"
             rf"|(?<!{_WU})\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}(?!{_WU})|(?<![\p{{L}}\p{{N}}_.-])(?:1[.-])?\d{{3}}[.-]\d{{3}}[.-]\d{{4}}(?![\p{{L}}\p{{N}}_]|[.-]\d)",
    "secret": rf"(?<!{_WU})(?:[0-9a-f]{{32,128}}|[0-9A-F]{{32,128}})(?!{_WU})"
              rf"|(?<!{_WU})(?:AKIA|ASIA)[A-Z0-9]{{16}}(?!{_WU})|(?<!{_WU})(?:sk|ghp|gho|xoxb|xoxp)[-_][A-Za-z0-9_-]{{20,}}",
    "iban": rf"(?<!{_WU})[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?!{_WU})",
    "name": rf"(?<!{_WU})(?=\p{{Lu}})(?:(?:{_TITLE})\.? {_NAME}(?: {_NAME})?|(?:{_KNOWN}) {_NAME})",
}
#: An entity begins where no letter or digit stands before, which spares trying every pattern within words.
ANY = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
#: What a text with an entity holds at least; the whole patterns run on such texts only.
HINT = rf"[0-9@]|(?:sk|ghp|gho|xoxb|xoxp)[-_]|A[KS]IA|[a-f]{{32}}|[A-F]{{32}}|(?=\p{{Lu}})(?<!\p{{L}})(?:(?:{_TITLE})\.?|{_KNOWN}) \p{{Lu}}"
DEFAULT_KEY = "surrogates-1"
#: From this draw on a surrogate that is still taken grows by a character a draw, where its kind allows.
LENGTHEN = 8


def entities(text: Column) -> Column:
    """The entities of a text, in order."""
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern takes the whole entity."""
    out = F.when(entity.contains("@"), "email")
    for kind, pattern in PATTERNS.items():
        out = out.when(entity.rlike(rf"\A(?:{pattern})\z"), kind)
    return out.otherwise("secret")


def canonical(kind: Column, entity: Column) -> Column:
    """What equal entities share: digits of numbers, names without titles, all else without case and spaces.

    A bar follows a telephone number's country code, which surrogates keep.
    """
    title = rf"\A(?:{_TITLE})\.? "
    return (F.when(kind.isin("card", "ssn"), F.regexp_replace(entity, r"\D", ""))
            .when(kind == "phone", F.regexp_replace(F.regexp_replace(entity, r"\A\+(\d{1,3})", "$1|"), r"[^\d|]", ""))
            .when(kind == "name", F.regexp_replace(entity, title, ""))
            .when(kind == "secret", entity)  # case tells secrets apart
            .otherwise(F.lower(F.regexp_replace(entity, r"\s", ""))))


def _stream(key: str, kind: Column, value: Column, draw: Column) -> Column:
    """256 keyed hexadecimal digits for a value's n-th draw."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, value, draw.cast("string"))
    return F.concat(F.sha2(seed, 512), F.sha2(F.concat(F.lit("2\x1f"), seed), 512))


def _at(stream: Column, i: Column, below: Column | int) -> Column:
    """A number below ``below`` from the stream's place i (three digits each, round and round)."""
    part = F.substring(stream, (i % 80) * 3 + 1, F.lit(3))
    return (F.conv(part, 16, 10).cast("int") + i * 7) % below


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _like(value: Column, stream: Column) -> Column:
    """Each digit for a digit and each letter for a letter of its script and case; all else stays."""
    def one(c: Column, i: Column) -> Column:
        pick = lambda letters: F.substring(F.lit(letters), _at(stream, i, len(letters)) + 1, F.lit(1))
        return (F.when(c.rlike(r"\A[0-9]\z"), _at(stream, i, 10).cast("string"))
                .when(c.rlike(r"\A\p{IsGreek}\z"), pick("αβγδεζηθικλμνξοπρστυφχψω"))
                .when(c.rlike(r"\A\p{IsCyrillic}\z"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
                .when(c.rlike(r"\A[\p{L}&&\P{IsLatin}]\z"), c)
                .when(c.rlike(r"\A\p{Lu}\z"), F.upper(pick("abcdefghijklmnopqrstuvwxyz")))
                .when(c.rlike(r"\A\p{L}\z"), pick("abcdefghijklmnopqrstuvwxyz"))
                .otherwise(c))
    return F.array_join(F.transform(_chars(value), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10; 0 is valid."""
    def add(acc: Column, x: Column) -> Column:
        d = x["c"].cast("int") * F.when(x["i"] % 2 == 1, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)
    numbered = F.transform(F.reverse(_chars(digits)), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.aggregate(numbered, F.lit(0), add) % 10


def _card(value: Column, stream: Column) -> Column:
    """Digits of the same length; where the value's check digit is valid, so is the surrogate's."""
    drawn = F.array_join(F.transform(_chars(value), lambda c, i: _at(stream, i, F.when(i == 0, 9).otherwise(10)).cast("string")), "")
    body = F.concat((F.substring(drawn, 1, 1).cast("int") % 9 + 1).cast("string"), F.substring(drawn, F.lit(2), F.length(drawn) - 2))
    check = ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string")
    return F.when(_luhn(value) == 0, F.concat(body, check)).otherwise(F.concat(body, F.substring(drawn, F.length(drawn), F.lit(1))))


def _hex(value: Column, stream: Column) -> Column:
    """A hexadecimal value of the same length; other secrets keep their prefix and form."""
    digits = lambda c, i: F.substring(F.lit("0123456789abcdef"), _at(stream, i, 16) + 1, F.lit(1))
    prefix = F.regexp_extract(value, r"\A(AKIA|ASIA|(?:sk|ghp|gho|xoxb|xoxp)[-_])", 1)
    rest = _like(F.expr("substring(_op_value, length(regexp_extract(_op_value, '^(AKIA|ASIA|(?:sk|ghp|gho|xoxb|xoxp)[-_])', 1)) + 1)"), stream)
    hexadecimal = F.array_join(F.transform(_chars(value), digits), "")
    return (F.when(value.rlike(r"\A[0-9a-f]+\z"), hexadecimal).when(value.rlike(r"\A[0-9A-F]+\z"), F.upper(hexadecimal))
            .otherwise(F.concat(prefix, rest)))


def _iban(country: Column, account: Column) -> Column:
    """Country, check digits and account: the remainder of account, country and 00 by 97 gives the check digits."""
    def add(acc: Column, c: Column) -> Column:
        d = F.ascii(c) - F.when(c.rlike(r"\A[0-9]\z"), 48).otherwise(55)
        return (acc * F.when(d > 9, 100).otherwise(10) + d) % 97
    rest = F.aggregate(_chars(F.concat(account, country, F.lit("00"))), F.lit(0), add)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account)


def _pick(names: tuple[str, ...], stream: Column, place: int) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), _at(stream, F.lit(place), len(names)) + 1)


def _name(value: Column, gender: Column, stream: Column, draw: Column) -> Column:
    """Given and family names of the value's script and gender, as many words as it has.

    From the fourth draw on the family name is doubled, then lettered, as single
    names are few.
    """
    def person(script: str) -> Column:
        given = F.when(gender == "f", _pick(GIVEN[script, "f"], stream, 0)).when(gender == "m", _pick(GIVEN[script, "m"], stream, 0)).otherwise(
            _pick(GIVEN.get((script, "x"), GIVEN[script, "m"]), stream, 0))
        ending = F.when((gender == "f") & F.lit(script == "cyrillic"), "а").otherwise("")
        family = F.concat(_pick(FAMILY[script], stream, 1), ending)
        second = F.concat(_pick(FAMILY[script], stream, 2), ending)
        family = F.when(draw >= 3, F.concat(family, F.lit("-"), second)).otherwise(family)
        letters = "ABCDEFGHIJKLMNOPRSTUVW" if script == "latin" else "АБВГДЕЖЗИКЛМНОПРСТУФ"
        extra = F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(draw - 6, F.lit(0))), lambda i: F.concat(
            F.substring(F.lit(letters), _at(stream, i + 5, len(letters)) + 1, F.lit(1)), F.lit("."))), "")
        family = F.when(draw >= 6, F.concat(extra, F.lit(" "), family)).otherwise(family)
        return F.when(value.contains(" "), F.concat(given, F.lit(" "), family)).otherwise(family)
    return F.when(value.rlike(r"\p{IsCyrillic}"), person("cyrillic")).otherwise(person("latin"))


def surrogate(key: str, kind: Column, value: Column, gender: Column, draw: Column) -> Column:
    """The canonical surrogate of a canonical value; reads the column ``_op_value`` as the value."""
    s = _stream(key, kind, value, draw)
    octets = F.transform(F.split(value, r"\."), lambda c, i: F.when(i == 0, _at(s, i, 223) + 1).otherwise(_at(s, i, 254) + 1).cast("string"))
    more = F.repeat(F.lit("0"), F.greatest(draw - LENGTHEN + 1, F.lit(0)))
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    local = F.concat(local, F.translate(more, "0", "a"))
    host = F.concat(_like(F.regexp_replace(domain, r"\.[^.]*\z", ""), F.reverse(s)), F.lit("."), F.regexp_extract(domain, r"[^.]*\z", 0))
    return (F.when(kind == "ip", F.array_join(octets, "."))
            .when(kind == "email", F.concat(_like(local, s), F.lit("@"), host))
            .when(kind == "card", _card(value, s))
            .when(kind == "secret", _hex(value, s))
            .when(kind == "name", _name(value, gender, s, draw))
            .when(kind == "phone", F.concat(F.regexp_extract(value, r"\A(\d*)\|", 1), _like(F.concat(F.regexp_replace(value, r"\A\d*\|", ""), more), s)))
            .when(kind == "iban", _iban(F.upper(F.substring(value, 1, 2)), F.upper(_like(F.expr("substring(_op_value, 5)"), s))))
            .when(kind == "ssn", _like(F.concat(value, more), s))
            .otherwise(_like(value, s)))


def _gender(entity: Column) -> Column:
    """From the title, else from the given name, else open."""
    title = F.regexp_extract(entity, rf"\A({_TITLE})\.? ", 1)
    given = F.regexp_extract(entity, rf"({_KNOWN})(?!\p{{L}})", 1)
    said = reduce(lambda c, t: c.when(title == t, TITLES[t]), TITLES, F.when(F.lit(False), ""))
    known = reduce(lambda c, g: c.when(given.isin(*GIVEN[g]), g[1]), GIVEN, F.when(F.lit(False), ""))
    known = reduce(lambda c, g: c.when(given.isin(*COMMON[g]), g), COMMON, known)
    russian = F.when(entity.rlike(r"(?:ова|ева|ина|ая)\z"), "f").when(entity.rlike(r"(?:ов|ев|ин|ий)\z"), "m")
    return F.coalesce(F.nullif(said, F.lit("x")), F.nullif(known, F.lit("x")), russian, F.lit("x"))


def poured(kind: Column, entity: Column, drawn: Column) -> Column:
    """The canonical surrogate in the entity's own writing."""
    letters = _chars(entity)
    place = lambda i, pattern: F.length(F.regexp_replace(F.substring(entity, F.lit(1), i + 1), pattern, ""))
    digits = F.array_join(F.transform(letters, lambda c, i: F.when(
        c.rlike(r"\A[0-9]\z"), F.substring(drawn, place(i, r"\D"), F.lit(1))).otherwise(c)), "")
    spaced = F.array_join(F.transform(letters, lambda c, i: F.when(
        c.rlike(r"\A\S\z"), F.substring(drawn, place(i, r"\s"), F.lit(1))).otherwise(c)), "")
    title = F.regexp_extract(entity, rf"\A(?:{_TITLE})\.? ", 0)
    # A surrogate that had to grow has digits left over.
    digits = F.concat(digits, F.substring(drawn, F.length(F.regexp_replace(entity, r"\D", "")) + 1, F.length(drawn)))
    return (F.when(kind.isin("card", "phone", "ssn"), digits)
            .when(kind == "name", F.concat(title, drawn))
            .when(kind == "iban", spaced)
            .when((kind != "secret") & (F.upper(entity) == entity) & (F.lower(entity) != entity), F.upper(drawn))
            .otherwise(drawn))


def assign(values: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``kind, value, gender`` (distinct kind and value) to the same with ``drawn``, distinct within its kind.

    Every value draws; a surrogate that several drew stays with the smallest
    value, one that occurs as a value stays with nobody; the others draw again,
    until all have one: from the LENGTHEN-th draw on surrogates of a crowded form
    grow, so that it does not run out.  Surrogates that differ only in what pouring hides do
    not occur, as pouring keeps all digits and letters.
    """
    waiting = values.withColumn("_op_value", F.col("value"))
    done: list[DataFrame] = []
    for draw in itertools.count():
        drawn = waiting.withColumn("drawn", surrogate(key, F.col("kind"), F.col("_op_value"), F.col("gender"), F.lit(draw)))
        drawn = written(drawn, "draw")
        winner = drawn.groupBy("kind", "drawn").agg(F.min("value").alias("value"))
        for before in [values.select("kind", F.replace("value", F.lit("|"), F.lit("")).alias("drawn")).distinct(), *[d.select("kind", "drawn") for d in done]]:
            winner = winner.join(before, ["kind", "drawn"], "left_anti")
        winner = written(winner, "drawn")
        done.append(winner)
        waiting = written(drawn.drop("drawn").join(winner, ["kind", "value"], "left_anti"), "waiting")
        if not waiting.limit(1).count():
            break
    return reduce(DataFrame.unionByName, done)


def replace(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and ``n_replaced``; ``n_chars``, if there, follows the text.

    A null text stays null and an empty one empty; texts without entities keep
    every byte.  Very long texts are searched whole.  Repeated rows stay, and
    equal texts get equal replacements.  An empty table gives no rows.  Columns
    other than text and n_chars stay as they are; names that begin with _op_
    are refused.
    """
    own_columns(docs)
    # What a text's entities become depends on the text alone: one row per distinct text with entities.
    digest = F.struct(F.xxhash64("text").alias("x"), F.md5("text").alias("m"))
    given = docs.select("text").where(F.col("text").rlike(HINT))
    found = given.withColumn("_op_e", F.array_distinct(entities(F.col("text")))).where(F.size("_op_e") > 0)
    found = written(found.select(digest.alias("_op_key"), "_op_e"), "entities")
    each = found.select("_op_key", F.explode("_op_e").alias("entity")).distinct()
    distinct = each.select("entity").distinct().withColumn("kind", kind_of(F.col("entity")))
    distinct = written(distinct.select("entity", "kind", canonical(F.col("kind"), F.col("entity")).alias("value"),
                                       F.when(F.col("kind") == "name", _gender(F.col("entity"))).otherwise("x").alias("gender")), "kinds")
    # A value said with a title and without is one person: the gender that any writing tells counts.
    values = written(distinct.groupBy("kind", "value").agg(F.min("gender").alias("gender")), "values")
    table = assign(values, key)
    surrogates = distinct.join(table, ["kind", "value"]).select("entity", poured(F.col("kind"), F.col("entity"), F.col("drawn")).alias("_op_s"))
    by_text = each.join(surrogates, "entity").groupBy("_op_key").agg(
        F.map_from_entries(F.collect_list(F.struct("entity", "_op_s"))).alias("_op_map"))
    by_text = written(by_text.withColumnRenamed("_op_key", "_op_k2"), "maps")

    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    dirty = docs.where(hinted).withColumn("_op_key", digest).join(by_text, F.col("_op_key") == F.col("_op_k2"), "left")
    parts, hits = F.split("text", ANY, -1), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    new = F.array_join(F.zip_with(parts, F.transform(hits, lambda e: F.element_at(F.col("_op_map"), e)),
                                  lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    dirty = dirty.withColumn("_op_new", F.when(F.col("_op_map").isNull(), F.col("text")).otherwise(new)) \
        .withColumn("n_replaced", F.when(F.col("_op_map").isNull(), F.lit(0)).otherwise(F.size(hits)).cast("long"))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("_op_new").alias("text")
        if name == "n_chars":
            return F.when(F.col("_op_map").isNull(), F.col(name)).otherwise(F.length("_op_new")).cast(docs.schema[name].dataType).alias(name)
        return F.col(name)

    names = [c for c in docs.columns if c != "n_replaced"]
    dirty = dirty.select(*[column(c) for c in names], "n_replaced")
    clean = docs.where(~hinted).select(*names, F.lit(0).cast("long").alias("n_replaced"))
    return clean.unionByName(dirty)
