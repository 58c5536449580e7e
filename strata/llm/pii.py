"""Surrogate generation for personal data and secrets.

Entities are found with one pattern per type. Every distinct entity gets a
surrogate from a keyed hash (HMAC over SHA-256): of the same type, script and
format (digits for digits, letters of the same case for letters, separators
kept), names of the same gender and script, card numbers with a valid check
digit, addresses in a reserved range, so it can't name anyone. The table of
distinct entities is what keeps coreference: one entity, one surrogate, in all
documents. A surrogate that two entities share, or that occurs as an entity
itself, is drawn again for all but the first, until none is left; persons share
no surname either.

Within a document, persons named after a title are met again without it or
by one name only: ``Mr John Smith``, then ``John Smith``, ``Mr Smith``,
``Smith`` or ``John``. A short or untitled mention takes its part of the full
name's surrogate if just one person of the document fits (a title's gender
counts); one that fits several is an entity of its own.

DataFrame functions only. Only documents with entities are joined with the
table; texts are cut at the matches and put together again, so a surrogate is
never read as an entity.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

ROUNDS = 64
OUT = ("entities", "kinds")  # columns added

# Titles by gender (n: of any), and what a name after them is made of.
TITLES: dict[str, str] = {
    "person_f": r"Mrs|Ms|Mme|Sra|Frau|[Гг]оспожа|[Гг]-жа|[Κκ]υρία",
    # M only as French "M.", not as an initial; the river is no person
    "person_m": r"Mr|Herr|(?<!\p{Lu}\. ?)M(?=\.)|Sr|(?<![Tt]he )Don|[Гг]осподин|[Гг]-н|[Κκ]ύριος",
    "person_n": r"Dr|Prof",
}
WORD = r"\p{Lu}\p{L}*+(?:['’-]\p{Lu}\p{L}++)*+"
NAME = rf"(?!(?:Dr|Prof)\b|(?:River|Valley|Basin|Delta)\b)(?:\p{{Lu}}\. ?)*{WORD}(?: (?:\p{{Lu}}\. )?{WORD})?"
LONE = r"(?<![\p{L}\p{N}_'’-])" + WORD  # a word that may name someone again
SECRET = r"(?i:password|passwd|passphrase|pwd|secret)"
API = r"(?i:token|(?:api|access)[_-]?key)"
TOKEN = r"[0-9A-Za-z_-]{16,}(?:\.[0-9A-Za-z_-]+)*"
H16 = "[0-9A-Fa-f]{1,4}"


def _after_title(*kinds: str) -> str:
    titles = "|".join(TITLES[k] for k in kinds)
    return rf"(?<= )(?=\p{{Lu}})(?<=(?<![\p{{L}}\p{{N}}])(?:{titles})\.? )" + NAME


# Types in order of precedence; patterns have no capturing groups. Where a
# context must stand before the match, its end is looked at first.
PATTERNS: dict[str, str] = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "aws_key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    # after a colon, where prose may follow, only values with a digit
    "password": rf"(?<== ?[\"']?)(?<={SECRET} ?= ?[\"']?)[^\s\"']+"
    rf"|(?<=: ?[\"']?)(?<={SECRET}[\"']? ?: ?[\"']?)(?=[^\s\"']*[0-9])[^\s\"',;]{{6,}}",
    "token": rf"(?<=[=:] ?[\"']?)(?<={API}[\"']? ?[=:] ?[\"']?){TOKEN}"
    r"|(?<=[=:] ?[\"']?)(?<=(?i:(?:api|access)[_-]?key)[\"']? ?[=:] ?[\"']?)(?=[0-9A-Za-z_.-]*[0-9])[0-9A-Za-z_.-]{8,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])",
    # +1 902 555-1000; other groups after a country code; (902) 555-1000; 902-555-1000; 902.555.1000
    "phone": r"(?=[+(0-9])(?:(?<![\w+])\+[0-9]{1,3}[ -]\(?[0-9]{2,4}\)?[ -][0-9]{3}[ -][0-9]{4}(?![0-9])"
    r"|(?<![\w+])\+[0-9](?:[ .-]?\(?[0-9]\)?){7,14}(?![0-9])"
    r"|(?<![\w(])\([0-9]{2,5}\)[ -]?[0-9]{3,4}[ -][0-9]{3,4}(?![0-9])"
    r"|(?<![\w+-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![\w-])"
    r"|(?<![\w.])[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?!\w|\.[0-9]))",
    "ipv4": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    # the first group has a digit, which tells it from a scope operator
    "ipv6": rf"(?<![\w:])(?=[0-9A-Fa-f]{{0,3}}[0-9])(?:(?:{H16}:){{7}}{H16}|(?:{H16}:){{1,6}}(?::{H16}){{1,6}})(?![\w:])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9A-Za-z])",
    **{kind: _after_title(kind) for kind in TITLES},
}
# all titles in one: the kind of a person is read from what stands before
ANY = "|".join(f"(?:{p})" for p in [*[p for k, p in PATTERNS.items() if k not in TITLES], _after_title(*TITLES)])
# No pattern matches in a text without one of these: a cheap test first.
HINT = rf"[0-9@]|AKIA|(?i:{SECRET}|{API})[\"']? ?[=:]|(?:{'|'.join(TITLES.values())})\.? \p{{Lu}}"

# Surrogate first and last names by gender and script.
NAMES: dict[tuple[str, str], tuple[str, ...]] = {
    ("f", "latin"): ("Alma", "Berta", "Clara", "Dora", "Elena", "Flora", "Greta", "Hanna", "Ida", "Julia", "Klara", "Lena", "Marta", "Nora", "Olga", "Paula"),
    ("m", "latin"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jakob", "Karl", "Leo", "Martin", "Nils", "Oscar", "Paul"),
    ("f", "cyrillic"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Инна", "Клара", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "Софья"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Сергей"),
    ("f", "greek"): ("Άννα", "Βάσω", "Γιώτα", "Δήμητρα", "Ελένη", "Ζωή", "Ηρώ", "Θάλεια", "Ιωάννα", "Κλειώ", "Λίνα", "Μαρία", "Νίκη", "Ξένια", "Ρέα", "Σοφία"),
    ("m", "greek"): ("Άρης", "Βασίλης", "Γιώργος", "Δημήτρης", "Ευάγγελος", "Ζήσης", "Ηλίας", "Θωμάς", "Ιωάννης", "Κώστας", "Λάμπρος", "Μάρκος", "Νίκος", "Πέτρος", "Σπύρος", "Φώτης"),
}
SYLLABLES = {
    "latin": ("ba", "den", "fel", "gar", "hol", "kam", "lin", "mor", "nev", "pas", "ril", "sten", "tov", "ul", "ven", "zar"),
    "cyrillic": ("ба", "вен", "гор", "дан", "ел", "жар", "зим", "кор", "лин", "мар", "нев", "пол", "рин", "сев", "тов", "хол"),
    "greek": ("βα", "γιαν", "δελ", "ζαρ", "θε", "καρ", "λιν", "μορ", "νικ", "παπ", "ριν", "σταν", "τορ", "φιλ", "χαρ", "ψαλ"),
}


def _type_of(entity: Column) -> Column:
    """The first pattern that matches the whole entity (context dropped)."""
    out = F.lit(None).cast("string")
    for name in reversed([n for n in PATTERNS if not n.startswith(("person", "password", "token"))]):
        out = F.when(entity.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(out)
    return out


def _hmac(key: str, message: Column) -> Column:
    """HMAC-SHA-256 of a text, in hexadecimal."""
    k = key.encode()
    k = (hashlib.sha256(k).digest() if len(k) > 64 else k).ljust(64, b"\0")
    inner = F.sha2(F.concat(F.lit(bytes(c ^ 0x36 for c in k)), F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(F.lit(bytes(c ^ 0x5C for c in k)), F.unhex(inner)), 256)


def _digit(seed: Column, i: Column) -> Column:
    """Keyed number 0..15 for a place, from 64 hex digits that repeat."""
    return F.instr(F.lit("0123456789abcdef"), F.substring(seed, (F.pmod(i, F.lit(64)) + 1).cast("int"), F.lit(1))) - 1


def _reshaped(value: Column, seed: Column, keep: int = 0) -> Column:
    """Each letter and digit replaced by another of its kind (case, script);
    everything else and the first ``keep`` characters stay."""
    kinds = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ",
             "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")

    def one(c: Column, i: Column) -> Column:
        n = _digit(seed, i) * 16 + _digit(seed, i + 31)
        out = c
        for kind in kinds:
            out = F.when(F.contains(F.lit(kind), c), F.substring(F.lit(kind), (F.pmod(n, F.lit(len(kind))) + 1).cast("int"), F.lit(1))).otherwise(out)
        return F.when(i < keep, c).otherwise(out)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _check_digit(value: Column) -> Column:
    """The card number with its last digit set so that the Luhn sum holds."""
    digits = F.reverse(F.split(F.regexp_replace(F.substring(value, F.lit(1), F.length(value) - 1), "[^0-9]", ""), ""))
    doubled = F.transform(
        digits, lambda d, i: F.when(i % 2 == 0, (d.cast("int") * 2).cast("int")).otherwise(d.cast("int"))
    )
    total = F.aggregate(doubled, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x))
    return F.concat(F.substring(value, F.lit(1), F.length(value) - 1), F.pmod(-total, F.lit(10)).cast("string"))


def _pick(values: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))


def _person(value: Column, seed: Column, gender: str, syllables: int) -> Column:
    script = F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    out = None
    for s, parts in SYLLABLES.items():
        last = F.initcap(F.concat(*[_pick(parts, _digit(seed, F.lit(3 + 4 * k))) for k in range(syllables)]))
        names = NAMES[("f", s)] + NAMES[("m", s)] if gender == "n" else NAMES[(gender, s)]
        first = _pick(names, _digit(seed, F.lit(1)) * 16 + _digit(seed, F.lit(2)))
        whole = F.when(value.contains(" "), F.concat(first, F.lit(" "), last)).otherwise(last)
        out = F.when(script == s, whole) if out is None else out.when(script == s, whole)
    return out


def surrogate(kind: Column, value: Column, seed: Column, syllables: int = 4) -> Column:
    """The type's surrogate for ``value`` under a hexadecimal seed; a surname has
    so many syllables."""
    n = lambda i: _digit(seed, F.lit(2 * i)) * 16 + _digit(seed, F.lit(2 * i + 1))
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    # reserved: 240.0.0.0/4 routes nowhere; .invalid is no domain; 555-01xx
    # numbers are too few for large corpora, so digits keep the format only
    ip = F.concat_ws(".", (F.lit(240) + _digit(seed, F.lit(60)) % 15).cast("string"), *[n(k).cast("string") for k in (1, 2, 3)])
    ipv6 = F.concat_ws(":", F.lit("2001:db8"), *[F.substring(seed, 4 * k + 1, 4) for k in range(6)])  # for documentation
    email = F.concat(_reshaped(local, seed), F.lit("@"), _reshaped(F.regexp_replace(domain, r"\.[^.]*$", ""), F.reverse(seed)), F.lit(".invalid"))
    return (
        F.when(kind == "email", email)
        .when(kind == "ipv4", ip)
        .when(kind == "card", _check_digit(_reshaped(value, seed)))
        .when(kind == "aws_key", _reshaped(value, seed, 4))
        .when(kind == "iban", _reshaped(value, seed, 2))
        .when(kind == "phone", _reshaped(value, seed, 2))
        .when(kind == "ipv6", ipv6)
        .when(kind == "person_f", _person(value, seed, "f", syllables))
        .when(kind == "person_m", _person(value, seed, "m", syllables))
        .when(kind == "person_n", _person(value, seed, "n", syllables))
        .otherwise(_reshaped(value, seed))
    )


def _is_person(kind: Column) -> Column:
    return kind.startswith("person")


def _mark(kind: Column, value: Column) -> Column:
    """What no two surrogates share: the whole, or a person's surname."""
    return F.when(_is_person(kind), F.substring_index(value, " ", -1)).otherwise(value)


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """``kind, entity, surrogate`` for distinct ``kind, entity`` rows: a
    surrogate stands for one entity and is no entity itself. Surnames grow
    longer the more often they had to be drawn, so their stock does not end."""
    kind, value, new = F.col("kind"), F.col("entity"), F.col("surrogate")

    def drawn(rows: DataFrame, attempt: int) -> DataFrame:
        seed = _hmac(key, F.concat_ws("|", kind, value, F.lit(str(attempt))))
        rows = rows.withColumn("surrogate", surrogate(kind, value, seed, 4 + min(attempt // 2, 8)))
        return rows.withColumn("mark", _mark(kind, new))

    words = F.when(_is_person(kind), F.split(value, " ")).otherwise(F.array(value))
    originals = entities.select(F.explode(F.array_union(words, F.array(value))).alias("mark")).distinct()
    done = None
    open_rows = written(drawn(entities, 0), "pii-round0")
    for attempt in range(1, ROUNDS + 1):
        first = F.row_number().over(Window.partitionBy("mark").orderBy("kind", "entity"))
        free = open_rows.join(originals, "mark", "left_anti")
        if done is not None:
            free = free.join(done.select("mark"), "mark", "left_anti")
        good = free.withColumn("n", first).where("n = 1").select("kind", "entity", "surrogate", "mark")
        done = written(good if done is None else done.union(good), f"pii-done{attempt}")
        rest = open_rows.join(done, ["kind", "entity"], "left_anti")
        if rest.isEmpty():
            return done.drop("mark")
        open_rows = written(drawn(rest.select("kind", "entity"), attempt), f"pii-round{attempt}")
    # a format too small for distinct surrogates: numbered, so distinctness still holds
    tag = F.concat(F.lit("["), F.upper(kind), F.lit("-"), F.substring(_hmac(key, F.concat_ws("|", kind, value)), 1, 24), F.lit("]"))
    return done.drop("mark").union(open_rows.select("kind", "entity", tag.alias("surrogate")))


def _kinds(text: Column, found: Column) -> Column:
    """Type and text of every match: by its own form, or by what stands before it."""
    spots = F.arrays_zip(F.split(text, ANY, -1).alias("before"), found.alias("e"))

    def one(spot: Column) -> Column:
        before, e = F.substring(spot["before"], -40, 40), spot["e"]
        title = lambda kind: before.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{TITLES[kind]})\.? (?:(?:Dr|Prof)\.? )?$")
        kind = (
            F.when(e.rlike(f"^(?:{PATTERNS['email']}|{PATTERNS['aws_key']})$"), _type_of(e))
            .when(before.rlike(rf"{SECRET}[\"']? ?[=:] ?[\"']?$"), "password")
            .when(before.rlike(rf"{API}[\"']? ?[=:] ?[\"']?$") & e.rlike(r"^[0-9A-Za-z_.-]{8,}$"), "token")
            .when(e.rlike(rf"^{NAME}$") & title("person_f"), "person_f")
            .when(e.rlike(rf"^{NAME}$") & title("person_m"), "person_m")
            .when(e.rlike(rf"^{NAME}$") & title("person_n"), "person_n")
            .otherwise(_type_of(e))
        )
        return F.struct(kind.alias("kind"), e.alias("entity"))

    return F.transform(F.slice(spots, F.lit(1), F.size(spots) - 1), one)


def _first(name: Column) -> Column:
    return F.substring_index(name, " ", 1)


def _last(name: Column) -> Column:
    return F.substring_index(name, " ", -1)


def _full_names(found: Column) -> Column:
    """Distinct persons of a document who are named in full; one whose title
    tells no gender takes that of the same name under another title."""
    full = F.array_distinct(F.filter(found, lambda e: _is_person(e["kind"]) & e["entity"].contains(" ")))

    def gendered(p: Column) -> Column:
        same = F.filter(full, lambda q: (q["entity"] == p["entity"]) & (q["kind"] != "person_n"))
        kind = F.when(p["kind"] == "person_n", F.coalesce(F.array_min(F.transform(same, lambda q: q["kind"])), p["kind"]))
        return F.struct(F.coalesce(kind, p["kind"]).alias("kind"), p["entity"].alias("entity"))

    return F.array_distinct(F.transform(full, gendered))


def _linked(full: Column, kind: Column, name: Column, any_gender: bool) -> Column:
    """``kind, entity, part`` of a mention: the one person of the document it
    fits, and which part of the name it gives; else itself."""
    fits = F.filter(
        full,
        lambda p: ((p["entity"] == name) | (_last(p["entity"]) == name) | (_first(p["entity"]) == name))
        & (F.lit(any_gender) | (p["kind"] == kind) | (kind == "person_n") | (p["kind"] == "person_n")),
    )
    one = F.get(fits, F.lit(0))
    part = F.when(one["entity"] == name, "whole").when(_last(one["entity"]) == name, "last").otherwise("given")
    found = F.struct(one["kind"].alias("kind"), one["entity"].alias("entity"), part.alias("part"))
    own = F.struct(kind.alias("kind"), name.alias("entity"), F.lit("whole").alias("part"))
    return F.when(F.size(fits) == 1, found).otherwise(own)


def _aliases(found: Column, full: Column) -> Column:
    """The single words that name a person of the document again: ``word``
    and what it is linked with. First names of one or two letters are none."""
    person = lambda p, word: F.struct(word.alias("word"), p["kind"].alias("kind"))
    names = F.concat(
        F.transform(full, lambda p: person(p, _last(p["entity"]))),
        F.transform(F.filter(full, lambda p: F.length(_first(p["entity"])) > 2), lambda p: person(p, _first(p["entity"]))),
        F.transform(F.filter(found, lambda e: _is_person(e["kind"]) & ~e["entity"].contains(" ")), lambda e: person(e, e["entity"])),
    )
    kept = F.filter(F.array_sort(F.array_distinct(names)), lambda a: F.length(a["word"]) > 1)
    return F.transform(kept, lambda a: F.struct(a["word"].alias("word"), _linked(full, a["kind"], a["word"], True).alias("who")))


def _mentions(part: Column, full: Column, aliases: Column) -> Column:
    """A stretch between matches, cut at its capitalised words: ``gap, word,
    who`` (null: names nobody of the document); the last has no word."""
    gaps, words = F.split(part, LONE, -1), F.regexp_extract_all(part, F.lit(LONE), F.lit(0))
    n = F.size(words)
    none = F.array(F.lit(None).cast("string"))
    row = F.arrays_zip(
        gaps.alias("gap"), words.alias("word"), F.slice(gaps, F.lit(2), n + 1).alias("after"),
        F.slice(F.concat(words, none), F.lit(2), n + 1).alias("next"), F.concat(none, words).alias("prev"),
    )

    def one(x: Column) -> Column:
        named = lambda name: F.get(F.filter(full, lambda p: p["entity"] == name), F.lit(0))
        to_next = named(F.when(x["after"] == " ", F.concat_ws(" ", x["word"], x["next"])))
        to_prev = named(F.when(x["gap"] == " ", F.concat_ws(" ", x["prev"], x["word"])))
        alias = F.get(F.filter(aliases, lambda a: a["word"] == x["word"]), F.lit(0))["who"]
        as_part = lambda p, name: F.struct(p["kind"].alias("kind"), p["entity"].alias("entity"), F.lit(name).alias("part"))
        another = (alias["part"] == "given") & (x["after"] == " ") & x["next"].isNotNull()  # that name before another surname
        who = (
            F.when(to_next["entity"].isNotNull(), as_part(to_next, "first"))
            .when(to_prev["entity"].isNotNull(), as_part(to_prev, "last"))
            .when(alias["entity"].isNotNull() & ~another, alias)
        )
        return F.struct(x["gap"].alias("gap"), x["word"].alias("word"), who.alias("who"))

    return F.transform(row, one)


def _put(who: Column, names: Column) -> Column:
    """The surrogate of a mention; a first name alone stays alone unless
    another person of the document was given the same one."""
    new = F.element_at(names, F.struct(who["kind"].alias("kind"), who["entity"].alias("entity")))
    same = F.filter(F.map_values(names), lambda v: v.startswith(F.concat(_first(new), F.lit(" "))))
    given = F.when(F.size(same) > 1, new).otherwise(_first(new))
    return F.when(who["part"] == "first", _first(new)).when(who["part"] == "last", _last(new)).when(who["part"] == "given", given).otherwise(new)


def replace_entities(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and ``entities``
    (how many mentions) and ``kinds`` (distinct types, sorted) added (columns of
    these names are replaced); one row per row.

    ``key`` is the caller's secret: whoever has it can test guesses. The same
    entity has the same surrogate in all rows; different entities have
    different ones; reruns with the same key agree. Null and empty texts
    and texts without entities stay as they are (entities 0). ids may be null
    or repeated. An n_chars column follows the new text; any other columns may
    have any names.
    """
    names = [c for c in docs.columns if c not in OUT]
    t, body = F.col("text"), F.col(f"`{text}`")
    # the document's own columns in one struct: no name of theirs can clash
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias("own"), body.alias("text"), F.col(f"`{doc_id}`").alias("id")
    )
    # every text is searched once; the table of matches holds all rows
    found = written(rows.withColumn("found", F.when(t.rlike(HINT), F.regexp_extract_all(t, F.lit(ANY), F.lit(0)))), "pii-matches")
    has = F.coalesce(F.size("found") > 0, F.lit(False))
    none = found.where(~has)
    some = written(found.where(has).withColumn("found", _kinds(t, F.col("found"))), "pii-kinds")
    some = some.withColumn("full", _full_names(F.col("found")))
    some = written(
        some.withColumn("aliases", _aliases(F.col("found"), F.col("full"))).withColumn(
            "found",
            F.transform(
                "found",
                lambda e: F.when(_is_person(e["kind"]), _linked(F.col("full"), e["kind"], e["entity"], False)).otherwise(
                    F.struct(e["kind"].alias("kind"), e["entity"].alias("entity"), F.lit("whole").alias("part"))
                ),
            ),
        ).withColumn("row", F.concat_ws("#", F.xxhash64("id", t), F.sha1(t))),
        "pii-found",
    )
    who = F.concat(
        F.transform("found", lambda e: F.struct(e["kind"].alias("kind"), e["entity"].alias("entity"))),
        F.transform("aliases", lambda a: F.struct(a["who"]["kind"].alias("kind"), a["who"]["entity"].alias("entity"))),
        F.col("full"),
    )
    spots = some.select("row", F.explode(F.array_distinct(who)).alias("e")).distinct().select("row", "e.kind", "e.entity")
    names_of = written(surrogate_table(spots.select("kind", "entity").distinct(), key), "pii-table")
    maps = (
        spots.join(names_of, ["kind", "entity"])
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.struct("kind", "entity"), "surrogate"))).alias("names"))
    )
    parts = F.split(t, ANY, -1)
    plain = lambda p: F.array(
        F.struct(p.alias("gap"), F.lit(None).cast("string").alias("word"),
                 F.lit(None).cast("struct<kind:string,entity:string,part:string>").alias("who"))
    )
    cut = F.transform(
        parts, lambda p: F.when(F.size("aliases") == 0, plain(p)).otherwise(_mentions(p, F.col("full"), F.col("aliases")))
    )
    swapped = some.join(maps, "row").withColumn("cut", cut)
    said = lambda x: F.concat(
        F.coalesce(x["gap"], F.lit("")),
        F.when(x["who"].isNotNull(), _put(x["who"], F.col("names"))).otherwise(F.coalesce(x["word"], F.lit(""))),
    )
    whole = F.array_join(
        F.transform(
            F.arrays_zip(F.col("cut").alias("cut"), F.col("found").alias("found")),
            lambda x: F.concat(
                F.array_join(F.transform(x["cut"], said), ""),
                F.when(x["found"].isNotNull(), _put(x["found"], F.col("names"))).otherwise(F.lit("")),
            ),
        ),
        "",
    )
    again = F.filter(F.flatten("cut"), lambda x: x["who"].isNotNull())
    kinds = F.concat(F.transform("found", lambda e: e["kind"]), F.transform(again, lambda x: x["who"]["kind"]))
    out = swapped.select("own", whole.alias("text"), (F.size("found") + F.size(again)).alias("entities"),
                         F.array_join(F.array_sort(F.array_distinct(kinds)), ",").alias("kinds"))
    own = lambda c: F.col("own").getField(c).alias(c)
    changed = [
        t.alias(c) if c == text else F.length(t).cast("long").alias(c) if c == "n_chars" else own(c) for c in names
    ]
    return out.select(*changed, *OUT).union(none.select(*[t.alias(c) if c == text else own(c) for c in names], F.lit(0).alias("entities"), F.lit("").alias("kinds")))
