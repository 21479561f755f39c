"""PII surrogates: detected entities get keyed, type-consistent replacements, distinct and stable."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.llm.hot import join_by_weight
from tarnweave.session import stash

#: Titles by gender, and syllables by script.
_MALE = "Mr|Mister|Herr|Monsieur|Señor|Sr|Don|Господин"
_FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Doña|Госпожа"
_EITHER = "Dr|Prof"
_TITLES = rf"(?:{_MALE}|{_FEMALE}|{_EITHER})\.? (?:(?:{_EITHER})\.? )*"
#: Lower-case words within names, and the words of names: initials, or capitalised.
_PARTICLES = (
    "von|vom|van|zu|zur|zum|der|den|dem|de|del|dela|della|di|da|do|dos|das|du|des|la|las|le|les|los|ten|ter|te|af|av|el|al|bin|ibn|y|e|и"
)
_INITIALS = r"(?:\p{Lu}\.-?)*\p{Lu}(?:\.|(?![\p{L}\p{M}'’-]))"
_NAME = rf"(?:{_INITIALS}|(?:\p{{Ll}}{{1,3}}['’-])?\p{{Lu}}[\p{{L}}\p{{M}}'’-]+)"
_NEXT = rf"(?:(?:{_PARTICLES}) ){{0,4}}{_NAME}"
#: Country codes, which surrogates of phone numbers keep.
_COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
_V4 = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
_H = "[0-9A-Fa-f]{1,4}"
_V6_END = r"(?![\p{L}\p{N}_:]|\.[0-9])"
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ge ka ke ko la le lo ma me mo na ne no pa ra re ro sa se so ta te va".split(),
    "cyrillic": "ба бе бо да де до ва ве га го ка ке ко ла ле ло ма ме мо на не но па ра ре ро са се со та те за".split(),
    "greek": "βα βε βο δα δε δο γα γε ζα ζε κα κε κο λα λε λο μα με μο να νε νο πα ρα ρε ρο σα σε σο τα τε φα".split(),
}
_ENDINGS = {
    "latin": {"m": "rin", "f": "lia", "x": "rel", "family": "sen"},
    "cyrillic": {"m": "рин", "f": "лия", "x": "рель", "family": "нко"},
    "greek": {"m": "ρος", "f": "λια", "x": "ρελ", "family": "δης"},
}
#: What entities look like, those that hold others first; the first kinds begin a word.
_WORDS = {
    "name": rf"(?=\p{{Lu}}){_TITLES}{_NEXT}(?: {_NEXT})*",
    "secret": r"(?=[AaPpSsTt])(?i:password|passwd|secret|token|api_key|apikey)\s?[=:]\s?\"?[A-Za-z0-9_/+-]{12,}",
    "access_key": r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    "email": r"(?<![\p{M}.%+-])[\p{L}\p{N}][\p{L}\p{M}\p{N}._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip6": rf"(?=[0-9A-Fa-f]{{1,4}}:)(?:(?:{_H}:){{6}}{_V4}|(?:{_H}:){{1,6}}(?::{_H}){{0,5}}:{_V4}|(?:{_H}:){{7}}{_H}"
    rf"|(?:{_H}:){{1,6}}(?::{_H}){{1,6}}|(?=[A-Fa-f:]*[0-9])(?:{_H}:){{1,7}}:){_V6_END}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
_NUMBERS = {
    "ip": rf"(?<![0-9.]){_V4}(?!\.?[0-9])",
    "ip6_short": rf"(?<![\p{{L}}\p{{N}}_:])::(?:(?:{_H}:){{0,5}}{_V4}|{_H}(?::{_H}){{0,6}}){_V6_END}",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])(?:"
    r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"  # 3-3-4
    r"|(?:\+|00(?=[1-9][0-9]{0,2}[ ./-]))[1-9](?:[ ./-]?(?:\([0-9]{1,5}\)[ ./-]?)?[0-9]){7,14}"  # international
    r"|(?:\(0[1-9][0-9]{1,4}\)|0[1-9][0-9]{1,4}(?=[ /-]))(?: ?[/-] ?| )?(?=(?:[ -]?[0-9]){5})[0-9]{2,8}(?:[ -][0-9]{1,5}){0,4}"
    r"|0[1-9](?:(?: [0-9]{2}){4}|(?:\.[0-9]{2}){4}|(?:-[0-9]{2}){4})"  # pairs
    r"|[6-9][0-9]{2}(?:(?:[ -][0-9]{3}){2}|(?:[ .-][0-9]{2}){3})|9[0-9][ .-][0-9]{3}(?:[ .-][0-9]{2}){2}"  # nine digits
    r")(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
    r"|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{1,3}(?!\.?[0-9]))?)(?![0-9])",
}
_PATTERNS = _WORDS | _NUMBERS
#: Most places in a text are passed by after one look at two characters.
PATTERN = (
    rf"(?=[\p{{L}}\p{{N}}])(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(_WORDS.values())})|(?=[0-9+(:])(?:{'|'.join(_NUMBERS.values())})"
)


#: Parts whose surrogates a task draws.
_DRAWN = 2048


@dataclass(frozen=True)
class SurrogateParams:
    """``key``: secret that surrogates depend on; keep it to get the same ones again."""

    key: str = "tarnweave"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _kind(entity: Column) -> Column:
    """What is found, or null for digits that are no card number. A name without a title, found
    again where it stands with one elsewhere in the text, is a name too."""
    whole = lambda k: entity.rlike(rf"\A(?:{_PATTERNS[k]})\z")
    kind = F.coalesce(*(F.when(whole(k), F.lit(k)) for k in _PATTERNS), F.lit("name"))
    return F.when((kind != "card") | (_luhn_sum(_digits(entity)) % 10 == 0), kind)


def _again(text: Column, entities: Column) -> Column:
    """A pattern for what ``PATTERN`` finds and the text's titled names where they stand without a
    title: all their words, and each by itself that isn't also a word of the text in lower case.
    Null where no name is found."""
    named = F.filter(entities, lambda e: e.rlike(rf"^{_TITLES}"))
    whole = F.array_distinct(F.transform(named, lambda e: F.regexp_replace(e, f"^{_TITLES}", "")))
    word = lambda w: F.concat(F.lit(r"(?<!\p{L})\Q"), F.lower(w), F.lit(r"\E(?!\p{L})"))
    alone = lambda w: (
        (F.length(w) > 2) & w.rlike(rf"^(?!(?:{_MALE}|{_FEMALE}|{_EITHER})$)\p{{Lu}}") & ~w.rlike(f"^{_INITIALS}$") & ~F.regexp_like(text, word(w))
    )
    single = F.filter(F.array_distinct(F.flatten(F.transform(whole, lambda f: F.split(f, " ")))), alone)
    every = F.concat(F.filter(whole, lambda f: f.contains(" ")), single)
    longest_first = F.reverse(F.array_sort(F.transform(every, lambda f: F.struct(F.length(f), f.alias("f")))))
    any_of = F.array_join(F.transform(longest_first, lambda f: f["f"]), r"\E|\Q")
    pattern = F.concat(F.lit(PATTERN + r"|(?<![\p{L}\p{M}\p{N}_])(?:\Q"), any_of, F.lit(r"\E)(?![\p{L}\p{M}\p{N}_])"))
    return F.when(F.size(every) > 0, pattern)


def _names(entity: Column) -> Column:
    """The words after the titles."""
    return F.split(F.regexp_replace(entity, f"^{_TITLES}", ""), " ")


def _is_name(word: Column) -> Column:
    return ~word.rlike(f"^(?:{_PARTICLES})$")


def _parts(entity: Column, kind: Column) -> Column:
    """array<struct<kind, norm, given, sex>> of what is replaced: parts of equal kind and norm are
    one person or thing. ``given``: a name with others after it, or, if null, by itself."""
    part = lambda kind, norm, given=F.lit(False), sex=F.lit("x"): F.struct(
        kind.alias("kind"), norm.alias("norm"), given.alias("given"), sex.alias("sex")
    )
    one = lambda norm: F.array(part(kind, norm))
    title = F.regexp_extract(entity, r"^([^. ]+)", 1)
    sex = F.when(title.rlike(f"^(?:{_MALE})$"), "m").when(title.rlike(f"^(?:{_FEMALE})$"), "f").otherwise("x")
    names = F.filter(_names(entity), _is_name)
    national = F.regexp_replace(_digits(F.regexp_replace(entity, rf"^(?:\+|00){_COUNTRY}", "")), "^0+", "")
    given = lambda i: F.when(F.size(names) > 1, i < F.size(names) - 1)
    tokens = F.transform(names, lambda t, i: part(F.lit("name"), F.lower(t), given(i), sex))
    return (
        F.when(kind == "name", tokens)
        .when(kind == "secret", one(F.regexp_extract(entity, r"[=:]\s?\"?([^\"=:]+)$", 1)))
        .when(kind == "email", one(F.lower(entity)))
        .when(kind == "iban", one(F.regexp_replace(entity, " ", "")))
        .when(kind.isin("ssn", "card"), one(_digits(entity)))
        .when(kind == "phone", one(national))
        .when(kind.startswith("ip6"), F.array(part(F.lit("ip6"), F.lower(entity))))
        .otherwise(one(entity))
    )


def _stream(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """Keyed hexadecimal digits, four for each character of ``norm`` and of what it may be widened by."""
    blocks = F.sequence(F.lit(0), ((F.length(norm) + _wider(attempt)) / 32).cast("int"))
    seed = lambda b: F.concat_ws("\x1f", F.lit(key), kind, attempt.cast("string"), b.cast("string"), norm)
    return F.array_join(F.transform(blocks, lambda b: F.sha2(seed(b).cast("binary"), 512)), "")


def _wider(attempt: Column) -> Column:
    """By how many characters a surrogate is longer where shorter ones were taken again and again."""
    return F.floor(attempt / 8).cast("int")


def _draw(stream: Column, i: Column, n: int) -> Column:
    return F.pmod(F.conv(F.substring(stream, 4 * i + 1, 4), 16, 10).cast("int"), F.lit(n))


def _substituted(norm: Column, stream: Column, hexadecimal: Column, first: Column) -> Column:
    """Each letter and digit from ``first`` on drawn anew, of its class: Cyrillic and Greek letters
    from their own alphabets, those of other scripts, marks and Latin ones beyond ASCII from a to z."""

    def char(i: Column) -> Column:
        c = F.substring(norm, i + 1, 1)
        letter = lambda base, n: F.char(F.lit(base) + _draw(stream, i, n))
        of = lambda alphabet: F.substring(F.lit(alphabet), _draw(stream, i, len(alphabet)) + 1, F.lit(1))
        return (
            F.when(i < first, c)
            .when(c.between("0", "9"), _draw(stream, i, 10).cast("string"))
            .when(c.between("a", "z"), F.when(hexadecimal, letter(97, 6)).otherwise(letter(97, 26)))
            .when(c.between("A", "Z"), F.when(hexadecimal, letter(65, 6)).otherwise(letter(65, 26)))
            .when(c.rlike(r"\p{IsCyrillic}"), of("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(c.rlike(r"\p{IsGreek}"), of("αβγδεζηθικλμνξοπρστυφχψω"))
            .when(c.rlike(r"[\p{L}\p{M}]"), letter(97, 26))
            .when(c.rlike(r"\p{N}"), _draw(stream, i, 10).cast("string"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(0), F.length(norm) - 1), char), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, i, 1).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda a, x: a + x)


def _core(kind: Column, norm: Column, attempt: Column, stream: Column) -> Column:
    """The surrogate of a part, of its type and shape, drawn from its stream of digits."""
    sub = lambda s, first=0, hexa=None: _substituted(s, stream, F.lit(False) if hexa is None else hexa, F.lit(first))
    tail = F.regexp_extract(norm, r"(\.[a-z]+)$", 1)
    octets = F.concat_ws(".", *((1 + _draw(stream, F.lit(i), 254)).cast("string") for i in range(4)))
    line = sub(norm)
    groups = F.concat_ws(":", *(F.lower(F.substring(stream, 4 * i + 1, 4)) for i in range(8)))
    phone = F.concat(
        (2 + _draw(stream, F.lit(0), 8)).cast("string"), F.substring(line, 2, 2),
        (2 + _draw(stream, F.lit(3), 8)).cast("string"), F.substring(line, 5, 6),
    )
    lead = F.concat((1 + _draw(stream, F.lit(0), 9)).cast("string"), F.substring(line, F.lit(2), F.length(line)))
    phone = F.when(F.length(norm) == 10, phone).otherwise(lead)
    number = sub(norm, 1)
    body = F.substring(number, F.lit(1), F.length(number) - 1)
    check = F.pmod(10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    card = F.when(_luhn_sum(norm) % 10 == 0, F.concat(body, check)).otherwise(number)
    script = F.when(norm.rlike(r"\p{IsCyrillic}"), "cyrillic").when(norm.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    person = reduce(
        lambda other, pair: F.when((script == pair[0]) & (kind == f"name:{pair[1]}"), pair[2]).otherwise(other),
        [(s, g, _syllables(s, stream, attempt, _ENDINGS[s][g])) for s in _SYLLABLES for g in _ENDINGS[s]],
        F.lit(""),
    )
    return (
        F.when(kind.startswith("name:"), person)
        .when(kind == "email", F.concat(sub(F.concat(F.repeat(F.lit("a"), _wider(attempt)), F.substring(norm, F.lit(1), F.length(norm) - F.length(tail)))), tail))
        .when(kind == "ip", octets)
        .when(kind == "ip6", groups)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "iban", sub(norm, 2))
        .when(kind == "access_key", sub(norm, 4))
        .when(kind == "secret", sub(norm, 0, norm.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")))
        .otherwise(sub(norm))
    )


def _syllables(script: str, stream: Column, attempt: Column, ending: str) -> Column:
    table = F.array(*map(F.lit, _SYLLABLES[script]))
    pick = F.transform(
        F.sequence(F.lit(0), F.least(F.lit(1) + attempt, F.lit(20))),
        lambda i: F.element_at(table, _draw(stream, i, len(_SYLLABLES[script])) + 1),
    )
    return F.concat(F.array_join(pick, ""), F.lit(ending))


def surrogates(parts: DataFrame, key: str, attempts: int = 64) -> DataFrame:
    """(kind, norm) rows -> (kind, norm, core), one row for each distinct part.

    No two parts of a kind get the same surrogate and none gets one that is itself a part: of
    parts that do, the first by order keeps it and the others draw again, names and mail addresses
    growing longer. Parts that find none in ``attempts`` draws, as hardly any of their form is
    free, exchange their values among themselves: those surrogates are real values, of other parts."""
    real = stash(parts.select("kind", "norm").distinct())
    tasks = max(1, -(-real.count() // _DRAWN))
    space = F.regexp_replace("kind", ":.*", "").alias("space")
    theirs = real.select(space, F.col("norm").alias("core")).distinct()
    pending, taken = real.withColumn("attempt", F.lit(0)), None
    for _ in range(attempts):
        # few bytes, much work: the number of tasks is given, so that none are joined
        seeded = pending.repartition(tasks, "kind", "norm").withColumn(
            "stream", _stream(F.col("kind"), F.col("norm"), F.col("attempt"), key)
        )
        core = _core(F.col("kind"), F.col("norm"), F.col("attempt"), F.col("stream"))
        drawn = stash(seeded.withColumn("core", core).drop("stream"))
        winners = drawn.groupBy("kind", "core").agg(F.min("norm").alias("norm"))
        free = winners.withColumn("space", space).join(theirs, ["space", "core"], "left_anti").drop("space")
        if taken is not None:
            free = free.join(taken, ["kind", "core"], "left_anti")
        good = stash(free.select("kind", "norm", "core"))
        taken = good if taken is None else taken.unionByName(good)
        pending = stash(
            drawn.join(good, ["kind", "norm"], "left_anti").select("kind", "norm", (F.col("attempt") + 1).alias("attempt"))
        )
        if pending.isEmpty():
            return taken
    return _exchanged(pending.select("kind", "norm"), taken, key, tasks)


def _exchanged(left: DataFrame, taken: DataFrame, key: str, tasks: int) -> DataFrame:
    """``taken`` with the parts that found no free surrogate, as those of their form are all in use:
    they exchange their own values in a keyed ring, so that each gets another's and no two the same.

    Rings are of parts of a kind and form; within ``tasks`` shares of these first, then of those that
    were alone in theirs. One that is alone in its form changes places with a part that has one."""
    form = F.regexp_replace(F.regexp_replace("norm", "[0-9]", "9"), r"[\p{L}\p{M}]", "a")
    place = F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "norm").cast("binary"), 256)
    open_, done = left.select("kind", "norm", form.alias("form"), place.alias("place")), taken
    for shares in (tasks, 1):
        share = F.pmod(F.xxhash64("place"), F.lit(shares))
        ring = Window.partitionBy("kind", "form", share).orderBy("place")
        around = F.first("norm").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        given = stash(open_.withColumn("core", F.coalesce(F.lead("norm").over(ring), around)))
        done = done.unionByName(given.where("core <> norm").select("kind", "norm", "core"))
        open_ = given.where("core = norm").drop("core")
    other = taken.withColumn("form", F.regexp_replace(F.regexp_replace("norm", "[0-9]", "9"), r"[\p{L}\p{M}]", "a"))
    other = other.groupBy("kind", "form").agg(F.min(F.struct("norm", "core")).alias("t"))
    pairs = stash(open_.join(other, ["kind", "form"], "left"))
    if not pairs.where("t is null").isEmpty():
        raise RuntimeError("a part has the only value of its kind and form")
    swapped = pairs.select("kind", "norm", F.col("t.core").alias("core")).unionByName(
        pairs.select("kind", F.col("t.norm").alias("norm"), F.col("norm").alias("core"))
    )
    return done.join(swapped.select("kind", "norm"), ["kind", "norm"], "left_anti").unionByName(swapped)


def _formed(parts: DataFrame) -> DataFrame:
    """``parts`` with the kind of a name saying which form it has wherever it stands: that of a
    given name, by the titles that it goes with, or of a family name."""
    names = parts.where("kind = 'name'")
    sexed = lambda s: F.coalesce(F.max((F.col("sex") == s) & F.coalesce("given", F.lit(True))), F.lit(False))
    by_norm = names.groupBy("norm").agg(
        F.coalesce(F.max("given"), F.lit(False)).alias("first"), sexed("m").alias("m"), sexed("f").alias("f"), F.count("*").alias("n")
    )
    form = F.when(~F.col("first"), "family").when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("x")
    forms = stash(by_norm.select("norm", F.concat(F.lit("name:"), form).alias("formed"), "n"))
    plain = ["entity", "of", "no", "kind", "norm"]
    formed = join_by_weight(names.drop("kind"), forms, "norm", "n").withColumn("kind", F.col("formed"))
    return parts.where("kind <> 'name'").select(*plain).unionByName(formed.select(*plain))


def _slots(entity: Column, core: Column, slot: str) -> Column:
    """The entity's shape with the characters of ``core`` in its last slots of the class."""
    free = lambda s: F.length(F.regexp_replace(s, f"[^{slot}]", ""))
    spare = free(entity) - F.length(core)

    def char(i: Column) -> Column:
        c, k = F.substring(entity, i, 1), free(F.substring(entity, F.lit(1), i)) - spare
        return F.when(c.rlike(f"[{slot}]") & (k > 0), F.substring(core, k, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)), char), "")


def _cased(model: Column, s: Column) -> Column:
    """``s`` in the case of ``model``: all capitals, a capital first, or letter by letter."""
    char = lambda i: F.when(
        F.substring(model, i, 1).rlike(r"\p{Lu}"), F.upper(F.substring(s, i, 1))
    ).otherwise(F.substring(s, i, 1))
    by_letter = F.array_join(F.transform(F.sequence(F.lit(1), F.length(s)), char), "")
    return F.when(model.rlike(r"^\P{Ll}{2,}$"), F.upper(s)).when(model.rlike(r"^\p{Lu}"), F.initcap(s)).otherwise(by_letter)


def _initials(model: Column, s: Column) -> Column:
    """``model`` with letters of ``s`` in place of its own, none of which stays."""
    char = lambda i: F.lower(F.substring(model, i, 1)) == F.substring(s, i, F.lit(1))
    return F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(model)),
            lambda i: F.when(~F.substring(model, i, 1).rlike(r"\p{L}"), F.substring(model, i, 1)).otherwise(
                F.upper(F.substring(s, F.when(char(i), i + 1).otherwise(i), F.lit(1)))
            ),
        ),
        "",
    )


def _shaped(entity: Column, kind: Column, cores: Column) -> Column:
    core = F.element_at(cores, 1)
    names = _names(entity)
    nth = lambda i: F.get(cores, F.size(F.filter(F.slice(names, F.lit(1), i + 1), _is_name)) - 1)
    initials = lambda w: w.rlike(f"^{_INITIALS}$")
    full = F.array_join(
        F.transform(
            names,
            lambda w, i: F.when(~_is_name(w), w).when(initials(w), _initials(w, nth(i))).otherwise(_cased(w, nth(i))),
        ),
        " ",
    )
    same_length = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(core)),
            lambda i: F.when(F.substring(entity, i, 1).rlike(r"\p{Lu}"), F.upper(F.substring(core, i, 1))).otherwise(
                F.substring(core, i, 1)
            ),
        ),
        "",
    )
    return (
        F.when(kind == "name", F.concat(F.regexp_extract(entity, f"^({_TITLES})", 1), full))
        .when(kind == "email", same_length)
        .when(kind == "secret", F.concat(F.substring(entity, F.lit(1), F.length(entity) - F.length(core)), core))
        .when(kind.isin("phone", "ssn", "card"), _slots(entity, core, "0-9"))
        .when(kind == "iban", _slots(entity, core, "A-Z0-9"))
        .otherwise(core)
    )


def replace_pii(
    docs: DataFrame, params: SurrogateParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row's id (under the name of ``id_col``), text with surrogates, and n_entities.

    Names after a title (any number of words, initials and particles), the same names and their
    words elsewhere in the text, e-mail, IPv4 and IPv6 addresses, phone numbers (international, or
    in the national groupings of North America, Germany, France and Spain), card numbers that pass
    the Luhn check, social security and IBAN numbers, access keys and assigned secrets are found by
    pattern. What is replaced depends on the key, the type and the normal form (case, spacing and
    punctuation aside) alone, so an entity gets one surrogate in all documents, and so does each
    word of a name, whatever its title. Surrogates keep the type's shape: case, separators, title,
    script, given names' gender as titles show it, country code, top-level domain, valid octets and
    check digits.

    Null texts stay null with no entities; texts without entities stay as they are. Rows of equal
    id and text get equal results, whatever their number; null ids are ids like others. An empty
    table gives an empty result. Other columns are ignored."""
    p = params or SurrogateParams()
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    searched = stash(plain.withColumn("entities", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))))
    some = F.coalesce(F.size("entities"), F.lit(0)) > 0
    again = _again(F.col("text"), F.col("entities"))
    holders = searched.where(some).withColumn("th", F.xxhash64("text")).withColumn("again", again)
    entities = F.when(F.col("again").isNotNull(), F.regexp_extract_all("text", F.col("again"), F.lit(0))).otherwise(F.col("entities"))
    found = stash(
        holders.select("id", "th", entities.alias("entities"))
        .distinct()
        .select("id", "th", F.posexplode("entities").alias("at", "entity"))
        .withColumn("kind", _kind(F.col("entity")))
    )
    parts = stash(
        found.where("kind is not null").groupBy("entity", "kind").agg(F.count("*").alias("n"))
        .withColumn("parts", _parts(F.col("entity"), F.col("kind")))
    )
    every = stash(
        _formed(
            parts.select("entity", F.col("kind").alias("of"), F.posexplode("parts").alias("no", "part")).select(
                "entity", "of", "no", "part.*"
            )
        )
    )
    uses = every.groupBy("kind", "norm").agg(F.count("*").alias("uses"))
    drawn = stash(surrogates(every, p.key).join(uses, ["kind", "norm"]))
    cores = (
        join_by_weight(every, drawn, ["kind", "norm"], "uses")
        .groupBy("entity", "of")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("no", "core"))), lambda x: x["core"]).alias("cores"))
        .join(parts.select("entity", "n"), "entity")
    )
    shaped = stash(cores.select("entity", "n", _shaped(F.col("entity"), F.col("of"), F.col("cores")).alias("surrogate")))
    mentions = join_by_weight(found.where("kind is not null"), shaped, "entity", "n").select("id", "th", "at", "kind", "surrogate")
    left = found.where("kind is null").select("id", "th", "at", "kind", F.col("entity").alias("surrogate"))
    lists = (
        mentions.unionByName(left)
        .groupBy("id", "th")
        .agg(
            F.transform(F.array_sort(F.collect_list(F.struct("at", "surrogate"))), lambda x: x["surrogate"]).alias("new"),
            F.count("kind").alias("n_entities"),
        )
        .select(F.col("id").alias("new_id"), F.col("th").alias("new_th"), "new", "n_entities")
    )
    gaps = F.when(F.col("again").isNotNull(), F.split("text", F.col("again"), -1)).otherwise(F.split("text", PATTERN, -1))
    mended = F.array_join(
        F.flatten(F.zip_with(gaps, F.concat("new", F.array(F.lit(""))), lambda g, s: F.array(g, s))), ""
    )
    replaced = holders.join(
        lists.hint("merge"), F.col("id").eqNullSafe(F.col("new_id")) & (F.col("th") == F.col("new_th"))
    ).select("id", mended.alias("text"), "n_entities")
    untouched = searched.where(~some).select("id", "text", F.lit(0).cast("long").alias("n_entities"))
    return untouched.unionByName(replaced).select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_entities")
