"""Keyed, consistent surrogates for personal data, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import free_name, stored

# Forms of address by gender.
TITLES = {
    "m": ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Господин"],
    "f": [
        "Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra",
        "Señorita", "Doña", "Госпожа",
    ],
    "n": ["Dr", "Prof", "Mx", "Доктор"],
}
_ANY_TITLE = "|".join(f"{t}|{t.upper()}" for group in TITLES.values() for t in group)
# Particles that stand inside a name.
PARTICLES = ["van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "le", "ten", "zu", "y"]
_EDGE = r"(?<![\p{L}\p{N}])"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]{1,63}+(?:\.[\p{L}\p{N}-]{1,63}+)+"
IP = r"(?<![\p{L}\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)(?!\p{L})"
IP6 = (
    r"(?<![\p{L}\p{N}:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){1,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,4})?)(?![\p{L}\p{N}:])"
)
SSN = _EDGE + r"\d{3}-\d{2}-\d{4}(?![-\p{L}\d])"
CARD = _EDGE + r"(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?)(?![\p{L}\d])"
PHONE = (
    r"(?<![\p{L}\d])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\p{L}\d])"
)
#: A word of a name: capital first, perhaps with hyphens and apostrophes.
WORD = r"\p{Lu}[\p{L}\p{M}]*+(?:['’-]\p{L}[\p{L}\p{M}]*+)*+"
_NEXT = rf"(?:(?:{'|'.join(PARTICLES)})\x20){{0,2}}{WORD}"
#: A form of address and up to four words, read forwards: nothing is looked for behind.
NAME = rf"{_EDGE}(?=\p{{Lu}})(?:{_ANY_TITLE})\.?\x20{_NEXT}(?:\x20{_NEXT}){{0,3}}"
ENTITY = "|".join([EMAIL, IP, IP6, SSN, CARD, PHONE, NAME])
#: Stands on both sides of an entity in a marked text; `ESCAPED` is what becomes of its first
#: character where a text holds it.
MARK, ESCAPE, ESCAPED = "\x01\x03", "\x01", "\x01\x02"
#: Draws of one entity, at most, before the space of its kind counts as exhausted.
MAX_DRAWS = 40

LATIN = ["ba", "be", "da", "do", "fe", "ga", "he", "jo", "ka", "le", "lo", "ma", "mi", "na", "no", "ra", "re", "sa", "te", "vi"]
CYRILLIC = ["ба", "ве", "га", "до", "же", "за", "ки", "ла", "ло", "ма", "ми", "на", "но", "ра", "ре", "са", "та", "те", "фе", "ши"]
LETTERS, CYRILLIC_LETTERS = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшщэюя"


def _kind(hit: Column) -> Column:
    return (
        F.when(hit.contains("@"), "email")
        .when(hit.rlike(rf"^(?:{IP})$"), "ip")
        .when(hit.rlike(rf"^(?:{IP6})$"), "ip6")
        .when(hit.rlike(rf"^(?:{SSN})$"), "ssn")
        .when(hit.rlike(rf"^(?:{CARD})$"), "card")
        .when(hit.rlike(r"^[+(\d]"), "phone")
        .otherwise("name")
    )


def _norm(hit: Column, kind: Column) -> Column:
    """What all spellings of one entity have in common: its digits, or its lower case."""
    return F.when(kind.isin("ssn", "card", "phone"), F.regexp_replace(hit, r"\D", "")).otherwise(F.lower(hit))


def _entity(kind: Column, hit: Column) -> Column:
    return F.struct(kind.alias("kind"), _norm(hit, kind).alias("norm"), hit.alias("hit"))


def _marked(text: Column, pattern: Column | str) -> Column:
    """The text cut at its entities: every second part is one. One pass of the pattern."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    return F.split(F.regexp_replace(text, pattern, F.lit(f"{MARK}$0{MARK}")), MARK, -1)


def _hits(parts: str) -> Column:
    return F.filter(parts, lambda _, k: k % 2 == 1)


_TITLED = rf"^(?:{_ANY_TITLE})\.?\x20"


def _name_words(hit: Column) -> Column:
    """Words of a titled name with their kinds: the last is a surname, the others are given
    names of the title's gender. Particles stay."""
    words = F.filter(F.split(F.regexp_replace(hit, _TITLED, ""), " "), lambda w: w.rlike(r"^\p{Lu}"))

    def titled(gender: str) -> Column:
        return F.lower(hit).rlike(rf"^(?:{'|'.join(t.lower() for t in TITLES[gender])})\.?\x20")

    given = F.when(titled("m"), "given_m").when(titled("f"), "given_f").otherwise("given_n")

    def word(w: Column, k: Column) -> Column:
        return F.struct(F.when(k == F.size(words) - 1, "surname").otherwise(given).alias("kind"), F.lower(w).alias("norm"), w.alias("hit"))

    return F.transform(words, word)


def with_entities(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds `_parts`, the text cut at its entities, and `_names`, the words of the names in it.

    A name is found after a form of address. Its words are then found wherever they stand in
    the same text, so a later bare mention is the same entity.
    """
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), ESCAPE, ESCAPED)
    cut = docs.withColumn("_parts", _marked(text, ENTITY))
    named = F.filter(_hits("_parts"), lambda h: h.rlike(_TITLED))
    words = F.array_distinct(F.flatten(F.transform(named, _name_words)))
    return cut.withColumn("_names", words)


def with_mentions(cut: DataFrame) -> DataFrame:
    """Cuts the texts that hold names once more, at every mention of their words."""
    spelled = F.array_join(F.array_distinct(F.transform("_names", lambda n: n["hit"])), "|")
    bare = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), spelled, F.lit(r")(?![\p{L}\p{N}])"))
    rest = "|".join([EMAIL, IP, IP6, SSN, CARD, PHONE])
    again = _marked(F.array_join("_parts", ""), F.concat(F.lit(f"{rest}|"), bare))
    return cut.withColumn("_parts", F.when(F.size("_names") > 0, again).otherwise(F.col("_parts")))


def _found(parts: str = "_parts", names: str = "_names") -> Column:
    """The entities of a cut text, in order."""

    def entity(hit: Column) -> Column:
        kind = _kind(hit)
        own = F.get(F.filter(names, lambda n: n["hit"] == hit), F.lit(0))["kind"]
        return _entity(F.when(kind == "name", F.coalesce(own, F.lit("surname"))).otherwise(kind), hit)

    return F.transform(_hits(parts), entity)


def _number(digest: Column, at: Column | int) -> Column:
    """A number from two hex digits of the digest; the position wraps around."""
    place = (at if isinstance(at, Column) else F.lit(at)) * 2 % 60 + 1
    return F.conv(F.substring(digest, place, F.lit(2)), 16, 10).cast("int")


def _digits(digest: Column) -> Column:
    return F.translate(digest, "abcdef", "012345")


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn scheme, of digits whose last one is the check digit."""

    def weighed(c: Column, at: Column) -> Column:
        value = c.cast("int")
        doubled = F.when(value > 4, value * 2 - 9).otherwise(value * 2)
        return F.when((F.length(digits) - at) % 2 == 0, doubled).otherwise(value)

    return F.aggregate(F.transform(F.split(digits, ""), weighed), F.lit(0), lambda a, x: a + x)


def _letters(text: Column, digest: Column) -> Column:
    """Letters to letters of the same script, digits to digits, the rest as it is."""

    def changed(c: Column, at: Column) -> Column:
        n = _number(digest, at)
        return (
            F.when(c.rlike(r"\d"), (n % 10).cast("string"))
            .when(c.rlike(r"\p{IsCyrillic}"), F.substring(F.lit(CYRILLIC_LETTERS), n % 28 + 1, F.lit(1)))
            .when(c.rlike(r"\p{L}"), F.substring(F.lit(LETTERS), n % 26 + 1, F.lit(1)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), changed), "")


def _name(kind: Column, norm: Column, digest: Column, draw: Column) -> Column:
    """Syllables of the name's script, one more per draw, with an ending of its gender."""

    def built(syllables: list[str], male: str, female: str, rest: str) -> Column:
        table = F.array(*[F.lit(s) for s in syllables])
        parts = F.transform(
            F.sequence(F.lit(0), draw + 1),
            lambda k: F.element_at(table, _number(digest, k) % len(syllables) + 1),
        )
        ending = F.when(kind == "given_m", male).when(kind == "given_f", female).otherwise(rest)
        return F.concat(F.array_join(parts, ""), ending)

    return F.when(norm.rlike(r"\p{IsCyrillic}"), built(CYRILLIC, "н", "на", "к")).otherwise(
        built(LATIN, "n", "na", "k")
    )


def surrogate(kind: Column, norm: Column, draw: Column, key: str) -> Column:
    """Replacement of a normalised entity, of the same kind; a later draw gives another."""

    def hashed(*parts: Column) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)

    digest = hashed(kind, norm, draw.cast("string"))
    digits, size = _digits(digest), F.length(norm)
    free = F.least(size, F.lit(10))
    phone = F.concat(F.substring(norm, F.lit(1), size - free), F.substring(digits, F.lit(1), free))
    body = F.concat(F.substring(norm, F.lit(1), F.lit(1)), F.substring(digits, F.lit(1), size - 2))
    check = (10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
    last = F.when(_luhn(norm) % 10 == 0, check.cast("string")).otherwise(F.substring(digits, F.lit(60), F.lit(1)))
    octets = [(_number(digest, k) % 254 + 1).cast("string") for k in range(4)]
    ip = (
        F.when(norm.startswith("10."), F.concat_ws(".", F.lit("10"), *octets[1:]))
        # 192.168 has few addresses: later draws go to the larger private range.
        .when(norm.startswith("192.168.") & (draw < 6), F.concat_ws(".", F.lit("192.168"), *octets[2:]))
        .when(norm.startswith("192.168."), F.concat_ws(".", F.lit("10"), *octets[1:]))
        .otherwise(F.concat_ws(".", (_number(digest, 0) % 111 + 11).cast("string"), *octets[1:]))
    )
    domain = F.substring_index(norm, "@", -1)
    top = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    # Short names have few others of their length, so later draws grow.
    longer = F.when(draw > 4, F.substring(digits, F.lit(40), draw - 2)).otherwise("")
    email = F.concat(
        _letters(F.substring_index(norm, "@", 1), digest), longer,
        F.lit("@"), _letters(host, hashed(F.lit("domain"), domain)), F.lit("."), top,
    )
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "ip6", _like(norm, digest, r"[0-9a-f]"))
        .when(kind == "ssn", F.substring(digits, 1, 9))
        .when(kind == "card", F.concat(body, last))
        .when(kind == "phone", phone)
        .otherwise(_name(kind, norm, digest, draw))
    )


def _like(text: Column, core: Column, taken: str) -> Column:
    """The text with its characters of a class replaced by those of `core`, in order."""

    def fill(state: Column, c: Column) -> Column:
        mine = c.rlike(taken)
        put = F.when(mine, F.substring(core, state["at"], F.lit(1))).otherwise(c)
        return F.struct(F.concat(state["text"], put).alias("text"), (state["at"] + mine.cast("int")).alias("at"))

    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))
    return F.aggregate(F.split(text, ""), start, fill, lambda state: state["text"])


def _formatted(kind: Column, hit: Column, core: Column) -> Column:
    """The replacement in the format of the original: its separators, or its letter case."""

    filled = _like(hit, core, r"\d")
    half = (F.length(core) / 2).cast("int")
    hyphened = F.concat_ws("-", F.initcap(F.substring(core, F.lit(1), half)), F.initcap(F.substring(core, half + 1, F.length(core))))
    name = F.when(hit.contains("-"), hyphened).otherwise(F.initcap(core))
    loud = (hit == F.upper(hit)) & (F.length(hit) > 1)
    return (
        F.when(kind.isin("ssn", "card", "phone"), filled)
        .when(kind.isin("email", "ip6"), F.when(loud, F.upper(core)).otherwise(core))
        .when(kind == "ip", core)
        .otherwise(F.when(loud, F.upper(core)).otherwise(name))
    )


def draws(found: DataFrame, key: str) -> DataFrame:
    """Entities whose first draw will not do, with the number of the draw that will.

    Over the distinct entities of the corpus: a surrogate must differ from every original
    of its kind and from every other surrogate. Of entities that share one the first in
    alphabetical order keeps it, the others draw again, until nothing clashes.
    """
    originals = stored(found.select("kind", "norm").distinct(), "pii-entities")

    def named(df: DataFrame) -> DataFrame:
        return df.withColumn("core", surrogate(F.col("kind"), F.col("norm"), F.col("draw"), key))

    state = stored(named(originals.withColumn("draw", F.lit(0))), "pii-draws")
    taken = originals.select("kind", F.col("norm").alias("core"))
    for _ in range(MAX_DRAWS):
        shared = state.groupBy("kind", "core").agg(F.min("norm").alias("first"), F.count("*").alias("n"))
        losers = state.join(shared.filter("n > 1"), ["kind", "core"]).filter("norm <> first")
        known = state.join(taken, ["kind", "core"], "left_semi")
        again = stored(
            losers.select("kind", "norm").unionByName(known.select("kind", "norm")).distinct(), "pii-again"
        )
        if again.isEmpty():
            return state.filter("draw > 0").select("kind", "norm", "draw")
        moved = state.join(again.withColumn("moved", F.lit(1)), ["kind", "norm"], "left").select(
            "kind", "norm", (F.col("draw") + F.coalesce("moved", F.lit(0))).alias("draw")
        )
        state = stored(named(moved), "pii-draws")
    raise RuntimeError(f"a kind of entity has too few surrogates for {MAX_DRAWS} draws")


def with_surrogates(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The documents with personal data replaced, and `n_entities`, the number replaced.

    E-mail addresses, IP and phone numbers, card and social security numbers, and names get
    surrogates of the same kind and format, keyed by `key`: one entity has one surrogate in
    the whole corpus, however it is written, and different entities have different ones
    (see `draws`). A name is found after a form of address, and from then on its words wherever they stand in the
    same text. Gender follows the title, script the name, valid card numbers stay valid,
    and addresses of one domain stay together.

    Every text is searched once, and stored in its parts. The first draw needs no lookup.
    Only entities that had to draw again are looked up, by a digest of the entities of a text;
    where there are none, the texts are put together without a shuffle. Equal entities combine on the
    map side before they are compared, so a hot one costs one row per task.

    Null texts stay null; rows may repeat; very long texts are read whole; other columns
    stay, whatever their names. If n_entities is taken, the number's name gets
    underscores. An empty table gives no rows.
    """
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_")).alias("_row") if others
        else F.struct(F.lit(0).alias("_")).alias("_row"),
        F.col(f"`{text_col}`").alias("_raw"),
    )
    cut = with_entities(rows, "_raw").withColumn("_null", F.col("_raw").isNull()).drop("_raw")
    cut = stored(cut, "pii-parts")
    whole = with_mentions(cut).select("_row", "_null", "_parts", _found().alias("_found"))
    exploded = whole.filter(F.size("_parts") > 1).select(
        F.xxhash64("_found").alias("_key"), F.explode("_found").alias("e")
    )
    exploded = stored(exploded.select("_key", "e.kind", "e.norm").distinct(), "pii-found")
    redrawn = stored(draws(exploded, key), "pii-redrawn")

    def name(kind: Column, norm: Column) -> Column:
        return F.concat_ws("|", kind, norm)

    if redrawn.isEmpty():
        known = whole.withColumn("_redrawn", F.create_map().cast("map<string,int>"))
    else:
        maps = (
            exploded.join(redrawn, ["kind", "norm"])
            .select("_key", F.struct(name(F.col("kind"), F.col("norm")), "draw").alias("entry"))
            .groupBy("_key")
            .agg(F.map_from_entries(F.collect_set("entry")).alias("_redrawn"))
        )
        known = whole.withColumn("_key", F.xxhash64("_found")).join(maps, "_key", "left")

    def replaced(e: Column) -> Column:
        again = F.coalesce(F.element_at("_redrawn", name(e["kind"], e["norm"])), F.lit(0))
        return _formatted(e["kind"], e["hit"], surrogate(e["kind"], e["norm"], again, key))

    def part(p: Column, k: Column) -> Column:
        kept = F.regexp_replace(p, ESCAPED, ESCAPE)
        return F.when(k % 2 == 0, kept).otherwise(F.get("_new", F.floor(k / 2).cast("int")))

    known = known.withColumn("_new", F.transform("_found", replaced))
    text = F.when(F.size("_parts") > 1, F.array_join(F.transform("_parts", part), "")).otherwise(
        F.regexp_replace(F.get("_parts", F.lit(0)), ESCAPED, ESCAPE)
    )
    return known.select(
        *[
            (F.when(~F.col("_null"), text) if c == text_col else F.col("_row")[c]).alias(c)
            for c in docs.columns
        ],
        F.size("_found").cast("bigint").alias(free_name(docs.columns, "n_entities")),
    )


def leftovers(before: DataFrame, after: DataFrame, text_col: str = "text") -> DataFrame:
    """Entities of the original texts that still occur, as entities, in the new ones."""

    def entities(df: DataFrame) -> DataFrame:
        rows = with_mentions(with_entities(df.select(text_col), text_col)).select(F.explode(_found()).alias("e"))
        return rows.select("e.kind", "e.norm").distinct()

    return entities(after).join(entities(before), ["kind", "norm"], "left_semi")
