"""Personal data replaced by keyed surrogates of the same kind.

Entities are found with patterns. Each distinct entity of the corpus gets one surrogate, made from a keyed hash of
its normal form: the same digits-and-letters shape, the same script, for names the same gender. Surrogates are
checked against each other and against all real entities; those that collide are made again. A surrogate is
then written in the format of each mention, so mentions of one entity stay mentions of one entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagemill.llm.columns import let, lookup, whole_text
from pagemill.session import written

MAX_ATTEMPTS = 40
# From this attempt on, surrogates of kinds without a fixed length get longer, a letter for as many attempts.
LONGER = 4

# Titles by gender, in several languages.
MALE_TITLES = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"]
FEMALE_TITLES = ["Mrs", "Ms", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"]
# Endings of made-up given names.
GIVEN_ENDINGS = {
    ("latin", "m"): "o", ("latin", "f"): "a", ("cyrillic", "m"): "ий", ("cyrillic", "f"): "ия",
    ("greek", "m"): "ης", ("greek", "f"): "ια",
}
# Syllables and endings of made-up family names.
SYLLABLES = {
    "latin": ["ba", "den", "fo", "gar", "hel", "ka", "lin", "mor", "na", "pel", "ro", "sten", "ta", "ven", "wal", "zi"],
    "cyrillic": ["ба", "вел", "гор", "дан", "жу", "кар", "лев", "мир", "ни", "пет", "ро", "сол", "тар", "фе", "чер", "щу"],
    "greek": ["βα", "γελ", "δο", "ζαν", "θε", "καρ", "λι", "μαν", "νο", "παπ", "ρα", "στα", "τσι", "φω", "χρι", "ψα"],
}
ENDINGS = {
    ("latin", "m"): "er", ("latin", "f"): "er", ("cyrillic", "m"): "ов", ("cyrillic", "f"): "ова",
    ("greek", "m"): "όπουλος", ("greek", "f"): "οπούλου",
}

NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
# In order: of patterns that fit at one place, the first decides.
PATTERNS = {
    "email": r"[\p{L}0-9._%+\-]+@[\p{L}0-9\-]+(?:\.[\p{L}0-9\-]+)+",
    "secret": r"(?i:\b(?:token|secret|password|api_key)\b\s*[=:]\s*\"[A-Za-z0-9+/_\-]{8,}\")|\bAKIA[0-9A-Z]{16}\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "phone": r"(?<![\d\w])(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)|(?<![\d\w])\+\d{1,3}(?:[ .\-]?\d{2,4}){3,4}(?!\d)|(?<![\d\w.\-])\d{3}(?:-\d{3}-|\.\d{3}\.)\d{4}(?![\d\w]|[.\-]\d)",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<![\d\w])\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}(?![\d\w])",
    "name": rf"(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(MALE_TITLES + FEMALE_TITLES)})\.? {NAME}(?: {NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def entity_kind(mention: Column) -> Column:
    """Which pattern the whole mention fits first."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return F.coalesce(kind, F.lit("phone"))


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _gender(mention: Column) -> Column:
    return F.when(mention.rlike(rf"^(?:{'|'.join(FEMALE_TITLES)})(?![\p{{L}}\p{{N}}_])"), "f").otherwise("m")


def normal_form(kind: Column, mention: Column) -> Column:
    """What two mentions of one entity have in common, whatever their format."""
    digits = F.regexp_replace(mention, r"[^0-9]", "")
    bare = F.upper(F.regexp_replace(mention, r"[^A-Za-z0-9]", ""))
    quoted = F.coalesce(F.nullif(F.regexp_extract(mention, r'"([^"]*)"', 1), F.lit("")), mention)
    # Names of one person share the family name: the last word, with script and gender.
    family = F.concat_ws("|", _script(mention), _gender(mention), F.lower(F.regexp_extract(mention, r"(\S+)$", 1)))
    return (
        F.when(kind == "email", F.lower(mention))
        .when(kind == "secret", quoted)
        .when(kind == "ip", mention)
        .when(kind == "iban", bare)
        .when(kind == "name", family)
        .otherwise(digits)
    )


def given_name(mention: Column) -> Column:
    """The given name before the family name, with script and gender like that; empty where there is none."""
    given = F.regexp_extract(mention, rf"^\S+ ({NAME}) {NAME}$", 1)
    return F.when(given == "", "").otherwise(F.concat_ws("|", _script(mention), _gender(mention), F.lower(given)))


def _digest(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\x00", F.lit(key), kind, normal, attempt.cast("string")), 256)


def _number(digest: Column, i: Column) -> Column:
    """A number from 0 to 65535 for the i-th character, whatever their number."""
    block = F.sha2(F.concat(digest, (i / 16).cast("int").cast("string")), 256)
    return F.conv(F.substring(block, F.pmod(i, F.lit(16)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _same_shape(text: Column, digest: Column) -> Column:
    """Every letter and digit replaced by one of its case and script, the rest kept."""
    def char(base: str, size: int, n: Column) -> Column:
        letters = "".join(chr(ord(base) + k) for k in range(size))
        return F.substring(F.lit(letters), n % size + 1, F.lit(1))

    def replace(c: Column, i: Column) -> Column:
        def pick(n: Column) -> Column:
            return (
                F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
                .when(c.rlike("[a-z]"), char("a", 26, n))
                .when(c.rlike("[A-Z]"), char("A", 26, n))
                .when(c.rlike(r"\p{IsCyrillic}") & c.rlike(r"\p{Lu}"), char("А", 32, n))
                .when(c.rlike(r"\p{IsCyrillic}"), char("а", 32, n))
                .when(c.rlike(r"\p{IsGreek}") & c.rlike(r"\p{Lu}"), char("Α", 17, n))
                .when(c.rlike(r"\p{IsGreek}"), char("α", 17, n))
                .when(c.rlike(r"\p{Lu}"), char("À", 22, n))
                .when(c.rlike(r"\p{L}"), char("à", 22, n))
                .otherwise(c)
            )

        return let(_number(digest, i), pick)

    return F.array_join(F.transform(F.split(text, ""), replace), "")


def _ip(digest: Column) -> Column:
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_number(digest, i) % 254 + 1).cast("string"))
    return F.array_join(octets, ".")


def _longer(shape: Column, digest: Column, attempt: Column) -> Column:
    """The shape with a letter before it for every ``LONGER`` attempts, so that a short shape never runs out."""
    letters = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), (attempt / LONGER).cast("int"))),
        lambda i: F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), _number(digest, i + 4096) % 26 + 1, F.lit(1)),
    )
    return F.when(attempt < LONGER, shape).otherwise(F.concat(F.array_join(letters, ""), shape))


def _email(normal: Column, digest: Column) -> Column:
    """All but the last label of the domain replaced."""
    last = F.regexp_extract(normal, r"\.[^.@]+$", 0)
    return F.concat(_same_shape(F.substring(normal, F.lit(1), F.length(normal) - F.length(last)), digest), last)


def _mask(normal: Column) -> Column:
    """What is left of an entity of whose shape no free value was found."""
    return F.regexp_replace(F.regexp_replace(normal, r"[0-9]", "0"), r"\p{L}", "x")


def _made_name(normal: Column, digest: Column, attempt: Column, endings: dict, syllables_least: int) -> Column:
    """``script|gender|name`` with a made-up name of the same script and gender."""
    made = F.lit(None).cast("string")
    for (script, gender), ending in endings.items():
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        # Later attempts may use more syllables, so there is always another name.
        stem = F.array_join(
            F.transform(F.sequence(F.lit(0), F.lit(syllables_least - 1) + (attempt / 2).cast("int")), lambda i: F.get(syllables, _number(digest, i) % 16)), ""
        )
        name = F.concat(F.lit(f"{script}|{gender}|"), stem, F.lit(ending))
        made = F.when(normal.startswith(f"{script}|{gender}|"), name).otherwise(made)
    return made


def make_surrogate(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """A surrogate in normal form; the same for the same key, entity and attempt."""
    def made(digest: Column) -> Column:
        return (
            F.when(kind == "name", _made_name(normal, digest, attempt, ENDINGS, 4))
            .when(kind == "given", _made_name(normal, digest, attempt, GIVEN_ENDINGS, 2))
            .when(kind == "ip", _ip(digest))
            .when(kind == "email", _longer(_email(normal, digest), digest, attempt))
            .when(kind == "secret", _longer(_same_shape(normal, digest), digest, attempt))
            .otherwise(_same_shape(normal, digest))
        )

    return let(_digest(key, kind, normal, attempt), made)


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """``kind, normal, surrogate`` for distinct entities, all surrogates distinct and none a real entity.

    Of entities that want one surrogate the first gets it; the others, and those whose surrogate is real,
    try again. Rounds are written to the shared folder; the driver sees whether any is left. Addresses, secrets and
    names get longer from attempt to attempt. Numbers keep their length: those of a shape that is as good as used up, left after
    ``MAX_ATTEMPTS``, all become the mask of the shape, zeros and ``x``.
    """
    real = entities.select("kind", F.col("normal").alias("surrogate"))
    open_, done = entities, None
    for attempt in range(MAX_ATTEMPTS):
        tried = open_.withColumn("surrogate", make_surrogate(key, F.col("kind"), F.col("normal"), F.lit(attempt)))
        rank = Window.partitionBy("kind", "surrogate").orderBy("normal")
        tried = tried.withColumn("rank", F.row_number().over(rank))
        taken = real if done is None else real.union(done.select("kind", "surrogate"))
        free = tried.join(taken.distinct().withColumn("taken", F.lit(True)), ["kind", "surrogate"], "left")
        judged = written(
            free.select("kind", "normal", "surrogate", (F.col("taken").isNull() & (F.col("rank") == 1)).alias("ok")),
            "surrogates",
        )
        found = judged.where("ok").drop("ok")
        done = found if done is None else done.union(found)
        open_ = judged.where("not ok").select("kind", "normal")
        if open_.isEmpty():
            return done
    return done.union(open_.withColumn("surrogate", _mask(F.col("normal"))))


def _refill(mention: Column, filling: Column, pattern: str) -> Column:
    """The characters of ``mention`` that fit ``pattern`` replaced, in order, by those of ``filling``."""
    chars, new = F.split(mention, ""), F.split(filling, "")
    places = F.transform(chars, lambda c: c.rlike(pattern).cast("int"))

    def build(at: Column) -> Column:
        def char(c: Column, i: Column) -> Column:
            number = F.aggregate(F.slice(at, F.lit(1), i), F.lit(0), lambda t, x: t + x)
            return F.when(F.get(at, i) == 1, F.get(new, number)).otherwise(c)

        return F.array_join(F.transform(chars, char), "")

    return let(places, build)


def render(kind: Column, mention: Column, surrogate: Column, given: Column) -> Column:
    """The surrogate in the format of the mention; ``given`` is that of the given name, NULL where there is none."""
    def written_out(name: Column) -> Column:
        return F.initcap(F.get(F.split(name, r"\|"), F.lit(2)))

    title = F.regexp_extract(mention, r"^(\S+) ", 1)
    name = F.concat_ws(" ", title, written_out(given), written_out(surrogate))
    cased = F.when(mention == F.upper(mention), F.upper(surrogate)).otherwise(surrogate)
    inner = F.regexp_extract(mention, r'"([^"]*)"', 1)
    quoted = F.when(inner != "", F.replace(mention, inner, surrogate)).otherwise(surrogate)
    return (
        F.when(kind == "name", name)
        .when(kind == "email", cased)
        .when(kind == "secret", quoted)
        .when(kind == "ip", surrogate)
        .when(kind == "iban", _refill(mention, surrogate, "[A-Za-z0-9]"))
        .otherwise(_refill(mention, surrogate, "[0-9]"))
    )


def replace_entities(df: DataFrame, key: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row as the struct ``input`` with ``entities`` (kind, mention, surrogate, in order) and the new ``text``.

    Whoever has ``key`` can tell which surrogate an entity has, so it is a secret of the corpus. Names are found after
    a title only; a name without one stays.

    NULL text counts as empty and has no entity. Rows without an id and repeated rows are treated like any other;
    equal entities get equal surrogates everywhere. An empty table gives no rows.
    """
    rows = df.select(
        F.struct("*").alias("input"), F.col(id_column).alias("doc"), whole_text(text).alias("text")
    ).withColumn("row", F.xxhash64("text"))
    # Without a digit, an at sign or a title there is nothing to find.
    maybe = F.col("text").rlike(rf"[0-9@]|(?i:token|secret|password|api_key)|(?:{'|'.join(MALE_TITLES + FEMALE_TITLES)})\.? ")
    mentions = rows.where(maybe).select(
        "doc", "row", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("place", "mention")
    )
    mentions = mentions.withColumn("kind", entity_kind(F.col("mention")))
    given = F.when(F.col("kind") == "name", given_name(F.col("mention"))).otherwise("")
    mentions = mentions.withColumn("normal", normal_form(F.col("kind"), F.col("mention"))).withColumn("given", given)
    mentions = written(mentions, "mentions")
    # Distinct given names get distinct surrogates and so do family names, hence people do.
    entities = mentions.select("kind", "normal").union(mentions.where("given != ''").select(F.lit("given"), "given"))
    surrogates = surrogate_table(entities.distinct(), key)
    whole = surrogates.where("kind != 'given'")
    givens = surrogates.where("kind = 'given'").select(F.col("normal").alias("given"), F.col("surrogate").alias("given_surrogate"))
    plain = lookup(mentions.where("given = ''"), whole, ["kind", "normal"], ["doc", "row"], "inner")
    full = lookup(mentions.where("given != ''"), whole, ["kind", "normal"], ["doc", "row"], "inner")
    full = lookup(full, givens, ["given"], ["doc", "row"], "inner")
    named = plain.withColumn("given_surrogate", F.lit(None).cast("string")).unionByName(full)
    rendered = named.select(
        "doc", "row", "place", "kind", "mention",
        render(F.col("kind"), F.col("mention"), F.col("surrogate"), F.col("given_surrogate")).alias("surrogate"),
    ).dropDuplicates(["doc", "row", "place"])
    listed = rendered.groupBy(F.col("doc").alias("of"), F.col("row").alias("of_row")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "kind", "mention", "surrogate"))),
            lambda e: F.struct(e["kind"].alias("kind"), e["mention"].alias("mention"), e["surrogate"].alias("surrogate")),
        ).alias("entities")
    )
    joined = rows.join(listed, F.col("doc").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left")
    between = F.split("text", ANY, -1)
    filled = F.zip_with(
        between, F.col("entities"), lambda part, e: F.concat(part, F.coalesce(e["surrogate"], F.lit("")))
    )
    return joined.select(
        "input",
        F.coalesce("entities", F.array().cast("array<struct<kind:string,mention:string,surrogate:string>>")).alias("entities"),
        F.when(F.col("entities").isNull(), F.col("text")).otherwise(F.array_join(filled, "")).alias("text"),
    )
