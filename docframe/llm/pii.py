"""Surrogates for private data: keyed, type-consistent replacements without collisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, free_name, let, without

TITLES = {
    "female": ["Mrs", "Ms", "Miss", "Lady", "Dame", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle",
               "Señora", "Sra", "Señorita", "Srta", "Signora", "Госпожа"],
    "male": ["Mr", "Sir", "Lord", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин"],
    "any": ["Mx", "Dr", "Doctor", "Prof", "Professor", "Rev", "Доктор", "Профессор"],
}
"""Fixed values: titles and the gender they tell."""
NAMES = {
    ("female", "latin"): ["Anna", "Clara", "Diana", "Elena", "Greta", "Irene", "Julia", "Laura",
                          "Marta", "Nora", "Olivia", "Paula", "Rosa", "Sofia", "Teresa", "Vera"],
    ("male", "latin"): ["Adrian", "Bruno", "Carlo", "Daniel", "Emil", "Felix", "Hugo", "Jonas",
                        "Leon", "Martin", "Nils", "Oscar", "Paul", "Robert", "Simon", "Victor"],
    ("any", "latin"): ["Alexis", "Andrea", "Casey", "Dana", "Jordan", "Kai", "Kim", "Luca", "Morgan",
                       "Noa", "Quinn", "Robin", "Sascha", "Taylor", "Toni", "Vanja"],
    ("any", "cyrillic"): ["Валя", "Женя", "Мика", "Паша", "Саша", "Слава", "Тоня", "Шура"],
    ("female", "cyrillic"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Софья"],
    ("male", "cyrillic"): ["Андрей", "Борис", "Виктор", "Иван", "Максим", "Олег", "Павел", "Роман"],
}
_TITLE = "(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.? "
_WORD = (r"(?:\p{Lu}\.|(?:\p{Lu}['’])?\p{Lu}[\p{L}\p{M}]+(?:['’]\p{Lu}[\p{L}\p{M}]+|-\p{L}[\p{L}\p{M}]*)*)")
_PARTICLE = "(?:van|von|vom|zu|zur|de|del|della|der|den|des|di|da|dos|du|la|le|ter|ten|bin|ibn|al|el) "
_NAME = f"(?!{_TITLE})(?:{_PARTICLE}){{0,3}}{_WORD}"
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"(?i:password|passwd|token|secret|api_?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_-]{8,}",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-][0-9]{4}"
             r"(?![0-9])"
             r"|(?<![0-9+])\+(?=(?:[ .()/-]{0,2}[0-9]){8})[0-9]{1,3}(?:[ .-]?\([0-9]{1,5}\))?"
             r"(?:[ ./-]?[0-9]{1,12}){1,6}(?![0-9])"
             r"|(?<![\p{L}0-9_+.-])[2-9][0-9]{9}(?![\p{L}0-9_]|[.-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "person": rf"(?<!\p{{L}})(?:{_TITLE})+{_NAME}(?: {_NAME}){{0,3}}",
}
"""Kinds of entities and what they look like, the first that fits counting."""
ANY = "|".join(KINDS.values())
DIGITS, HEX = "0123456789", "0123456789abcdef"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEAD = r"^(?i:password|passwd|token|secret|api_?key)\s{0,3}[=:]\s{0,3}[\"']?"
_GENDERS = [(g, r"^(?:" + "|".join(t) + r")\.? ") for g, t in TITLES.items()]
_PERSON_HEAD = f"^(?:{_TITLE})+"


def kind_of(match: Column) -> Column:
    # the lookarounds are stripped of what stood round the match
    found = F.when(match.contains("@"), F.lit("email"))
    for kind, pattern in KINDS.items():
        if kind != "email":
            found = found.when(match.rlike("^(?:" + pattern + ")$"), F.lit(kind))
    return found


def norms_of(kind: Column, match: Column) -> Column:
    """What all spellings of one entity share, in a list: digits of numbers (a phone's last ten), e-mail
    addresses in lower case, a secret without what stands before it. Each word of a name is an
    entity of its own, with its gender and script, so that a surname stays the same beside
    other first names and alone; particles (von, de) are none."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    gender = F.lit(None).cast("string")
    for g, pattern in _GENDERS:
        gender = F.coalesce(gender, F.when(match.rlike(pattern), F.lit(g)))
    names = F.transform(
        F.filter(F.split(F.regexp_replace(match, _PERSON_HEAD, ""), " "), _is_name),
        lambda w: F.concat_ws("/", gender, F.when(w.rlike(r"^\p{IsCyrillic}"), "cyrillic").otherwise("latin"), w))
    return F.when(kind == "person", names).when(kind.isNotNull(), F.array(
        F.when(kind == "email", F.lower(match)).when(
            kind == "phone", F.right(digits, F.lit(10))).when(
            kind.isin("card", "ssn"), digits).when(
            kind == "secret", F.regexp_replace(match, _HEAD, "")).otherwise(match)))


def _is_name(word: Column) -> Column:
    return word.rlike(r"^\p{Lu}")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), (n % len(alphabet) + 1).cast("int"), F.lit(1))


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The replacement's norm: each character is drawn, by a hash of (key, kind, norm, attempt),
    from its own class; what the kind fixes (domain, issuer digit, key prefix) stays."""
    digest = F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"),
                                           F.lit(str(k)), norm), 256) for k in range(2)])

    def of_digest(hexed: Column) -> Column:
        def number(i: Column) -> Column:
            return F.conv(F.substring(hexed, (i % 64 * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")

        def classed(text: Column) -> Column:
            return F.concat_ws("", F.transform(F.split(text, ""), lambda c, i: F.when(
                c.rlike("[0-9]"), _pick(DIGITS, number(i))).when(
                c.rlike("[a-z]"), _pick(LOWER, number(i))).when(
                c.rlike("[A-Z]"), _pick(UPPER, number(i))).otherwise(c)))

        def drawn(text: Column, alphabet: str) -> Column:
            return F.concat_ws("", F.transform(
                F.split(text, ""), lambda c, i: _pick(alphabet, number(i))))

        def listed(names: list[str]) -> Column:
            whole = F.array(*[F.lit(n) for n in names])
            return F.transform(F.sequence(F.lit(0), attempt), lambda a: F.get(
                whole, number(a) % len(names)))

        domain = F.regexp_extract(norm, r"([^.@]+\.[^.@]+)$", 1)
        own = F.left(norm, F.char_length(norm) - F.char_length(domain))
        octets = F.transform(F.split(norm, r"\."), lambda o, i: (
            1 + number(i) % 254).cast("string"))
        phone = F.concat_ws("", F.transform(F.split(norm, ""), lambda c, i: F.when(
            i.isin(0, 3), _pick(DIGITS[2:], number(i))).otherwise(_pick(DIGITS, number(i)))))
        card = F.concat(F.left(norm, F.lit(1)), drawn(F.substring(norm, 2, 14), DIGITS))
        last = F.when(_luhn(norm) == 0, ((10 - _luhn(F.concat(card, F.lit("0"))) % 10) % 10)
                      .cast("string")).otherwise(_pick(DIGITS, number(F.lit(40))))
        people = F.lit(None).cast("string")
        for (gender, script), names in NAMES.items():
            picked = listed(names)
            people = F.coalesce(people, F.when(
                norm.startswith(f"{gender}/{script}/"),
                F.concat(F.lit(f"{gender}/{script}/"), F.concat_ws("-", picked))))
        secret = F.when(norm.rlike("^[0-9a-f]+$"), drawn(norm, HEX)).otherwise(classed(norm))
        return F.when(kind == "email", F.concat(classed(own), domain)).when(
            kind == "ip", F.concat_ws(".", octets)).when(
            kind == "phone", phone).when(
            kind == "card", F.concat(card, last)).when(
            kind == "ssn", drawn(norm, DIGITS)).when(
            kind == "access_key", F.concat(
                F.left(norm, F.lit(4)), drawn(F.substring(norm, 5, 16), UPPER + DIGITS))).when(
            kind == "secret", secret).otherwise(people)

    return let(digest, of_digest)


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(
        d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10


def render(kind: Column, match: Column, tos: Column) -> Column:
    """The replacements in the spelling of ``match``: its punctuation, country code, capitals and
    what stands before it, and a name's particles and initials."""
    to = F.element_at(tos, 1)

    def name(s: Column, w: Column) -> Column:
        new = F.element_at(F.split(F.get(tos, s["k"]), "/"), -1)
        return F.struct(
            F.concat(s["out"], F.lit(" "), F.when(~_is_name(w), w).when(
                w.endswith("."), F.concat(F.left(new, F.lit(1)), F.lit("."))).otherwise(new)).alias("out"),
            (s["k"] + F.when(_is_name(w), 1).otherwise(0)).alias("k"))

    names = F.substring(F.aggregate(
        F.split(F.regexp_replace(match, _PERSON_HEAD, ""), " "),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), name)["out"], 2, 1 << 30)

    def fill(s: Column, c: Column) -> Column:
        return F.struct(
            F.concat(s["out"], F.when(c.rlike("[0-9]") & (s["k"] > 0), F.substring(
                to, s["k"].cast("int"), F.lit(1))).otherwise(c)).alias("out"),
            (s["k"] + F.when(c.rlike("[0-9]"), 1).otherwise(0)).alias("k"))

    extra = F.char_length(F.regexp_replace(match, "[^0-9]", "")) - F.char_length(to)
    numbers = F.aggregate(F.split(match, ""), F.struct(
        F.lit("").alias("out"), (1 - extra).cast("int").alias("k")), fill)["out"]
    cased = F.concat_ws("", F.zip_with(F.split(match, ""), F.split(to, ""), lambda c, t: F.when(
        c.rlike(r"\p{Lu}"), F.upper(t)).otherwise(t)))
    head = F.regexp_extract(match, _HEAD, 0)
    title = F.regexp_extract(match, _PERSON_HEAD, 0)
    return F.when(kind == "email", cased).when(kind.isin("phone", "card", "ssn"), numbers).when(
        kind == "secret", F.concat(head, to)).when(
        kind == "person", F.concat(title, names)).otherwise(to)


def surrogates(entities: DataFrame, key: str, max_rounds: int = 50) -> DataFrame:
    """(kind, norm, to) per distinct (kind, norm): no two have the same replacement, and no
    replacement is itself an entity of the table.

    All draw at once; of those that draw alike the first keeps its draw, and the others and those
    that hit an entity draw again. Each round joins tables of distinct entities by key."""
    real = cut(entities.select("kind", "norm").distinct())
    open_, done = real, None
    for attempt in range(max_rounds):
        draws = open_.withColumn("to", surrogate(F.col("kind"), F.col("norm"), F.lit(attempt), key))
        first = Window.partitionBy("kind", "to").orderBy("norm")
        draws = draws.withColumn("n", F.row_number().over(first))
        taken = real.select("kind", F.col("norm").alias("to"))
        if done is not None:
            taken = taken.unionByName(done.select("kind", "to"))
        taken = taken.distinct().withColumn("taken", F.lit(True))
        draws = cut(draws.join(taken, ["kind", "to"], "left"))
        good = (F.col("n") == 1) & F.col("taken").isNull()
        fine = draws.where(good).select("kind", "norm", "to")
        done = fine if done is None else done.unionByName(fine)
        open_ = draws.where(~good).select("kind", "norm")
        if not open_.take(1):
            return done
    raise RuntimeError(f"replacements still collide after {max_rounds} draws")


def replace(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = "key"
            ) -> DataFrame:
    """Every row, its text with surrogates, and ``entities``: (kind, surrogate) in text order.

    A person is one to four name words after a title of ``TITLES``; a phone has a country code, or ten
    digits, 3-3-4 or without separators. What looks otherwise stays: names without a title, national
    numbers of other shapes, addresses, other ids.

    One entity has one surrogate in the whole table, in whichever spelling, and different
    entities have different ones; which they are depends on ``key`` alone, but for collisions. NULL
    texts stay NULL; texts without entities stay as they are, with an empty list. Rows alike in id and
    text are alike in the result; a NULL id is an id like others. An empty table stays empty. Extra
    columns pass through; one named ``entities`` is replaced. A frequent entity is replaced in
    its documents' occurrences, never gathered."""
    df = without(df, "entities")
    row, found = free_name(df, "_row"), free_name(df, "_found")
    text = F.col(f"`{text_col}`")
    tagged = df.withColumn(row, F.xxhash64(f"`{id_col}`", f"`{text_col}`"))
    spots = cut(tagged.select(F.col(row).alias("row"), F.regexp_extract_all(
        text, F.lit(ANY), F.lit(0)).alias("m")).where(F.size("m") > 0).dropDuplicates(["row"]).select(
        "row", F.posexplode("m").alias("at", "match")).withColumn(
        "kind", kind_of(F.col("match"))).select("*", F.posexplode_outer(
            norms_of(F.col("kind"), F.col("match"))).alias("part", "norm")))
    known = spots.where(F.col("kind").isNotNull())
    chosen = surrogates(known, key)
    filled = spots.join(chosen, ["kind", "norm"], "left").groupBy("row", "at", "kind", "match").agg(
        F.array_sort(F.collect_list(F.struct("part", "to")))["to"].alias("tos")).withColumn(
        "new", F.coalesce(render(F.col("kind"), F.col("match"), F.col("tos")), F.col("match")))
    per_row = filled.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("at", "kind", "new"))).alias(found)).withColumnRenamed("row", row)
    out = tagged.join(per_row, row, "left")
    parts = F.split(text, ANY, -1)
    rebuilt = F.concat_ws("", F.zip_with(parts, found, lambda p, f: F.concat(
        p, F.coalesce(f["new"], F.lit("")))))
    return out.withColumn("entities", F.coalesce(
        F.transform(found, lambda f: F.struct(f["kind"].alias("kind"), f["new"].alias("surrogate"))),
        F.array().cast("array<struct<kind:string,surrogate:string>>"))).withColumn(
        text_col, F.when(F.col(found).isNull(), text).otherwise(rebuilt)).drop(row, found)
