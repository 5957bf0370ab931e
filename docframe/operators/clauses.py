"""Search clauses: a boolean Column plus, for ranked search, a score.

A clause on a missing value does not hold. ``pred`` may be NULL for such rows, which a filter
drops anyway and which keeps it pushable to the file scan; wherever a clause is negated,
counted or summed the NULL is turned into "does not hold" first (``Clause.negated``,
``Clause.holds``).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field as dc_field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, text as tx
from ..functions.dates import date_math
from ..functions.text import col
from ..spec import Spec

# A text term whose corpus statistics a ranked clause needs: (field, analyzer, token)
Term = tuple[str, str, str]


@dataclass(frozen=True)
class Clause:
    pred: Column
    score: Callable[["object"], Column] | None = None  # given the ranking context
    boost: float = 1.0
    terms: frozenset[Term] = dc_field(default_factory=frozenset)
    nullable: tuple[Column, ...] | None = None  # pred is NULL exactly when one of these is

    def holds(self) -> Column:
        return F.coalesce(self.pred, F.lit(False))

    def negated(self) -> Column:
        if self.nullable is None:
            return ~self.holds()
        return reduce(lambda a, c: a | c.isNull(), self.nullable, ~self.pred)

    def scored(self, ctx) -> Column:
        base = self.score(ctx) if self.score else F.lit(1.0)
        return base * F.lit(float(self.boost))


def _lit(value):
    return value if isinstance(value, Column) else F.lit(value)


def all_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)


def any_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


# ---- exact-value clauses -------------------------------------------------------------


def range_(field, gt=None, gte=None, lt=None, lte=None, now=None, boost: float = 1.0) -> Clause:
    """Bounds are ANDed. With ``now`` given, string bounds are date math."""
    c = col(field)

    def bound(v):
        return date_math(v, now) if now is not None and isinstance(v, str) else _lit(v)

    parts = []
    if gt is not None:
        parts.append(c > bound(gt))
    if gte is not None:
        parts.append(c >= bound(gte))
    if lt is not None:
        parts.append(c < bound(lt))
    if lte is not None:
        parts.append(c <= bound(lte))
    if not parts:
        raise ValueError("a range needs at least one bound")
    return Clause(all_of(parts), boost=boost, nullable=(c,))


def term(field, value, boost: float = 1.0) -> Clause:
    c = col(field)
    return Clause(c == _lit(value), boost=boost, nullable=(c,))


def terms(field, values: Sequence, boost: float = 1.0) -> Clause:
    c = col(field)
    return Clause(c.isin(list(values)), boost=boost, nullable=(c,))


def terms_from(df: DataFrame, field: str, values: DataFrame, column: str) -> DataFrame:
    """``terms`` with a list held in a table: a semi join, so the list may be any length."""
    keys = values.select(F.col(column).alias(field)).where(F.col(field).isNotNull()).distinct()
    return df.join(keys, field, "left_semi")


def not_terms_from(df: DataFrame, field: str, values: DataFrame, column: str) -> DataFrame:
    """``must_not`` of ``terms_from``: an anti join that keeps rows without a value."""
    keys = values.select(F.col(column).alias(field)).where(F.col(field).isNotNull()).distinct()
    return df.join(keys, field, "left_anti")


def exists(field, is_list: bool = False, boost: float = 1.0) -> Clause:
    c = col(field)
    return Clause(c.isNotNull() & (F.size(c) > 0) if is_list else c.isNotNull(), boost=boost)


def prefix(field, value: str, boost: float = 1.0) -> Clause:
    c = col(field)
    return Clause(c.startswith(value), boost=boost, nullable=(c,))


def wildcard(field, value: str, case_insensitive: bool = False, boost: float = 1.0) -> Clause:
    """``?`` is one character and ``*`` any run, over the whole value."""
    c = col(field)
    body = "".join(
        "." if ch == "?" else ".*" if ch == "*" else re.escape(ch) for ch in value
    )
    flags = "(?isu)" if case_insensitive else "(?s)"
    pred = c.rlike(f"{flags}^{body}$")
    head = re.match(r"[^?*]*", value)[0]
    if head and not case_insensitive:
        pred = c.startswith(head) & pred  # reaches the file scan; the pattern does not
    return Clause(pred, boost=boost, nullable=(c,))


def match_all(boost: float = 1.0) -> Clause:
    return Clause(F.lit(True), boost=boost)


def match_none() -> Clause:
    return Clause(F.lit(False))


def geo_distance(
    lat, lon, location: dict | str, distance, distance_type: str = "arc",
    validation_method: str = "strict", boost: float = 1.0,
) -> Clause:
    """Points within ``distance``. ``validation_method`` says what an out-of-range stored
    point does: ``strict`` and ``ignore_malformed`` never match it, ``coerce`` wraps it."""
    if isinstance(location, str):
        lat0, lon0 = (float(x) for x in location.split(","))
    else:
        lat0, lon0 = float(location["lat"]), float(location["lon"])
    if not (-90 <= lat0 <= 90 and -180 <= lon0 <= 180):
        if validation_method == "strict":
            raise ValueError(f"location out of range: {location}")
        lon0 = (lon0 + 180) % 360 - 180
        lat0 = max(-90.0, min(90.0, lat0))
    y, x = col(lat), col(lon)
    km = geo.kilometres(distance)
    if validation_method == "coerce":
        x = geo.wrap_lon(x)
        y = F.greatest(F.lit(-90.0), F.least(F.lit(90.0), y))
        valid = F.lit(True)
    else:
        valid = y.between(-90, 90) & x.between(-180, 180)
    if distance_type == "plane":
        near = geo.plane_km(y, x, lat0, lon0) <= km
    else:
        near = geo.bounding_box(y, x, lat0, lon0, km) & (
            geo.haversine_km(y, x, lat0, lon0) <= km
        )
    return Clause(valid & near, boost=boost)


# ---- full-text clauses ---------------------------------------------------------------


# Letters and digits make up tokens; anything else separates them.
IN_TOKEN = r"[\p{L}\p{N}]"


class _Standard:
    """Tests on the lower-cased text itself. A word is found as a literal with no token
    character on either side, which says the same as splitting the text into tokens at a
    fraction of the cost, and a substring test rules most rows out before that."""

    sep = tx.WORD_BREAK

    def __init__(self, field):
        self.field, self.text = field, F.lower(col(field))

    def words(self, words: Sequence[str]) -> list[Column]:
        return [self.text.contains(w) & self.pattern([w], w) for w in words]

    def pattern(self, words: Sequence[str], body: str, prefix: bool = False) -> Column:
        start = f"(?<!{IN_TOKEN}{words[0]})"
        body = words[0] + start + body[len(words[0]):]
        return self.text.rlike(body if prefix else f"{body}(?!{IN_TOKEN})")

    def sequence(self, words, slop: int = 0, prefix: bool = False) -> Column:
        there = all_of([self.text.contains(w) for w in dict.fromkeys(words)])
        if slop:
            # each gap may hold ``slop`` words: two words need no more, others rule most rows out
            gap = f"{self.sep}(?:{IN_TOKEN}+{self.sep}){{0,{slop}}}"
            near = there & self.pattern(words, gap.join(words), False)
            return near if len(words) == 2 else near & _in_order(tx.tokens(self.field), words, slop)
        return there & self.pattern(words, self.sep.join(words), prefix)

    def starting(self, word: str) -> Column:
        return self.text.contains(word) & self.pattern([word], word, prefix=True)


class _Tokens:
    """The same tests on the token list of any other analyser, joined by spaces."""

    def __init__(self, field, analyzer: str):
        self.tokens = tx.ANALYZERS[analyzer](field)
        self.text = F.concat(F.lit(" "), F.array_join(self.tokens, " "), F.lit(" "))

    def words(self, words: Sequence[str]) -> list[Column]:
        return [F.array_contains(self.tokens, w) for w in words]

    def sequence(self, words, slop: int = 0, prefix: bool = False) -> Column:
        if slop == 0:
            return self.text.contains(" " + " ".join(words) + ("" if prefix else " "))
        return _in_order(self.tokens, words, slop)

    def starting(self, word: str) -> Column:
        return self.text.contains(f" {word}")


def _reader(field, analyzer: str):
    return _Standard(field) if analyzer == "standard" else _Tokens(field, analyzer)


def _bm25(field, analyzer: str, words: Sequence[str]):
    if not isinstance(field, str):  # an element of a list: no statistics, so a constant score
        return None, frozenset()

    def score(ctx):
        return reduce(lambda a, b: a + b, [ctx.weight(field, analyzer, w) for w in words])

    return score, frozenset((field, analyzer, w) for w in words)


def match(
    field, query, operator: str = "or", analyzer: str = "standard",
    zero_terms_query: str = "none", boost: float = 1.0,
) -> Clause:
    """Numbers and keywords match by equality; text by any (default) or all query tokens."""
    if not isinstance(query, str) or analyzer == "keyword":
        return term(field, query, boost)
    words = list(dict.fromkeys(tx.analyse_query(query, analyzer)))
    if not words:
        return Clause(F.lit(zero_terms_query == "all"), boost=boost)
    found = _reader(field, analyzer).words(words)
    pred = all_of(found) if operator.lower() == "and" else any_of(found)
    score, needs = _bm25(field, analyzer, words)
    return Clause(pred, score, boost, needs)


def match_phrase(
    field, query: str, slop: int = 0, analyzer: str = "standard", boost: float = 1.0
) -> Clause:
    """Query tokens in order, with up to ``slop`` extra positions in total.

    A phrase is one pattern over the text, with slop one pass over its tokens; nothing is
    exploded or joined.
    """
    words = tx.analyse_query(query, analyzer)
    if not words:
        return match_none()
    pred = _reader(field, analyzer).sequence(words, slop if len(words) > 1 else 0)
    score, needs = _bm25(field, analyzer, list(dict.fromkeys(words)))
    return Clause(pred, score, boost, needs)


def _in_order(tokens: Column, words: Sequence[str], slop: int) -> Column:
    """Some run of tokens holds the words in order with at most ``slop`` others among them.

    One fold over the query's own tokens: per word, the latest start of a run that has come
    as far as that word. A later start never fits worse, so one number per word is enough."""
    n = len(words)
    there = F.filter(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i"))),
                     lambda x: x["t"].isin(*dict.fromkeys(words)))
    none = F.lit(-1)

    def step(s: Column, x: Column) -> Column:
        before = [x["i"], *[s[f"w{j}"] for j in range(n - 1)]]
        now = [F.when((x["t"] == w) & (b >= 0), b).otherwise(s[f"w{j}"])
               for j, (w, b) in enumerate(zip(words, before))]
        fits = (x["t"] == words[-1]) & (before[-1] >= 0) & (x["i"] - before[-1] - (n - 1) <= slop)
        return F.struct(*[c.alias(f"w{j}") for j, c in enumerate(now)], (s["found"] | fits).alias("found"))

    start = F.struct(*[none.alias(f"w{j}") for j in range(n)], F.lit(False).alias("found"))
    return F.aggregate(there, start, step)["found"]


def match_phrase_prefix(field, query: str, analyzer="standard", boost: float = 1.0) -> Clause:
    """The phrase with its last token as a prefix."""
    words = tx.analyse_query(query, analyzer)
    if not words:
        return match_none()
    return Clause(_reader(field, analyzer).sequence(words, prefix=True), boost=boost)


def match_bool_prefix(field, query: str, analyzer="standard", boost: float = 1.0) -> Clause:
    """Any token; the last one as a prefix."""
    words = tx.analyse_query(query, analyzer)
    if not words:
        return match_none()
    found = _reader(field, analyzer)
    return Clause(any_of([*found.words(words[:-1]), found.starting(words[-1])]), boost=boost)


def by_fields(fields: dict[str, object], analyzers: dict[str, str] | None = None) -> Clause:
    """Every field matches its value (all tokens of it, for text)."""
    names = analyzers or {}
    return bool_(must=[
        match(f, v, operator="and", analyzer=names.get(f, "keyword")) for f, v in fields.items()
    ])


class Declared:
    """The clauses of a spec's fields: what a clause means follows from the declared kind.

    Keywords, numbers and dates are compared whole, text is analysed, a list field holds if any
    element does, and a field that is not indexed is refused. Fields inside objects are named
    by dotted paths; a path through a list of objects means any of them."""

    def __init__(self, spec: Spec):
        self.spec = spec

    def _field(self, path: str):
        fields, found, lists = self.spec.fields, None, []
        parts = path.split(".")
        for i, part in enumerate(parts):
            found = next((f for f in fields if f.name == part), None)
            if found is None:
                raise ValueError(f"{self.spec.name} has no field {path!r}")
            if not found.index:
                raise ValueError(f"{path!r} is not indexed, so it cannot be searched")
            if found.kind == "nested" and i < len(parts) - 1:
                lists.append(i)
            fields = found.fields
        return found, lists

    def _over(self, path: str, make: Callable[[object], Clause], boost: float = 1.0) -> Clause:
        found, lists = self._field(path)
        if not lists:
            return any_element(path, make, boost) if found.many else make(path)
        parts = path.split(".")
        outer, inner = ".".join(parts[:lists[0] + 1]), parts[lists[0] + 1:]

        def test(x: Column) -> Clause:
            value = x
            for name in inner:
                value = value[name]
            return any_element(value, make) if found.many else make(value)

        return any_element(outer, test, boost)

    def term(self, path: str, value, boost: float = 1.0) -> Clause:
        return self._over(path, lambda c: term(c, value, boost), boost)

    def terms(self, path: str, values: Sequence, boost: float = 1.0) -> Clause:
        return self._over(path, lambda c: terms(c, values, boost), boost)

    def range_(self, path: str, boost: float = 1.0, **bounds) -> Clause:
        return self._over(path, lambda c: range_(c, boost=boost, **bounds), boost)

    def prefix(self, path: str, value: str, boost: float = 1.0) -> Clause:
        return self._over(path, lambda c: prefix(c, value, boost), boost)

    def wildcard(self, path: str, value: str, boost: float = 1.0, **options) -> Clause:
        return self._over(path, lambda c: wildcard(c, value, boost=boost, **options), boost)

    def exists(self, path: str, boost: float = 1.0) -> Clause:
        found, lists = self._field(path)
        if lists:
            return self._over(path, lambda c: exists(c), boost)
        return exists(path, is_list=found.many or found.kind == "nested", boost=boost)

    def match(self, path: str, query, boost: float = 1.0, **options) -> Clause:
        found, _ = self._field(path)
        if found.kind != "text":
            return self.term(path, query, boost)
        return self._over(path, lambda c: match(c, query, boost=boost, **options), boost)

    def match_phrase(self, path: str, query: str, boost: float = 1.0, **options) -> Clause:
        found, _ = self._field(path)
        if found.kind != "text":
            return self.term(path, query, boost)
        return self._over(path, lambda c: match_phrase(c, query, boost=boost, **options), boost)

    def by_fields(self, fields: dict[str, object]) -> Clause:
        """Every field matches its value; text by all tokens of it."""
        return bool_(must=[
            self.match(f, v, operator="and") if self._field(f)[0].kind == "text"
            else self.match(f, v) for f, v in fields.items()])


def multi_match(
    query: str, fields: Sequence[str] | Spec, type: str = "best_fields", operator: str = "or",
    analyzer: str = "standard", boost: float = 1.0,
) -> Clause:
    """One query over several text fields (all text fields of a spec, if one is given); see
    the parts below for each ``type``."""
    if isinstance(fields, Spec):
        fields = [f.name for f in fields.fields if f.kind == "text"]
    if type in ("best_fields", "most_fields"):
        parts = [match(f, query, operator, analyzer) for f in fields]
    elif type == "phrase":
        parts = [match_phrase(f, query, analyzer=analyzer) for f in fields]
    elif type == "phrase_prefix":
        parts = [match_phrase_prefix(f, query, analyzer) for f in fields]
    elif type == "bool_prefix":
        parts = [match_bool_prefix(f, query, analyzer) for f in fields]
    elif type == "cross_fields":
        # every token in some field; a token is scored by its best field
        words = list(dict.fromkeys(tx.analyse_query(query, analyzer)))
        per_word = [
            best_of([match(f, w, analyzer=analyzer) for f in fields]) for w in words
        ]
        return bool_(must=per_word, boost=boost) if per_word else match_none()
    else:
        raise ValueError(f"unknown multi_match type: {type!r}")
    if type == "best_fields":
        return best_of(parts, boost)
    return bool_(should=parts, boost=boost)


def best_of(parts: Sequence[Clause], boost: float = 1.0) -> Clause:
    """Any part holds; the score is the best one."""

    def score(ctx):
        each = [F.when(p.pred, p.scored(ctx)).otherwise(F.lit(0.0)) for p in parts]
        return each[0] if len(each) == 1 else F.greatest(*each)

    return Clause(any_of([p.pred for p in parts]), score, boost,
                  frozenset().union(*[p.terms for p in parts]))


# ---- fuzzy clauses -------------------------------------------------------------------


def fuzzy_limit(value: str, fuzziness: int | str) -> int:
    if str(fuzziness).lower() != "auto":
        return int(fuzziness)
    return 0 if len(value) <= 2 else 1 if len(value) <= 5 else 2


def _swaps(word: str) -> set[str]:
    return {
        word[:i] + word[i + 1] + word[i] + word[i + 2:] for i in range(len(word) - 1)
    } - {word}


def edit_distance(c: Column, value: str, limit: int, transpositions: bool = True) -> Column:
    """Distance of a column to a constant, or NULL above ``limit``.

    Swapping two neighbours counts one edit. Every swap is applied to the constant here, on
    the driver, so each row only sees plain ``levenshtein`` calls and an ``in`` list.
    """
    def within(word: str, n: int) -> Column:
        return F.levenshtein(c, F.lit(word), n)

    plain = within(value, limit)
    best = F.when(plain >= 0, plain)
    if transpositions and limit >= 1:
        if limit > 2:
            raise ValueError("transpositions are supported up to distance 2")
        once = _swaps(value)
        options = [best]
        for word in sorted(once):
            d = within(word, limit - 1)
            options.append(F.when(d >= 0, d + 1))
        if limit >= 2:
            shorter = {value[:i] + value[i + 1:] for i in range(len(value))}
            twice = set().union(*[_swaps(w) for w in once | shorter]) if once else set()
            if twice:
                options.append(F.when(c.isin(sorted(twice)), F.lit(2)))
        # a swap is two plain edits, so few terms get as far as the swaps
        if len(options) > 1:
            best = F.when(within(value, 2 * limit) >= 0, F.least(*options))
    return best


def _cuts(word: Column, times: int) -> Column:
    """The word and what is left of it when up to ``times`` characters are taken out."""
    def once(w: Column) -> Column:
        return F.when(F.length(w) > 0, F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(
            F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))).otherwise(F.array().cast("array<string>"))

    out = [F.array(word)]
    if times >= 1:
        out.append(once(word))
    if times >= 2:
        out.append(F.flatten(F.transform(once(word), once)))
    return F.array_distinct(F.concat(*out))


def _swapped(word: Column) -> Column:
    return F.when(F.length(word) > 1, F.transform(
        F.sequence(F.lit(1), F.length(word) - 1), lambda i: F.concat(
            F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1, F.lit(1)), F.substr(word, i, F.lit(1)),
            F.substr(word, i + 2)))).otherwise(F.array().cast("array<string>"))


def near_terms(vocabulary: DataFrame, term: str, queries: DataFrame, query: str, fuzziness: int | str = "auto",
               prefix_length: int = 0, max_expansions: int | None = None, transpositions: bool = True
               ) -> DataFrame:
    """(query, term, distance): the distinct terms near each of many query terms, which may be as many
    as there are.

    Two words within n edits are equal once up to n characters are taken out of each, so both sides are
    joined on what is left of them, and only pairs that meet are measured. Nothing is compared
    with all terms. Distances go up to 2."""
    most = 2 if str(fuzziness).lower() == "auto" else int(fuzziness)
    if most > 2:
        raise ValueError("many terms are supported up to distance 2")
    size = F.length("query")
    limit = F.when(size <= 2, 0).when(size <= 5, 1).otherwise(2) if str(
        fuzziness).lower() == "auto" else F.lit(most)
    asked = queries.select(F.col(query).alias("query")).where("query is not null").distinct()
    terms = vocabulary.select(F.col(term).alias("term")).where("term is not null").distinct()
    # only as many characters as the query's own limit allows
    mine = asked.withColumn("limit", limit).withColumn("cut", F.explode(
        F.when(F.col("limit") == 0, _cuts(F.col("query"), 0)).when(
            F.col("limit") == 1, _cuts(F.col("query"), min(1, most))).otherwise(_cuts(F.col("query"), most))))
    theirs = terms.withColumn("cut", F.explode(_cuts(F.col("term"), most)))
    if prefix_length:
        head = F.xxhash64("cut", F.substring("query", 1, prefix_length))
        mine, theirs = mine.withColumn("cut", head), theirs.withColumn(
            "cut", F.xxhash64("cut", F.substring("term", 1, prefix_length)))
    else:
        mine, theirs = (x.withColumn("cut", F.xxhash64("cut")) for x in (mine, theirs))
    met = mine.join(theirs, "cut").where(
        F.abs(size - F.length("term")) <= F.col("limit")).select("query", "term", "limit").distinct()
    a, b = F.col("query"), F.col("term")
    ways = [F.levenshtein(a, b)]
    if transpositions:
        ways += [1 + F.array_min(F.transform(_swapped(a), lambda w: F.levenshtein(w, b))),
                 1 + F.array_min(F.transform(_swapped(b), lambda w: F.levenshtein(a, w))),
                 F.when(F.arrays_overlap(_swapped(a), _swapped(b)), 2)]
    shortest = F.least(*ways) if transpositions else ways[0]
    found = met.withColumn("distance", shortest).where(F.col("distance") <= F.col("limit"))
    if prefix_length:
        found = found.where(F.substring("query", 1, prefix_length) == F.substring("term", 1, prefix_length))
    if max_expansions is not None:
        best = Window.partitionBy("query").orderBy("distance", "term")
        found = found.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= max_expansions)
    return found.select("query", "term", "distance")


def fuzzy_hits(df: DataFrame, field: str, id: str, queries: DataFrame, query: str, fuzziness: int | str = "auto",
               prefix_length: int = 0, max_expansions: int | None = None, transpositions: bool = True,
               analyzer: str = "standard") -> DataFrame:
    """(query, id, distance): the rows with a term near each query term, and the least distance."""
    words = df.select(F.col(id).alias(id), F.explode(F.array_distinct(tx.ANALYZERS[analyzer](field))).alias("term"))
    near = near_terms(words, "term", queries, query, fuzziness, prefix_length, max_expansions, transpositions)
    return words.join(near, "term").groupBy("query", id).agg(F.min("distance").alias("distance"))


def expand(
    df: DataFrame, field: str, value: str, fuzziness: int | str = "auto",
    prefix_length: int = 0, max_expansions: int | None = None, transpositions: bool = True,
    analyzer: str = "standard",
) -> DataFrame:
    """The distinct terms of ``field`` near ``value``: (term, distance), closest first.

    Lengths and prefix are tested before any distance, and only near terms are shuffled.
    ``max_expansions=None`` keeps them all.
    """
    limit = fuzzy_limit(value, fuzziness)
    vocabulary = df.select(F.explode(F.array_distinct(tx.ANALYZERS[analyzer](field))).alias("term"))
    near = F.length("term").between(len(value) - limit, len(value) + limit)
    if prefix_length:
        near = near & F.col("term").startswith(value[:prefix_length])
    found = (
        vocabulary.where(near)
        .withColumn("distance", edit_distance(F.col("term"), value, limit, transpositions))
        .where(F.col("distance").isNotNull())
        .distinct()
    )
    if max_expansions is not None:
        found = found.orderBy("distance", "term").limit(max_expansions)
    return found


def fuzzy(
    df: DataFrame, field: str, value: str, fuzziness: int | str = "auto", prefix_length: int = 0,
    max_expansions: int | None = None, transpositions: bool = True, analyzer: str = "standard",
    boost: float = 1.0,
) -> Clause:
    """Rows of ``df`` with a term near ``value``; scores a constant.

    With ``max_expansions`` the closest terms come from a scalar subquery holding at most
    that many strings; without it the distance is tested on each row.
    """
    found = tx.ANALYZERS[analyzer](field)
    if max_expansions is None:
        limit = fuzzy_limit(value, fuzziness)

        def near(t):
            ok = t.startswith(value[:prefix_length]) if prefix_length else F.lit(True)
            return ok & edit_distance(t, value, limit, transpositions).isNotNull()

        return Clause(F.exists(found, near), boost=boost)
    terms_ = expand(df, field, value, fuzziness, prefix_length, max_expansions,
                    transpositions, analyzer)
    near_terms = terms_.agg(F.collect_list("term")).scalar()
    return Clause(F.arrays_overlap(found, near_terms), boost=boost)


def match_fuzzy(
    df: DataFrame, field: str, query: str, operator: str = "or", fuzziness: int | str = "auto",
    prefix_length: int = 0, max_expansions: int | None = None, transpositions: bool = True,
    analyzer: str = "standard", boost: float = 1.0,
) -> Clause:
    """``match`` where every query token stands for the terms near it."""
    words = list(dict.fromkeys(tx.analyse_query(query, analyzer)))
    if not words:
        return match_none()
    parts = [
        fuzzy(df, field, w, fuzziness, prefix_length, max_expansions, transpositions, analyzer)
        for w in words
    ]
    if operator.lower() == "and":
        return bool_(must=parts, boost=boost)
    return bool_(should=parts, boost=boost)


# ---- lists ---------------------------------------------------------------------------


def any_element(field, test: Callable[[Column], Clause | Column], boost: float = 1.0) -> Clause:
    """Some element satisfies ``test``; several conditions in it apply to the same element."""

    def holds(x: Column) -> Column:
        t = test(x)
        return t.holds() if isinstance(t, Clause) else F.coalesce(t, F.lit(False))

    return Clause(F.exists(col(field), holds), boost=boost)


# ---- composition ---------------------------------------------------------------------


def needed_matches(spec: int | str, total: int) -> int:
    """``3``, ``-1`` (all but one), ``"75%"`` or ``"-25%"`` of ``total`` clauses."""
    text = str(spec).strip()
    if text.endswith("%"):
        share = int(text[:-1])
        n = total * abs(share) // 100
        n = total - n if share < 0 else n
    else:
        n = int(text)
        n = total + n if n < 0 else n
    return max(0, n)


def bool_(
    must: Sequence[Clause] = (), filter: Sequence[Clause] = (), should: Sequence[Clause] = (),
    must_not: Sequence[Clause] = (), minimum_should_match: int | str | None = None,
    boost: float = 1.0,
) -> Clause:
    """Boolean composition. ``must`` and matching ``should`` clauses add up their scores."""
    parts = [c.pred for c in must] + [c.pred for c in filter] + [c.negated() for c in must_not]
    if should:
        if minimum_should_match is None:
            need = 0 if must or filter else 1
        else:
            need = needed_matches(minimum_should_match, len(should))
        if need == 1:
            parts.append(any_of([c.pred for c in should]))
        elif need == len(should):
            parts.extend(c.pred for c in should)
        elif need > 1:
            hits = reduce(lambda a, b: a + b, [c.holds().cast("int") for c in should])
            parts.append(hits >= need)
    pred = all_of(parts) if parts else F.lit(True)

    def score(ctx):
        each = [c.scored(ctx) for c in must]
        each += [F.when(c.pred, c.scored(ctx)).otherwise(F.lit(0.0)) for c in should]
        return reduce(lambda a, b: a + b, each) if each else F.lit(0.0)

    return Clause(pred, score, boost, frozenset().union(*[c.terms for c in [*must, *should]]))
