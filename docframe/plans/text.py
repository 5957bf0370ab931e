"""Text analysis and full-text clauses over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import clauses as c
from ..operators.ranking import search
from ..sources.tables import read
from ..spec import Field, Spec
from .registry import query

# The standard tokens of a column, in DuckDB.
TOKENS = r"[x FOR x IN regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+') IF x <> '']"


def toks(name: str) -> str:
    return TOKENS.format(name)


DOCS = f"SELECT doc_id, lang, {toks('text')} AS t FROM documents"


DOCUMENT = c.Declared(Spec("document", (Field("doc_id", "long"), Field("text", "text"), Field("lang"))))


def documents(spark, sf):
    return read(spark, sf, "documents")


def _docs(spark, sf, clause):
    return search(documents(spark, sf), clause).select("doc_id")


@query("tx_tokens", f"""
    SELECT token, count(*) AS n, count(DISTINCT doc_id) AS n_docs
    FROM (SELECT doc_id, unnest({toks('text')}) AS token FROM documents) GROUP BY 1""")
def tx_tokens(spark, sf):
    """Vocabulary: occurrences and documents per token, from one explosion. The tokens are
    followed by the distinct ones; the position tells which is which, so both counts are
    summed up in every task and only one row per token and task is shuffled."""
    t = tx.tokens("text")
    rows = documents(spark, sf).select(t.alias("t"))
    both = rows.select(F.size("t").alias("dl"), F.posexplode(
        F.concat("t", F.array_distinct("t"))).alias("i", "token"))
    return both.groupBy("token").agg(
        F.count(F.when(F.col("i") < F.col("dl"), F.lit(1))).alias("n"),
        F.count(F.when(F.col("i") >= F.col("dl"), F.lit(1))).alias("n_docs"))


STOP_SQL = ", ".join(f"'{w}'" for w in tx.STOP_WORDS)


@query("tx_english", f"""
    WITH t AS (SELECT conv_id, turn, unnest({toks('text')}) AS w FROM conversations),
    kept AS (SELECT * FROM t WHERE w NOT IN ({STOP_SQL})),
    s AS (SELECT conv_id, turn, CASE
            WHEN w LIKE '%ies' AND w NOT LIKE '%eies' AND w NOT LIKE '%aies'
                THEN w[:-4] || 'y'
            WHEN w LIKE '%es' AND w NOT LIKE '%aes' AND w NOT LIKE '%ees' AND w NOT LIKE '%oes'
                THEN w[:-2]
            WHEN w LIKE '%s' AND w NOT LIKE '%us' AND w NOT LIKE '%ss' THEN w[:-2]
            ELSE w END AS w FROM kept)
    SELECT CASE WHEN regexp_matches(w, '[aeiouy].*ing$') THEN w[:-4]
                WHEN regexp_matches(w, '[aeiouy].*ed$') THEN w[:-3] ELSE w END AS stem,
           count(*) AS n
    FROM s GROUP BY 1""")
def tx_english(spark, sf):
    rows = read(spark, sf, "conversations")
    return rows.select(F.explode(tx.english("text")).alias("stem")).groupBy("stem").agg(
        F.count(F.lit(1)).alias("n"))


@query("tx_normalise", """
    SELECT s_suppkey, lower(trim(s_name)) AS name FROM supplier""")
def tx_normalise(spark, sf):
    return read(spark, sf, "supplier").select("s_suppkey", tx.normalise("s_name").alias("name"))


@query("tx_ngrams", """
    WITH p AS (SELECT lower(p_name) AS s FROM part),
    grams AS (
        SELECT 'inner' AS kind, substr(s, i, n) AS gram
        FROM p, range(2, 4) AS sizes(n), range(1, 40) AS starts(i) WHERE i + n - 1 <= length(s)
        UNION ALL
        SELECT 'edge', substr(s, 1, n) FROM p, range(2, 6) AS sizes(n) WHERE n <= length(s))
    SELECT kind, gram, count(*) AS n FROM grams GROUP BY 1, 2""")
def tx_ngrams(spark, sf):
    names = read(spark, sf, "part")
    inner = names.select(F.lit("inner").alias("kind"),
                         F.explode(tx.ngrams("p_name", 2, 3)).alias("gram"))
    edge = names.select(F.lit("edge").alias("kind"),
                        F.explode(tx.edge_ngrams("p_name", 2, 5)).alias("gram"))
    return inner.unionByName(edge).groupBy("kind", "gram").agg(F.count(F.lit(1)).alias("n"))


@query("f_match_or", f"""
    SELECT doc_id FROM ({DOCS}) WHERE list_has_any(t, ['thtion', 'eauiereux'])""")
def f_match_or(spark, sf):
    return _docs(spark, sf, DOCUMENT.match("text", "Thtion, EAUIEREUX!"))


@query("f_match_and", f"""
    SELECT doc_id FROM ({DOCS}) WHERE list_has_all(t, ['the', 'erth', 'with'])""")
def f_match_and(spark, sf):
    return _docs(spark, sf, c.match("text", "the erth with", operator="and"))


@query("f_zero_terms", """
    SELECT 'all' AS mode, count(*) AS n FROM documents
    UNION ALL SELECT 'none', 0 FROM region WHERE r_regionkey = 0""")
def f_zero_terms(spark, sf):
    docs = read(spark, sf, "documents")
    counts = [
        search(docs, c.match("text", "?! --", zero_terms_query=mode)).agg(
            F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n"))
        for mode in ("all", "none")
    ]
    return counts[0].unionByName(counts[1])


@query("f_phrase", f"""
    SELECT doc_id FROM ({DOCS})
    WHERE contains(' ' || array_to_string(t, ' ') || ' ', ' of the ')
      AND NOT contains(' ' || array_to_string(t, ' ') || ' ', ' in the ')""")
def f_phrase(spark, sf):
    return _docs(spark, sf, c.bool_(must=[c.match_phrase("text", "of the")],
                                    must_not=[c.match_phrase("text", "In the")]))


@query("f_phrase_slop", f"""
    WITH pos AS (
        SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM ({DOCS})),
    two AS (
        SELECT DISTINCT a.doc_id FROM pos a JOIN pos b
          ON a.doc_id = b.doc_id AND a.w = 'with' AND b.w = 'by' AND b.i > a.i AND b.i <= a.i + 3),
    three AS (
        SELECT DISTINCT a.doc_id FROM pos a
        JOIN pos b ON a.doc_id = b.doc_id AND a.w = 'the' AND b.w = 'of' AND b.i > a.i
        JOIN pos c ON a.doc_id = c.doc_id AND c.w = 'and' AND c.i > b.i AND c.i - a.i - 2 <= 3
        WHERE b.i <= a.i + 4)
    SELECT doc_id FROM two UNION SELECT doc_id FROM three""")
def f_phrase_slop(spark, sf):
    return _docs(spark, sf, c.bool_(should=[
        c.match_phrase("text", "with by", slop=2),
        c.match_phrase("text", "the of and", slop=3),
    ]))


# DuckDB's distances count bytes. Terms are lower-case, so giving each accented letter a
# capital of its own makes them count characters.
ACCENTED = "àâäáãæçéèêëíîïñóôöœßúùûü"
CHARS = f"translate(term, '{ACCENTED}', 'ABCDEFGHIJKLMNOPQRSTUVWX')"


def _vocabulary_sql(condition: str, distance: str, limit: int) -> str:
    return f"""(SELECT term FROM (
        SELECT DISTINCT unnest(t) AS term FROM ({DOCS})) WHERE {condition}
        ORDER BY {distance}, term LIMIT {limit})"""


@query("f_fuzzy", f"""
    WITH docs AS ({DOCS}),
    near AS (SELECT list(term) AS l FROM {_vocabulary_sql(
        f"levenshtein({CHARS}, 'erthly') <= 2 AND starts_with(term, 'e')",
        f"levenshtein({CHARS}, 'erthly')", 20)})
    SELECT doc_id FROM docs, near WHERE list_has_any(t, l)""")
def f_fuzzy(spark, sf):
    docs = documents(spark, sf)
    return search(docs, c.fuzzy(docs, "text", "erthly", "auto", prefix_length=1,
                                max_expansions=20, transpositions=False)).select("doc_id")


@query("f_fuzzy_swap", f"""
    SELECT term, damerau_levenshtein({CHARS}, 'whthre') AS distance
    FROM (SELECT DISTINCT unnest(t) AS term FROM ({DOCS}))
    WHERE damerau_levenshtein({CHARS}, 'whthre') <= 2""")
def f_fuzzy_swap(spark, sf):
    return c.expand(documents(spark, sf), "text", "whthre", 2, max_expansions=None).select(
        "term", F.col("distance").cast("long").alias("distance"))


FUZZY_TERMS = f"""v AS (SELECT DISTINCT unnest(t) AS term FROM ({DOCS})),
    q AS (SELECT query FROM (SELECT DISTINCT substr(term, 1, 2) || substr(term, 4, 1) || substr(term, 3, 1)
              || substr(term, 5) AS query FROM v WHERE length(term) >= 5) ORDER BY md5(query), query LIMIT 1000),
    near AS (SELECT query, term, damerau_levenshtein({CHARS}, {CHARS.replace("term", "query")}) AS distance
             FROM q JOIN v ON abs(length(term) - length(query)) <= CASE WHEN length(query) <= 5 THEN 1 ELSE 2 END
             WHERE distance <= CASE WHEN length(query) <= 5 THEN 1 ELSE 2 END)"""


@query("f_fuzzy_terms", f"""
    WITH {FUZZY_TERMS}
    SELECT query, count(*) AS n_terms, sum(distance)::BIGINT AS distances, min(term) AS first_term
    FROM near GROUP BY 1""")
def f_fuzzy_terms(spark, sf):
    """A thousand misspelt terms, each with a swap, and the vocabulary near them."""
    words = documents(spark, sf).select(F.explode(F.array_distinct(tx.tokens("text"))).alias("term")).distinct()
    t = F.col("term")
    made = words.where(F.length(t) >= 5).select(F.concat(
        F.substring(t, 1, 2), F.substring(t, 4, 1), F.substring(t, 3, 1), F.substr(t, F.lit(5))).alias("query"))
    asked = made.distinct().orderBy(F.md5("query"), "query").limit(1000)
    return c.near_terms(words, "term", asked, "query").groupBy("query").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("distance").alias("distances"), F.min("term").alias("first_term"))


@query("f_match_fuzzy", f"""
    WITH docs AS ({DOCS}),
    a AS (SELECT list(term) AS l FROM {_vocabulary_sql(
        f"levenshtein({CHARS}, 'shhere') <= 2", f"levenshtein({CHARS}, 'shhere')", 50)}),
    b AS (SELECT list(term) AS l FROM {_vocabulary_sql(
        f"levenshtein({CHARS}, 'ouhe') <= 1", f"levenshtein({CHARS}, 'ouhe')", 50)})
    SELECT doc_id FROM docs, a, b WHERE list_has_any(t, a.l) AND list_has_any(t, b.l)""")
def f_match_fuzzy(spark, sf):
    docs = documents(spark, sf)
    return search(docs, c.match_fuzzy(docs, "text", "shhere ouhe", operator="and",
                                      max_expansions=50, transpositions=False)).select("doc_id")


PAGES = f"SELECT page_id, {toks('url')} AS u, {toks('html')} AS h FROM pages"


def _pages(spark, sf, clause):
    return search(read(spark, sf, "pages"), clause).select("page_id")


@query("mm_phrase", f"""
    SELECT page_id FROM ({PAGES})
    WHERE contains(' ' || array_to_string(u, ' ') || ' ', ' example com ')
       OR contains(' ' || array_to_string(h, ' ') || ' ', ' example com ')""")
def mm_phrase(spark, sf):
    return _pages(spark, sf, c.multi_match("example.com", ["url", "html"], "phrase"))


@query("mm_phrase_prefix", f"""
    SELECT page_id FROM ({PAGES})
    WHERE contains(' ' || array_to_string(u, ' ') || ' ', ' example org en 8')
       OR contains(' ' || array_to_string(h, ' ') || ' ', ' example org en 8')""")
def mm_phrase_prefix(spark, sf):
    return _pages(spark, sf, c.multi_match("example org en 8", ["url", "html"], "phrase_prefix"))


@query("mm_bool_prefix", f"""
    SELECT page_id FROM ({PAGES})
    WHERE list_contains(u, 'casino') OR list_contains(h, 'casino')
       OR len([x FOR x IN list_concat(u, h) IF starts_with(x, 'utm')]) > 0""")
def mm_bool_prefix(spark, sf):
    return _pages(spark, sf, c.multi_match("casino utm", ["url", "html"], "bool_prefix"))
