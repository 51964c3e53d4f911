"""Quality rules, line first (native: DataFrame functions only).

Every line is judged on its own by three families of rules:

* punctuation -- a line is a fragment if it is short, carries no sentence
  punctuation and does not end in a terminal mark; a line is noise if symbol
  and exclamation characters weigh too much against its words;
* navigation -- separators (``|``, ``>``, bullets) between most of its words;
* boilerplate -- a short line with a licence, cookie, copyright or script notice; a
  sentence that only names one of these things stays.

Lines that fail are removed.  Only then is the document judged: it is rejected
if it lost more than ``max_lost`` of its word characters, or if it fails the
base rules (too few words, too many words in repeated three-word windows).

Defined results: null text has no words, no lines, and is rejected (fewer than
``min_words`` words); an empty table gives an empty result; other columns pass
through unread (input columns are never named in an output by accident: the
output has only the columns listed in ``RESULT``).  Repeated rows are judged
one by one.  All work is per row, so a hot source or a group of copies adds no
shuffle and no skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
          "n_lines", "n_bad_lines", "bad_chars", "clean_text", "kept"]

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Notices that make a line boilerplate (lower case).  A word that a sentence may be
# about (cookie, copyright, JavaScript, to subscribe, to sign up) needs the rest of its notice.
BOILERPLATE = (
    r"(?:all rights reserved|terms of (?:use|service)|privacy policy|lorem ipsum|click here|\(c\) ?[12][0-9][0-9][0-9]|©"
    r"|licen[sc]ed under|under the [a-z0-9 .-]* licen[sc]e|copyright (?:notice|\(c\)|[12][0-9][0-9][0-9])"
    r"|cookie (?:policy|notice|settings|preferences|consent)|(?:uses?|using|accept|enable|allow|manage) (?:all |our )?cookies"
    r"|(?:enable|requires?|without|turn on) javascript|javascript (?:is|must be|to be) (?:disabled|enabled|required|turned)"
    r"|(?:subscribe to|sign up for) (?:our|my|this|the newsletter|the mailing|free|email|updates|newsletter))"
)
# Marks that end or divide a sentence, also full-width, Devanagari and Arabic ones.
MARKS = ".!?\u2026:;\u3002\uff01\uff1f\uff1a\uff1b\uff0e\uff61\u0964\u0965\u061f\u06d4"


def _settled(d: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once: Catalyst would otherwise copy the
    expression into every later use, also into the body of a lambda, where it
    would run once per element."""
    return d.select("*", F.explode(F.array(value)).alias(name))


def _removed(c: Column, pattern: str) -> Column:
    """How many code points of ``c`` match a character class."""
    return F.when(c.rlike(pattern), F.length(c) - F.length(F.regexp_replace(c, pattern, ""))).otherwise(0)


def _bad(body: Column, short_line: int, fragment: int) -> Column:
    """True for a trimmed line that one of the rules removes; a line without a word is layout, never bad."""
    size = F.length(body)
    noise = _removed(body, r"[#*$%&<>{}!]")
    separators = _removed(body, r"[|>\u2022\u00bb\u00b7]")
    odd = body.rlike(r"[#*$%&<>{}!|\u2022\u00bb\u00b7]")
    return (size > 0) & (
        ((size < fragment) & ~body.rlike(f"[{MARKS}]"))
        | F.when(odd, (noise * 10 >= size + 10) | ((separators >= 2) & (separators * 24 >= size))).otherwise(False)
        | F.when(size <= short_line, body.rlike("(?i)" + BOILERPLATE)).otherwise(False))


def quality_rules(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = 50,
                  max_repeat: float = 0.5, max_lost: float = 0.5, short_line: int = 200,
                  fragment: int = 20) -> DataFrame:
    """``key`` and ``RESULT``, one row per input row.  ``short_line`` and
    ``fragment`` are line lengths in code points."""
    d = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    d = _settled(d, "w", F.array_remove(F.split("t", SPACE), ""))
    # Lines: judged first, one by one.
    trimmed = F.transform(F.split("t", "\n"), lambda x: F.struct(
        x.alias("x"), F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "").alias("b")))
    d = _settled(d, "l", F.filter(trimmed, lambda x: F.lit(True)))
    d = _settled(d, "bad", F.filter("l", lambda x: _bad(x["b"], short_line, fragment)))
    # Words in three-word windows that occur again in the text.
    windows = F.arrays_zip(F.expr("slice(w, 1, size(w) - 2)").alias("a"), F.expr("slice(w, 2, size(w) - 2)").alias("b"),
                           F.expr("slice(w, 3, size(w) - 2)").alias("c"))
    d = _settled(d, "h", F.when(F.size("w") > 3, F.transform(windows, lambda x: F.xxhash64(x["a"], x["b"], x["c"]))))
    d = _settled(d, "s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(
        F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    d = _settled(d, "at", F.sort_array(F.transform(F.expr(
        "filter(s, (x, i) -> x.h = get(s, i - 1).h OR x.h = get(s, i + 1).h)"), lambda x: x["i"])))
    covered = F.aggregate(
        "at", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["end"])).alias("n"), (i + 3).alias("end")))["n"]
    with_word = F.expr("transform(filter(l, x -> x.b <> ''), x -> x.x)")
    d = d.select(
        "key", "t", "l", "bad", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _removed(F.col("t"), f"[{SYMBOLS}]").cast("long").alias("n_symbols"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.explode(F.array(with_word)).alias("lw"))
    d = d.select(
        "*", (F.size("lw") - F.size(F.array_distinct("lw"))).cast("long").alias("n_dup_lines"),
        F.size("lw").cast("long").alias("n_lines"), F.size("bad").cast("long").alias("n_bad_lines"),
        F.aggregate("bad", F.lit(0), lambda a, x: a + F.length(F.regexp_replace(x["b"], SPACE, ""))).cast("long").alias("bad_chars"),
        ((F.col("n_words") < min_words)
         | (F.lit(100) * F.col("n_repeat_words") > F.lit(round(100 * max_repeat)) * F.col("n_words"))).alias("base_failed"))
    clean = F.when(F.size("bad") == 0, F.col("t")).otherwise(F.array_join(F.transform(
        F.filter("l", lambda x: ~_bad(x["b"], short_line, fragment)), lambda x: x["x"]), "\n"))
    kept = ~F.col("base_failed") & (F.col("bad_chars") * 100 <= F.col("word_chars") * round(100 * max_lost))
    return d.withColumn("clean_text", clean).withColumn("kept", kept).select(F.col("key").alias(key), *RESULT)


QUERY = "op10_quality_rules"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g,
             unnest(range(1, len(w) - 1)) AS i FROM w),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
lines AS (SELECT doc_id, trim(unnest(l), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS b FROM w),
f AS (SELECT doc_id, b, length(b) AS size,
             length(b) - length(regexp_replace(b, '[#*$%&<>{{}}!]', '', 'g')) AS noise,
             length(b) - length(regexp_replace(b, '[|>•»·]', '', 'g')) AS seps FROM lines),
lost AS (SELECT doc_id, sum(length(regexp_replace(b, '[\x20\x09-\x0D]+', '', 'g'))) AS bad_chars FROM f
         WHERE (size < 20 AND NOT regexp_matches(b, '[{MARKS}]'))
            OR (noise > 0 AND noise * 10 >= size + 10)
            OR (seps >= 2 AND seps * 24 >= size)
            OR (size <= 200 AND regexp_matches(b, '(?i){BOILERPLATE}'))
         GROUP BY doc_id),
b AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             coalesce(bad_chars, 0) AS bad_chars
      FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad_chars * 100 <= word_chars * 50 AS kept
FROM v
"""
