"""Line-first quality rules, in DataFrame functions only.

Every line with a word is judged by itself: punctuation (mostly signs, or shouting), navigation (a row of
menu entries), boilerplate (licence and site phrases), and repetition (equal to an earlier line). Lines
that fail are removed, and a document that loses too much of its text with them is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, as characters and as a class of Java's patterns.
SPACE, SPACES = " \t\n\x0b\x0c\r", r"[\x20\x09-\x0D]+"

#: Phrases of site chrome and licences.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "enable javascript",
    "lorem ipsum", "licensed under", "released under the", "general public license", "subscribe to our newsletter",
)

#: Signs a hundred characters of a line may have; menu bars a line may have; hundredths of a text it may lose.
SIGNS, BARS, LOSS = 5, 3, 40
MIN_WORDS, MAX_REPEATED = 50, 50

#: Bits of a packed value that hold a word's position.
_PLACE = 24


def line_fails(line: Column) -> Column:
    """Whether one line fails the punctuation, navigation or boilerplate rule."""
    signs = F.length(line) - F.length(F.translate(line, "#*$%&|<>!", ""))
    bars = F.length(line) - F.length(F.translate(line, "|", ""))
    phrase = F.lower(line).rlike("|".join(BOILERPLATE))
    return (signs * 100 > SIGNS * F.length(line)) | (bars >= BARS) | phrase


def _repeated_words(docs: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words within three-word windows that occur twice or more.

    Windows are sorted within the row as numbers: 40 bits of hash above 24 of position. Neighbours with
    equal hashes are compared word by word, and a row where they differ, or with more words than fit,
    sorts the words themselves.
    """
    words, seq = F.col("words"), F.sequence(F.lit(0), F.greatest(F.col("n_words") - 3, F.lit(0)))
    size = 1 << _PLACE

    def packed(i):
        mark = F.xxhash64(words[i], words[i + 1], words[i + 2])
        return F.shiftleft(mark, _PLACE).bitwiseOR(i.cast("long"))

    def mark_of(x):
        return F.shiftright(x, _PLACE)

    def place_of(x):
        return x.bitwiseAND(F.lit(size - 1)).cast("int")

    fits = (F.col("n_words") >= 3) & (F.col("n_words") < size)
    docs = docs.withColumn("__s", F.when(fits, F.sort_array(F.transform(seq, packed))))
    s = F.col("__s")
    twins = F.filter(
        F.transform(s, lambda x, i: F.when((i > 0) & (mark_of(x) == mark_of(F.get(s, i - 1))), F.struct(place_of(F.get(s, i - 1)).alias("a"), place_of(x).alias("b")))),
        lambda q: q.isNotNull(),
    )
    docs = docs.withColumn("__q", twins).drop("__s")
    q = F.col("__q")

    def differs(pair):
        a, b = pair["a"], pair["b"]
        return (words[a] != words[b]) | (words[a + 1] != words[b + 1]) | (words[a + 2] != words[b + 2])

    slow = (F.col("n_words") >= size) | F.exists(q, differs)
    ordered = F.array_sort(F.transform(seq, lambda i: F.struct(words[i].alias("x"), words[i + 1].alias("y"), words[i + 2].alias("z"), i.alias("i"))))

    def same(one, other):
        return (one["x"] == other["x"]) & (one["y"] == other["y"]) & (one["z"] == other["z"])

    docs = docs.withColumn("__t", F.when(slow, ordered))
    t = F.col("__t")
    exact = F.filter(F.transform(t, lambda x, i: F.when((i > 0) & same(x, F.get(t, i - 1)), F.struct(F.get(t, i - 1)["i"].alias("a"), x["i"].alias("b")))), lambda p: p.isNotNull())
    docs = docs.withColumn("__q", F.when(t.isNotNull(), exact).otherwise(q)).drop("__t")
    places = F.sort_array(F.array_distinct(F.concat(F.transform(q, lambda p: p["a"]), F.transform(q, lambda p: p["b"]))))
    docs = docs.withColumn("__p", F.when(F.size(q) > 0, places)).drop("__q")
    p = F.col("__p")
    covered = F.aggregate(F.transform(p, lambda x, i: F.coalesce(F.least(F.get(p, i + 1) - x, F.lit(3)), F.lit(3))), F.lit(0), lambda total, x: total + x)
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__p")


def _scored(docs: DataFrame, carried: list[Column]) -> DataFrame:
    """The carried columns and the scores of column ``text``."""
    whole, names = F.col("text"), [f"__c{i}" for i in range(len(carried))]
    docs = docs.select(*[c.alias(n) for c, n in zip(carried, names, strict=True)], F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("words", F.array_remove(F.split(whole, SPACES), "")).withColumn("n_words", F.size("words"))
    docs = docs.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
    docs = _repeated_words(docs).drop("words")
    docs = docs.withColumn("n_symbols", (F.length(whole) - F.length(F.translate(whole, "#*$%&|<>", ""))).cast("long"))
    docs = docs.withColumn("__lines", F.split(whole, "\n"))
    docs = docs.withColumn("__full", F.filter("__lines", lambda line: F.btrim(line, F.lit(SPACE)) != ""))
    docs = docs.withColumn("__once", F.array_distinct("__full"))
    docs = docs.withColumn("n_dup_lines", (F.size("__full") - F.size("__once")).cast("long"))
    docs = docs.withColumn("__good", F.filter("__once", lambda line: ~line_fails(line)))

    def chars(lines):
        return F.length(F.array_join(lines, ""))

    docs = docs.withColumn("n_removed_chars", (chars("__full") - chars("__good")).cast("long"))
    docs = docs.withColumn("n_failed_lines", (F.size("__full") - F.size("__good")).cast("long"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    loses = 100 * F.col("n_removed_chars") > LOSS * chars("__full")
    return docs.select(
        *names, F.col("n_words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~loses).alias("kept"), "n_failed_lines", "n_removed_chars",
        F.array_join("__good", "\n").alias("clean_text"),
    )


def score_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row with its counts, verdict and ``clean_text``, the text without failed lines.

    Null and empty texts have no words and fail. Lines without a word are dropped and count for nothing.
    Repeated rows and null ids are judged like others. No row needs another, so nothing is shuffled.
    """
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return _scored(named, [F.col("doc_id")]).withColumnRenamed("__c0", "doc_id")


def report(docs: DataFrame) -> DataFrame:
    """``score_lines`` without the text."""
    return score_lines(docs).drop("clean_text")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, without their failed lines; ``n_chars`` follows the text."""
    names = docs.columns
    # a row number in the condition keeps the filter above the scores: pushed below them, it would repeat
    # every expression they rest on, and those of these in turn
    scored = _scored(docs, [F.col(c) for c in names]).withColumn("__stays", F.col("kept") & (F.monotonically_increasing_id() >= 0)).where("__stays")
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return scored.select(*[new.get(c, F.col(f"__c{i}")).alias(c) for i, c in enumerate(names)])


ORACLE = r"""
WITH rows_ AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split_ AS MATERIALIZED (
    SELECT rid, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM rows_),
words AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split_),
windows_ AS (
    SELECT rid, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (
    SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w, w1, w2) AS n FROM windows_ WHERE w2 IS NOT NULL) WHERE n > 1),
covered AS (
    SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
lines_ AS (SELECT rid, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM split_),
judged AS (
    SELECT rid, l, row_number() OVER (PARTITION BY rid, l ORDER BY i) > 1
           OR 100 * (length(l) - length(translate(l, '#*$%&|<>!', ''))) > 5 * length(l)
           OR length(l) - length(replace(l, '|', '')) >= 3
           OR regexp_matches(lower(l), 'PHRASES') AS bad
    FROM lines_),
per_line AS (
    SELECT rid, count(*) FILTER (WHERE bad) AS n_failed_lines, count(*) - count(DISTINCT l) AS n_dup_lines,
           coalesce(sum(length(l)) FILTER (WHERE bad), 0) AS lost, sum(length(l)) AS chars
    FROM judged GROUP BY rid),
counted AS (
    SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
           length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(c.n, 0) AS n_repeat_words, coalesce(n_failed_lines, 0) AS n_failed_lines,
           CAST(coalesce(lost, 0) AS BIGINT) AS n_removed_chars, coalesce(chars, 0) AS chars
    FROM split_ LEFT JOIN covered c USING (rid) LEFT JOIN per_line USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT 100 * n_removed_chars > 40 * chars AS kept,
       n_failed_lines, n_removed_chars
FROM counted
""".replace("PHRASES", "|".join(BOILERPLATE))
