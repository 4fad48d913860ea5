"""Quality rules (operator 9): cross-document line frequency, with built-in functions only.

Words are runs ``[^\\x20\\x09-\\x0D]+``. A line (cut at \\n) counts if it has a
word; it is normalised to its words joined by one space, A-Z in lower case, and
hashed to 64 bits.

Per host (the document's ``source``), the number of different documents that
hold a line is counted; documents of equal text count once, as whole copies are
the business of deduplication. A line held by more than ``max(LINE_DOCS, LINE_SHARE *
the host's different documents)`` is boilerplate. A document is depleted if its
lines without boilerplate have fewer than LEFT_WORDS words or less than LEFT_SHARE
of its words. A document is kept if it passes the base rules and isn't depleted.

Base rules: ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``
are counted on the raw text; a document fails with fewer than 10 words, or if over
a fifth of its words lie in five-word windows that occur twice or more. Windows are
compared by 64-bit hashes within one document.

``cleaned`` gives every document's text without its boilerplate lines, the others
rejoined as they stand; ``judged`` takes its counts from both texts.

All counting per document is done on its own row. Lines are shuffled as hashes
with their places, once per different text of a host, pre-aggregated per task;
boilerplate lines find their texts through a join salted on the text, so a line
that a third of all documents share is spread over SALTS tasks, and the places to
be removed reach the documents through a join salted on the row, so that copies of
one text are spread as well.

Edge cases: null text = empty text: no words, fails the base rules. Null sources
form one host. Rows of null or repeated doc_id are judged each on their own.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmart.llm.common import materialize, prepare

LINE_DOCS = 3      # a line is boilerplate in more documents of its host than this ...
LINE_SHARE = 0.02  # ... and than this share of them
LEFT_WORDS = 10
LEFT_SHARE = 0.5
MIN_WORDS = 10
REPEAT_SHARE = (20, 100)
SALTS = 16
WORD = r"[^\x20\x09-\x0D]+"


def _words(text: str | Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _repeats(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from the column ``words``: words in windows of five that repeat."""
    keep = [c for c in df.columns if c != "words"]
    df = df.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    df = df.select(*keep, F.expr(
        "CASE WHEN size(h) < 5 THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, size(h) - 5),"
        " i -> xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4])) END").alias("g"))
    # most texts repeat no window: only others sort theirs
    df = df.select(*keep, F.expr(
        "CASE WHEN size(array_distinct(g)) < size(g)"
        " THEN array_sort(transform(g, (x, i) -> struct(x AS h, i AS i))) END").alias("s"))
    df = df.select(*keep, F.expr(
        "array_sort(transform(filter(s, (x, i) -> (i > 0 AND s[i - 1].h = x.h) OR"
        " (i < size(s) - 1 AND s[i + 1].h = x.h)), x -> x.i))").alias("p"))
    # each window adds the words up to the next one's start, five at most
    covered = F.expr(
        "5L + aggregate(zip_with(slice(p, 1, size(p) - 1), slice(p, 2, size(p) - 1),"
        " (a, b) -> least(b - a, 5)), 0L, (n, x) -> n + x)")
    return df.select(*keep, F.when(F.size("p") > 0, covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id, host, text, content``; ``content`` is a hash of the text."""
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("host"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("content", F.xxhash64("text"))


def lined(rows: DataFrame) -> DataFrame:
    """``host, content`` of each different text, and ``lines``: hash and place of each line with a word."""
    raw = F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(x.alias("x"), i.alias("place"))),
                   lambda r: r["x"].rlike(WORD))
    lines = F.transform(raw, lambda r: F.struct(
        F.xxhash64(F.translate(F.array_join(_words(r["x"]), " "), string.ascii_uppercase, string.ascii_lowercase)).alias("line"),
        r["place"].alias("place")))
    return rows.select("host", "content", lines.alias("lines")).groupBy("host", "content").agg(
        F.first("lines").alias("lines"))


def boilerplate(texts: DataFrame) -> DataFrame:
    """``host, line`` of lines in too many different documents of their host."""
    hosts = texts.groupBy("host").agg(F.count("*").alias("documents"))
    lines = texts.select("host", F.explode(F.array_distinct("lines.line")).alias("line")).groupBy("host", "line").agg(
        F.count("*").alias("held")).where(F.col("held") > LINE_DOCS)
    many = lines.join(hosts, lines["host"].eqNullSafe(hosts["host"])).where(
        F.col("held") > F.col("documents") * LINE_SHARE)
    return many.select(lines["host"], "line")


def cleaned(docs: DataFrame) -> DataFrame:
    """``doc_id, text, clean_text`` for every row: the text, and what is left of it without its boilerplate lines."""
    rows = _rows(docs)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    texts = materialize(lined(rows), "quality-texts")
    marked = materialize(boilerplate(texts).select(F.xxhash64("host", "line").alias("mark"), salts), "quality-lines")
    lines = texts.select("host", "content", F.explode("lines").alias("x")).select(
        F.xxhash64("host", "content").alias("key"), F.xxhash64("host", "x.line").alias("mark"), F.col("x.place").alias("place"),
        F.pmod("content", F.lit(SALTS)).cast("int").alias("salt"))
    gone = lines.join(marked, ["mark", "salt"], "left_semi").groupBy("key").agg(F.collect_list("place").alias("gone"))
    gone = materialize(gone, "quality-gone").select("key", "gone", salts)
    rows = rows.select("doc_id", "text", F.xxhash64("host", "content").alias("key"),
                       F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"))
    left = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("gone", i)), "\n")
    # the same join at every size: a broadcast would grow with the number of cut texts
    return rows.join(gone.hint("merge"), ["key", "salt"], "left").select(
        "doc_id", "text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("clean_text"))


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_left_words``."""
    rows = cleaned(docs).select(
        "*", _words("text").alias("words"), F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)).alias("raw"))
    rows = rows.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        # most texts lose no line: only others are counted again
        F.when(F.col("clean_text") == F.col("text"), F.size("words")).otherwise(
            F.size(_words("clean_text"))).cast("long").alias("n_left_words"))
    share, whole = REPEAT_SHARE
    failed = (F.col("n_words") < MIN_WORDS) | (whole * F.col("n_repeat_words") > share * F.col("n_words"))
    out = _repeats(rows).withColumn("base_failed", failed)
    left = F.col("n_left_words")
    depleted = (left < LEFT_WORDS) | (left < F.col("n_words") * LEFT_SHARE)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~depleted).alias("kept"), "n_left_words")


# DuckDB SQL for ``judged`` over the table documents
ORACLE = f"""
WITH rows AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, source AS host FROM documents
), lines AS (
  SELECT row, host, text, pos, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM (
    SELECT row, host, text, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM rows)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), normal AS (
  SELECT row, host, text, line, len(words) AS words,
         translate(array_to_string(words, ' '), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS norm FROM lines
), held AS (
  SELECT host, norm, count(DISTINCT text) AS held FROM normal GROUP BY host, norm
), hosts AS (
  SELECT host, count(DISTINCT text) AS documents FROM rows GROUP BY host
), marked AS (
  SELECT held.host, held.norm FROM held JOIN hosts ON held.host IS NOT DISTINCT FROM hosts.host
  WHERE held.held > {LINE_DOCS} AND held.held > hosts.documents * {LINE_SHARE}
), gone AS (
  SELECT n.row, sum(n.words) AS gone FROM normal n JOIN marked m
  ON n.norm = m.norm AND n.host IS NOT DISTINCT FROM m.host GROUP BY n.row
), words AS (
  SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM rows
), grams AS (
  SELECT row, i, list_slice(w, i, i + 4) AS g FROM (SELECT row, w, unnest(range(1, len(w) - 3)) AS i FROM words)
), twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY row
), dups AS (
  SELECT row, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY row
), base AS (
  SELECT r.row, r.doc_id, len(w.w)::BIGINT AS n_words,
         length(regexp_replace(r.text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(r.text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         (len(w.w) - coalesce(g.gone, 0))::BIGINT AS n_left_words
  FROM rows r JOIN words w USING (row) LEFT JOIN dups d USING (row) LEFT JOIN covered c USING (row)
  LEFT JOIN gone g USING (row)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words)
         AND NOT (n_left_words < {LEFT_WORDS} OR n_left_words < n_words * {LEFT_SHARE}) AS kept,
       n_left_words
FROM base
"""
