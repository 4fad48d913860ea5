"""Secret scans (operator 10): base patterns and character Markov models, built-in functions only.

Base spans, leftmost and non-overlapping per kind (code points, end exclusive):
``assign`` (a key word, = or :, a value of 8 characters or more), ``access``
(AKIA..., 16 or more) and ``hex`` (32 or more). Matches that are too short are
consumed and dropped.

The method adds kind ``markov``: tokens ``[A-Za-z0-9+/_=-]`` of MIN_TOKEN or more
characters with a letter and a digit that touch no base span and whose mean
log-likelihood ratio, of a model of random strings to one of ordinary words,
exceeds MIN_RATIO a character. Both are first-order Markov models of characters
trained from labelled samples: the values of base spans are random strings, the
words of documents without any are ordinary. The samples are bounded (training
only): SAMPLE_VALUES values and SAMPLE_DOCS documents, those of least hash, of these
SAMPLE_CHARS characters each from a place drawn by hash. What reaches the driver are counts of
character pairs, 2 * 128 * 128 numbers at most.

Positions: ``\\G(.*?)(pattern)`` gives the gap before each match, so a start is
the length of all gaps and matches before it. One pass over the texts writes
the matches of every document; what is shuffled after it are matches only.

Edge cases: null text = empty text: no spans, the digest of the empty string.
Without base spans in the table the random model is uniform. Repeated rows and
rows of null doc_id are scanned each on their own. Other columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flightmart.llm.common import hashed_window, materialize, prepare

_KEY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
_CHARS = "[A-Za-z0-9+/_=-]"
MIN_TOKEN = 20

# kind: its pattern with one group, a pattern that any text with a valid match
# holds, the least length, and whether that is the group's (else the match's)
KINDS = {
    "assign": (_KEY + "([A-Za-z0-9+/_.=-]+)", _KEY + "[A-Za-z0-9+/_.=-]{8}", 8, True),
    "access": ("AKIA[A-Z0-9]+()", "AKIA[A-Z0-9]{12}", 16, False),
    "hex": ("[0-9a-f]+()", "[0-9a-f]{32}", 32, False),
    "markov": (rf"(?<!{_CHARS})(?=[A-Za-z+/_=-]*[0-9]){_CHARS}{{{MIN_TOKEN},}}()",
               rf"(?<!{_CHARS})(?=[A-Za-z+/_=-]*[0-9]){_CHARS}{{{MIN_TOKEN}}}", MIN_TOKEN, False),
}
BASE = ("assign", "access", "hex")
MIN_RATIO = 1.0
SAMPLE_VALUES = 5000
SAMPLE_DOCS = 2000
SAMPLE_CHARS = 2000
RANDOM_PRIOR, ORDINARY_PRIOR = 5.0, 0.1
_SYMBOLS = 128


def _matches(number: int, kind: str) -> Column:
    """``kind, place, gap, hit, value`` of every match of a kind in ``text``."""
    pattern, hint, _, by_group = KINDS[kind]
    whole = rf"(?s)\G(.*?)({pattern})"
    found = F.arrays_zip(*[
        F.regexp_extract_all("text", F.lit(whole), F.lit(g)).alias(n) for g, n in ((1, "gap"), (2, "hit"), (3, "value"))])
    hits = F.transform(found, lambda x, i: F.struct(
        F.lit(number).alias("kind"), i.alias("place"), F.length(x["gap"]).cast("long").alias("gap"),
        F.length(x["hit"]).cast("long").alias("hit"), (x["value"] if by_group else x["hit"]).alias("value")))
    return F.when(F.col("text").rlike(hint), hits).otherwise(F.lit(None))


def matched(docs: DataFrame) -> DataFrame:
    """``row, doc_id, content, hits``: all matches of all kinds, written once."""
    prepare(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hits = F.flatten(F.filter(F.array(*[_matches(n, k) for n, k in enumerate(KINDS)]), lambda x: x.isNotNull()))
    rows = rows.select("row", "doc_id", F.xxhash64("text").alias("content"), hits.alias("hits"))
    return materialize(rows, "secret-hits")


def placed(rows: DataFrame) -> DataFrame:
    """``row, kind, start, end, value`` of all matches that are long enough."""
    hits = rows.select("row", F.explode("hits").alias("x")).select("row", "x.*")
    before = W.partitionBy("row", "kind").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("gap") + F.col("hit")).over(before)
    least = F.array(*[F.lit(k[2]) for k in KINDS.values()])[F.col("kind")]
    spans = hits.select("row", "kind", (end - F.col("hit")).alias("start"), end.alias("end"), "value")
    return spans.where(F.length("value") >= least)


def _codes(text: str) -> Column:
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


def _pair_counts(words: DataFrame) -> dict[tuple[int, int], int]:
    codes = words.select(_codes("word").alias("c"))
    pairs = codes.select(F.explode(F.expr(
        "CASE WHEN size(c) > 1 THEN transform(sequence(0, size(c) - 2), i -> struct(c[i] AS a, c[i + 1] AS b)) END"
    )).alias("p")).where(f"p.a < {_SYMBOLS} AND p.b < {_SYMBOLS}")
    # at most _SYMBOLS ** 2 rows
    return {(r.a, r.b): r.n for r in pairs.groupBy("p.a", "p.b").agg(F.count("*").alias("n")).collect()}


def ratios(docs: DataFrame, spans: DataFrame, n_docs: int) -> list[float]:
    """Log of P(b | a, random) / P(b | a, ordinary) at a * 128 + b."""
    base = spans.where(F.col("kind") < len(BASE)).select(F.col("value").alias("word")).distinct()
    random = base.orderBy(F.xxhash64("word"), "word").limit(SAMPLE_VALUES)
    sample = docs.where(F.length("text") > 0).select(
        hashed_window("text", SAMPLE_CHARS).alias("text"), F.xxhash64("text").alias("at"))
    # of many documents only every so many-th hash is looked at, so that a task's candidates
    # don't grow with the number of tasks
    sample = sample.where(F.pmod("at", F.lit(max(1, n_docs // (4 * SAMPLE_DOCS)))) == 0)
    sample = sample.orderBy("at", "text").limit(SAMPLE_DOCS)
    for kind in BASE:
        sample = sample.where(~F.col("text").rlike(KINDS[kind][1]))
    ordinary = sample.select(F.explode(F.regexp_extract_all("text", F.lit(f"{_CHARS}{{4,}}"), F.lit(0))).alias("word"))
    # tokens that are yet to be judged are no labelled sample
    ordinary = ordinary.where((F.length("word") < MIN_TOKEN) | ~F.col("word").rlike("[0-9]"))
    alphabet = [c for c in range(_SYMBOLS) if chr(c).isalnum() or chr(c) in "+/_=-"]

    def logs(counts: dict, prior: float) -> dict:
        out = {}
        for a in alphabet:
            total = sum(counts.get((a, b), 0) for b in alphabet) + prior * len(alphabet)
            out |= {(a, b): math.log((counts.get((a, b), 0) + prior) / total) for b in alphabet}
        return out

    r, o = logs(_pair_counts(random), RANDOM_PRIOR), logs(_pair_counts(ordinary), ORDINARY_PRIOR)
    return [r[a, b] - o[a, b] if (a, b) in r else 0.0 for a in range(_SYMBOLS) for b in range(_SYMBOLS)]


def _mean_ratio(table: list[float]) -> Column:
    """Mean log-likelihood ratio of the column ``value``."""
    literal = F.from_json(F.lit(json.dumps(table)), "array<double>")
    pairs = F.zip_with("codes", F.slice("codes", 2, F.greatest(F.size("codes") - 1, F.lit(0))), lambda a, b: a * _SYMBOLS + b)
    # the last character has no successor
    known = F.filter(pairs, lambda p: p.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda acc, p: acc + F.get(F.col("table"), p))
    return total / F.greatest(F.size(known), F.lit(1)), literal


def secret_spans(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``row, kind, start, end`` of base and Markov spans."""
    spans = materialize(placed(rows), "secret-spans")
    mean, literal = _mean_ratio(ratios(docs, spans, rows.count()))
    tokens = spans.where((F.col("kind") == len(BASE)) & F.col("value").rlike("[A-Za-z]"))
    tokens = tokens.select("*", _codes("value").alias("codes"), literal.alias("table")).where(mean > MIN_RATIO)
    both = spans.where(F.col("kind") < len(BASE)).unionByName(tokens.drop("codes", "table"))
    # a base span over a token starts at or before it and ends after its start, or starts within it
    w = W.partitionBy("row").orderBy("start")
    base = F.col("kind") < len(BASE)
    reach = F.max(F.when(base, F.col("end"))).over(w.rangeBetween(W.unboundedPreceding, W.currentRow))
    ahead = F.min(F.when(base, F.col("start"))).over(w.rangeBetween(W.currentRow, W.unboundedFollowing))
    both = both.select("row", "kind", "start", "end", reach.alias("reach"), ahead.alias("ahead"))
    touched = (F.coalesce("reach", F.lit(-1)) > F.col("start")) | (F.coalesce("ahead", F.col("end")) < F.col("end"))
    return both.where(base | ~touched).select("row", "kind", "start", "end")


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row."""
    rows = matched(docs)
    spans = secret_spans(docs, rows)
    each = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
    names = F.array(*[F.lit(k) for k in KINDS])
    out = rows.select("row", "doc_id").join(each, "row", "left").withColumn(
        "s", F.coalesce("s", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))

    def written(column: Column) -> Column:
        return F.array_join(F.transform(column, lambda x: F.concat_ws(
            ":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ",")

    counts = [F.expr(f"cast(size(filter(s, x -> x.kind = {k})) AS bigint)").alias(f"n_{BASE[k]}")
              for k in range(len(BASE))]
    base = F.filter("s", lambda x: x["kind"] < len(BASE))
    return out.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("s")).alias("spans"))


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret span of ``text`` replaced by ``mark``; touching spans get one mark."""
    columns = docs.columns
    rows = matched(docs)
    each = secret_spans(docs, rows).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))
    # rows of equal id and text have equal spans
    spans = rows.join(each, "row").groupBy("doc_id", "content").agg(F.first("s").alias("s"))
    spans = materialize(spans, "secret-cuts").withColumnsRenamed({"doc_id": "_id", "content": "_content", "s": "_s"})
    keyed = docs.withColumn("_key", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    out = keyed.join(spans, (F.col("_key") == F.col("_content")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), "left")
    # merged spans, then the text between them
    out = out.withColumn("_m", F.expr(
        "aggregate(slice(_s, 2, size(_s)), array(_s[0]), (m, x) -> CASE WHEN x.start <= element_at(m, -1).end"
        " THEN concat(slice(m, 1, size(m) - 1), array(named_struct('start', element_at(m, -1).start,"
        " 'end', greatest(element_at(m, -1).end, x.end)))) ELSE concat(m, array(x)) END)"))
    clean = F.expr(
        f"array_join(transform(sequence(0, size(_m)), i -> substring(text,"
        f" cast(CASE WHEN i = 0 THEN 1 ELSE _m[i - 1].end + 1 END AS int),"
        f" cast(CASE WHEN i = size(_m) THEN length(text) ELSE _m[i].start END"
        f" - CASE WHEN i = 0 THEN 0 ELSE _m[i - 1].end END AS int))), '{mark}')")
    return out.withColumn("text", F.when(F.col("_m").isNull(), F.col("text")).otherwise(clean)).select(*columns)
