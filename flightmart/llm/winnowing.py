"""Document fingerprints (operator 2) by winnowing, with built-in functions only.

A text's tokens are its words ``[^\\x20\\x09-\\x0D]+`` in pieces of at most 16
code points, so that texts without spaces have many tokens too. Every K
consecutive tokens give a 64-bit hash (a shorter text: one hash of all its
tokens). Of every WINDOW consecutive hashes the least is chosen, the rightmost
on ties, and its position kept: any K + WINDOW - 1 tokens that two texts share
hold a common fingerprint, which are five, so short texts and edited ones share some. Hashes are compared by their upper 33 bits, then
position.

Window minima take log2(WINDOW) passes over a row's array: the minimum of 2w
hashes is that of the first w and the next w. There is no shuffle for it.

``next_documents`` puts each document beside its successor in descending doc_id
order with one shuffle: documents go to ranges of doc_id, and the first one of
each range is also copied to the end of the range above it.

Edge cases: null text = empty text: no tokens, an empty fingerprint. The likeness
of two fingerprints is the share of common hashes, 1 for two empty ones. Null
doc_ids come last in descending order; rows of equal doc_id follow each other by
text, the greater first. A table of one row is its own successor. Other columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flightmart.llm.common import text_rows

K = 2
WINDOW = 4           # a power of two
RANGE_ROWS = 4096
MAX_RANGES = 1 << 16  # bounds of ranges that the driver and the plan hold at most; beyond, ranges hold more rows
_PLACE = (1 << 31) - 1


def _grams(tokens: str) -> Column:
    """Hashes of every K tokens, from the array of the tokens' hashes."""
    args = ", ".join(f"{tokens}[i + {j}]" for j in range(K))
    return F.expr(
        f"CASE WHEN size({tokens}) = 0 THEN array()"
        f" WHEN size({tokens}) < {K} THEN array(xxhash64({tokens}))"
        f" ELSE transform(sequence(0, size({tokens}) - {K}), i -> xxhash64({args})) END").cast("array<long>")


def with_fingerprint(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """Adds ``{prefix}hashes`` (chosen hashes in text order) and ``{prefix}positions`` (of their first tokens)."""
    t, g, m = f"{prefix}_tokens", f"{prefix}_grams", f"{prefix}_least"
    keep = [c for c in df.columns]
    pieces = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]{1,16}"), F.lit(0))
    df = df.select("*", F.transform(pieces, lambda x: F.xxhash64(x)).alias(t))
    df = df.select(*keep, _grams(t).alias(g))
    # upper 33 bits of the hash, then the falling position
    df = df.select("*", F.expr(
        f"transform({g}, (x, i) -> (x & -{_PLACE + 1}) | ({_PLACE} - i))").alias(m))
    for s in (1 << p for p in range(int(math.log2(WINDOW)))):
        df = df.withColumn(m, F.expr(
            f"zip_with({m}, slice({m}, {s + 1}, greatest(size({m}) - {s}, 0)), (x, y) -> least(x, y))"))
    df = df.withColumn(m, F.expr(f"array_distinct(slice({m}, 1, greatest(size({m}) - {WINDOW - 1}, 1)))"))
    df = df.select(*keep, g, F.expr(f"transform({m}, x -> cast({_PLACE} - (x & {_PLACE}) as int))").alias(f"{prefix}positions"))
    hashes = F.expr(f"transform({prefix}positions, p -> {g}[p])").alias(f"{prefix}hashes")
    return df.select(*keep, hashes, f"{prefix}positions")


def likeness(a: str, b: str) -> Column:
    """Common hashes over all hashes of two fingerprints; 1 if both are empty."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either).cast("double")


def as_text(hashes: str) -> Column:
    """A fingerprint as a string: its hashes in hexadecimal, in text order."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), " ")


def next_documents(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_{column}`` of the next document in descending doc_id order (after
    the last one: the first)."""
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    docs = docs.withColumn("_key", key)
    # numbers only: bounds of about RANGE_ROWS documents each
    rows, top = docs.agg(F.count("*"), F.max("_key")).first()
    ranges = min(max(1, math.ceil(rows / RANGE_ROWS)), MAX_RANGES)
    bounds: list[int] = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        accuracy = max(10_000, 4 * ranges)
        bounds = sorted(set(docs.agg(F.percentile_approx("_key", shares, accuracy)).first()[0]))
    # the bounds of every 64th range first, then those within
    blocks = [bounds[i:i + 64] for i in range(0, len(bounds), 64)]
    if blocks:
        table = F.array(*[F.array(*map(F.lit, b)) for b in blocks]).cast("array<array<long>>")
        heads = F.array(*[F.lit(b[-1]) for b in blocks]).cast("array<long>")
        docs = docs.withColumn("_block", F.size(F.filter(heads, lambda b: b < F.col("_key"))))
        within = F.coalesce(F.get(table, F.col("_block")), F.array().cast("array<long>"))
        place = F.size(F.filter(within, lambda b: b < F.col("_key")))
        docs = docs.withColumn("_range", F.col("_block") * 64 + place)
        is_bound = F.exists(within, lambda b: b == F.col("_key"))
        # the range above the last bound of a block is the first one of the next block
        higher = F.when(F.element_at(within, -1) == F.col("_key"), (F.col("_block") + 1) * 64).otherwise(
            F.col("_range") + 1)
    else:
        docs = docs.withColumn("_range", F.lit(0))
        is_bound, higher = F.lit(False), F.lit(0)
    # the greatest document of a range succeeds the least one of the range above; the greatest of all succeeds the least
    here = F.struct(F.col("_range").alias("range"), F.lit(0).alias("copy"))
    above = F.when(is_bound, F.struct(higher.alias("range"), F.lit(1).alias("copy")))
    around = F.when(F.col("_key") == F.lit(top).cast("long"), F.struct(F.lit(0).alias("range"), F.lit(2).alias("copy")))
    placed = docs.withColumn("_at", F.explode(F.filter(F.array(here, above, around), lambda x: x.isNotNull())))
    placed = placed.select("*", "_at.range", "_at.copy").drop("_at", "_block", "_range")
    order = W.partitionBy("range").orderBy(F.col("copy") == 2, F.desc("_key"), F.desc("text"), "copy")
    placed = placed.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return placed.where("copy = 0").drop("range", "copy", "_key")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, positions``."""
    rows = text_rows(docs).withColumn("n_chars", F.length("text").cast("long"))
    rows = with_fingerprint(rows, "text").withColumnsRenamed({"hashes": "own", "positions": "own_positions"})
    rows = next_documents(rows, ["text", "own"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                      F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", "n_chars", "own", "own_positions", "next_own", edited.alias("edited"))
    rows = with_fingerprint(rows, "edited")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text("own").alias("fingerprint"),
        as_text("hashes").alias("edited_fingerprint"), likeness("own", "hashes").alias("near_edited"),
        likeness("own", "next_own").alias("near_next"), F.col("own_positions").alias("positions"))
