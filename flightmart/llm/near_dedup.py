"""MinHash near-duplicate grouping (operator 3): SuperMinHash, banding, verification, union-find.

A document's set holds its distinct shingles of five words (A-Z lower-cased,
words are runs of bytes other than 0x20 and 0x09-0x0D); with fewer words the
whole sequence is the one shingle; without words the set is empty. Documents
are linked if 100 * |intersection| >= 75 * |union|, checked on the full sets.

1. Documents of equal sets form a class (128-bit digest of the sorted set);
   everything after works on classes, so exact copies cost one row each.
2. SuperMinHash gives each class 128 correlated minima. 32 bands of 4 rows
   make the candidate buckets: a pair at similarity 0.75 shares no bucket with
   a probability of 5e-6, at 0.85 of 6e-11.
3. The class that shares most buckets is the hub of a bucket. Each class is compared with one hub, the
   best of its buckets, and union-find joins the links. Copies of one text mostly end up in one
   component here, and pairs within a component are not looked at again.
4. Where a bucket's classes then still lie in several components, an exact prefix filter finds every
   pair that can be similar. Shingles are put in order by the number of open classes that hold
   them, rarest first. Sets of n and n' shingles that are similar share at least
   c = 75 (n + n') / 175, so the first shingle they share has c - 1 others behind it in both; the smaller set is indexed
   by its first n - 75 * 2n / 175 shingles, the larger one probes with those that leave enough for
   some partner of 75 to 100 % of its size. Keys are (shingle, size class). A key's classes of
   its most frequent component meet only those of others, so the many copies of one component aren't paired.
5. Pairs are verified on the whole sets and joined by union-find again. No cap is set anywhere.

Edge cases: null text = empty text: no shingles, its own component, kept. A
null ``doc_id`` takes part; the component id is the smallest non-null id
(null if there is none) and a row is kept if its id equals it, nulls included.
Repeated rows have equal sets, so they share a component and all rows of the
smallest id are kept. Other columns of the input are never read.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmart.llm.common import (
    U, ascii_lower, hot_join, map_batches, mix, text_rows, utf8, word_hashes, word_spans, written,
)
from flightmart.llm.graph import components

WORDS = 5
SIMILARITY = (75, 100)
BANDS, ROWS = 32, 4
ELEMENTS = 1 << 16  # shingles whose permutations are held at a time
SIZES = 8           # size classes per doubling of a set's size
_GOLDEN = 0x9E3779B97F4A7C15


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, offsets = utf8(texts)
    starts, ends = word_spans(data, offsets)
    hashes = word_hashes(ascii_lower(data), starts, ends)
    bounds = np.searchsorted(starts, offsets)
    out = []
    rolled = np.zeros(max(0, len(hashes) - words + 1), U)
    for j in range(words):
        rolled += mix(hashes[j:j + len(rolled)] + U(j + 1)) if len(rolled) else rolled
    rolled = mix(rolled)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= words:
            out.append(np.unique(rolled[lo:hi - words + 1]))
        elif hi > lo:
            short = mix(hashes[lo:hi] + np.arange(100, 100 + hi - lo, dtype=U))
            out.append(mix(short.sum(keepdims=True) + U(hi - lo)))
        else:
            out.append(np.empty(0, U))
    return out


def super_minhash(sets: list[np.ndarray], size: int) -> np.ndarray:
    """SuperMinHash signatures of any number of sets, ELEMENTS at a time (or one larger set)."""
    out, lo, held = [np.empty((0, size), U)], 0, 0
    for i, s in enumerate(sets):
        if i > lo and held + len(s) > ELEMENTS:
            out.append(_super_minhash(sets[lo:i], size))
            lo, held = i, 0
        held += len(s)
    return np.concatenate([*out, _super_minhash(sets[lo:], size)])


def _super_minhash(sets: list[np.ndarray], size: int) -> np.ndarray:
    """SuperMinHash signatures (``len(sets)`` x ``size``, one 64-bit word per slot).

    Element x draws, for j = 0, 1, ..., a random number in [j, j + 1) for the
    slot at place j of its own random permutation (Fisher-Yates, one swap a
    step), and each slot keeps the least number. All elements of a batch take
    step j together; a document stops as soon as all its slots hold numbers
    below j + 1, as later steps can't lower any. A number is stored as j in
    the high and the fraction in the low 32 bits.
    """
    n = len(sets)
    sig = np.full((n, size), np.iinfo(U).max, U)
    lengths = np.array([len(s) for s in sets])
    doc = np.repeat(np.arange(n), lengths)
    x = np.concatenate(sets) if n and len(doc) else np.empty(0, U)
    perm = None
    with np.errstate(over="ignore"):
        for j in range(size):
            if not len(x):
                break
            z = mix(x + U((j + 1) * _GOLDEN & (2**64 - 1)))
            place = j + (((z & U(0xFFFFFFFF)) * U(size - j)) >> U(32)).astype(np.int64)
            value = (U(j) << U(32)) | (z >> U(32))
            if perm is None:
                slot = place
            else:
                rows = np.arange(len(x))
                slot = perm[rows, place].astype(np.int64)
                perm[rows, place] = perm[rows, j]
                perm[rows, j] = slot
            np.minimum.at(sig.reshape(-1), doc * size + slot, value)
            if j + 1 == size:
                break
            open_docs = (sig >= (U(j + 1) << U(32))).any(axis=1)
            stay = open_docs[doc]
            if not stay.all():
                x, doc, place = x[stay], doc[stay], place[stay]
                perm = perm[stay] if perm is not None else None
            if perm is None:
                perm = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), (len(x), 1))
                rows = np.arange(len(x))
                perm[rows, place] = 0
                perm[rows, 0] = place
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of the key."""
    key = np.tile(mix(np.arange(1, bands + 1, dtype=U)), (len(sig), 1))
    for r in range(rows):
        key = mix(key ^ sig[:, r:bands * rows:rows]) * U(_GOLDEN)
    return key.view(np.int64)


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, content, n_shingles, digest, bands``: a hash of the text, the set's size, its
    128-bit digest and its band keys."""

    def run(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(batch.column("text"))
        keys = band_keys(super_minhash(sets, bands * rows), bands, rows)
        return {
            "doc_id": batch.column("doc_id"),
            "content": batch.column("content"),
            "n_shingles": np.array([len(s) for s in sets], np.int64),
            "digest": [hashlib.md5(s.tobytes()).digest() for s in sets],
            "bands": pa.ListArray.from_arrays(
                np.arange(len(sets) + 1, dtype=np.int32) * bands, pa.array(keys.reshape(-1))),
        }

    source = text_rows(docs).withColumn("content", F.xxhash64("text"))
    return map_batches(
        source, run, "doc_id long, content long, n_shingles long, digest binary, bands array<long>")


def shingle_table(texts: DataFrame) -> DataFrame:
    """``cid, n, shingles`` of the classes of ``texts(cid, text)``; the set as 64-bit hashes, ascending."""

    def run(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(batch.column("text"))
        sizes = np.array([len(s) for s in sets], np.int64)
        offsets = np.zeros(len(sets) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        return {"cid": batch.column("cid"), "n": sizes,
                "shingles": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets).view(np.int64)))}

    return map_batches(texts, run, "cid long, n long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose whole sets are similar enough."""
    num, den = SIMILARITY

    def run(batch: pa.RecordBatch) -> dict:
        def arrays(column: pa.Array) -> list[np.ndarray]:
            return np.split(np.asarray(column.flatten()), np.asarray(column.offsets)[1:-1] - column.offsets[0].as_py())

        left, right = arrays(batch.column("set_a")), arrays(batch.column("set_b"))
        common = np.array([np.intersect1d(s, t, assume_unique=True).size for s, t in zip(left, right, strict=True)])
        either = np.array([len(s) + len(t) for s, t in zip(left, right, strict=True)]) - common
        hit = pa.array(np.flatnonzero(den * common >= num * either))
        return {"a": batch.column("a").take(hit), "b": batch.column("b").take(hit)}

    pairs, total = pairs.select("a", "b"), 2 * pairs.count()
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count("*").alias("n"))
    ends = written(ends, "nd-ends")
    sets = sets.join(ends.select("cid"), "cid", "left_semi")
    for end in ("a", "b"):    # a hub is in many pairs
        found = sets.select(F.col("cid").alias(end), F.col("shingles").alias(f"set_{end}"))
        pairs = hot_join(pairs, found, [end], ends.withColumnRenamed("cid", end), total, ["a", "b"])
    return map_batches(pairs, run, "a long, b long")


def hub_pairs(members: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """``a, b``: every class with the best hub of its buckets (a row a class at most)."""
    hubs = members.groupBy("key").agg(F.max(F.struct("score", "cid")).alias("hub"))
    met = hot_join(members.select("key", "cid"), hubs, ["key"], sizes, total, ["cid"])
    best = met.where(F.col("hub.cid") != F.col("cid")).groupBy("cid").agg(F.max("hub").alias("hub"))
    return best.select(F.least("cid", "hub.cid").alias("a"), F.greatest("cid", "hub.cid").alias("b")).distinct()


def open_classes(members: DataFrame, roots: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """``cid, root`` of the classes in buckets that hold several components."""
    rows = members.select("key", "cid").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    rows = written(rows.withColumn("root", F.coalesce("root", "cid")), "nd-rows")
    several = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    return hot_join(rows, several, ["key"], sizes, total, ["cid"]).select("cid", "root").distinct()


def _least_common(n: str, m: str) -> str:
    """The least number of shared shingles at which sets of n and m are similar."""
    num, den = SIMILARITY
    return f"ceil({num} * ({n} + {m}) / {num + den})"


def prefix_rows(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``shingle, size, probe, cid, root, n, pos``: the prefixes of all open classes, by shingle and size class."""
    num, den = SIMILARITY
    owned = classes.join(sets, "cid").select("cid", "root", F.col("n").alias("of"), F.explode("shingles").alias("shingle"))
    held = written(owned.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "nd-held")
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranked = hot_join(owned, held.withColumnRenamed("n", "df"), ["shingle"], held, total, ["cid"])
    # shingles of one class alone come first; they match nothing, so only their number counts
    lists = ranked.groupBy("cid").agg(F.first("root").alias("root"), F.first("of").alias("n"),
                                      F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("s"))
    lists = lists.withColumn("alone", F.col("n") - F.size("s"))
    reach = F.col("n") - F.ceil(F.lit(num) * F.col("n") / den) + 1 - F.col("alone")
    rows = lists.where(reach > 0).select("cid", "root", "n", "alone", F.posexplode(F.slice("s", F.lit(1), reach.cast("int"))))
    rows = rows.select("cid", "root", "n", (F.col("alone") + F.col("pos")).alias("pos"), F.col("col.shingle").alias("shingle"))

    def size(n: str) -> str:
        return f"cast(floor({SIZES} * log2({n})) as int)"

    index = rows.where(F.expr(f"n - pos >= {_least_common('n', 'n')}")).withColumn("size", F.expr(size("n")))
    # partners of lo to hi shingles leave enough behind this one
    spans = rows.withColumn("lo", F.expr(f"ceil({num} * n / {den})")).withColumn(
        "hi", F.expr(f"least(n, floor((n - pos) * {num + den} / {num}) - n)")).where("hi >= lo")
    probe = spans.withColumn("size", F.explode(F.expr(f"sequence({size('lo')}, {size('hi')})"))).drop("lo", "hi")
    index, probe = index.withColumn("probe", F.lit(False)), probe.withColumn("probe", F.lit(True))
    return index.unionByName(probe)


def prefix_pairs(rows: DataFrame) -> DataFrame:
    """``a, b``: the pairs of classes of different components that their prefixes leave possible."""
    on = ["shingle", "size"]
    parts = rows.groupBy(*on, "root").agg(F.count("*").alias("n"), F.count_if("probe").alias("probes"))
    keys = parts.groupBy(*on).agg(F.max_by("root", F.struct("n", "root")).alias("major"), F.sum("n").alias("n"),
                                  F.sum("probes").alias("probes"), F.count("*").alias("roots"))
    keys = written(keys.where("roots > 1 and probes > 0 and probes < n").select(*on, "major", "n"), "nd-keys")
    sizes, total = keys.select(*on, "n"), rows.count()
    live = hot_join(rows, keys.drop("n"), on, sizes, total, ["cid"]).withColumn("minor", F.col("root") != F.col("major"))
    live = written(live.drop("major"), "nd-live")
    names = ["cid", "root", "n", "pos"]
    out = []
    # one of two classes of different components is not of the key's most frequent one
    for index, probe in (("minor", "true"), ("not minor", "minor")):
        x = live.where(f"not probe and ({index})").select(*on, *[F.col(c).alias(f"x_{c}") for c in names])
        y = live.where(f"probe and ({probe})").select(*on, *[F.col(c).alias(f"y_{c}") for c in names])
        many, few, by = (y, x, "y_cid") if index == "minor" else (x, y, "x_cid")
        met = hot_join(many, few, on, sizes, total, [by])
        least = _least_common("x_n", "y_n")
        met = met.where(F.expr(f"x_root <> y_root and (x_n < y_n or (x_n = y_n and x_cid < y_cid)) "
                               f"and x_n - x_pos >= {least} and y_n - y_pos >= {least}"))
        out.append(met.select(F.least("x_cid", "y_cid").alias("a"), F.greatest("x_cid", "y_cid").alias("b")))
    return out[0].unionByName(out[1]).distinct()


def links_between(members: DataFrame, sizes: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, root`` of every linked class of ``members(key, cid, score)``; ``sizes`` of the buckets."""
    total = members.count()
    links = written(verified(written(hub_pairs(members, sizes, total), "nd-pairs"), sets), "nd-links")
    classes = written(open_classes(members, components(links), sizes, total), "nd-classes-open")
    pairs = prefix_pairs(written(prefix_rows(classes, sets), "nd-prefixes"))
    more = written(verified(written(pairs, "nd-pairs"), sets), "nd-links")
    return components(links.unionByName(more))


def _known(column: str):
    return F.coalesce(F.col(column), F.lit((1 << 63) - 1))


def grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, content``, one row per row of ``docs``; ``content`` is
    the xxhash64 of the text, which tells rows of one doc_id apart."""
    sig = written(signatures(docs), "nd-sig")
    classes = sig.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("label"), F.min(F.struct(_known("doc_id").alias("id"), "content")).alias("text_of"),
        F.first("bands").alias("bands"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "nd-classes")

    rows = classes.select("cid", F.explode("bands").alias("key"))
    shared = written(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "nd-shared")
    n_classes = classes.count()
    buckets = hot_join(rows, shared.withColumnRenamed("n", "size"), ["key"], shared, n_classes * BANDS, ["cid"])
    # at most BANDS keys a class
    scored = buckets.groupBy("cid").agg(F.sum("size").alias("score"), F.collect_list("key").alias("keys"))
    scored = written(scored, "nd-members")
    members = scored.select("cid", "score", F.explode("keys").alias("key"))

    # a class's text by id and hash, as ids may be null or repeat with other texts
    needed = scored.select("cid").join(classes.select("cid", "text_of.*"), "cid")
    source = text_rows(docs).select(_known("doc_id").alias("id"), F.xxhash64("text").alias("content"), "text")
    texts = source.join(needed, ["id", "content"]).groupBy("cid").agg(F.first("text").alias("text"))
    roots = links_between(members, shared, written(shingle_table(texts), "nd-sets"))

    labels = classes.select("cid", "digest", "label").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    labels = written(labels.withColumn("root", F.coalesce("root", "cid")), "nd-labels")
    least = labels.groupBy("root").agg(F.min("label").alias("component_id"), F.count("*").alias("n"))
    least = written(least, "nd-least")
    groups = hot_join(labels, least.drop("n"), ["root"], least.select("root", "n"), n_classes, ["cid"])
    groups = groups.select("digest", "component_id")
    sizes = classes.select("digest", F.col("copies").alias("n"))
    out = sig.select("doc_id", "content", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
    out = hot_join(out, groups, ["digest"], sizes, sig.count(), ["doc_id", "content"], "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "content")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``."""
    return grouped(docs).drop("content")


# DuckDB SQL for ``near_duplicates`` over the table documents
ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT rid, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM docs
), sizes AS (
  SELECT rid, count(*) AS n FROM shingles GROUP BY rid
), common AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * k >= 75 * (x.n + y.n - k)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT rid AS a, rid AS b FROM docs UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), least AS (
  SELECT r.a AS rid, min(d.doc_id) AS component_id FROM reach r JOIN docs d ON d.rid = r.b GROUP BY r.a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs JOIN least USING (rid) LEFT JOIN sizes USING (rid)
"""
