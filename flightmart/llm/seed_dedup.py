"""Substring dedup by seed and extend (operator 12): repeated passages of words are cut.

Words are runs of bytes other than 0x20 and 0x09-0x0D, compared as they are. A word goes if a
window of ``WINDOW`` consecutive words of its document covers it whose words also start
earlier: in a document of smaller ``doc_id``, or earlier in the same one. Windows are judged on the
input; windows that overlap or touch each other count all the same.

1. Seeds. Every window keeps one anchor: the least hash among its ``SEED_WORDS``-grams, the
   leftmost of equals. Which one depends on the window's words alone, so equal windows have
   the same anchor at the same place, and about one word in seven begins an anchor.
2. Join. Anchors that occur once are dropped; a hot anchor is pre-aggregated by each task and its
   rows are dealt over ``SALTS`` tasks when they are joined back (:func:`join_groups`).
3. Extend. A match through an anchor can reach ``REACH`` words to both sides before another
   anchor takes over. Occurrences equal over that whole reach (one hash of all its words and their
   number, compared within one anchor) extend each other fully: all but the earliest are matched
   with that one. No pair of later copies is ever formed, so a group of n copies costs n rows.
4. Where an anchor's occurrences differ within reach, the earliest of each kind extend to the
   windows they still share: for every split of the reach between left and right, occurrences with equal
   words to both sides are matched with the earliest one.
5. Matches of one document with the same earlier document at the same distance that overlap or
   touch are one maximal repeat (:func:`repeats`). The words of all repeats are cut.

Two matched passages agree in two 64-bit hashes, the anchor's and that of the extension. Each step is
written, and its shuffle files go with it.

Edge cases: null text = empty text: no words. A text of fewer than WINDOW words keeps all. A null
``doc_id`` is later than all others. Rows that repeat a ``doc_id`` and its text are one document,
and all keep the same words; rows of one ``doc_id`` with other texts are each held against all,
where "earlier" goes by doc_id, then position (28 bits of a hash tell such texts apart). One word repeated a million times is one anchor
with many positions: still a row per word. A very long text is one Arrow row of its own, and its
matches (at most a few per anchor) meet it again in one task; no other group is ever gathered. An empty
table gives an empty table. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmart.llm.common import U, map_batches, mix, text_rows, utf8, word_hashes, word_spans, written
from flightmart.llm.fim import strings

WINDOW = 20
SEED_WORDS = 8
REACH = WINDOW - SEED_WORDS
SALTS = 16
HOT, HOT_LEAST = 4096, 64
TAG_BITS = 28
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Words:
    """Words of a batch of texts, with hashes of any run of them."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = utf8(texts)
        self.starts, self.ends = word_spans(self.data, self.offsets)
        self.bounds = np.searchsorted(self.starts, self.offsets)     # first word of each text
        self.lo, self.hi = self.bounds[:-1], self.bounds[1:]

    def hash_runs(self) -> None:
        """Prefix sums of a polynomial over all words of the batch."""
        words = word_hashes(self.data, self.starts, self.ends)
        n = len(words)
        self.back = np.ones(n + 1, U)
        self.back[1:] = np.cumprod(np.full(n, _INVERSE, U))
        power = np.ones(n, U)
        power[1:] = np.cumprod(np.full(max(0, n - 1), _BASE, U))[:max(0, n - 1)]
        self.sums = np.zeros(n + 1, U)
        np.cumsum(words * power, out=self.sums[1:])

    def run(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words from ``at`` to before ``end``; equal runs have equal hashes anywhere."""
        return mix((self.sums[end] - self.sums[at]) * self.back[at] + (end - at).astype(U))


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First words of the anchors of all windows (ascending), and the texts that hold them."""
    n = len(words.starts)
    grams = words.run(np.arange(max(0, n - SEED_WORDS + 1)), np.arange(SEED_WORDS, max(SEED_WORDS, n + 1)))
    text = np.repeat(np.arange(len(words.lo)), words.hi - words.lo)
    first = np.arange(max(0, n - WINDOW + 1))
    first = first[first + WINDOW <= words.hi[text[first]]]
    chosen = np.zeros(n, bool)
    step = 1 << 20
    for lo in range(0, len(first), step):
        at = first[lo:lo + step]
        least, where = grams[at], at.copy()
        for t in range(1, REACH + 1):
            other = grams[at + t]
            lower = other < least
            least = np.where(lower, other, least)
            where[lower] = at[lower] + t
        chosen[where] = True
    found = np.flatnonzero(chosen)
    return found, text[found]


def reach(words: Words, at: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words to the left of an anchor and to the right of it that a match through it can cover."""
    return np.minimum(at - words.lo[text], REACH), np.minimum(words.hi[text] - at - SEED_WORDS, REACH)


def occurrences(rows: DataFrame) -> DataFrame:
    """``id, place, anchor, context`` of every anchor; see :func:`_place`."""

    def run(batch: pa.RecordBatch) -> dict:
        words = Words(batch.column("text"))
        words.hash_runs()
        at, text = anchors(words)
        left, right = reach(words, at, text)
        context = mix(words.run(at - left, at + SEED_WORDS + right) + (left * (REACH + 1) + right).astype(U))
        where = pa.array(text)
        return {
            "id": batch.column("id").take(where),
            "place": _place(at - words.lo[text], np.asarray(batch.column("tag"))[text], right),
            "anchor": words.run(at, at + SEED_WORDS).view(np.int64), "context": context.view(np.int64),
        }

    return map_batches(rows, run, "id long, place long, anchor long, context long")


def _place(pos: np.ndarray, tag: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A position, its text's tag and the reach to the right in one word that sorts by position."""
    return (pos.astype(np.int64) << 32) | (tag << 4) | right


POS, TAG, RIGHT = "shiftright(place, 32)", f"(shiftright(place, 4) & {(1 << TAG_BITS) - 1}L)", "(place & 15L)"


def shared_windows(rows: DataFrame) -> DataFrame:
    """``id, place, anchor, window`` of every window through the anchors at ``at`` of a text."""

    def run(batch: pa.RecordBatch) -> dict:
        words = Words(batch.column("text"))
        words.hash_runs()
        lists = batch.column("at")
        text = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
        at = np.asarray(lists.flatten()).astype(np.int64) + words.lo[text]
        left, right = reach(words, at, text)
        anchor = words.run(at, at + SEED_WORDS)
        out = []
        for before in range(REACH + 1):
            ok = np.flatnonzero((left >= before) & (right >= REACH - before))
            start = at[ok] - before
            out.append((text[ok], start, anchor[ok], words.run(start, start + WINDOW)))
        text, start, anchor, window = (np.concatenate(c) for c in zip(*out, strict=True))
        tag = np.asarray(batch.column("tag"))[text]
        return {"id": batch.column("id").take(pa.array(text)),
                "place": _place(start - words.lo[text], tag, np.zeros(len(start), np.int64)),
                "anchor": anchor.view(np.int64), "window": window.view(np.int64)}

    return map_batches(rows, run, "id long, place long, anchor long, window long")


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], total: int) -> DataFrame:
    """``rows`` joined with their group (a written table with its size ``n``), hot groups over SALTS tasks.

    A group is hot beyond 1/HOT of all rows, so there are fewer than HOT of them: that list is broadcast.
    """
    hot = F.col("n") > max(total // HOT, HOT_LEAST)
    known = F.broadcast(groups.where(hot).select(*on, F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "place"), F.lit(SALTS)).cast("int")).otherwise(0)
    dealt = rows.join(known, on, "left").withColumn("salt", salt).drop("hot")
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(groups.withColumn("salt", F.explode(salts)).drop("n"), [*on, "salt"]).drop("salt")


def _later():
    """A place after the earliest one of its group (a repeated row's own place is not)."""
    return (F.col("id") > F.col("first.id")) | (
        (F.col("id") == F.col("first.id")) & (F.expr(POS) > F.shiftright("first.place", 32)))


def _keyed(docs: DataFrame) -> DataFrame:
    rows = text_rows(docs)
    return rows.select("doc_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"),
                       F.xxhash64("text").bitwiseAND(F.lit((1 << TAG_BITS) - 1)).alias("tag"), "text")


def matches(docs: DataFrame) -> DataFrame:
    """``id, tag, start, end, from_id, from_start``: passages of a document (numbers of words) that
    start earlier too, at ``from_start`` of ``from_id``; every repeated window lies in one of them."""
    rows = _keyed(docs).select("id", "tag", "text")
    found = written(occurrences(rows), "sd-anchors")
    total = found.count()
    repeated = written(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "sd-repeated")
    seeds = written(join_groups(found, repeated, ["anchor"], total), "sd-seeds")

    kinds = seeds.groupBy("anchor", "context").agg(F.min(F.struct("id", "place")).alias("first"), F.count("*").alias("n"))
    kinds = written(kinds, "sd-kinds")
    copies = kinds.where("n > 1")
    left = F.least(F.expr(POS), F.lit(REACH))
    full = join_groups(seeds, copies, ["anchor", "context"], total).where(_later()).select(
        "id", F.expr(TAG).alias("tag"), (F.expr(POS) - left).alias("start"),
        (F.expr(POS) + SEED_WORDS + F.expr(RIGHT)).alias("end"),
        F.col("first.id").alias("from_id"), (F.shiftright("first.place", 32) - left).alias("from_start"))
    full = written(full, "sd-full")

    # kinds of anchors that have several: what their occurrences still share lies in single windows
    several = kinds.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    firsts = kinds.select("anchor", "first.id", "first.place")
    several = written(several, "sd-several")
    at = join_groups(firsts, several, ["anchor"], total).groupBy("id", F.expr(TAG).alias("tag")).agg(
        F.collect_set(F.expr(POS)).alias("at"))
    windows = written(shared_windows(rows.join(written(at, "sd-at"), ["id", "tag"])), "sd-windows")
    earliest = windows.groupBy("anchor", "window").agg(
        F.min(F.struct("id", "place")).alias("first"), F.count("*").alias("n")).where("n > 1")
    partly = join_groups(windows, written(earliest, "sd-earliest"), ["anchor", "window"], total).where(_later()).select(
        "id", F.expr(TAG).alias("tag"), F.expr(POS).alias("start"), (F.expr(POS) + WINDOW).alias("end"),
        F.col("first.id").alias("from_id"), F.shiftright("first.place", 32).alias("from_start"))
    return full.unionByName(partly)


def _merged(spans: DataFrame) -> DataFrame:
    """The matches of one row as maximal repeats: sorted by source, distance and start, then merged."""

    def run(batch: pa.RecordBatch) -> dict:
        lists = batch.column("spans")
        flat = lists.flatten()
        row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
        start, end, source, at = (np.asarray(flat.field(i)).astype(np.int64) for i in range(4))
        shift = at - start
        order = np.lexsort((start, shift, source, row))
        row, start, end, source, shift = row[order], start[order], end[order], source[order], shift[order]
        new = np.ones(len(row), bool)
        if len(row) > 1:
            same = (row[1:] == row[:-1]) & (source[1:] == source[:-1]) & (shift[1:] == shift[:-1])
            # spans of one source and distance ascend, and each is at most 2 * REACH + SEED_WORDS words: the
            # furthest end so far is that of a running maximum within the group
            group = np.concatenate([[0], np.cumsum(~same)])
            far = np.maximum.accumulate(end + group * (int(end.max()) + 1)) - group * (int(end.max()) + 1)
            new[1:] = ~(same & (start[1:] <= far[:-1]))
            end = far
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1 if len(row) else first
        where = pa.array(row[first])
        return {"id": batch.column("id").take(where), "tag": batch.column("tag").take(where),
                "start": start[first], "end": end[last], "from_id": source[first], "from_start": start[first] + shift[first]}

    return map_batches(spans, run, "id long, tag long, start long, end long, from_id long, from_start long")


def repeats(docs: DataFrame) -> DataFrame:
    """Maximal repeats: ``id, tag, start, end, from_id, from_start``, in words.

    ``tag`` is a hash of the text, which tells rows of one doc_id apart; a null doc_id shows as the
    largest long.
    """
    spans = matches(docs).distinct().groupBy("id", "tag").agg(
        F.collect_list(F.struct("start", "end", "from_id", "from_start")).alias("spans"))
    return _merged(spans)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``, a row per row of ``docs``; ``kept`` holds the words that
    stay, joined by one space."""
    spans = matches(docs).select("id", "tag", "start", "end").distinct().groupBy("id", "tag").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = written(spans, "sd-spans")
    rows = _keyed(docs).join(spans, ["id", "tag"], "left").select("doc_id", "text", "spans")

    def run(batch: pa.RecordBatch) -> dict:
        words = Words(batch.column("text"))
        lists = batch.column("spans")
        flat = lists.flatten()
        sizes = np.where(np.asarray(lists.is_valid()), np.diff(np.asarray(lists.offsets)), 0)
        lo = np.repeat(words.lo, sizes)
        step = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(step, lo + np.asarray(flat.field(0)), 1)
        np.add.at(step, lo + np.asarray(flat.field(1)), -1)
        gone = np.cumsum(step[:-1]) > 0
        counted = np.zeros(len(gone) + 1, np.int64)
        np.cumsum(gone, out=counted[1:])
        kept, offsets = join_words(words, ~gone)
        return {"doc_id": batch.column("doc_id"), "n_words": words.hi - words.lo,
                "n_removed": counted[words.hi] - counted[words.lo], "kept": strings(kept, offsets)}

    return map_batches(rows, run, "doc_id long, n_words long, n_removed long, kept string")


def join_words(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of each text that are kept, joined by one space, as bytes and offsets."""
    kept = np.flatnonzero(keep)
    size = words.ends[kept] - words.starts[kept]
    text = np.searchsorted(words.bounds, kept, "right") - 1
    lead = np.ones(len(kept), bool)                  # first kept word of its text
    lead[1:] = text[1:] != text[:-1]
    total = size + ~lead
    out = np.full(int(total.sum()), 32, np.uint8)
    at = np.cumsum(total) - size                     # where each word goes
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at, size) + inside] = words.data[np.repeat(words.starts[kept], size) + inside]
    offsets = np.zeros(len(words.offsets), np.int64)
    np.cumsum(np.bincount(text, total, minlength=len(offsets) - 1).astype(np.int64), out=offsets[1:])
    return out, offsets


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# DuckDB SQL for ``digests`` over the table documents
ORACLE = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS MATERIALIZED (
  SELECT rid, id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h
  FROM (SELECT rid, id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)
), firsts AS MATERIALIZED (
  SELECT h, min((id, i)) AS f FROM windows GROUP BY h HAVING count(*) > 1
), hits AS MATERIALIZED (
  SELECT DISTINCT rid, i FROM windows JOIN firsts USING (h) WHERE (id, i) > f
), gone AS (
  SELECT DISTINCT rid, i + j AS k FROM hits, range(0, 20) AS t(j)
), words AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM docs
), kept AS (
  SELECT w.rid, count(g.k) AS n_removed, string_agg(CASE WHEN g.k IS NULL THEN w.word END, ' ' ORDER BY w.k) AS t
  FROM words w LEFT JOIN gone g ON g.rid = w.rid AND g.k = w.k GROUP BY w.rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""
