"""Exact substring dedup (operator 6): suffix arrays per shard, Kasai prefixes, merging by binary search.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier
(in a document of a smaller doc_id, or earlier in the same one) is removed. Texts
are UTF-8 bytes, matches stay within documents, and strings are judged on the input.

A suffix array over all bytes would shuffle every suffix. Here each window of
LENGTH bytes is owned by one *anchor*: the K-gram with the least hash among the
window's K-grams (the rightmost on ties). Equal windows have equal anchors at
equal places, so a string can only repeat if its anchor does. The starts that an
anchor owns are consecutive; with the LENGTH - 1 bytes after them they form a
*segment*, and every window lies in exactly one.

1. Every segment is reduced to its anchor, a digest of its bytes and its place,
   and dealt out by anchor. Of equal segments the earliest stands for all;
   every start of the others is removed. Anchors that are frequent in a
   sample (a bounded list) are dealt to several tasks each, whose earliest
   segments then meet once more, so a passage that a third of all documents
   share does not fall on one task.
2. Anchors with several different segments (the edges of shared passages) go
   with their bytes to shards by anchor. A shard of about SHARD bytes gets a
   suffix array by Larsson-Sadakane refinement and common prefixes by Kasai's
   recurrence; starts that share LENGTH bytes form a run, whose earliest
   stays. Where an anchor's segments reach over several shards, the windows of
   later shards are looked up in, and merged into, the sorted windows of earlier
   ones by binary search. Anchors with more than HOT different segments are
   dealt out by a digest of each window instead, so that neither a shard nor a
   task holds an unbounded anchor.
3. Removed starts return to their documents, which are cut.

Edge cases: null text = empty text: nothing to remove. Texts of fewer than
LENGTH bytes are never cut. Rows that repeat a doc_id and its text count as that
one document: a string they share at the same place is not earlier, and all of them
get the same cuts. Rows of one doc_id with other texts are documents of their own,
in the order of a hash of the text (their ``version``), so one copy of a string
always stays. A null doc_id sorts before all others. Other columns are ignored.
Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmart.llm.common import (
    U, arrow_schema, kgram_hashes, map_batches, materialize, mix, text_rows, to_batch, utf8,
)

LENGTH = 100
K = 32
SHARD = 4 << 20
HOT = 2000
SAMPLE_ONE_IN = 64
FREQUENT = 50_000
PART_ROWS = 10_000
LOW12 = U(4095)
NULL_ID = -(1 << 63)
KEY = ["doc_id", "version"]
_MAX = np.iinfo(U).max


def owners(data: np.ndarray, offsets: np.ndarray, length: int, k: int):
    """``(text, first, count, anchor, digest)`` of every segment of a batch of texts.

    ``first`` is the first owned start (in ``data``), ``count`` how many starts
    are owned, ``anchor`` the hash of the owning K-gram and ``digest`` a hash of
    all the segment's bytes (from the hashes of the K-grams that tile it).
    """
    starts = len(data) - length + 1
    if starts <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, U), np.empty(0, U)
    window = length - k + 1
    hashes = mix(kgram_hashes(data, k))
    # high bits: hash; low 20 bits: falling place within blocks, so that the
    # least value is the least hash and, on ties, the rightmost place
    low = U((1 << 20) - 1)
    places = np.arange(len(hashes), dtype=np.int64)
    out = np.empty(starts, np.int64)
    for lo in range(0, starts, (1 << 20) - window):
        hi = min(starts, lo + (1 << 20) - window)
        part = (hashes[lo:hi + window - 1] & ~low) | (low - (places[lo:hi + window - 1] - lo).astype(U))
        rows = np.concatenate([part, np.full(-len(part) % window, _MAX, U)]).reshape(-1, window)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()[window - 1:window - 1 + hi - lo]
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()[:hi - lo]
        out[lo:hi] = lo + (low - (np.minimum(ahead, behind) & low)).astype(np.int64)
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes)), sizes)[:starts]
    inside = np.flatnonzero(np.arange(starts) + length <= offsets[text + 1])
    if not len(inside):
        return owners(data[:0], offsets[:1], length, k)
    owner, text = out[inside], text[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    first, count = inside[at], np.diff(np.append(at, len(inside)))
    last = first + count - 1 + length - k  # the K-gram that ends the segment
    digest = mix(hashes[last] + count.astype(U))
    for step in range(0, window + length - k, k):
        digest = mix(digest ^ hashes[np.minimum(first + step, last)]) + U(step)
    return text[at], first, count, hashes[owner[at]], digest


def segment_rows(docs: DataFrame, frequent: np.ndarray, spread: np.ndarray) -> DataFrame:
    """``anchor, code, doc_id, version, first`` of every segment of ``docs(doc_id, version, text)``.

    ``anchor`` keeps 52 bits of the hash; its low 12 bits are 0, or, for one
    of the ``frequent`` anchors, a part from 1 to its ``spread`` taken from the
    document. ``code`` is a digest of the segment's bytes with the number of
    owned starts in its low 7 bits.
    """
    shared = docs.sparkSession.sparkContext.broadcast((frequent, spread))  # at most FREQUENT numbers

    def run(batch: pa.RecordBatch) -> dict:
        often, parts = shared.value
        ids, versions = batch.column("doc_id").to_numpy(), batch.column("version").to_numpy()
        out = [[], [], [], [], []]
        for lo, hi, data, offsets in chunks(batch.column("text")):
            text, first, count, anchor, digest = owners(data, offsets, LENGTH, K)
            doc, version = ids[lo:hi][text], versions[lo:hi][text]
            anchor = (anchor & ~LOW12).view(np.int64)
            if len(often):
                at = np.minimum(np.searchsorted(often, anchor), len(often) - 1)
                part = 1 + (mix(doc.view(U) ^ version.view(U)) % parts[at].astype(U)).astype(np.int64)
                anchor = anchor | np.where(often[at] == anchor, part, 0)
            code = (digest & ~U(127)) | count.astype(U)
            for column, values in zip(out, (anchor, code.view(np.int64), doc, version, first - offsets[text]), strict=True):
                column.append(values)
        anchor, code, doc, version, first = (np.concatenate(c) if c else np.empty(0, np.int64) for c in out)
        return {"anchor": anchor, "code": code, "doc_id": doc, "version": version, "first": first}

    return map_batches(docs, run, "anchor long, code long, doc_id long, version long, first long")


def chunks(texts: pa.Array, size: int = 1 << 20):
    """Runs of whole texts of about ``size`` bytes: ``(from, to, data, offsets)``."""
    data, offsets = utf8(texts)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def frequent_anchors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted anchors that a sample of one in SAMPLE_ONE_IN documents holds often, at most FREQUENT
    of them, and into how many parts each is dealt (up to 4095)."""
    none = np.empty(0, np.int64)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_ONE_IN)) == 0)
    rows = segment_rows(sample, none, none).groupBy("anchor").agg(F.count("*").alias("n")).where(
        F.col("n") * SAMPLE_ONE_IN > PART_ROWS)
    top = rows.orderBy(F.desc("n"), "anchor").limit(FREQUENT).collect()
    top.sort(key=lambda r: r.anchor)
    spread = [min(4095, r.n * SAMPLE_ONE_IN // PART_ROWS + 1) for r in top]
    return np.array([r.anchor for r in top], np.int64), np.array(spread, np.int64)


def same_segments(rows: DataFrame) -> DataFrame:
    """``anchor, code, doc_id, version, first, kind`` of rows sorted by anchor, code, document and start:
    kind 0 equals an earlier segment of its anchor; kind 1 is the first of its
    kind while its anchor has others; the rest (segments alone) is dropped. Parts of
    frequent anchors give kind 2 instead of 1, also for segments alone."""
    schema = "anchor long, code long, doc_id long, version long, first long, kind int"
    target = arrow_schema(schema)

    def decide(anchor, code, doc, version, first):
        new_anchor = np.ones(len(anchor), bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new_code = new_anchor.copy()
        new_code[1:] |= code[1:] != code[:-1]
        group = np.cumsum(new_anchor) - 1
        several = np.bincount(group, weights=new_code)[group] > 1
        part = (anchor & 4095) > 0
        kind = np.where(~new_code, 0, np.where(part, 2, np.where(several, 1, -1))).astype(np.int32)
        at = np.flatnonzero(kind >= 0)
        return to_batch({"anchor": anchor[at], "code": code[at], "doc_id": doc[at], "version": version[at],
                         "first": first[at], "kind": kind[at]}, target)

    def run(batches):
        held = None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("anchor", "code", "doc_id", "version", "first")]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            # the last anchor may go on in the next batch
            cut = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
            held = [c[cut:] for c in columns]
            if cut:
                yield decide(*[c[:cut] for c in columns])
        if held is not None and len(held[0]):
            yield decide(*held)

    return rows.mapInArrow(run, schema)


def suffix_order(data: np.ndarray) -> np.ndarray:
    """The suffix array of ``data``, by Larsson-Sadakane refinement.

    Suffixes are ranked by their first 7 bytes (the end sorts first); then,
    doubling the depth h, each group of equal rank is sorted by the rank h places
    on. Groups of one suffix are final and drop out of further rounds. The order
    must be complete: common prefixes are carried on from suffix to suffix.
    """
    n = len(data)
    padded = np.concatenate([data.astype(U) + U(1), np.zeros(7, U)])
    key = np.zeros(n, U)
    for j in range(7):
        key = (key << U(9)) | padded[j:j + n]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = key[order][1:] != key[order][:-1]
    head = np.flatnonzero(new)
    rank[order] = np.repeat(head, np.diff(np.append(head, n)))
    h = 7
    while True:
        sizes = np.diff(np.append(head, n))
        open_at = np.flatnonzero(np.repeat(sizes > 1, sizes))  # places of unsorted groups
        if not len(open_at):
            break
        suffix = order[open_at]
        group = rank[suffix]
        ahead = suffix + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(group * (n + 1) + second, kind="stable")
        suffix, group, second = suffix[by], group[by], second[by]
        order[open_at] = suffix
        first = np.ones(len(by), bool)
        first[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        new[open_at] = first
        head = np.flatnonzero(new)
        starts = open_at[first]
        rank[suffix] = np.repeat(starts, np.diff(np.append(np.flatnonzero(first), len(by))))
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, bounds: np.ndarray, limit: int) -> np.ndarray:
    """Bytes (up to ``limit``) each suffix shares with its predecessor in ``order``.

    Kasai: the suffix one place on shares at least one byte less. All segments
    (``bounds``) walk their suffixes together, each carrying its own length.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(limit + 1, np.uint8)])
    shared = np.zeros(n, np.int64)
    lengths = np.diff(bounds)
    carry = np.zeros(len(lengths), np.int64)
    lanes = np.argsort(-lengths, kind="stable")
    sizes = lengths[lanes]
    for t in range(int(lengths.max(initial=0))):
        lanes = lanes[:np.searchsorted(-sizes, -t, side="left")] if sizes[-1] <= t else lanes
        sizes = sizes[:len(lanes)]
        here = bounds[lanes] + t
        other = before[here]
        h = np.where(other >= 0, np.maximum(carry[lanes] - 1, 0), 0)
        room = np.minimum(n - here, n - np.maximum(other, 0))
        go = np.flatnonzero(other >= 0)
        while len(go):
            same = (h[go] < limit) & (h[go] < room[go])
            same &= padded[here[go] + h[go]] == padded[other[go] + h[go]]
            go = go[same]
            h[go] += 1
        carry[lanes] = h
        shared[here] = h
    return shared


def repeats_in_shard(data: np.ndarray, bounds: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(removed, order)`` over the owned starts of a shard's segments, given in document order:
    whether an equal window precedes, and the starts' places in window order."""
    order = suffix_order(data)
    shared = common_prefixes(data, order, bounds, length)
    run = np.empty(len(data), np.int64)
    run[order] = np.cumsum(shared[order] < length)
    lane = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    start = bounds[lane] + inside
    by = np.argsort(run[start], kind="stable")
    removed = np.zeros(len(start), bool)
    ordered = run[start][by]
    removed[by[1:]] = ordered[1:] == ordered[:-1]
    return removed, by


def _windows(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The windows at ``starts`` as fixed-width byte strings (a trailing mark keeps zero bytes)."""
    rows = np.empty((len(starts), length + 1), np.uint8)
    rows[:, :length] = data[starts[:, None] + np.arange(length)]
    rows[:, length] = 1
    return rows.view(f"S{length + 1}").ravel()


class ShardMerger:
    """Resolves segments that arrive sorted by anchor, document and start, shard by shard."""

    def __init__(self, length: int):
        self.length = length
        self.anchor = None  # the anchor open at the end of the last shard
        self.sorted = np.empty(0, f"S{length + 1}")  # its distinct windows so far

    def shard(self, anchor: np.ndarray, data: np.ndarray, bounds: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Per owned start: is an equal window earlier in this or a former shard?"""
        removed, _ = repeats_in_shard(data, bounds, counts, self.length)
        first = np.cumsum(counts) - counts
        owner = np.repeat(anchor, counts)
        starts = np.repeat(bounds[:-1] - first, counts) + np.arange(len(owner))
        if self.anchor is not None and len(self.sorted):
            at = np.flatnonzero((owner == self.anchor) & ~removed)
            if len(at):
                mine = _windows(data, starts[at], self.length)
                place = np.minimum(np.searchsorted(self.sorted, mine), len(self.sorted) - 1)
                removed[at[self.sorted[place] == mine]] = True
        last = anchor[-1]
        if last != self.anchor:
            self.anchor, self.sorted = last, self.sorted[:0]
        at = np.flatnonzero((owner == last) & ~removed)
        fresh = np.sort(_windows(data, starts[at], self.length))
        merged = np.insert(self.sorted, np.searchsorted(self.sorted, fresh), fresh)
        self.sorted = merged
        return removed


def resolved(edges: DataFrame) -> DataFrame:
    """``doc_id, version, first, count`` runs of removed starts of
    ``edges(anchor, doc_id, version, first, count, bytes)``.

    Rows come sorted by anchor, document and start within a partition.
    """
    schema = "doc_id long, version long, first long, count int"
    target = arrow_schema(schema)

    def flush(merger: ShardMerger, rows: list[pa.RecordBatch]):
        batch = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        data, bounds = utf8(batch.column("bytes"))
        counts = batch.column("count").to_numpy().astype(np.int64)
        removed = merger.shard(batch.column("anchor").to_numpy(), data, bounds, counts)
        lane = np.repeat(np.arange(len(counts)), counts)
        inside = np.arange(len(lane)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.flatnonzero(removed)
        if not len(at):
            return None
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(lane[at]) > 0)
        head = np.flatnonzero(new)
        seg = lane[at[head]]
        return to_batch({
            "doc_id": batch.column("doc_id").take(pa.array(seg)),
            "version": batch.column("version").take(pa.array(seg)),
            "first": batch.column("first").to_numpy()[seg] + inside[at[head]],
            "count": np.diff(np.append(head, len(at))).astype(np.int32)}, target)

    def run(batches):
        merger, rows, held = ShardMerger(LENGTH), [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                if part.num_rows:
                    rows.append(part)
                    held += int(utf8(part.column("bytes"))[1][-1])
                if held >= SHARD:
                    out = flush(merger, rows)
                    rows, held = [], 0
                    if out is not None:
                        yield out
        if rows:
            out = flush(merger, rows)
            if out is not None:
                yield out

    return edges.mapInArrow(run, schema)


def windows(edges: DataFrame) -> DataFrame:
    """``digest, doc_id, version, first`` of every owned window (for anchors with very many segments)."""

    def run(batch: pa.RecordBatch) -> dict:
        data, bounds = utf8(batch.column("bytes"))
        counts = batch.column("count").to_numpy().astype(np.int64)
        lane = np.repeat(np.arange(len(counts)), counts)
        inside = np.arange(len(lane)) - np.repeat(np.cumsum(counts) - counts, counts)
        raw, starts = data.tobytes(), (bounds[lane] + inside).tolist()
        return {"digest": pa.array([hashlib.md5(raw[s:s + LENGTH]).digest() for s in starts], pa.binary()),
                "doc_id": batch.column("doc_id").take(pa.array(lane)),
                "version": batch.column("version").take(pa.array(lane)),
                "first": batch.column("first").to_numpy()[lane] + inside}

    return map_batches(edges, run, "digest binary, doc_id long, version long, first long")


def edge_bytes(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """``anchor, doc_id, version, first, count, bytes`` of ``edges(anchor, doc_id, version, first, count)``."""
    wanted = edges.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "first", "count")).alias("edges"))

    def run(batch: pa.RecordBatch) -> dict:
        data, offsets = utf8(batch.column("text"))
        raw, lists = data.tobytes(), batch.column("edges")
        flat = lists.flatten()
        first, count = flat.field("first").to_numpy(), flat.field("count").to_numpy()
        lane = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        start = offsets[lane] + first
        stop = start + count + LENGTH - 1
        pick = pa.array(lane)
        return {"anchor": flat.field("anchor"), "doc_id": batch.column("doc_id").take(pick),
                "version": batch.column("version").take(pick), "first": first, "count": count,
                "bytes": pa.array([raw[a:b] for a, b in zip(start.tolist(), stop.tolist(), strict=True)], pa.binary())}

    return map_batches(docs.join(wanted, KEY), run,
                       "anchor long, doc_id long, version long, first long, count int, bytes binary")


def removed_starts(docs: DataFrame) -> DataFrame:
    """``doc_id, version, first, count``: runs of starts whose window starts earlier elsewhere.

    ``docs(doc_id, version, text)`` holds every key once.
    """
    parts = _partitions(docs)
    rows = segment_rows(docs, *frequent_anchors(docs))
    order = ("anchor", "code", *KEY, "first")
    level1 = materialize(same_segments(rows.repartition(parts, "anchor").sortWithinPartitions(*order)), "sa-level1")

    whole = F.shiftleft(F.shiftright("anchor", 12), 12)
    often = level1.where("kind = 2").withColumn("anchor", whole).drop("kind")
    busy = often.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("anchor")
    busy = materialize(busy, "sa-busy")
    calm = often.join(busy, "anchor", "left_anti").repartition(parts, "anchor").sortWithinPartitions(*order)
    level2 = materialize(same_segments(calm), "sa-level2")

    starts = F.col("code").bitwiseAND(127).cast("int").alias("count")
    gone = level1.where("kind = 0").unionByName(level2.where("kind = 0")).select(*KEY, "first", starts)
    edges = level1.where("kind = 1").unionByName(level2.where("kind = 1")).select(
        "anchor", *KEY, "first", starts, F.lit(False).alias("busy"))
    spread = often.join(busy, "anchor", "left_semi").select(
        "anchor", *KEY, "first", starts, F.lit(True).alias("busy"))
    # the low bit of an anchor is free: it tells the busy ones apart
    both = edges.unionByName(spread).withColumn(
        "anchor", F.when(F.col("busy"), F.col("anchor") + 1).otherwise(F.col("anchor")))
    held = materialize(edge_bytes(docs, both), "sa-edges")
    low = F.col("anchor").bitwiseAND(1)
    shards = held.where(low == 0).repartition(parts, "anchor").sortWithinPartitions("anchor", *KEY, "first")
    single = windows(held.where(low == 1))
    least = single.groupBy("digest").agg(F.min(F.struct(*KEY, "first")).alias("least"))
    later = single.join(least, "digest").where(F.struct(*KEY, "first") != F.col("least")).select(
        *KEY, "first", F.lit(1).alias("count"))
    return gone.unionByName(resolved(shards)).unionByName(later)


def _partitions(docs: DataFrame) -> int:
    """Enough partitions for the shuffles keyed by anchor: the session's setting or the scan's splits."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())


def _runs(keyed: DataFrame, repeated: bool) -> DataFrame:
    """``doc_id, version, runs``: the removed starts of every cut document, as start * 128 + count."""
    docs = materialize(keyed.distinct(), "sa-docs") if repeated else keyed
    runs = removed_starts(docs).select(*KEY, (F.col("first") * 128 + F.col("count")).alias("run"))
    return runs.groupBy(*KEY).agg(F.collect_list("run").alias("runs"))


def _cut(text: bytes, packed: pa.Scalar) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the spans they form."""
    if not packed.is_valid:
        return text, 0, 0
    runs = np.sort(packed.values.to_numpy())
    lo = runs >> 7
    hi = np.minimum(lo + (runs & 127) + LENGTH - 1, len(text))
    reach = np.maximum.accumulate(hi)
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > reach[:-1]
    at = np.flatnonzero(new)
    begin, end = lo[at], reach[np.append(at[1:], len(lo)) - 1]
    live = end > begin
    begin, end = begin[live], end[live]
    edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(text)]
    left = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
    return left, len(text) - len(left), len(begin)


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``doc_id, version, text`` of every row, and whether some doc_id has several rows (else all versions are 0)."""
    rows = text_rows(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text")
    several = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    repeated = bool(several.limit(1).count())
    return rows.select("doc_id", _version(repeated), "text"), repeated


def _version(repeated: bool):
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (F.xxhash64(text) if repeated else F.lit(0).cast("long")).alias("version")


def cut_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row."""
    keyed, repeated = _keyed(docs)

    def run(batch: pa.RecordBatch) -> dict:
        data, offsets = utf8(batch.column("text"))
        raw = data.tobytes()
        cuts = [_cut(raw[offsets[i]:offsets[i + 1]], packed) for i, packed in enumerate(batch.column("runs"))]
        return {"doc_id": batch.column("doc_id"), "n_bytes": np.diff(offsets), "n_removed": [c[1] for c in cuts],
                "n_spans": [c[2] for c in cuts], "kept_sha256": [hashlib.sha256(c[0]).hexdigest() for c in cuts]}

    out = map_batches(keyed.join(_runs(keyed, repeated), KEY, "left"), run,
                      "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed bytes cut from ``text`` and ``n_chars`` set anew.

    A cut may fall inside a code point of several bytes; bytes that no longer
    form one are dropped with it.
    """
    keyed, repeated = _keyed(docs)
    runs = _runs(keyed, repeated).toDF("_key", "_version", "runs")
    rows = docs.withColumn("text", F.coalesce("text", F.lit("")))
    same = (F.coalesce("doc_id", F.lit(NULL_ID)) == F.col("_key")) & (_version(repeated) == F.col("_version"))
    rows = rows.join(runs, same, "left").drop("_key", "_version")
    schema = docs.schema

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = utf8(batch.column("text"))
            raw = data.tobytes()
            texts = [_cut(raw[offsets[i]:offsets[i + 1]], packed)[0].decode("utf-8", "ignore")
                     for i, packed in enumerate(batch.column("runs"))]
            columns = {n: batch.column(n) for n in schema.fieldNames()}
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([len(t) for t in texts], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return rows.select(*schema.fieldNames(), "runs").mapInArrow(run, schema)


# DuckDB SQL for ``cut_texts`` over the table documents
ORACLE = r"""
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents
), starts AS (
  SELECT doc_id, i, md5(substr(hx, 2 * i + 1, 200)) AS w FROM (SELECT doc_id, hx, unnest(range(0, len(hx) // 2 - 99)) AS i FROM docs)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM starts) WHERE n > 1
), marked AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM later)
), spans AS (
  SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM marked GROUP BY doc_id, span
), gaps AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM spans
), cut AS (
  SELECT g.doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans, max(hi) AS last,
         string_agg(substr(hx, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS kept
  FROM gaps g JOIN docs d USING (doc_id) GROUP BY g.doc_id
)
SELECT doc_id, (len(hx) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(hx, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""
