"""Sequence packing (operator 5): first-fit decreasing over a tournament tree, in random groups.

A document is its byte-level BPE ids with an end id appended. Whole sequences
of ``SIZE`` ids are cut off its front; the rest (fewer than ``SIZE``) is one
piece. Documents are dealt into random groups by a hash of the row, about
``GROUP_DOCS`` each whatever their source or length, and a group is packed on
its own:

1. first-fit decreasing: pieces by falling length, each into the first bin
   with room, found in a tournament tree whose inner nodes hold the largest
   room below them;
2. as documents may be cut freely, the emptiest bins are then dissolved: their
   pieces are cut, at multiples of ``BLOCK`` ids, to fill the gaps of the
   others.

Each text is encoded once and its ids are written to the shared folder. Groups
are packed from the documents' numbers of ids alone, so a group's memory does not
grow with its texts; the places then join the ids by row. ``pieces`` holds the ids
of every piece with its place, ``sequences`` the packed sequences themselves, and
``packed`` the pieces with a checksum in place of the ids.

Ids are those of the ``tokenizers`` library for the given file; the encoder is
built from the same file's vocabulary and pattern. The path is a parameter and
must be readable on every worker.

Edge cases: null text = empty text: one piece holding the end id. Repeated
rows are packed each on their own. Null doc_ids pass. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmart.llm.bpe import byte_alphabet
from flightmart.llm.common import map_batches, materialize, text_rows

SIZE = 2048
END_ID = 1
GROUP_DOCS = 4096
BLOCK = 32

#: The pattern of byte-level vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    """The file's vocabulary as ranks (its ids are in the order of its merges)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    back = {c: b for b, c in enumerate(byte_alphabet())}
    ranks = {bytes([back[c] for c in s]): i for s, i in spec["model"]["vocab"].items() if s not in special}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(path: str, text: str) -> np.ndarray:
    """The uint32 ids of a text; special tokens in it count as such."""
    return np.array(encoder(path).encode(text, allowed_special="all"), np.uint32)


def encoded(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``row, doc_id, doc_tokens, ids`` of every document, the end id included."""

    def run(batch: pa.RecordBatch) -> dict:
        ids = [np.append(encode(path, text), np.uint32(end_id)) for text in batch.column("text").to_pylist()]
        counts = [len(i) for i in ids]
        return {"row": batch.column("row"), "doc_id": batch.column("doc_id"), "doc_tokens": counts,
                "ids": _lists(np.concatenate(ids), counts)}

    rows = text_rows(docs).withColumn("row", F.monotonically_increasing_id())
    return map_batches(rows, run, "row long, doc_id long, doc_tokens long, ids array<int>")


def _lists(values: np.ndarray, counts) -> pa.Array:
    """Adjoining lists of ``counts`` values."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


class Tournament:
    """Room of bins 0, 1, ...; ``first(x)`` is the first bin with room for x."""

    def __init__(self, bins: int, size: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [size] * (2 * self.leaves)

    def first(self, need: int) -> int:
        room, i = self.room, 1
        while i < self.leaves:
            i *= 2
            if room[i] < need:
                i += 1
        return i - self.leaves

    def take(self, b: int, used: int) -> None:
        room, i = self.room, b + self.leaves
        room[i] -= used
        i //= 2
        while i:
            best = max(room[2 * i], room[2 * i + 1])
            if room[i] == best:
                break
            room[i] = best
            i //= 2


def first_fit_decreasing(pieces: list[int], size: int) -> list[list[int]]:
    """Bins of indexes into ``pieces`` (lengths of at most ``size``)."""
    tree, bins = Tournament(len(pieces), size), []
    for i in sorted(range(len(pieces)), key=lambda i: (-pieces[i], i)):
        b = tree.first(pieces[i])
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
        tree.take(b, pieces[i])
    return bins


def fill_gaps(bins: list[list[tuple[int, int, int]]], size: int) -> list[list[tuple[int, int, int]]]:
    """Dissolve the emptiest bins into the gaps of the others.

    A piece is ``(document, start, length)``; it is cut only at multiples of
    BLOCK from the start of the document's rest.
    """
    fill = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: (fill[b], b))
    low, high = 0, len(order) - 1
    while low < high:
        donor, taker = order[low], order[high]
        room = size - fill[taker]
        if not bins[donor]:
            low += 1
        elif room < BLOCK:
            high -= 1
        else:
            doc, start, length = bins[donor].pop()
            part = length if length <= room else room // BLOCK * BLOCK
            # the front of a piece keeps its start, so later cuts stay on blocks
            bins[taker].append((doc, start, part))
            if part < length:
                bins[donor].append((doc, start + part, length - part))
            fill[taker] += part
            fill[donor] -= part
            if part < length:
                high -= 1
    return [b for b in bins if b]


def pack_group(rows: pd.DataFrame, size: int) -> pd.DataFrame:
    """The places of all pieces of one group ``row, doc_tokens``: their sequence (from 0) and offset."""
    rows = rows.sort_values("row", kind="stable")
    row, total = rows["row"].tolist(), rows["doc_tokens"].tolist()
    rests, out, sequence = [n % size for n in total], [], 0
    for i, n in enumerate(total):
        for k in range(n // size):
            out.append((row[i], k * size, size, sequence, 0))
            sequence += 1
    open_docs = [i for i, n in enumerate(rests) if n]
    bins = first_fit_decreasing([rests[i] for i in open_docs], size)
    bins = fill_gaps([[(open_docs[k], 0, rests[open_docs[k]]) for k in b] for b in bins], size)
    for b in bins:
        offset = 0
        for i, start, length in b:
            out.append((row[i], total[i] - rests[i] + start, length, sequence, offset))
            offset += length
        sequence += 1
    return pd.DataFrame(out, columns=["row", "start", "length", "sequence_id", "offset"])


def pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID,
           group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per piece, with its ids: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``."""
    rows = materialize(encoded(docs, path, end_id), "pack-ids")
    groups = max(1, round(rows.count() / group_docs))

    def pack(key, part: pd.DataFrame) -> pd.DataFrame:
        result = pack_group(part, size)
        result["sequence_id"] += int(key[0]) << 32
        return result

    keyed = rows.select("row", "doc_tokens", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"))
    places = keyed.groupBy("group").applyInPandas(
        pack, "row long, start long, length long, sequence_id long, offset long")
    held = places.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("places"))

    def cut(batch: pa.RecordBatch) -> dict:
        # sorted by start, a document's pieces adjoin and hold all its ids: its list is the pieces' lists
        lists, found = batch.column("ids"), batch.column("places")
        flat, lane = found.flatten(), np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
        length = flat.field("length").to_numpy()
        return {"doc_id": batch.column("doc_id").take(pa.array(lane)), "start": flat.field("start"), "length": length,
                "ids": _lists(lists.flatten().to_numpy(), length),
                "doc_tokens": batch.column("doc_tokens").take(pa.array(lane)),
                "sequence_id": flat.field("sequence_id"), "offset": flat.field("offset")}

    return map_batches(rows.join(held, "row"), cut, "doc_id long, start long, length long, ids array<int>, "
                       "doc_tokens long, sequence_id long, offset long")


def sequences(cut: DataFrame) -> DataFrame:
    """``sequence_id, n_ids, ids`` of the sequences that ``pieces`` make up."""
    held = cut.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    ids = F.flatten(F.col("held.ids"))
    return held.select("sequence_id", F.size(ids).cast("long").alias("n_ids"), ids.alias("ids"))


def packed(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID,
           group_docs: int = GROUP_DOCS) -> DataFrame:
    """The pieces with a checksum of their ids: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    return checksums(pieces(docs, path, size, end_id, group_docs))


def checksums(cut: DataFrame) -> DataFrame:
    """``ids_crc32`` of the little-endian ids in place of ``ids``."""

    def run(batch: pa.RecordBatch) -> dict:
        lists = batch.column("ids")
        raw = lists.flatten().to_numpy().astype("<u4").tobytes()
        ends = 4 * np.cumsum(batch.column("length").to_numpy())
        crcs = [zlib.crc32(raw[b - 4 * n:b]) for b, n in zip(ends.tolist(), batch.column("length").to_pylist(), strict=True)]
        return {c: batch.column(c) for c in batch.schema.names if c != "ids"} | {"ids_crc32": crcs}

    return map_batches(cut, run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                       "sequence_id long, offset long")
