"""Fill-in-middle transformation (operator 13) by displacement scatter.

A text is cut into units: a word (a run of bytes other than 0x20 and 0x09-0x0D) with the
white space before it; white space after the last word is a unit of its own. Two cuts, drawn
from a hash of ``doc_id``, part the units into prefix, middle and suffix:

    psm   <P> prefix <S> suffix <M> middle
    spm   <S> suffix <P> prefix <M> middle
    plain the text as it is

All texts of an Arrow batch are moved together. The cuts of every text give the byte shift of
its three parts; the differences between the shifts of neighbouring parts are added at the
bytes where a part begins, a cumulative sum turns them into one shift a byte, and one numpy
scatter writes the output. :func:`restored` finds the three marks in an output, builds the same
differences over the text to be rebuilt and gathers its bytes, without looking at the text.
A mark can't arise by accident: no text with a mark is cut, and no mark overlaps another.

Edge cases: a null text is the empty text, which is plain, as is any text that holds a mark.
A null ``doc_id`` is hashed as no digits (``42:``). A part may be empty; text of white space
only is one unit. Repeated rows and rows of one ``doc_id`` are transformed alike, row by row.
A very long text is one Arrow row of its own: memory grows with the batch's bytes (some 30
bytes a byte), never with the table. An empty table gives an empty table. Only ``doc_id`` and
``text`` are read, so other columns may have any name. ``restored`` gives null for an output
that its form doesn't fit (a mark missing, doubled or out of order).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightmart.llm.common import map_batches, text_rows, utf8, word_spans

SEED = "42"
PLAIN_PERCENT = 50   # of all texts stay plain ...
SPM_PERCENT = 80     # ... and of the others are suffix first
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
MARK = 3             # bytes of a mark
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four numbers below 2**32 for a document: the first 8-digit groups of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def marks_at(data: np.ndarray, offsets: np.ndarray, mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions of a mark and the number of the text that holds each; none crosses texts."""
    if len(data) < MARK:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2]))
    row = np.searchsorted(offsets, at, "right") - 1
    inside = at + MARK <= offsets[row + 1]
    return at[inside], row[inside]


def cuts(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray):
    """Number of units of every text and the bytes at which its prefix and its middle end."""
    _, ends = word_spans(data, offsets)
    first = np.searchsorted(ends, offsets, "right")   # number of words up to each text
    words = np.diff(first)
    last = np.concatenate([ends, [0]])[np.maximum(first[1:] - 1, 0)] if len(ends) else np.zeros(len(words), np.int64)
    lo, hi = offsets[:-1], offsets[1:]
    covered = np.where(words > 0, last, lo)           # end of the last word
    units = words + (covered < hi)
    a, b = h1 % (units + 1), h2 % (units + 1)

    def byte(unit: np.ndarray) -> np.ndarray:
        word = first[:-1] + unit - 1
        inner = np.concatenate([ends, [0]])[np.clip(word, 0, len(ends))]
        return np.where(unit == 0, lo, np.where(unit > words, hi, inner))

    return units, byte(np.minimum(a, b)), byte(np.maximum(a, b))


def _layout(form: np.ndarray, prefix: np.ndarray, middle: np.ndarray, suffix: np.ndarray):
    """Where the prefix, middle and suffix begin in an output, from its own start."""
    spm = form == SPM
    cut = form != PLAIN
    at_prefix = np.where(spm, 2 * MARK + suffix, np.where(cut, MARK, 0))
    at_suffix = np.where(spm, MARK, np.where(cut, 2 * MARK + prefix, prefix + middle))
    at_middle = np.where(cut, 3 * MARK + prefix + suffix, prefix)
    return at_prefix, at_middle, at_suffix


def _shifts(starts: list[np.ndarray], shifts: list[np.ndarray], size: int) -> np.ndarray:
    """One shift a byte: differences between the shifts of successive parts, added up."""
    begin = np.stack(starts, 1).reshape(-1)
    shift = np.stack(shifts, 1).reshape(-1)
    small = size < 1 << 30
    step = np.zeros(size + 1, np.int32 if small else np.int64)
    np.add.at(step, begin, np.diff(shift, prepend=0).astype(step.dtype))  # empty parts share a byte: they add up
    return np.cumsum(step[:-1], dtype=step.dtype)


def scatter(data: np.ndarray, offsets: np.ndarray, p: np.ndarray, m: np.ndarray, form: np.ndarray):
    """The outputs of all texts as bytes and offsets."""
    lo, hi = offsets[:-1], offsets[1:]
    out = np.zeros(len(offsets), np.int64)
    np.cumsum(hi - lo + np.where(form == PLAIN, 0, 3 * MARK), out=out[1:])
    at_prefix, at_middle, at_suffix = _layout(form, p - lo, m - p, hi - m)
    base = out[:-1]
    shift = _shifts([lo, p, m], [base + at_prefix - lo, base + at_middle - p, base + at_suffix - m], len(data))
    target = np.empty(int(out[-1]), np.uint8)
    target[np.arange(len(data), dtype=shift.dtype) + shift] = data
    cut = form != PLAIN
    for name, at in (("P", at_prefix), ("S", at_suffix), ("M", at_middle)):
        for i, byte in enumerate(MARKS[name]):
            target[(base + at - MARK + i)[cut]] = byte
    return target, out


def gather(data: np.ndarray, offsets: np.ndarray, form: np.ndarray):
    """The texts of outputs as bytes and offsets, and which outputs fit their form."""
    n = len(form)
    lo, hi = offsets[:-1], offsets[1:]
    cut = form != PLAIN
    fits = np.ones(n, bool)
    at = {}
    for name, mark in MARKS.items():
        where, row = marks_at(data, offsets, mark)
        fits &= ~cut | (np.bincount(row, minlength=n) == 1)
        at[name] = np.zeros(n, np.int64)
        at[name][row] = where
    spm = form == SPM
    head, second = np.where(spm, at["S"], at["P"]), np.where(spm, at["P"], at["S"])
    fits &= ~cut | ((head == lo) & (head < second) & (second < at["M"]))
    whole = ~cut | ~fits                       # taken as they are
    one = second - head - MARK                 # bytes of the part that comes first
    two = at["M"] - second - MARK
    prefix = np.where(whole, hi - lo, np.where(spm, two, one))
    suffix = np.where(whole, 0, np.where(spm, one, two))
    middle = np.where(whole, 0, hi - at["M"] - MARK)
    out = np.zeros(n + 1, np.int64)
    np.cumsum(prefix + middle + suffix, out=out[1:])
    base = out[:-1]
    at_prefix, at_middle, at_suffix = _layout(np.where(whole, PLAIN, form), prefix, middle, suffix)
    begins = [base, base + prefix, base + prefix + middle]
    sources = [lo + at_prefix, lo + at_middle, lo + at_suffix]
    shift = _shifts(begins, [s - b for s, b in zip(sources, begins, strict=True)], int(out[-1]))
    return data[np.arange(len(shift), dtype=shift.dtype) + shift], out, fits


def code_points(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Number of code points between bytes ``lo`` and ``hi``."""
    count = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=count[1:])
    return count[hi] - count[lo]


def strings(data: np.ndarray, offsets: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Bytes and offsets as an Arrow string column."""
    mask = None if valid is None or valid.all() else pa.array(valid).buffers()[1]
    if offsets[-1] < 1 << 31:
        return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [
            mask, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [mask, pa.py_buffer(offsets), pa.py_buffer(data)])


def transformed(docs: DataFrame, seed: str = SEED, plain_percent: int = PLAIN_PERCENT,
                spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of ``docs``."""

    def run(batch: pa.RecordBatch) -> dict:
        data, offsets = utf8(batch.column("text"))
        h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4))
        units, p, m = cuts(data, offsets, h1, h2)
        form = np.where(h4 % 100 < spm_percent, SPM, PSM)
        plain = (np.diff(offsets) == 0) | (h3 % 100 >= plain_percent)
        for mark in MARKS.values():
            plain[marks_at(data, offsets, mark)[1]] = True
        form[plain] = PLAIN
        out, out_offsets = scatter(data, offsets, p, m, form)
        return {
            "doc_id": batch.column("doc_id"), "n": units.astype(np.int64), "form": FORMS[form],
            "prefix_chars": pa.array(code_points(data, offsets[:-1], p), mask=plain),
            "middle_chars": pa.array(code_points(data, p, m), mask=plain),
            "output": strings(out, out_offsets),
        }

    rows = text_rows(docs)
    return map_batches(rows.select("doc_id", "text", *draws(F.col("doc_id"), seed)), run,
                       "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(df: DataFrame) -> DataFrame:
    """``df`` with a column ``text`` rebuilt from ``output`` and ``form`` alone (in place of one it has)."""
    codes = {name: i for i, name in enumerate(FORMS.tolist())}
    df = df.drop("text")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + ["text string"])

    def run(batch: pa.RecordBatch) -> dict:
        data, offsets = utf8(batch.column("output"))
        form = np.array([codes.get(f, PLAIN) for f in batch.column("form").to_pylist()], np.int64)
        text, text_offsets, fits = gather(data, offsets, form)
        return dict(zip(batch.schema.names, batch.columns, strict=True)) | {"text": strings(text, text_offsets, fits)}

    return map_batches(df, run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """The outputs and the restored texts as SHA-256, with the form and the lengths of the parts."""
    return restored(transformed(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("text", 256).alias("restored_sha256"))


# DuckDB SQL for ``digests`` over the table documents
ORACLE = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), units AS (
  SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM docs
), cut AS (
  SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM units
), parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM cut
)
SELECT doc_id, len(u)::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
