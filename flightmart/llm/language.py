"""Language identification (operator 7): averaged hashed subword embeddings and a linear softmax.

A text's features are its byte n-grams of 2, 3 and 4 bytes (ASCII letters in
lower case), hashed into ``BUCKETS``. Their embeddings are averaged and a
linear softmax gives the languages' probabilities. Both are trained together by
stochastic gradient descent in numpy on the driver, from a bounded sample:
``PER_LANGUAGE`` rows of each language, ``TRAIN_CHARS`` characters of each from
a place drawn by hash (parameters of the training only; predictions read whole texts).

One part in five of the sample is held back to calibrate: a temperature that
minimises the log loss, then the least probability at which accepted
predictions are right in ``PRECISION`` of cases. ``accepted`` is false below it.

As embedding and softmax are linear, prediction adds up a table of one logit
per bucket and language, the product of both matrices.

Edge cases: text null or without a letter: ``und``, score 0, not accepted.
No row to learn from: every text is ``und``. One language: it is always
predicted. Rows of a null doc_id are held out and not learned from. Repeated
rows get equal predictions; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flightmart.llm.common import BYTE_WORDS, U, ascii_lower, hashed_window, map_batches, prepare, utf8

PER_LANGUAGE = 1000
TRAIN_CHARS = 500
BUCKETS = 1 << 16
DIM = 16
EPOCHS = 4
BATCH = 32
RATE = 1.0
EMBED_RATE = 200.0  # of the embeddings, whose gradients are spread over a text's n-grams
PRECISION = 0.99
GRAMS = (2, 3, 4)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(True))


def buckets(data: np.ndarray, k: int) -> np.ndarray:
    """The bucket of the ``k`` bytes from every position."""
    n = len(data) - k + 1
    if n <= 0:
        return np.empty(0, np.int64)
    h = BYTE_WORDS[data[:n]] * U(0xD6E8FEB86659FD93)
    for j in range(1, k):
        h = (h + BYTE_WORDS[data[j:j + n]]) * U(0xD6E8FEB86659FD93)
    return (h >> U(48)).astype(np.int64)


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, chars: int = TRAIN_CHARS) -> DataFrame:
    """``text, lang``: the same rows for the same table, whatever its layout."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0))
    rows = rows.select("lang", hashed_window("text", chars).alias("text"), F.xxhash64("doc_id", "text").alias("at"))
    # of a language with many rows only every so many-th hash is a candidate (four times as many
    # as needed are left), so that what tasks send on doesn't grow with their number
    counts = {r.lang: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    every = {lang: n // (4 * per_language) for lang, n in counts.items() if n >= 8 * per_language}
    if every:
        known = F.create_map(*[F.lit(x) for pair in sorted(every.items()) for x in pair])
        share = F.coalesce(F.try_element_at(known, F.col("lang")), F.lit(1))
        rows = rows.where(F.pmod("at", share) == 0)
    place = F.row_number().over(W.partitionBy("lang").orderBy("at", "text"))
    return rows.withColumn("place", place).where(F.col("place") <= per_language).select("lang", "text", "place")


class Model:
    """``classes``; one logit per bucket and class; bias; least accepted probability."""

    def __init__(self, classes, table, bias, threshold):
        self.classes, self.table, self.bias, self.threshold = classes, table, bias, threshold

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Class probabilities of every text (uniform where a text has no n-gram)."""
        n, classes = len(offsets) - 1, len(self.classes)
        total, grams = np.zeros((n, classes)), np.zeros(n)
        data = ascii_lower(data)
        for k in GRAMS:
            at = buckets(data, k)
            last = np.maximum(offsets[1:] - k + 1, offsets[:-1])  # n-grams don't reach into the next text
            for c in range(classes):
                summed = np.concatenate([[0.0], np.cumsum(self.table[at, c], dtype=np.float64)])
                reach = np.minimum(last, len(at))
                total[:, c] += summed[np.maximum(reach, np.minimum(offsets[:-1], len(at)))] - summed[
                    np.minimum(offsets[:-1], len(at))]
            grams += last - offsets[:-1]
        logits = total / np.maximum(grams, 1)[:, None] + self.bias
        return softmax(logits)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], langs: list[str], seed: int = 7) -> Model:
    classes = sorted(set(langs))
    target = np.searchsorted(np.array(classes), np.array(langs))
    features = []
    for text in texts:
        data = ascii_lower(np.frombuffer(text.encode(), np.uint8))
        features.append(np.concatenate([buckets(data, k) for k in GRAMS]))
    rng = np.random.default_rng(seed)
    place = rng.permutation(len(texts))
    held, used = place[:len(place) // 5], place[len(place) // 5:]
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weight, bias = np.zeros((DIM, len(classes)), np.float32), np.zeros(len(classes), np.float32)

    def averages(rows):
        at = [features[i] for i in rows]
        sizes = np.array([max(1, len(a)) for a in at])
        at = [a if len(a) else np.zeros(1, np.int64) for a in at]
        flat = np.concatenate(at)
        starts = np.cumsum(sizes) - sizes
        return flat, sizes, np.add.reduceat(embed[flat], starts, axis=0) / sizes[:, None]

    steps = EPOCHS * max(1, len(used) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        used = rng.permutation(used)
        for lo in range(0, len(used), BATCH):
            rows = used[lo:lo + BATCH]
            rate = RATE * max(0.05, 1 - step / steps)
            flat, sizes, mean = averages(rows)
            error = softmax(mean @ weight + bias)
            error[np.arange(len(rows)), target[rows]] -= 1
            back = (error @ weight.T).astype(np.float32)
            weight -= rate * (mean.T @ error).astype(np.float32) / len(rows)
            bias -= 0.1 * rate * error.sum(axis=0).astype(np.float32) / len(rows)
            # each n-gram of a text moves by the text's gradient over its length;
            # moves of one bucket are summed first
            order = np.argsort(flat, kind="stable")
            move = np.repeat(EMBED_RATE * rate * back / sizes[:, None], sizes, axis=0)[order]
            first = np.flatnonzero(np.append(True, np.diff(flat[order]) > 0))
            embed[flat[order][first]] -= np.add.reduceat(move, first, axis=0)
            step += 1
    logits = np.concatenate([averages(held[i:i + 256])[2] @ weight + bias for i in range(0, len(held), 256)]) if len(
        held) else np.zeros((0, len(classes)))
    scale, threshold = calibrate(logits, target[held])
    return Model(classes, (embed @ weight * scale).astype(np.float32), bias * scale, threshold)


def calibrate(logits: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """The factor on logits with the least log loss, and the least accepted probability."""
    if not len(target):
        return 1.0, 0.0
    rows = np.arange(len(target))
    scales = np.geomspace(0.25, 16, 49)
    loss = [-np.log(np.maximum(softmax(logits * s)[rows, target], 1e-12)).mean() for s in scales]
    scale = float(scales[int(np.argmin(loss))])
    p = softmax(logits * scale)
    best, right = p.max(axis=1), p.argmax(axis=1) == target
    order = np.argsort(-best, kind="stable")
    precision = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(precision >= PRECISION)
    return scale, float(best[order][good[-1]]) if len(good) else 1.0


def identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` for every row."""
    prepare(docs.sparkSession)
    if model is None:
        rows = sorted((r.lang, r.place, r.text) for r in sample(docs).collect())  # at most PER_LANGUAGE each
        model = train([r[2] for r in rows], [r[0] for r in rows]) if rows else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        model, texts = shared.value, batch.column("text")
        n = batch.num_rows
        data, offsets = utf8(texts)
        lower = ascii_lower(data)
        letters = np.concatenate([[0], np.cumsum((lower >= 97) & (lower <= 122))])
        lettered = (letters[offsets[1:]] - letters[offsets[:-1]]) > 0
        for i in np.flatnonzero(~lettered):
            lettered[i] = any(c.isalpha() for c in texts[int(i)].as_py() or "")
        pred, score, accepted = ["und"] * n, np.zeros(n), np.zeros(n, bool)
        if model is not None:
            p = np.concatenate([model.probabilities(d, o) for d, o in slices(data, offsets)])
            best, top = p.argmax(axis=1), p.max(axis=1)
            score = np.where(lettered, top, 0.0)
            accepted = lettered & (top >= model.threshold)
            pred = [model.classes[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": pred, "score": score, "accepted": accepted}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return map_batches(
        rows, run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def slices(data: np.ndarray, offsets: np.ndarray, size: int = 1 << 20):
    """Runs of whole texts of about ``size`` bytes."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi
