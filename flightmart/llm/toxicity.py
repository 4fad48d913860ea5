"""Toxicity (operator 1): subsequence string-kernel SVM with Nystroem landmarks.

The kernel compares words by their subsequences of three characters, each
weighted by DECAY for every character it spans (Lodhi et al.), so a word with
inserted or dropped characters stays close to the word it hides. Subsequences
may span up to SPAN characters. Words are lower-cased and lose what is neither
letter nor digit (``i.d-i*o,t``); runs of single characters are joined (``i d
i o t``); a word longer than WINDOW is scored in overlapping windows.

Training (numpy, on the driver, from a bounded sample of labelled documents: at
most PER_CLASS of a label): a sentence is toxic because of some word in it,
but labels mark whole documents. So, as in multiple-instance learning, each toxic
document names its most telling words as witnesses, clean documents give all of
theirs, and witnesses and SVM are fitted in turn; clean words that score highest
are added every round. The kernel to LANDMARKS words, whitened by the Nystroem
map, feeds a linear squared-hinge SVM. A logistic curve over the documents'
highest margins gives the score.

Scoring: the SVM is linear in kernels to landmarks, and these are linear in the
word's subsequences, so the landmarks fold into one weight per subsequence: the
same sum in another order. Whole texts are scored, each distinct word once.

Edge cases: null text = empty text = text without words: the score of the least
margin. No label of either class: score 0, predicted 0. A null doc_id is
held out. A document labelled twice is toxic if one label says so; null labels
are ignored. Repeated rows get equal scores. Other columns are never read. An empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flightmart.llm.common import map_batches, prepare, text_rows

PER_CLASS = {1: 1200, 0: 2400}
LANDMARKS = 128
SPAN = 8
DECAY = 0.7
WINDOW = 24
ROUNDS = 3
SLACK = 4.0  # how far below the median document's best word a first witness may lie, in log odds
CACHE = 300_000

LETTERS = 40  # a-z, 0-9 as one, 12 classes of other code points, padding
_SINGLES = re.compile(r"(?<!\S)\S(?:\s+\S(?!\S)){2,}")
_JUNK = re.compile(r"[\W_]+")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(True))


def words_of(text: str) -> set[str]:
    """The distinct instances of a text: cleaned words and joined runs of single characters."""
    text = text.lower()
    found = set(text.split())
    if _SINGLES.search(text):
        found.update("".join(m.split()) for m in _SINGLES.findall(text))
    return found


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character classes of all words in a row, and the words' offsets."""
    joined = "".join(words)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = (points >= 97) & (points <= 122)
    digit = (points >= 48) & (points <= 57)
    out = np.where(letter, points - 97, np.where(digit, 26, 27 + points % 12)).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum([len(w) for w in words])])


def cleaned(word: str) -> list[str]:
    """What of a word is scored: its letters and digits, in windows if it is long."""
    word = _JUNK.sub("", word)
    if len(word) <= WINDOW:
        return [word] if word else []
    step = WINDOW // 2
    return [word[i:i + WINDOW] for i in range(0, len(word) - step, step)]


def subsequences(words: list[str]):
    """``(word, subsequence, weight)`` arrays, one step of the spans at a time."""
    c, offsets = codes(words)
    owner = np.repeat(np.arange(len(words)), np.diff(offsets))
    n = len(c)
    for far in range(2, SPAN):
        if n <= far:
            break
        same = np.flatnonzero(owner[:n - far] == owner[far:])
        if not len(same):
            continue
        ends = c[same] * LETTERS * LETTERS + c[same + far]
        for mid in range(1, far):
            yield owner[same], ends + c[same + mid] * LETTERS, DECAY ** (far + 1)


def norms(words: list[str]) -> np.ndarray:
    """Root of the words' summed squared subsequence weights (a function of length)."""
    length = np.array([len(w) for w in words], float)
    total = np.zeros(len(words))
    for far in range(2, SPAN):
        total += np.maximum(length - far, 0) * (far - 1) * DECAY ** (2 * (far + 1))
    return np.sqrt(np.maximum(total, DECAY ** 6))


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel values, words x landmarks."""
    features = np.zeros((LETTERS ** 3, len(landmarks)), np.float32)
    for owner, sub, weight in subsequences(landmarks):
        np.add.at(features, (sub, owner), weight)
    features /= norms(landmarks)
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for owner, sub, weight in subsequences(words):
        first = np.flatnonzero(np.append(True, np.diff(owner) > 0))
        out[owner[first]] += weight * np.add.reduceat(features[sub], first, axis=0)
    return out / norms(words)[:, None].astype(np.float32)


class Model:
    def __init__(self, weights: np.ndarray, bias: float, floor: float, slope: float, shift: float):
        self.weights, self.bias, self.floor, self.slope, self.shift = weights, bias, floor, slope, shift
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def margins(self, words: list[str]) -> np.ndarray:
        """The SVM's margin of each word (the highest of a long word's windows)."""
        parts, owner = [], []
        for i, w in enumerate(words):
            for piece in cleaned(w):
                parts.append(piece)
                owner.append(i)
        out = np.full(len(words), self.floor)
        if parts:
            total = np.zeros(len(parts))
            for who, sub, weight in subsequences(parts):
                total += weight * np.bincount(who, self.weights[sub], len(parts))
            np.maximum.at(out, owner, total / norms(parts) + self.bias)
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        known, sets = self.known, [words_of(t) for t in texts]
        if len(known) > CACHE:
            known.clear()
        new = [w for w in set().union(*sets) if w not in known]
        known.update(zip(new, self.margins(new).tolist(), strict=True))
        top = np.array([max([known[w] for w in s], default=self.floor) for s in sets])
        return self.probability(top)

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights (last: bias) of the squared-hinge SVM, by Newton steps over the active rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        active = y * (x @ w) < 1
        xa, ca = x[active], cost[active]
        new = np.linalg.solve(ridge + (xa * ca[:, None]).T @ xa, (xa * ca[:, None]).T @ y[active])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(label = 1), by Newton steps with a weak prior."""
    x = np.stack([margin, np.ones(len(margin))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - label) + 1e-2 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def telling(toxic: list[set[str]], clean: list[set[str]]) -> dict[str, float]:
    """First guess: log odds of a word and of its strings of 4 and 5 characters."""
    def count(docs):
        found = Counter()
        for words in docs:
            found.update({g for w in words for g in grams(w)})
        return found

    t, c = count(toxic), count(clean)
    odds = {g: np.log((n + 0.1) / (len(toxic) + 1)) - np.log((c[g] + 0.1 + 0.9 * (n < 2)) / (len(clean) + 1))
            + 0.5 * np.log(n) for g, n in t.items()}
    return defaultdict(lambda: -9.0, odds)


def grams(word: str) -> set[str]:
    return {word, *(word[i:i + k] for k in (4, 5) for i in range(len(word) - k + 1))} if word else set()


def covering(docs: list[set[str]], words: set[str], most: int) -> list[str]:
    """Up to ``most`` of the words, each time the one in most documents without a chosen one yet;
    once all documents have one, they are covered again by the other words."""
    chosen: list[str] = []
    words = set(words)
    while words and len(chosen) < most:
        left = [found for d in docs if (found := d & words)]
        if not left:
            break
        while left and len(chosen) < most:
            count = Counter(w for d in left for w in d)
            best = min(count, key=lambda w: (-count[w], w))
            chosen.append(best)
            words.discard(best)
            left = [d for d in left if best not in d]
    return chosen


def train(texts: list[str], labels: list[int]) -> Model | None:
    docs = [sorted({p for w in words_of(t) for p in cleaned(w)}) for t in texts]
    label = np.array(labels, float)
    toxic = [set(d) for d, y in zip(docs, labels, strict=True) if y]
    clean = [set(d) for d, y in zip(docs, labels, strict=True) if not y]
    if not toxic or not clean:
        return None
    odds = telling(toxic, clean)
    value = {w: max(odds[g] for g in grams(w)) for d in toxic for w in d}
    ever_clean = set().union(*clean)
    spread = np.median([max((value[w] for w in d), default=-9) for d in toxic])
    first = [{w for w in sorted(d, key=lambda w: (-value[w], w))[:6] if value[w] >= spread - SLACK and w not in ever_clean}
             for d in toxic]
    witness = set().union(*first)
    rng = np.random.default_rng(3)
    pool = sorted(ever_clean)
    negative = [pool[i] for i in rng.permutation(len(pool))[:3000]]
    hard: list[str] = sorted(ever_clean, key=lambda w: (-max(odds[g] for g in grams(w)), w))[:500]
    model = None
    for _ in range(ROUNDS):
        positive = sorted(witness)
        if not positive:
            break
        # half the landmarks are witnesses that cover the toxic documents; half are clean words, some alike
        landmarks = list(dict.fromkeys(covering(toxic, witness, LANDMARKS // 2) + hard[:LANDMARKS // 4] + negative[:LANDMARKS // 4]))
        words = positive + list(dict.fromkeys(hard + negative))
        y = np.where(np.arange(len(words)) < len(positive), 1.0, -1.0)
        base = kernel(landmarks, landmarks).astype(float)
        vals, vecs = np.linalg.eigh((base + base.T) / 2 + 1e-6 * np.eye(len(landmarks)))
        whiten = vecs / np.sqrt(np.maximum(vals, 1e-6))
        x = kernel(words, landmarks).astype(float) @ whiten
        cost = np.where(y > 0, 10.0 * max(1.0, (y < 0).sum() / len(positive)) ** 0.5, 10.0)
        w = svm(x, y, cost)
        alpha = whiten @ w[:-1]
        folded = np.zeros(LETTERS ** 3)
        scale = alpha / norms(landmarks)
        for owner, sub, weight in subsequences(landmarks):
            np.add.at(folded, sub, weight * scale[owner])
        model = Model(folded, float(w[-1]), float(w[-1]) - 1.0, 1.0, 0.0)
        # witnesses and hard negatives of the next round
        every = sorted(set().union(*toxic) | ever_clean)
        margin = dict(zip(every, model.margins(every).tolist(), strict=True))
        witness = set()
        for d, guess in zip(toxic, first, strict=True):
            best = {v for v in d if margin[v] > 0.5 and v not in ever_clean}
            if not best and d:
                top = max(d, key=lambda v: (margin[v], v))
                best = {top} if margin[top] > 0 and top not in ever_clean else guess
            witness |= best
        hard = sorted(ever_clean, key=lambda v: (-margin[v], v))[:1500]
    if model is None:
        return None
    top = np.array([max([margin[w] for w in d], default=model.floor) for d in docs])
    model.slope, model.shift = logistic(top, label)
    return model


def sample(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] | None = None) -> DataFrame:
    """``text, toxic, place``: at most PER_CLASS labelled documents of each class, never held-out ones."""
    most = per_class or PER_CLASS
    known = labels.where(~held_out() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    place = F.row_number().over(W.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    picked = known.withColumn("place", place).where(
        F.col("place") <= F.when(F.col("toxic") == 1, most[1]).otherwise(most[0]))
    # at most PER_CLASS rows of three numbers each: a proven bound
    return text_rows(docs).join(F.broadcast(picked), "doc_id").select("text", "toxic", "place")


def fitted(docs: DataFrame, labels: DataFrame) -> Model | None:
    rows = sorted((r.toxic, r.place, r.text) for r in sample(docs, labels).collect())
    return train([r[2] for r in rows], [r[0] for r in rows]) if rows else None


def scored(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = model or fitted(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        model = shared.value
        n = batch.num_rows
        score = model.score(batch.column("text").to_pylist()) if model is not None else np.zeros(n)
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": score, "predicted": (score >= 0.5).astype(np.int32)}

    rows = text_rows(docs).withColumn("held_out", held_out())
    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def kept(docs: DataFrame, training_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted clean, all columns as they are."""
    model = fitted(training_docs, labels)
    if model is None:
        return docs
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                score = shared.value.score([t or "" for t in batch.column("text").to_pylist()])
                yield batch.filter(pa.array(score < 0.5))

    return docs.mapInArrow(run, docs.schema)
