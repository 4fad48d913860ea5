"""BPE encoding and decoding (operator 8): merges by a contiguous array of adjacent ranks.

The vocabulary file (a ``tokenizers`` JSON file with a BPE model) is a
parameter; it must be readable at the same path on every worker. A text is
split at the file's special tokens, normalised (NFC, lower case code point by
code point), cut into words by the file's pattern, and each word's UTF-8 bytes,
written in the file's byte alphabet, are merged:

- a short word holds its part boundaries and, beside each part, the rank of
  merging it with the next one. The least rank is found by a scan (the first
  one wins ties), the boundary between the two parts is deleted, and only the
  ranks of the new part with its two neighbours are looked up again;
- a word of more than ``SHORT`` parts keeps the same ranks in a heap, as the
  scan would take quadratic time; the merges are the same.

Words repeat, so a worker keeps the encodings of up to ``CACHE`` words.

Decoding joins the ids' vocabulary strings by a space, which is what the file
asks for (it has no decoder), special tokens included.

Edge cases: null text = empty text: no ids, both digests of the empty string.
Repeated rows give equal results; other columns are not read; null ids pass.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from flightmart.llm.common import map_batches, text_rows

#: The pattern of this vocabulary family, its word classes written out for two
#: alphabets: ASCII in lower case, and all code points below U+0500.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_WIDE = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_\u00b2\u00b3\u00b9\u00bc-\u00be]+|[\d\u00b2\u00b3\u00b9\u00bc-\u00be]"
    r"|(?:[^\w\t-\r \x85\xa0]|_)+")
_FAR = re.compile("[\u0500-\U0010ffff]")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SHORT = 256
CACHE = 200_000
_NONE = 1 << 62


def byte_alphabet() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: the
    visible Latin-1 characters stand for themselves, the others for the code
    points from 256 on, in order."""
    visible = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in visible)
    shifted = {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [shifted.get(b, chr(b)) for b in range(256)]


class Words(dict):
    """word -> (ids, their decimal digits joined by spaces, their strings joined by spaces)."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, word: str):
        v = self.vocabulary
        ids = v.merge(word)
        value = (" ".join(map(str, ids)), " ".join([v.strings[i] for i in ids]))
        if len(self) >= CACHE:
            self.clear()
        self[word] = value
        return value


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.ids | self.special).items()}
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != _PATTERN:
            raise ValueError(f"{path}: the word pattern is not the one this operator splits by")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        library = Tokenizer.from_file(path)
        self.library_normalise = library.normalizer.normalize_str
        self.library_split = library.pre_tokenizer.pre_tokenize_str
        self.alphabet = byte_alphabet()
        self.from_alphabet = {c: b for b, c in enumerate(self.alphabet)}
        # (left id, right id) -> rank and merged id in one integer, least rank first
        self.pairs: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            key = self.ids[left] << 20 | self.ids[right]
            self.pairs.setdefault(key, rank << 20 | self.ids[left + right])
        self.words = Words(self)

    def split(self, text: str) -> list[str]:
        """The normalised text's words. Code points from U+0500 on get their
        classes from the library, whose Unicode version may differ from Python's."""
        if text.isascii():
            return _ASCII.findall(text.lower())
        if _FAR.search(text) is None:
            # lower() alone makes a word's last capital sigma a final one
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
            return _WIDE.findall(text)
        back = self.from_alphabet
        found = self.library_split(self.library_normalise(text))
        return [bytes([back[c] for c in w]).decode("utf-8", "surrogateescape") for w, _ in found]

    def merge(self, word: str) -> list[int]:
        alphabet = self.alphabet
        symbols = [alphabet[b] for b in word.encode("utf-8", "surrogateescape")]
        symbols[-1] += self.suffix
        parts = [self.ids[s] for s in symbols]
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        find = self.pairs.get
        ranks = [find(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            parts[i] = least & 0xFFFFF
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find(parts[i - 1] << 20 | parts[i], _NONE)
            if i < len(ranks):
                ranks[i] = find(parts[i] << 20 | parts[i + 1], _NONE)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        find, n = self.pairs.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := find(parts[i] << 20 | parts[i + 1], _NONE)) != _NONE]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or find(parts[i] << 20 | parts[j], _NONE) != rank:
                continue  # one of the two parts has changed since
            parts[i], alive[j] = rank & 0xFFFFF, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := find(parts[i] << 20 | parts[after[j]], _NONE)) != _NONE:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := find(parts[before[i]] << 20 | parts[i], _NONE)) != _NONE:
                heapq.heappush(heap, (r, before[i]))
        return [p for p, live in zip(parts, alive, strict=True) if live]

    def pieces(self, text: str) -> list[tuple[str, str]]:
        """Digits and strings of the ids, one pair per word or special token."""
        words, out = self.words, []
        for k, part in enumerate(self.cut.split(text) if "<|" in text else (text,)):
            if k % 2:
                out.append((str(self.special[part]), part))
            elif part:
                out += [words[w] for w in self.split(part)]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for digits, _ in self.pieces(text) for i in digits.split(" ")]

    def decode(self, ids) -> str:
        return " ".join(self.strings[i] for i in ids)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded``: the ids of every text and the text they decode to."""

    def run(batch: pa.RecordBatch) -> dict:
        v, ids, texts = vocabulary(path), [], []
        for text in batch.column("text").to_pylist():
            found = v.pieces(text)
            ids.append(np.array(" ".join([d for d, _ in found]).split(), np.int32))
            texts.append(" ".join([s for _, s in found]))
        return {"doc_id": batch.column("doc_id"), "ids": ids, "decoded": texts}

    return map_batches(text_rows(docs), run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the encoding and its decoding."""

    def run(batch: pa.RecordBatch) -> dict:
        v, n, ids, texts = vocabulary(path), [], [], []
        for text in batch.column("text").to_pylist():
            found = v.pieces(text)
            digits = " ".join([d for d, _ in found])
            n.append(digits.count(" ") + 1 if digits else 0)
            ids.append(hashlib.sha256(digits.encode()).hexdigest())
            texts.append(hashlib.sha256(" ".join([s for _, s in found]).encode()).hexdigest())
        return {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": texts}

    return map_batches(
        text_rows(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
