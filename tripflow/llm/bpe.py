"""Byte-level BPE with forced boundaries."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import map_batches
from tripflow.llm.encoders import BYTE_LEVEL_WORDS, byte_letters

#: Distinct words kept per task, some 200 bytes each, and texts worked on at a time.
WORDS_KEPT = 500_000
TEXTS_AT_ONCE = 512

_WORD = regex.compile(BYTE_LEVEL_WORDS)
# The same cuts, faster, for texts of these characters alone.
_COMMON = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ]*")
_COMMON_WORD = re.compile(
    r" ?[^\W\d_²³¹¼½¾]+|'s|'t|'re|'ve|'m|'ll|'d| ?[\d²³¹¼½¾]+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+"
)
_SHORT = 256


class Vocabulary:
    """Tokens as bytes, merges by pair of ids, and the byte pairs found inside tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        letters = byte_letters()
        model = definition["model"]
        self.special = {t["content"]: t["id"] for t in definition["added_tokens"]}
        self.tokens: dict[int, bytes] = {
            i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if t not in self.special
        }
        ids = {t: i for i, t in self.tokens.items()}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.ranks: dict[int, int] = {}  # of a pair of ids, packed in one number
        self.joined: list[int] = []  # by rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = (bytes(letters[c] for c in x) for x in (left, right))
            self.ranks[ids[a] << 32 | ids[b]] = rank
            self.joined.append(ids[a + b])
        self.inside = np.zeros(1 << 16, dtype=bool)
        for token in self.tokens.values():
            self.inside[[x << 8 | y for x, y in zip(token, token[1:], strict=False)]] = True
        self.tokens |= {i: t.encode() for t, i in self.special.items()}

    def fragments(self, words: Sequence[bytes]) -> list[list[bytes]]:
        """Each word cut between bytes no token holds side by side; no merge can cross there."""
        if not words:
            return []
        octets = np.frombuffer(b"".join(words), np.uint8).astype(np.uint16)
        cuts = np.flatnonzero(~self.inside[octets[:-1] << 8 | octets[1:]]) + 1
        ends = np.cumsum([len(w) for w in words])
        owner = np.searchsorted(ends, cuts, side="right")
        starts = ends - np.array([len(w) for w in words])
        found = [[w] for w in words]
        inner = cuts > starts[owner]  # the others are the words' own ends
        cuts, owner = cuts[inner], owner[inner]
        opens = np.flatnonzero(np.diff(owner, prepend=-1)).tolist()
        for first, last in pairwise([*opens, len(cuts)]):
            word = words[owner[first]]
            edges = [0, *(cuts[first:last] - starts[owner[first]]).tolist(), len(word)]
            found[owner[first]] = [word[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return found

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of a fragment: the lowest-ranked pair first, of equal ones the leftmost."""
        ids = [self.byte_ids[b] for b in fragment]
        return self._merge_short(ids) if len(ids) <= _SHORT else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank, none = self.ranks.get, len(self.joined)
        ranks = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            ids[i] = self.joined[least]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(ids[i] << 32 | ids[i + 1], none)
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 32 | ids[i], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, in n log n steps."""
        count = len(ids)
        after, ahead = list(range(1, count + 1)), list(range(-1, count - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            rank = self.ranks.get(ids[i] << 32 | ids[j])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(count - 1):
            offer(i, i + 1)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= count or ids[j] != right:
                continue
            ids[i], ids[j] = self.joined[rank], -1
            after[i] = after[j]
            if after[i] < count:
                ahead[after[i]] = i
                offer(i, after[i])
            if ahead[i] >= 0:
                offer(ahead[i], i)
        return [x for x in ids if x >= 0]


class Bpe:
    """Texts are cut into words and these at forced boundaries; each fragment is merged by itself.

    Distinct words of a slice of texts are encoded once, and remembered for the next.
    """

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.words: dict[str, bytes] = {}
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            cut = [self._cut(t) for t in texts[at : at + TEXTS_AT_ONCE]]
            if len(self.words) > WORDS_KEPT:
                self.words = {}
            met: set[str] = set()
            met.update(*cut)
            self._learn(list(met.difference(self.words)))
            known = self.words.__getitem__
            for words in cut:
                yield np.frombuffer(b"".join(map(known, words)), "<u4")

    def _cut(self, text: str) -> list[str]:
        """Words, and special tokens, which stand alone."""
        if not any(s in text for s in self.vocabulary.special):
            return _COMMON_WORD.findall(text) if _COMMON.fullmatch(text) else _WORD.findall(text)
        found: list[str] = []
        for at, part in enumerate(self.special.split(text)):
            found += [part] if at % 2 else _WORD.findall(part)
        return found

    def _learn(self, new: list[str]) -> None:
        merge = self.vocabulary.merge
        for word, fragments in zip(new, self.vocabulary.fragments([w.encode() for w in new]), strict=True):
            special = self.vocabulary.special.get(word)
            ids = [i for f in fragments for i in merge(f)] if special is None else [special]
            self.words[word] = struct.pack(f"<{len(ids)}I", *ids)

    def decode(self, ids: Iterable[int]) -> str:
        """Bytes of all ids together; what is no UTF-8 becomes replacement characters."""
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids)).decode("utf-8", "replace")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of every text; a null text counts as empty and has no ids.

    Null and repeated ids keep their rows, an empty table gives an empty result, and other
    columns are not read.
    """

    def make():
        bpe = Bpe(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [i.astype(np.int32) for i in bpe.encode(batch.column(1).to_pylist())]
            ids = pa.array(found, pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

        return step

    return map_batches(_texts(docs, id_col, text_col), "doc_id bigint, ids array<int>", make)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``text`` of every row of ids; null ids give a null text."""

    def make():
        bpe = Bpe(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if i is None else bpe.decode(i) for i in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

        return step

    rows = encoded.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{ids_col}`").alias("ids"))
    return map_batches(rows, "doc_id bigint, text string", make)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and SHA-256 of the ids and of the text decoded from them.

    Encodes and decodes in one task, so that ids need not travel; rows as in ``encode``.
    """

    def make():
        bpe = Bpe(path)
        names = [str(i) for i in range(max(bpe.vocabulary.tokens) + 1)]

        def digests(found: np.ndarray) -> tuple[int, str, str]:
            ids = found.tolist()
            listed = ",".join(map(names.__getitem__, ids))
            return len(ids), _sha256(listed), _sha256(bpe.decode(ids))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found: Sequence[tuple[int, str, str]] = [digests(ids) for ids in bpe.encode(batch.column(1).to_pylist())]
            columns = [
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([f[1] for f in found], pa.string()),
                pa.array([f[2] for f in found], pa.string()),
            ]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(_texts(docs, id_col, text_col), schema, make)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
