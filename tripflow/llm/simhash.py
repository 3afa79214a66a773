"""SimHash near-duplicates through a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import key_runs, map_batches, run_starts, stored
from tripflow.llm.components import components, joined_apart

SHINGLE_WORDS = 3
MAX_BITS = 2
_SEED = 42
GROUP_WORDS = 1 << 14  # of a group of evenly spread fingerprints
_FANOUT = 16
_QUERIES = 2048
_ROWS = 1 << 16


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the text's word shingles, repeats included.

    Letters A-Z are lower-cased and words end at ASCII white space, which are exactly
    the rules of ``bytes.lower`` and ``bytes.split``. Fewer words than a shingle form
    one; no word gives zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends[:-1]]
    last = [e - 1 for e in ends[width - 1 :]] or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], _SEED) for a, b in zip(starts, last, strict=False)), np.uint64, len(last)
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _ROWS):
        octets = hashes[at : at + _ROWS].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _printed(rows: DataFrame, width: int) -> DataFrame:
    """The column ``text``, the last one, replaced by ``print``, the fingerprint's bits as a signed long."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            bits = np.array([fingerprint(t, width) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            columns = [*batch.columns[:-1], pa.array(bits.view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "print"])

        return step

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return map_batches(rows, f"{schema}, print bigint", make)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``print`` (the fingerprint's bits as a signed long) per row."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _printed(rows, width)


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """Place of each word in the reflected Gray sequence, where neighbours differ in one bit."""
    rank = bits.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical Hamming index over groups of distinct fingerprints.

    ``bits`` is sorted by group, and within it by Gray rank, so that neighbours share long
    bit patterns. Level 0 holds the fingerprints; a node above covers up to ``_FANOUT``
    nodes of its group below and carries the bits all of them share that its parent does
    not carry already. A search adds up differences on those bits on its way down and
    gives up a whole node once they exceed the limit.
    """

    def __init__(self, bits: np.ndarray, group_starts: np.ndarray) -> None:
        rows = len(bits)
        full = ~np.uint64(0)
        group = np.zeros(rows, dtype=np.int64)
        group[group_starts[1:]] = 1
        group = np.cumsum(group)
        place = np.arange(rows) - group_starts[group]
        pattern = [bits]
        mask = [np.full(rows, full)]
        self.first: list[np.ndarray] = []  # first child of each node, per level above 0
        self.count: list[np.ndarray] = []
        while len(pattern[-1]) > len(group_starts):
            opens = np.flatnonzero(place % _FANOUT == 0)
            both = np.bitwise_and.reduceat(pattern[-1] & mask[-1], opens)
            neither = np.bitwise_and.reduceat(~pattern[-1] & mask[-1], opens)
            self.first.append(opens)
            self.count.append(np.diff(np.append(opens, len(place))))
            group = group[opens]
            place = place[opens] // _FANOUT
            pattern.append(both)
            mask.append(both | neither)
        self.pattern = pattern
        own = []
        for level, bits_shared in enumerate(mask):
            above = np.zeros(len(bits_shared), dtype=np.uint64)
            if level < len(self.first):
                above = np.repeat(mask[level + 1], self.count[level])
            own.append(bits_shared & ~above)
        self.own = own
        self.root = group  # of each node of the top level, in order
        self.given_up = [0] * len(pattern)  # nodes of each level that searches did not open

    def links(self, queries: np.ndarray, groups: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Query number and fingerprint number of every pair within ``limit`` bits."""
        top = len(self.pattern) - 1
        query = np.arange(len(queries))
        node = groups.copy()  # the top level has one root per group
        apart = np.bitwise_count((queries ^ self.pattern[top][node]) & self.own[top][node]).astype(np.int64)
        near = apart <= limit
        self.given_up[top] += int((~near).sum())
        query, node, apart = query[near], node[near], apart[near]
        for level in range(top, 0, -1):
            count = self.count[level - 1][node]
            query = np.repeat(query, count)
            apart = np.repeat(apart, count)
            opens = np.cumsum(count) - count
            node = np.arange(len(query)) - np.repeat(opens, count) + np.repeat(self.first[level - 1][node], count)
            apart = apart + np.bitwise_count((queries[query] ^ self.pattern[level - 1][node]) & self.own[level - 1][node])
            near = apart <= limit
            self.given_up[level - 1] += int((~near).sum())
            query, node, apart = query[near], node[near], apart[near]
        return query, node


def _local_roots(bits: np.ndarray, group_starts: np.ndarray, limit: int) -> np.ndarray:
    """For each fingerprint, the number of the first one it is linked to within its group."""
    index = GrayIndex(bits, group_starts)
    label = np.arange(len(bits))
    group = np.searchsorted(group_starts, label, side="right") - 1
    for at in range(0, len(bits), _QUERIES):
        query, node = index.links(bits[at : at + _QUERIES], group[at : at + _QUERIES], limit)
        query = query + at
        later = node < query
        query, node = query[later], node[later]
        while len(query):
            low = np.minimum(label[query], label[node])
            np.minimum.at(label, label[query], low)
            np.minimum.at(label, label[node], low)
            label = label[label]
            open_ = label[query] != label[node]
            query, node = query[open_], node[open_]
    while True:
        jumped = label[label]
        if (jumped == label).all():
            return label
        label = jumped


def _band_masks(limit: int, free: int, width: int) -> list[int]:
    """``limit + 1`` masks of ``width`` of the free bits each; one of none if there is no width.

    Words that differ in up to ``limit`` bits, free ones all of them, share the bits of one of
    the masks, since each difference lies in one of them at most.
    """
    bits = [bit for bit in range(63, -1, -1) if free >> bit & 1]
    bands = [bits[i * width : (i + 1) * width] for i in range(limit + 1)] if width else [[]]
    return [sum(1 << bit for bit in band) for band in bands]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _finer(limit: int, least_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each large group the masks by which it is dealt again: thirds of the bits its words differ in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for mask, shared, varying in zip(*(batch.column(c).to_pylist() for c in ("mask", "shared", "varying")), strict=True):
                free = varying & (1 << 64) - 1
                if free.bit_count() > least_bits:  # else distinctness alone bounds the group
                    width = free.bit_count() // (limit + 1)
                    rows += [(mask, shared, _signed(mask & (1 << 64) - 1 | m)) for m in _band_masks(limit, free, width)]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(columns, ["mask", "shared", "finer"])

    return run


def _groups(words: DataFrame, limit: int, group_words: int) -> list[DataFrame]:
    """The words (``print``) dealt to groups by the bits that ``mask`` keeps (``shared``).

    The masks keep so few bits that evenly spread words form groups of about ``group_words``.
    A group that is counted to be eight times as large is dealt again by a third of the bits
    in which its words differ, until these alone bound it. Any two words within ``limit`` bits
    meet in some group.
    """
    shared = F.col("print").bitwiseAND(F.col("mask")).alias("shared")
    width = min(max((words.count() // group_words).bit_length() - 1, 0), 64 // (limit + 1))
    masks = [F.lit(_signed(m)).cast("bigint") for m in _band_masks(limit, (1 << 64) - 1, width)]
    rows = words.select(F.explode(F.array(*masks)).alias("mask"), "print").select("mask", shared, "print")
    most = 8 * group_words
    found = []
    while True:
        varying = F.bit_or("print").bitwiseXOR(F.bit_and("print")).alias("varying")
        sizes = rows.groupBy("mask", "shared").agg(F.count("*").alias("n"), varying)
        large = sizes.filter(F.col("n") > most)
        large = large.mapInArrow(_finer(limit, most.bit_length() - 1), "mask bigint, shared bigint, finer bigint")
        large = stored(large, "large-groups")
        if large.isEmpty():
            return [*found, rows]
        found.append(rows.join(large, ["mask", "shared"], "left_anti"))
        again = rows.join(large, ["mask", "shared"]).select(F.col("finer").alias("mask"), "print").distinct()
        rows = stored(again.select("mask", shared, "print"), "dealt-again")


def links(prints: DataFrame, limit: int = MAX_BITS, group_words: int = GROUP_WORDS) -> DataFrame:
    """Edges ``u``, ``v`` that span all links of distinct fingerprints (column ``print``).

    Fingerprints are dealt to groups by few of their bits, three times for two bits, so that
    a group is large enough for the Gray-order index to do the search: sorted by Gray rank,
    with upper nodes of shared bit patterns, most of which are given up unopened. No group is
    unbounded, whatever the data (``_groups``); many copies of a text are one fingerprint. A
    group gives one edge per linked fingerprint rather than every pair.
    """
    words = stored(prints.select("print"), "words")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, ["mask", "shared"]):
            starts = run_starts([rows.column("mask"), rows.column("shared")])
            sizes = np.diff(np.append(starts, rows.num_rows))
            bits = rows.column("print").to_numpy().astype(np.int64).view(np.uint64)
            paired = np.repeat(sizes > 1, sizes)
            bits = bits[paired]
            if not len(bits):
                continue
            sizes = sizes[sizes > 1]
            starts = np.cumsum(sizes) - sizes
            order = np.lexsort((gray_rank(bits), np.repeat(np.arange(len(sizes)), sizes)))
            bits = bits[order]
            root = _local_roots(bits, starts, limit)
            linked = root != np.arange(len(bits))
            found = [pa.array(bits[linked].view(np.int64)), pa.array(bits[root[linked]].view(np.int64))]
            yield pa.RecordBatch.from_arrays(found, ["u", "v"])

    edges = []
    for rows in _groups(words, limit, group_words):
        dealt = rows.select("mask", "shared", "print").repartition("mask", "shared").sortWithinPartitions("mask", "shared")
        edges.append(dealt.mapInArrow(search, "u bigint, v bigint"))
    return reduce(DataFrame.unionByName, edges)


def hex_print(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    limit: int = MAX_BITS,
) -> DataFrame:
    """Per row ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    Rows are linked if their fingerprints differ in at most ``limit`` bits;
    ``component_id`` is the smallest id reachable over links. Null and empty texts have
    fingerprint zero and are linked like any other. A row with a null id takes part and
    names no component (null if all ids of it are null). Repeated rows are kept, an empty
    table gives an empty result, and other columns are not read.
    """
    prints = stored(fingerprints(docs, id_col, text_col, width), "prints")
    distinct = prints.groupBy("print").agg(F.min("doc_id").alias("least_id"))
    member = components(links(prints.select("print").distinct(), limit)).withColumnRenamed("node", "print")
    linked = distinct.join(member, "print")
    least = linked.groupBy("root").agg(F.min("least_id").alias("linked_id"))
    named = joined_apart(member, least, "root").select("print", "linked_id")
    component = distinct.join(named, "print", "left").select(
        "print", F.coalesce("linked_id", "least_id").alias("component_id")
    )
    found = joined_apart(prints, component, "print")
    return found.select("doc_id", hex_print("print").alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    limit: int = MAX_BITS,
) -> DataFrame:
    """One row of each near-duplicate component, all columns.

    It is the row of the smallest id, nulls last; among rows of one id the smallest row
    hash decides, and among rows repeated in full their place. Rows are stored with a
    number first, so that the choice names one row whatever ids they carry. The best row
    of each fingerprint and then of each component is found in the map task first, so a
    hot id, or many rows without one, reach no task together. Only the numbers of the rows
    that go are then joined with the rows.

    Null and empty texts have fingerprint zero and are one component with those within
    ``limit`` bits of it; an empty table stays empty; column names may be any.
    """
    number = "_number"
    while number in docs.columns:
        number += "_"
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    rows = numbered.select(
        F.col(number).alias("number"),
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.xxhash64(*hashed).alias("hash"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    rows = stored(_printed(rows, width), "prints")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "hash", "number")
    best = rows.groupBy("print").agg(F.min(place).alias("best"))
    member = components(links(rows.select("print").distinct(), limit)).withColumnRenamed("node", "print")
    root = F.coalesce("root", "print").alias("root")
    first = best.join(member, "print", "left").select(root, "best").groupBy("root").agg(F.min("best").alias("best"))
    kept = stored(first.select(F.col("best.number").alias("number")), "kept")
    gone = stored(rows.select("number").join(kept, "number", "left_anti"), "gone").withColumnRenamed("number", number)
    return numbered.join(gone, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
