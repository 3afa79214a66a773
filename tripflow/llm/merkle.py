"""Merkle manifest of a dataset, with inclusion proofs found by pointer jumping.

Rows are the leaves of one tree a source, in order of their ids; the trees' roots are the
leaves of a tree of their own, in order of the sources. Every node knows the siblings it
is hashed with on the way to its parent. Pointers then jump: a node takes over its
ancestor's pointer and appends the ancestor's segment of siblings to its own, so that the
distance doubles with every self-join until each node reaches the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import dropped, key_runs, run_starts, spans_of, stored

ARITY = 3
#: Levels that one task builds above a run of consecutive nodes: 3^7 = 2,187 of them.
LEVELS = 7

# How a column enters its row's hash.
_NULL, _SEPARATOR = "-", ":"

_ALL = "/"  # names the tree over all sources; a source's own name begins with "=" or is empty
_STEP = "array<struct<left:binary,right:binary>>"


def leaf_hash(columns: Sequence[Column]) -> Column:
    """SHA-256, in hex, of the columns' texts, each behind its length in bytes; ``-`` for a null."""

    def part(column: Column) -> Column:
        text = column.cast("string")
        known = F.concat(F.octet_length(text).cast("string"), F.lit(_SEPARATOR), text)
        return F.coalesce(known, F.lit(_NULL))

    return F.sha2(F.concat(*map(part, columns)), 256)


def _ranked(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows with ``index`` (their place in their ``tree``, from 0), and ``height`` (levels above the leaves).

    All rows are sorted once over all tasks; a task's rows of a tree are then counted, and
    what comes before them in other tasks is added up from these counts. So a tree that
    holds most rows is ranked by many tasks. ``order`` ends in a column that differs in
    every row, by which repeated rows are split as well.
    """
    dealt = rows.repartitionByRange(F.col("tree"), *map(F.col, order)).sortWithinPartitions("tree", *order)
    placed = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    task = F.shiftright("_at", 33).alias("_task")
    counts = placed.groupBy("tree", task).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")
    before = F.sum("_rows").over(tree.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(
        F.col("tree").alias("_tree"),
        F.col("_task").alias("_of"),
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(tree).alias("_total"),
    )
    found = placed.join(offsets, (F.col("tree") == F.col("_tree")) & (task == F.col("_of")))
    kept = [c for c in placed.columns if c != "_at"]
    return found.select(
        *kept, (F.col("_at") + F.col("_shift")).alias("index"), _height(F.col("_total")).alias("height")
    )


def _height(leaves: Column) -> Column:
    """Levels above so many leaves: the number of powers of the arity below it."""
    powers = [ARITY**k for k in range(40) if ARITY**k < 2**63]
    return sum((F.when(leaves > p, 1).otherwise(0) for p in powers), F.lit(0)).cast("int")


def _hashed(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


_NODE = f"tree string, level int, index bigint, height int, hash binary, above binary, step {_STEP}"


def _grown(nodes: DataFrame, base: int, carry: Sequence[str]) -> DataFrame:
    """All nodes over those of level ``base`` within runs of 3^LEVELS, those at the bottom included.

    ``nodes`` has ``tree``, ``index``, ``height``, ``hash`` and the carried columns. Each node
    comes with its parent's hash (``above``) and the siblings left and right of it
    (``step``); those of the topmost level built lack both. Carried columns are null above ``base``.
    """
    width = ARITY**LEVELS
    run = F.floor(F.col("index") / F.lit(width)).alias("run")
    dealt = nodes.select("tree", run, "index", "height", "hash", *carry)
    dealt = dealt.repartition("tree", "run").sortWithinPartitions("tree", "run", "index")
    kind = nodes.select(*carry).schema
    step = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, ["tree", "run"]):
            tree, first = rows.column("tree").to_pylist(), rows.column("index").to_numpy()
            height, hashes = rows.column("height").to_numpy(), rows.column("hash").to_pylist()
            number: list[int] = []  # of the bottom row whose carried columns go with a node
            out: list[tuple] = []
            for a, z in spans_of(run_starts([rows.column("tree"), rows.column("run")]), rows.num_rows):
                name, top, at, level = tree[a], int(height[a]), int(first[a]), base
                line, own = hashes[a:z], list(range(a, z))
                while True:
                    last = level == top or level == base + LEVELS
                    above = [] if last else [_hashed(line[i : i + ARITY]) for i in range(0, len(line), ARITY)]
                    for i, digest in enumerate(line):
                        parent = None if last else above[i // ARITY]
                        low = i - i % ARITY
                        siblings = None if last else [(b"".join(line[low:i]), b"".join(line[i + 1 : low + ARITY]))]
                        out.append((name, level, at + i, top, digest, parent, siblings))
                    number += own
                    if last:
                        break
                    line, own, at, level = above, [None] * len(above), at // ARITY, level + 1
            own = pa.array(number, pa.int64())
            columns = list(zip(*out, strict=True))
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            steps = [None if s is None else [{"left": p, "right": q} for p, q in s] for s in columns[6]]
            arrays.append(pa.array(steps, step))
            carried = [rows.column(c).combine_chunks().take(own) for c in carry]
            names = ["tree", "level", "index", "height", "hash", "above", "step", *carry]
            yield from pa.table([*arrays, *carried], names).to_batches(max_chunksize=10_000)

    others = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kind)
    return dealt.mapInArrow(grow, _NODE + others)


def _tree(leaves: DataFrame, carry: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Stored nodes of every tree: the leaves with their carried columns, and all others.

    Each pass builds ``LEVELS`` levels; what it leaves at its top goes through the next one.
    """
    built = stored(_grown(leaves, 0, carry), name)
    bottom = built.filter("level = 0")
    upper = built.filter("level > 0").drop(*carry)
    top = built.agg(F.max("height").alias("h")).first()["h"] or 0
    base = LEVELS
    while base < top:
        again = stored(_grown(upper.filter(F.col("level") == base).select("tree", "index", "height", "hash"), base, []), name)
        # the topmost nodes of the pass before come again, now with parents
        kept = (F.col("level") != base) | (F.col("height") == base)
        upper = upper.filter(kept).unionByName(again.filter((F.col("level") > base) | (F.col("height") > base)))
        base += LEVELS
    return bottom, upper


def _parent(index: Column) -> Column:
    return F.floor(index / F.lit(ARITY)).cast("bigint")


def prove(docs: DataFrame, id_col: str, source_col: str, columns: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Per row ``doc_id``, ``leaf``, ``subroot``, ``root`` (hex) and ``proof``, then the columns of ``carry``.

    A leaf hashes ``columns`` (``leaf_hash``). The leaves of a source ascend by id, a null id
    first, rows of one id by their leaf; every three consecutive nodes, at the end fewer,
    become the hash of their digests in hex, until one is left, the subroot. The
    subroots, in order of the sources' bytes, a null source first, become the root in the
    same way. ``proof`` lists the siblings left and right of each node from the leaf to the
    root; both are empty where a node is alone in its run. ``fold`` leads a leaf to the root
    with it.

    Every row has its leaf, repeated rows one each, and null or empty texts and very long
    ones are hashed like any others. An empty table gives an empty result.
    """
    carried = [f"_carried_{i}" for i in range(len(carry))]
    name = F.col(f"`{source_col}`").cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("tree"),
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.unhex(leaf_hash([F.col(f"`{c}`") for c in columns])).alias("hash"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(carry, carried, strict=True)],
        F.monotonically_increasing_id().alias("number"),
    )
    leaves = stored(leaves, "leaves")
    own = ["doc_id", *carried]
    ranked = _ranked(leaves, ["doc_id", "hash", "number"], "ordered-leaves")
    bottom, upper = _tree(ranked, own, "nodes")

    lone = F.col("height") == 0
    subroots = bottom.filter(lone).select("tree", "hash", "height").unionByName(
        upper.filter("level = height").select("tree", "hash", "height")
    )
    over = subroots.select(F.lit(_ALL).alias("tree"), F.col("tree").alias("source"), F.col("height").alias("below"), "hash")
    top_leaves, top_upper = _tree(_ranked(over, ["source"], "ordered-subroots"), ["source", "below"], "top-nodes")
    peak = top_leaves.filter("level = height").select("hash").unionByName(
        top_upper.filter("level = height").select("hash")
    ).first()
    root = F.lower(F.hex(F.lit(bytes(peak["hash"]) if peak else b"")))

    below = upper.filter("level < height").select(
        "tree", "level", "index", "step",
        F.struct("tree", (F.col("level") + 1).alias("level"), _parent(F.col("index")).alias("index")).alias("up"),
        F.when(F.col("level") + 1 == F.col("height"), F.col("above")).alias("subroot"),
    )
    turned = top_leaves.select(
        F.col("source").alias("tree"), F.col("below").alias("level"), F.lit(0).cast("bigint").alias("index"),
        F.coalesce("step", F.array().cast(_STEP)).alias("step"),
        F.when(F.col("height") > 0, F.struct(
            F.lit(_ALL).alias("tree"), F.lit(1).alias("level"), _parent(F.col("index")).alias("index")
        )).alias("up"),
        F.col("hash").alias("subroot"),
    )
    above = top_upper.select(
        "tree", "level", "index", F.coalesce("step", F.array().cast(_STEP)).alias("step"),
        F.when(F.col("level") < F.col("height"), F.struct(
            "tree", (F.col("level") + 1).alias("level"), _parent(F.col("index")).alias("index")
        )).alias("up"),
        F.lit(None).cast("binary").alias("subroot"),
    )
    nodes = _jumped(stored(below.unionByName(turned).unionByName(above), "pointers"))

    up = F.when(lone, F.struct("tree", F.lit(0).alias("level"), F.lit(0).cast("bigint").alias("index"))).otherwise(
        F.struct("tree", F.lit(1).alias("level"), _parent(F.col("index")).alias("index"))
    )
    first = F.coalesce("step", F.array().cast(_STEP)).alias("_first")
    waiting = bottom.select(up.alias("_up"), first, "hash", "above", "height", *own)
    ends = nodes.select(F.struct("tree", "level", "index").alias("_node"), "step", "subroot")
    found = waiting.join(ends, F.col("_up") == F.col("_node"))
    hexed = lambda c: F.lower(F.hex(c))
    return found.select(
        "doc_id",
        hexed("hash").alias("leaf"),
        hexed("subroot").alias("subroot"),
        root.alias("root"),
        F.concat("_first", "step").alias("proof"),
        *[F.col(n).alias(c) for c, n in zip(carry, carried, strict=True)],
    )


def _jumped(nodes: DataFrame) -> DataFrame:
    """Every node with the whole segment from itself to the root.

    ``up`` points to an ancestor, and is null once the root is reached. In each round all
    nodes that still point somewhere are joined with the nodes they point to and take over
    their pointers, segments and, if they know none, subroots. The rounds are logarithmic in the
    depth, each is stored, and nodes under one ancestor may be split, since both sides are
    shuffled for the join.
    """
    while True:
        waits = nodes.filter("up IS NOT NULL")
        if waits.isEmpty():
            return nodes
        ends = nodes.select(
            F.struct("tree", "level", "index").alias("_node"), F.col("up").alias("_up"),
            F.col("step").alias("_step"), F.col("subroot").alias("_subroot"),
        )
        met = waits.join(ends, F.col("up") == F.col("_node")).select(
            "tree", "level", "index", F.concat("step", "_step").alias("step"), F.col("_up").alias("up"),
            F.coalesce("subroot", "_subroot").alias("subroot"),
        )
        after = stored(nodes.filter("up IS NULL").unionByName(met), "pointers")
        dropped(nodes)
        nodes = after


def fold(leaf: Column, proof: Column) -> Column:
    """The root, in hex, that a leaf (hex) and its proof lead to."""
    hexed = lambda c: F.lower(F.hex(c))
    return F.aggregate(
        proof, leaf, lambda at, step: F.sha2(F.concat(hexed(step["left"]), at, hexed(step["right"])), 256)
    )


def proof_hash(proof: Column) -> Column:
    """SHA-256 of all siblings in hex, level by level, left to right."""
    hexed = lambda c: F.lower(F.hex(c))
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), ""), 256)


# The columns of a leaf in their order, and which ids are tampered with.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_DIVISOR = 2


def tampered(docs: DataFrame) -> DataFrame:
    """Adds ``tampered_leaf``: the leaf without the text's line ends, where the id's checksum is even, else null."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_DIVISOR == 0
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    columns = [cut if c == "text" else F.col(c) for c in LEAF_COLUMNS]
    return docs.withColumn("tampered_leaf", F.when(chosen, leaf_hash(columns)))


def manifest(docs: DataFrame) -> DataFrame:
    """The contract's columns: proofs of ``documents``, folded again from rows some of which were tampered with.

    Rows without an id are not tampered with. Columns beyond those of the leaf are not read.
    """
    changed = tampered(docs.select(*LEAF_COLUMNS))
    proved = prove(changed, "doc_id", "source", LEAF_COLUMNS, carry=["tampered_leaf"])
    folded = fold(F.coalesce("tampered_leaf", "leaf"), F.col("proof")).alias("folded_root")
    found = proved.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"), folded)
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
