"""Line deduplication by content-defined chunks, in DataFrame operations only.

A rolling hash over line hashes cuts texts into chunks of two lines or more, at places that
do not move when lines are added elsewhere. Chunks that occur again go. What a repeated
passage leaves beside them, since its ends lie in chunks of mixed lines, goes by its two-line
windows. Both are compared by the digests of their lines, after the texts of all lines that
share a digest have been compared byte by byte.

Only digests are shuffled, and texts of repeated lines once for their comparison: rows stay
where they were stored, and what is found out about them comes to them by block.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import stored, stored_in_place

WINDOW = 2  # lines whose hashes decide on a boundary
DIVISOR = 3  # one line in so many may end a chunk
_BASE = 1_000_003
_MODULUS = 2_147_483_647
_BLOCK_BITS = 14  # a block has 2^14 rows at most

Digest = Callable[[Column], Column]


def md5(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _as_row(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator of one row each.

    The optimizer does not merge expressions across it, so an array that the lambdas of
    the next step look into is computed once per row and not once per element.
    """
    packed = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_packed")
    return df.select("*", packed).select(*df.columns, *[F.col(f"_packed.{n}").alias(n) for n in columns])


def _candidates(digests: Column, window: int, divisor: int) -> Column:
    """Per line whether the rolling hash of the ``window`` lines up to it is divisible."""
    hashes = F.transform(digests, lambda d: F.conv(F.hex(F.substring(d, 1, 4)), 16, 10).cast("bigint"))
    count = F.size(digests)
    none = F.lit(0).cast("bigint")
    back = [
        F.concat(F.array_repeat(none, k), F.slice(hashes, 1, F.greatest(count - k, F.lit(0)))) for k in range(window)
    ]

    def divisible(row: Column) -> Column:
        oldest_first = [row[str(k)] for k in range(window - 1, -1, -1)]
        return reduce(lambda value, item: (value * _BASE + item) % _MODULUS, oldest_first, none) % divisor == 0

    return F.transform(F.arrays_zip(*back), divisible)


def _ends(candidates: Column) -> Column:
    """Lines, from 1, that end a chunk: the last one, and candidates that follow none.

    So two ends are never neighbours; none leaves a single line at either end of the text.
    """
    count = F.size(candidates)

    def ends(line: Column) -> Column:
        first = F.get(candidates, line - 1) & ~F.coalesce(F.get(candidates, line - 2), F.lit(False))
        return (line == count) | (first & (line > 1) & (line < count - 1))

    return F.filter(F.sequence(F.lit(1), count), ends)


def _cut(rows: DataFrame, window: int, divisor: int, digest: Digest) -> DataFrame:
    """Per row ``number``, ``id``, ``n_chunks`` and ``lines``: place, digest, and first line and size of the chunk."""
    found = _as_row(rows.filter("text IS NOT NULL"), digests=F.transform(F.split("text", "\n"), digest)).drop("text")
    found = _as_row(found, candidates=_candidates(F.col("digests"), window, divisor))
    found = _as_row(found, ends=_ends(F.col("candidates"))).drop("candidates")

    def chunk(number: Column) -> Column:
        before = F.coalesce(F.get("ends", number - 2), F.lit(0))
        last = F.get("ends", number - 1)
        return F.transform(F.sequence(before + 1, last), lambda at: F.struct(
            at.alias("at"), F.get("digests", at - 1).alias("digest"), (before + 1).alias("start"), (last - before).alias("size")
        ))

    lines = F.flatten(F.transform(F.sequence(F.lit(1), F.size("ends")), chunk))
    return found.select("number", "id", F.size("ends").alias("n_chunks"), lines.alias("lines"))


def _to_blocks(values: DataFrame, numbers: DataFrame) -> DataFrame:
    """``values`` (by ``number``) as one array a block, with a place for each of the block's rows."""
    index = F.col("number").bitwiseAND((1 << _BLOCK_BITS) - 1)
    every = numbers.join(values, "number", "left")
    block = F.shiftright("number", _BLOCK_BITS).alias("block")
    value = F.struct(*[c for c in values.columns if c != "number"])
    listed = F.array_sort(F.collect_list(F.struct(index.alias("index"), value.alias("value"))))
    found = every.groupBy(block).agg(listed.alias("listed"))
    return found.select("block", F.transform("listed", lambda x: x["value"]).alias("values"))


def _brought(rows: DataFrame, blocks: DataFrame, buckets: int) -> DataFrame:
    """The stored rows with their ``value``; only the blocks' arrays are shuffled."""
    come = blocks.repartition(buckets, "block").hint("shuffle_hash")
    index = F.col("number").bitwiseAND((1 << _BLOCK_BITS) - 1).cast("int")
    return rows.join(come, "block").withColumn("value", F.get("values", index)).drop("values")


def _repeated(lines: DataFrame) -> DataFrame:
    """Per row its lines whose digest occurs more than once, in order."""
    often = lines.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    return _by_row(lines.join(stored(often, "repeated-digests"), "digest", "left_semi"))


def _by_row(lines: DataFrame) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct("at", "digest", "start", "size")))
    return lines.groupBy("number", "id").agg(listed.alias("lines"))


def _told_apart(found: DataFrame, rows: DataFrame, numbers: DataFrame, buckets: int, digest: Digest) -> DataFrame:
    """The repeated lines, once their texts were compared: where several texts share a digest, the text joins it."""

    def texts(lines: DataFrame) -> DataFrame:
        places = lines.select("number", F.transform("lines", lambda x: x["at"]).alias("places"))
        near = _brought(rows.select("number", "block", "text"), _to_blocks(places, numbers), buckets)
        near = _as_row(near.filter("value.places IS NOT NULL"), split=F.split("text", "\n")).drop("text")
        one = F.explode(F.transform("value.places", lambda at: F.struct(at.alias("at"), F.get("split", at - 1).alias("line"))))
        return near.select("number", one.alias("one")).select("number", "one.at", digest(F.col("one.line")).alias("digest"), "one.line")

    different = texts(found).select("digest", "line").distinct().groupBy("digest").count().filter("count > 1")
    shared = stored(different.select("digest"), "shared-digests")
    if shared.isEmpty():
        return found
    lines = found.select("number", "id", F.explode("lines").alias("one")).select("number", "id", "one.*")
    alone = lines.join(shared, "digest", "left_anti")
    named = texts(found).join(shared, "digest", "left_semi").select("number", "at", F.concat("digest", F.encode("line", "UTF-8")).alias("named"))
    others = lines.join(shared, "digest", "left_semi").drop("digest").join(named, ["number", "at"])
    return stored(_by_row(alone.unionByName(others.withColumnRenamed("named", "digest"))), "repeated-lines")


def _later(pieces: DataFrame) -> DataFrame:
    """Pieces (``key``, ``id``, ``number``, ``at``) of which an equal one comes before."""
    place = F.struct("id", "number", "at")
    firsts = pieces.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = stored(firsts.select(F.col("key").alias("of"), "first"), "first-places")
    return pieces.join(firsts, F.col("key") == F.col("of")).filter(place != F.col("first"))


def _removed(found: DataFrame, empty: Column) -> DataFrame:
    """``number`` and ``gone``: lines of chunks and of two-line windows that occurred before."""
    index = F.sequence(F.lit(0), F.size("lines") - 1)
    line = lambda i: F.get("lines", i)
    digests = lambda part: F.transform(part, lambda x: x["digest"])

    def whole(i: Column) -> Column:  # all lines of a chunk are repeated ones
        size = line(i)["size"]
        last = F.get("lines", i + size - 1)["at"]
        return (line(i)["at"] == line(i)["start"]) & (size > 1) & (last == line(i)["start"] + size - 1)

    chunks = F.transform(F.filter(index, whole), lambda i: F.struct(
        line(i)["at"].alias("at"), line(i)["size"].alias("size"), digests(F.slice("lines", i + 1, line(i)["size"])).alias("key")
    ))
    windows = F.transform(F.filter(index, lambda i: F.get("lines", i + 1)["at"] == line(i)["at"] + 1), lambda i: F.struct(
        line(i)["at"].alias("at"), F.lit(2).alias("size"), F.array(line(i)["digest"], F.get("lines", i + 1)["digest"]).alias("key")
    ))

    def later(pieces: Column) -> DataFrame:
        each = found.select("id", "number", F.explode(pieces).alias("one")).select("id", "number", "one.*")
        each = each.filter(F.exists("key", lambda d: d != empty))
        return _later(each).select("number", F.sequence(F.col("at"), F.col("at") + F.col("size") - 1).alias("at"))

    every = later(chunks).unionByName(later(windows))
    return every.groupBy("number").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("gone"))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    divisor: int = DIVISOR,
    report: bool = False,
    digest: Digest = md5,
) -> DataFrame:
    """The same rows and columns, repeated runs of two or more lines taken out of the text.

    Texts are cut into chunks of two lines or more where a rolling hash over the last
    ``window`` line hashes is divisible by ``divisor``. A chunk goes if an equal one comes
    before it, in its own text or another, and so do two neighbouring lines that come
    before as neighbours. Before means a smaller id, a null id first, then the row read first,
    then the place in the text; the first occurrence of a line always stays. Lines that share
    a ``digest`` are compared byte by byte and told apart if they differ. Runs of empty lines
    alone are no repeats.

    A null text stays null, an empty one empty; a text all of whose lines go becomes empty and
    its row stays, also where rows are repeated in full. An empty table stays empty. ``report``
    adds ``n_chunks`` and ``n_removed`` (lines), in place of columns of these names.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.monotonically_increasing_id().alias("number")
    names = [f"c{i}" for i in range(len(docs.columns))]
    named = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)],
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), number,
    )
    named = named.drop(names[docs.columns.index(text_col)])
    rows = stored_in_place(named.withColumn("block", F.shiftright("number", _BLOCK_BITS)), buckets, "block", "number")
    cut = stored(_cut(rows.select("number", "id", "text"), window, divisor, digest), "line-digests")
    lines = cut.select("number", "id", F.explode("lines").alias("one")).select("number", "id", "one.*")
    numbers = rows.select("number")
    found = stored(_repeated(lines), "repeated-lines")
    found = _told_apart(found, rows, numbers, buckets, digest)
    gone = _removed(found, digest(F.lit("")))
    values = cut.select("number", F.col("n_chunks").cast("bigint").alias("n_chunks")).join(stored(gone, "gone"), "number", "left")
    near = _brought(rows, _to_blocks(values, numbers), buckets)
    near = _as_row(near, split=F.when(F.col("value.gone").isNotNull(), F.split("text", "\n")))
    left = F.array_except(F.sequence(F.lit(1), F.size("split")), F.col("value.gone"))
    text = F.when(F.col("split").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda at: F.get("split", at - 1)), "\n")
    )
    counts = {
        "n_chunks": F.coalesce("value.n_chunks", F.lit(0).cast("bigint")),
        "n_removed": F.coalesce(F.size("value.gone"), F.lit(0)).cast("bigint"),
    }
    columns = [
        text.alias(c) if c == text_col else F.col(n).alias(c)
        for c, n in zip(docs.columns, names, strict=True)
        if not report or c not in counts
    ]
    return near.select(*columns, *([c.alias(n) for n, c in counts.items()] if report else []))


ORACLE = f"""
WITH lined AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL
),
hashed AS (
    SELECT *, ('0x' || left(md5(line), 8))::BIGINT AS h, max(i) OVER (PARTITION BY doc_id) AS n FROM lined
),
marked AS (
    SELECT *, ((coalesce(lag(h) OVER w, 0) % {_MODULUS}) * {_BASE} + h) % {_MODULUS} % {DIVISOR} = 0 AS may
    FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
),
ended AS (
    SELECT *, i = n OR may AND NOT coalesce(lag(may) OVER w, FALSE) AND i > 1 AND i < n - 1 AS ends,
           lead(line) OVER w AS next
    FROM marked WINDOW w AS (PARTITION BY doc_id ORDER BY i)
),
numbered AS (
    SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS number
    FROM ended
),
chunks AS (
    SELECT doc_id, number, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS chunk, min(i) AS first, max(i) AS last
    FROM numbered GROUP BY doc_id, number
),
later_chunks AS (
    SELECT doc_id, first, last,
           lines > 1 AND trim(chunk, chr(10)) <> '' AND row_number() OVER (PARTITION BY chunk, lines > 1 ORDER BY doc_id, number) > 1 AS gone
    FROM chunks
),
later_windows AS (
    SELECT doc_id, i AS first, i + 1 AS last, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, i) > 1 AS gone
    FROM ended WHERE next IS NOT NULL AND (line <> '' OR next <> '')
),
spans AS (SELECT * FROM later_chunks WHERE gone UNION ALL SELECT * FROM later_windows WHERE gone),
lost AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM spans),
rebuilt AS (
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE lost.i IS NULL), '') AS text,
           count(lost.i) AS n_removed, sum(ends::BIGINT)::BIGINT AS n_chunks
    FROM ended LEFT JOIN lost USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE r.text END AS text,
       coalesce(r.n_chunks, 0) AS n_chunks, coalesce(r.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN rebuilt r USING (doc_id)
"""
