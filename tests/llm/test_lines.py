from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from tripflow.llm.common import read
from tripflow.llm.lines import dedup_lines


def plain_chunks(text):
    """Chunks as (first line, lines)."""
    lines = text.split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    may = [
        ((hashes[i - 1] if i else 0) % 2147483647 * 1_000_003 + h) % 2147483647 % 3 == 0 for i, h in enumerate(hashes)
    ]
    chunks, first = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or may[i] and not (i and may[i - 1]) and 0 < i < len(lines) - 2:
            chunks.append((first, lines[first : i + 1]))
            first = i + 1
    return chunks


def plain(rows):
    """Texts after removal, in the order of rows (id, text)."""
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0, n))
    seen, gone = set(), {n: set() for n in order}
    for n in order:
        lines = [] if rows[n][1] is None else rows[n][1].split("\n")
        pieces = [(i, tuple(c), "chunk") for i, c in (plain_chunks(rows[n][1]) if lines else []) if len(c) > 1]
        pieces += [(i, tuple(lines[i : i + 2]), "window") for i in range(len(lines) - 1)]
        for i, piece, kind in pieces:
            if not any(piece):
                continue
            if (kind, piece) in seen:
                gone[n] |= set(range(i, i + len(piece)))
            seen.add((kind, piece))
    return [
        (key, None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[n]))
        for n, (key, text) in enumerate(rows)
    ]


def test_matches_plain_version(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    wanted = sorted(plain([(r.doc_id, r.text) for r in docs.collect()]))
    got = dedup_lines(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == wanted
    assert sum(len(t) for _, t in wanted) < docs.selectExpr("sum(length(text)) AS n").first().n


def test_shared_passage_survives_shifts(spark):
    rng = random.Random(5)
    line = lambda: " ".join(str(rng.randrange(10**6)) for _ in range(6))
    passage = [line() for _ in range(40)]
    rows = [(n, "\n".join([line() for _ in range(n)] + passage + [line()])) for n in range(1, 6)]
    got = {r.doc_id: r.text.split("\n") for r in dedup_lines(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[1] == rows[0][1].split("\n")
    for n in range(2, 6):
        assert got[n] == [x for x in rows[n - 1][1].split("\n") if x not in passage]


def test_odd_rows(spark):
    many = "\n".join(f"line {i}" for i in range(30_000))
    rows = [(2, None), (None, "a\nb\nc\nd"), (1, ""), (4, "a\nb\nc\nd"), (5, many), (6, "\n" + many), (7, "x" * 500_000), (8, "\n\n\n"), (9, "c\nd\n\n\n\ne"), (9, "d\n\n\n\nf"), (10, "q\nq\nq\nq"), (11, "b\nz")]
    docs = spark.createDataFrame([(i, t, "gone", 1) for i, t in rows], "doc_id int, text string, _gone string, number int").coalesce(1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in dedup_lines(docs).collect()), key=key) == sorted(plain(rows), key=key)
    twice = docs.filter("doc_id = 5").unionAll(docs.filter("doc_id = 5"))
    assert sorted(r.text for r in dedup_lines(twice).collect()) == ["", many]
    assert dedup_lines(docs.limit(0)).count() == 0
    again = dedup_lines(dedup_lines(docs, report=True), report=True)
    assert again.columns == [*docs.columns, "n_chunks", "n_removed"]
    assert again.agg({"n_removed": "sum"}).first()[0] == 0
    clash = docs.withColumnsRenamed({"_gone": "n_removed", "number": "block"})
    assert dedup_lines(clash, report=True).columns == ["doc_id", "text", "block", "n_chunks", "n_removed"]
    assert dedup_lines(clash).columns == clash.columns


def test_lines_that_share_a_digest_are_told_apart(spark):
    rng = random.Random(6)
    rows = [(n, "\n".join(rng.choice(["", "ab", "ac", "bc", "xyz", "xyw", "k" * 9]) for _ in range(rng.randrange(9)))) for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)

    def weak(line):  # lines of one length share it; boundaries stay those of the md5
        return F.concat(F.substring(F.unhex(F.md5(line)), 1, 0), F.encode(F.lpad(F.length(line).cast("string"), 8, "0"), "UTF-8"))

    got = sorted((r.doc_id, r.text) for r in dedup_lines(docs, divisor=10**9, digest=weak).collect())
    wanted = sorted((r.doc_id, r.text) for r in dedup_lines(docs, divisor=10**9).collect())
    assert got == wanted and got != rows


def test_repeats_left_in_the_corpus(spark):
    """Of the surplus occurrences of lines over 50 words in repeated two-line runs, none is left."""
    docs = read(spark, "/root/testdata/sf0.01", "documents")

    def surplus(texts):
        seen, again = set(), 0
        for text in texts:
            lines = (text or "").split("\n")
            for pair in zip(lines, lines[1:], strict=False):
                again += pair in seen and len(" ".join(pair).split()) > 50
                seen.add(pair)
        return again

    before = surplus(r.text for r in docs.orderBy("doc_id").collect())
    after = surplus(r.text for r in dedup_lines(docs).orderBy("doc_id").collect())
    assert before > 50 and after <= 0.02 * before


def test_plan_holds_no_python(spark, sf_dir):
    plan = dedup_lines(read(spark, sf_dir, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
