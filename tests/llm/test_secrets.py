from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from urllib.parse import quote

import pytest

from tripflow.llm.common import read
from tripflow.llm.secrets import Scanner, digest, find_secrets, redact_secrets

SECRET = "password=hunter2hunter2"


def spans(text):
    return Scanner().scan(text)[1]


def b64(data: bytes | str) -> str:
    return base64.b64encode(data.encode() if isinstance(data, str) else data).decode()


def test_base_rules():
    text = 'token: abcde api_key = "abcdef" ' + "a" * 23 + " " + "0f" * 12 + " AKIA" + "Z" * 15 + " AKIA" + "Z" * 16
    found = [(k, text[s:e]) for s, k, e in Scanner().scan(text)[0]]
    assert found == [(0, 'api_key = "abcdef'), (2, "0f" * 12), (1, "AKIA" + "Z" * 16)]


def test_a_short_value_consumes_its_match():
    assert Scanner().scan("secret=token: abcdefgh")[0] == []


@pytest.mark.parametrize(
    "wrapped",
    [
        b64(SECRET),
        b64(b64(b64(SECRET))),
        b64(gzip.compress(SECRET.encode())),
        b64(zlib.compress(b64(gzip.compress(SECRET.encode())).encode())),
        b64(quote(SECRET, safe="")),
        b64("".join(f"\\u{ord(c):04x}" for c in SECRET)),
        b64(gzip.compress(gzip.compress(SECRET.encode()))),
    ],
)
def test_nested_layers_map_to_the_outer_run(wrapped):
    text = f"before {wrapped} after"
    found = [s for s in spans(text) if s[1] == 0]
    assert found
    for start, _, end in found:
        assert 7 <= start < end <= 7 + len(wrapped)


def test_percent_and_unicode_places_are_exact():
    text = "é " + "".join(f"%{b:02x}" for b in SECRET.encode()) + " z"
    assert spans(text) == [(2, 0, 2 + 3 * len(SECRET))]
    text = "é password\\u003dhunter2 z"
    assert spans(text) == [(2, 0, 2 + len("password\\u003dhunter2"))]
    assert spans(quote(quote(SECRET, safe=""), safe="")) == [(0, 0, len(quote(quote(SECRET, safe=""), safe="")))]


def test_percent_of_wide_characters():
    text = quote("éé password=ééhunter2", safe="") + " token=abcdef"
    places = [text[s:e] for s, k, e in spans(text)]
    assert places == ["token=abcdef"]


def test_layers_seen_before_end_the_work():
    text = "%25" * 50 + "41"
    base, found, layers, too_large = Scanner().scan(text)
    assert (base, found, too_large) == ([], [], 0) and layers > 0


def test_a_bomb_is_counted():
    bomb = b64(gzip.compress(b"a" * 200_000))
    assert Scanner(limit=100_000).scan(bomb)[3] == 1
    assert Scanner().scan(bomb)[3] == 0


def test_base_digest_matches_plain_patterns(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    found = {r.doc_id: r for r in digest(find_secrets(docs)).collect()}
    assign = re.compile(
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    some = 0
    for row in docs.collect():
        text = row.text or ""
        base = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        names = ("assign", "access", "hex")
        plain = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(base))
        got = found[row.doc_id]
        assert got.base_sha256 == hashlib.sha256(plain.encode()).hexdigest()
        assert [got.n_assign, got.n_access, got.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert set(filter(None, plain.split(","))) <= set(filter(None, got.spans.split(",")))
        some += len(base)
    assert some > 0 and len(found) == docs.count()


def test_odd_rows(spark):
    rows = [(1, None, "x"), (None, SECRET, "y"), (1, None, "x"), (2, "", None), (3, "a b " * 200_000 + SECRET, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, spans string")
    got = sorted(digest(find_secrets(docs)).select("doc_id", "spans").collect(), key=lambda r: (r[0] or 0, r[1]))
    assert [tuple(r) for r in got] == [
        (None, "assign:0:23"), (1, ""), (1, ""), (2, ""), (3, "assign:800000:800023"),
    ]
    assert digest(find_secrets(docs.limit(0))).count() == 0
    clean = {r.doc_id: r for r in redact_secrets(docs).collect()}
    assert clean[None].text == "[SECRET]" and clean[1].text is None and clean[3].text.endswith("b [SECRET]")
    assert redact_secrets(docs).columns == docs.columns
