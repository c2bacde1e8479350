"""Operators do the whole job: no part of a text, page or corpus is left out."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tallyboard.llm import queries, secret_scan

LONG = "q7" * 3000


SPANS_OF = secret_scan.Scanner(secret_scan.RULES).ready()
KINDS = [r.kind for r in secret_scan.RULES]


def spans_of(text: str, kind: str) -> list[str]:
    data = text.encode()
    found = secret_scan._points(data, SPANS_OF(data), secret_scan.RULES)
    return [text[s["start"] : s["stop"]] for s in found if s["kind"] == kind]


@pytest.mark.parametrize(
    ("kind", "secret"),
    [
        ("url_login", f"https://user:{LONG}@"),
        ("url_login", f"https://{LONG}:pw@"),
        ("url_login", "a" + LONG + "://u:p@"),
        ("signed_token", f"eyJ{LONG}.eyJ{LONG}.{LONG}"),
        ("key_block", "-----BEGIN " + "VERY " * 20 + "PRIVATE KEY-----"),
    ],
)
def test_long_secrets_are_found_whole(kind, secret):
    assert spans_of(f"é = {secret} x {secret}", kind) == [secret, secret]


#: Each kind's expression with the group that has to have so many characters.
PLAIN = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]+", 0, 32),
    "key_block": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    "signed_token": (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1),
    "forge_token": ("gh[oprsu]_[A-Za-z0-9]{36,}", 0, 1),
    "chat_token": ("xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    "url_login": (r"[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20/:@]+:[^\x00-\x20/:@]+@", 0, 1),
}
PIECES = {
    "assign": ["token", "Secret", "API_KEY", "apikey", "password", "=", ":", " ", '"', "'", "abc", "abcdefgh", "-", "é", "\n"],
    "access": ["AKIA", "AKI", "A", "Z9", "0123456789", "x", " ", "é"],
    "hex": ["0123456789abcdef", "a", "f0", "g", " ", "A", "0" * 31, "é"],
    "key_block": ["-----", "-----BEGIN ", "PRIVATE KEY", "PRIVATE KEY-----", "X ", "RSA", "-", "x", " "],
    "signed_token": ["eyJ", "eyJ0123456789", "eyJ0123456789.", ".", "_", "ab", " ", "ey", "0123456789"],
    "forge_token": ["gho_", "ghp_", "gh", "a1" * 18, "b", "_", " ", "Z9z", "é"],
    "chat_token": ["xoxb-", "xoxa-", "xox", "b-", "-", "0123456789", "a", " ", "é"],
    "url_login": ["9ab://", "é:", "u:p@", "://", ":", "@", "/", ".", "-", "9", "ab", "é", " ", "+"],
}


@pytest.mark.parametrize("kind", KINDS)
def test_spans_equal_those_of_the_expression(kind):
    expression, group, least = PLAIN[kind]
    rng, found = random.Random(5), 0
    everything = sorted({p for own in PIECES.values() for p in own})
    for turn in range(6_000):
        pieces = PIECES[kind] if turn % 3 else everything
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 16)))
        want = [m[0] for m in re.finditer(expression, text) if len(m[group]) >= least]
        assert spans_of(text, kind) == want, (kind, text)
        found += len(want)
    assert found > 20


@pytest.mark.parametrize("text", ["eyJ" * 400_000, "eyJa." * 200_000, "a" * 400_000 + "://" * 200_000, "http://a:" * 100_000, "xoxb-" * 3 + "token=" * 150_000, "a://b:c" * 100_000 + "@"])
def test_long_runs_take_linear_time(text):
    """A quadratic scan of these would take hours."""
    SPANS_OF(text.encode())


def test_query_equals_a_plain_version(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op2_secret_scan(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        all_ = sorted((m.start(), k, m.end(), kind) for k, (kind, (p, g, n)) in enumerate(PLAIN.items()) for m in re.finditer(p, docs[r.doc_id]) if len(m[g]) >= n)
        assert r.spans == ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in all_)
        base = [x for x in all_ if x[3] in secret_scan.BASE_KINDS]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[3] == kind for x in base) for kind in secret_scan.BASE_KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in base).encode()).hexdigest()
