"""Codes of vectors against a plain version in Python's integers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyboard.llm import vector_codes as V

DIM, SCHEMA = 8, "vec_id long, embedding array<double>, label int"


def plain(rows, parts, entries, rounds):
    kept = [(i, v, k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = lambda v: [max(-(1 << 63), min(V.MOST, math.floor(x * 256) if abs(x) < 1e300 else int(math.copysign(1 << 64, x)))) for x in v]
    ids = sorted({i for i, v, _ in kept if i is not None and len(v) == DIM})[:entries]
    cuts = [p * DIM // parts for p in range(parts + 1)]
    start = [whole(min(v for i, v, _ in kept if i == k and len(v) == DIM)) for k in ids]
    books = [[v[a:b] for v in start] for a, b in zip(cuts, cuts[1:])]

    def assign(v, p):
        far = [sum((x - y) ** 2 for x, y in zip(v[cuts[p] : cuts[p + 1]], e)) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        moved = [list(map(list, b)) for b in books]
        for p in range(parts):
            held = defaultdict(list)
            for _, v, _ in kept:
                if len(v) == DIM:
                    held[assign(whole(v), p)[0]].append(whole(v)[cuts[p] : cuts[p + 1]])
            for e, own in held.items():
                moved[p][e] = [sum(c) // len(own) for c in zip(*own)]
        books = moved
    out = []
    for i, v, k in kept:
        if len(v) != DIM:
            out.append((i, k, None, None))
            continue
        each = [assign(whole(v), p) for p in range(parts)]
        out.append((i, k, "".join(f"{a:02x}" for a, _ in each), min(V.MOST, sum(e for _, e in each))))
    total = defaultdict(list)
    for _, k, _, e in out:
        if e is not None:
            total[k].append(e)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, k, c, e, min(V.MOST, sum(total[k])) if k in total else None) for i, k, c, e in out), key=repr), digest


def rows(seed, n, wide=False):
    rng = random.Random(seed)
    draw = lambda: [round(rng.gauss(0, 1), rng.choice([1, 6])) for _ in range(DIM)]
    out = [(i, draw(), rng.choice([0, 1, 1, 1, None])) for i in range(n)]
    out += [out[3], (3, draw(), 2), (None, draw(), 1), (None, None, None), (7, None, 0), (n, [math.nan] * DIM, 0), (n + 1, [math.inf] * DIM, 0), (n + 2, [None] * DIM, 0)]
    out += [(n + 3, draw()[:3], 9), (n + 4, [], 1)] + [(n + 5 + j, [0.25] * DIM, 1) for j in range(40)]
    return out + [(n + 60, [1e30, -1e30] * 4, 1), (n + 61, [1e307] * DIM, 1), (n + 62, [-3e6] * DIM, None)] * wide


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("partitions", [1, 7])
def test_codes(spark, wide, partitions):
    data = rows(5, 60, wide)
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "v", "of", "code", "error", "label_error")}).repartition(partitions)
    books = V.fit(df, parts=4, entries=6)
    got = sorted((tuple(r) for r in V.encode(df, books).collect()), key=repr)
    assert (got, books.sha256()) == plain(data, 4, 6, 2)


def test_uneven_parts(spark):
    data = rows(8, 30)
    df = spark.createDataFrame(data, SCHEMA)
    books = V.fit(df, parts=3, entries=64)
    assert sorted((tuple(r) for r in V.encode(df, books).collect()), key=repr) == plain(data, 3, 64, 2)[0]


def test_many_labels_join_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(V, "BROADCAST_LABELS", 0)
    data = rows(9, 30)
    df = spark.createDataFrame(data, SCHEMA)
    assert sorted((tuple(r) for r in V.encode(df, V.fit(df, 4, 5), label_col="label").collect()), key=repr) == plain(data, 4, 5, 2)[0]


def test_nothing_to_code(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert V.encode(empty, V.fit(empty)).collect() == []
    nameless = spark.createDataFrame([(None, [1.0] * DIM, 1)], SCHEMA)
    assert [tuple(r) for r in V.encode(nameless, V.fit(nameless)).collect()] == [(None, 1, None, None, None)]
