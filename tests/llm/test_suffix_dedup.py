"""Byte strings repeated across documents, against every window of every text."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyboard.llm import suffix_dedup as S
from tallyboard.llm.suffix_merge import intervals, lay_out

EXTRA = ("id", "own", "g", "seeds", "bucket", "kept", "n_bytes", "_place_of", "data", "kind")


def plain(rows, window):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for s in range(len(t) - window + 1):
            if i is not None:
                first[t[s : s + window]] = min(first.get(t[s : s + window], i), i)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - window + 1):
            if i is not None and first[t[s : s + window]] < i:
                gone[s : s + window] = True
        gone = gone[: len(t)]
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return sorted(out, key=repr)


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "be", "gâmma", "мир", "of", "日本"]) + str(rng.randint(0, 60))
    prose = lambda k: " ".join(word() for _ in range(k))
    line, shared = prose(6), [prose(rng.randint(3, 25)) for _ in range(8)]
    made = [prose(rng.randint(0, 30)) + rng.choice(["", "\n"]) + (rng.choice(shared) if rng.random() < 0.5 else "") + prose(rng.randint(0, 9)) for _ in range(n)]
    made += [prose(3) + line + prose(3) for _ in range(n)] + [made[0]] * 6 + [made[1][:-3] + "x"] * 3
    made += [None, "", "a", "a" * 49, "a" * 50, "a" * 700, "ab" * 300, "a" * 60, "é" * 120, shared[0] + shared[0], "\x00" * 80, "\x00" * 90]
    rows = [(i, t) for i, t in enumerate(made)]
    return rows + [(3, made[5]), (3, made[5]), (None, made[0]), (None, None), (2, shared[2])]


@pytest.mark.parametrize("window, options", [(50, {}), (50, {"hot": 2}), (50, {"hot": 6, "group_bytes": 900, "bucket_seeds": 40}), (9, {"group_bytes": 3000, "bucket_seeds": 100}), (2, {}), (1, {})])
def test_repeats(spark, window, options, monkeypatch):
    monkeypatch.setattr(S, "PIECE_BYTES", 256)
    rows = texts(window, 40)
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in EXTRA}).repartition(3)
    assert sorted((tuple(r) for r in S.remove_repeats(df, window=window, **options).collect()), key=repr) == plain(rows, window)


def test_ids_as_text(spark):
    rows = [(None if i is None else f"doc-{i:08d}", t) for i, t in texts(7, 20)]
    got = S.remove_repeats(spark.createDataFrame(rows, "doc_id string, text string"), group_bytes=2000)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, 50)


def test_nothing(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("depth", [1, 4, 5, 6, 13, 50])
def test_intervals_of_merged_shards(depth):
    rng = random.Random(depth)
    for _ in range(30):
        letters = rng.choice([b"ab", b"abcdefgh", b"\x00\xf4a"])
        passages = [bytes(rng.choice(letters) for _ in range(rng.randint(depth, depth + 20))) for _ in range(rng.randint(3, 12))] * rng.randint(1, 2)
        texts = [lay_out(np.frombuffer(b"".join(s), np.uint8), np.cumsum([0, *map(len, s)]))[0] for s in (passages[k::3] for k in range(3))]
        suffixes, group = intervals(texts, depth)
        whole = np.concatenate(texts).tobytes()
        windows = {}
        for k in range(len(whole) - depth + 1):
            if 0 not in whole[k : k + depth]:
                windows.setdefault(whole[k : k + depth], []).append(k)
        found = {}
        for k, g in zip(suffixes.tolist(), group.tolist()):
            found.setdefault(g, []).append(k)
        assert sorted(sorted(x) for x in found.values()) == sorted(x for x in windows.values() if len(x) > 1)
        assert [whole[k : k + depth] for k in suffixes.tolist()] == sorted(whole[k : k + depth] for k in suffixes.tolist())
