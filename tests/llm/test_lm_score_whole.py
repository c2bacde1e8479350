"""The window network against plain versions: windows, forward pass, slopes, training on every window, one result under any partitioning."""

from __future__ import annotations

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from tallyboard.llm import lm_score, queries
from tallyboard.llm.vocabulary import cells
from tests.llm.test_operators import ALNUM, LOWER, MESSY, frame

WIDE = 2 * lm_score.SIDE + 1


def tokens_plainly(table, text):
    return [int(table[cells(pa.array([w]))[0][0]]) for w in ALNUM.findall((text or "").translate(LOWER))]


def windows_plainly(tokens):
    wide = [lm_score.PAD] * lm_score.SIDE + tokens + [lm_score.PAD] * lm_score.SIDE
    return [tuple(wide[i : i + WIDE]) for i in range(len(tokens))]


def log_prob_plainly(net, window):
    tables, bias, w_class, b_class, w_member, b_member = (w.astype(np.float64) for w in net.weights)
    middle = window[lm_score.SIDE]
    context = window[: lm_score.SIDE] + window[lm_score.SIDE + 1 :]
    h = np.tanh(bias + sum(tables[k][t] for k, t in enumerate(context)))
    classes = np.exp(h @ w_class + b_class)
    every = np.concatenate([classes[c] / classes.sum() * (m := np.exp(h @ w_member[c] + b_member[c])) / m.sum() for c in range(lm_score.CLASSES)])
    assert every.sum() == pytest.approx(1)
    return np.log(every[middle])


def unit_windows(row):
    """Windows of a unit's row, each as often as its stream counts."""
    out, at = collections.Counter(), 0
    for n, count in zip(row.lengths, row.counts):
        own = np.frombuffer(row.streams, dtype=np.uint16)[at : at + n]
        at += n
        for i in np.flatnonzero(own < lm_score.TOKENS):
            out[tuple(int(x) & 0x7FFF for x in own[i - lm_score.SIDE : i + lm_score.SIDE + 1])] += count
    return out


def test_units_hold_every_window_of_every_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60).unionByName(frame(spark, MESSY).select("doc_id", "text"))
    table = lm_score.token_table(np.arange(lm_score.CELLS), np.arange(lm_score.CELLS), lm_score.TOKENS, lm_score.FOLDED)
    want = collections.Counter()
    for r in docs.collect():
        want.update(windows_plainly(tokens_plainly(table, r.text)))
    rows = lm_score.units(docs, table, 10_000).collect()
    assert sum(map(unit_windows, rows), collections.Counter()) == want
    assert len({r.unit % lm_score.ROUNDS for r in rows}) == lm_score.ROUNDS


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 100, 101, 163])
def test_a_cut_loses_no_window(monkeypatch, n):
    monkeypatch.setattr(lm_score, "SEGMENT", 50)
    tokens = np.random.default_rng(n).integers(0, lm_score.TOKENS, n)
    parts = lm_score.segments(lm_score.padded(tokens, np.array([0, n]))[0])
    got = []
    for own in parts:
        got += [tuple(int(x) & 0x7FFF for x in own[i - lm_score.SIDE : i + lm_score.SIDE + 1]) for i in np.flatnonzero(own < lm_score.TOKENS)]
        assert len(own) <= 50 + 2 * lm_score.SIDE
    assert got == windows_plainly(tokens.tolist())


@pytest.mark.parametrize("n", [1, 700, 3 * lm_score.BATCH + 1])
def test_training_passes_over_every_window_once(monkeypatch, n):
    rng = np.random.default_rng(0)
    stream, _ = lm_score.padded(rng.integers(0, lm_score.TOKENS, n), np.array([0, n]))
    weight, seen, weights = rng.integers(1, 1000, len(stream)).astype(np.float32), [], []

    def gradient(self, context, middle, own):
        assert 0 < len(middle) <= lm_score.BATCH
        wide = np.insert(context, lm_score.SIDE, middle, axis=0)
        seen.extend(map(tuple, wide.T.tolist()))
        weights.extend(own.tolist())
        return [np.zeros_like(w) for w in self.weights]

    monkeypatch.setattr(lm_score.Network, "gradient", gradient)
    lm_score.Network.new().train(stream, weight, [1], 0.02)
    want = zip(windows_plainly(stream[lm_score.SIDE : -lm_score.SIDE].tolist()), weight[lm_score.SIDE : -lm_score.SIDE].tolist())
    assert sorted(zip(seen, weights)) == sorted(want)


def sample(n):
    rng = np.random.default_rng(4)
    return rng.integers(0, lm_score.TOKENS + 1, (len(lm_score.PLACES), n)), rng.integers(0, lm_score.TOKENS, n)


def test_forward_pass_equals_a_plain_one():
    net = lm_score.Network.new(np.arange(lm_score.TOKENS))
    context, middle = sample(40)
    windows = [(*context[: lm_score.SIDE, i].tolist(), int(middle[i]), *context[lm_score.SIDE :, i].tolist()) for i in range(40)]
    assert net.log_prob(context, middle, step=7) == pytest.approx([log_prob_plainly(net, w) for w in windows], rel=1e-5)


def test_gradient_is_the_slope():
    net = lm_score.Network.new()
    net.weights = [w.astype(np.float64) for w in net.weights]
    context, middle = sample(50)
    weight = np.random.default_rng(1).integers(1, 9, 50)
    loss = lambda: -(net.log_prob(context, middle) * weight).sum() / weight.sum()
    for w, g in zip(net.weights, net.gradient(context, middle, weight)):
        spot = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        keep, h = w[spot], 1e-4
        w[spot] = keep + h
        up = loss()
        w[spot] = keep - h
        down = loss()
        w[spot] = keep
        assert (up - down) / (2 * h) == pytest.approx(g[spot], rel=5e-3)


def test_weights_stand_for_repeats():
    net = lm_score.Network.new()
    context, middle = sample(40)
    count = np.arange(1, 41)
    repeated = net.gradient(np.repeat(context, count, axis=1), np.repeat(middle, count), np.ones(count.sum()))
    for a, b in zip(repeated, net.gradient(context, middle, count)):
        assert np.allclose(a, b, atol=1e-5)


def test_the_network_learns_order(spark):
    """Words follow one another in a ring; held-out texts in that order score above their shuffled words."""
    rng = random.Random(0)
    ring = [f"w{k}" for k in range(60)]
    start = lambda: rng.randrange(60)
    text = lambda n: " ".join(ring[(a + k) % 60] for a in [start()] for k in range(n))
    scorer = lm_score.fit(frame(spark, [(k, text(60)) for k in range(600)]))
    held = [text(50) for _ in range(30)]
    mixed = [" ".join(rng.sample(t.split(), 50)) for t in held]
    got = {r.doc_id: r.log_prob for r in lm_score.score(frame(spark, list(enumerate(held + mixed))), scorer).collect()}
    assert min(got[k] for k in range(30)) > max(got[k] for k in range(30, 60))


def test_held_out_texts_score_above_their_unigrams(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scorer = lm_score.fit(docs.where("doc_id % 5 <> 0"))
    count = np.ones(lm_score.TOKENS)
    for r in docs.where("doc_id % 5 <> 0").collect():
        np.add.at(count, tokens_plainly(scorer.table, r.text), 1)
    held = docs.where("doc_id % 5 = 0").collect()
    unigram = sum(np.log(count[t] / count.sum()).sum() for t in (np.array(tokens_plainly(scorer.table, r.text), int) for r in held))
    got = {r.doc_id: (r.n_tokens, r.log_prob) for r in lm_score.score(docs.where("doc_id % 5 = 0"), scorer).collect()}
    assert sum(v for _, v in got.values()) > unigram
    for r in held[:8]:
        own = windows_plainly(tokens_plainly(scorer.table, r.text))[:200_000]
        assert got[r.doc_id][0] == len(own) == len(ALNUM.findall(r.text.translate(LOWER)))
        assert got[r.doc_id][1] == pytest.approx(sum(log_prob_plainly(scorer.network, w) for w in own), rel=1e-4)


def test_weights_do_not_depend_on_the_partitioning(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name, kept = "spark.sql.adaptive.coalescePartitions.enabled", []
    for on, parts, split in (("true", "4", 1), ("false", "13", 7)):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set(name, on)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            kept.append(lm_score.fit(docs.repartition(split)))
        finally:
            spark.conf.unset(name)
            spark.conf.set("spark.sql.shuffle.partitions", old)
    assert (kept[0].table == kept[1].table).all() and (kept[0].network.flat() == kept[1].network.flat()).all()


def test_edges(spark):
    docs = frame(spark, MESSY)
    got = lm_score.score(docs, lm_score.fit(docs)).collect()
    assert collections.Counter((r.doc_id, r.n_tokens) for r in got) == collections.Counter((i, len(ALNUM.findall((t or "").translate(LOWER)))) for i, t in MESSY)
    assert all((r.n_tokens == 0) == (r.log_prob == 0) for r in got)
    none = frame(spark, [])
    assert lm_score.score(none, lm_score.fit(none)).count() == 0
    words = frame(spark, [(1, "?!"), (2, None)])
    assert lm_score.score(words, lm_score.fit(words)).where("log_prob = 0").count() == 2


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op10_lm_score(spark, sf_dir).collect()}
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert got.keys() == docs.keys()
    for i, r in got.items():
        assert r.n_tokens == len(ALNUM.findall(docs[i].translate(LOWER))) and (r.per_token is None if not r.n_tokens else r.per_token == pytest.approx(r.log_prob / r.n_tokens))
