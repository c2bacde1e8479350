"""Masked pseudo-likelihood of documents under a bidirectional window network (operator 10).

Tokens are words in a vocabulary of `TOKENS` (see `vocabulary`). The network sees SIDE tokens on either
side of a masked one, each through a table of its place, a hidden layer of tanh units, and two softmaxes:
over the classes of tokens, and over the members of the masked token's class. A document's score is the
sum over all its tokens of the logarithm of the probability that the network gives the token from both
sides. The network starts at the counts of the tokens alone.

It is trained on every window of every document, in three passes over the corpus.

1. Words are counted by cell: at most 65,536 numbers reach the driver.
2. Texts become streams of token numbers, two bytes a word. Equal streams are one row with a count, and a
   stream of more than `SEGMENT` tokens is cut, with the tokens beside a cut repeated as context, so
   that no window is lost and no row is long. Streams are dealt to units by their hash, as many units as keep each
   at about `UNIT` tokens, and every unit is written as one row.
3. Training is synchronous. In each of `ROUNDS` rounds the units of that round are trained on, each from
   the common weights, every window once and weighted by its count; the results are averaged by
   weight. So every window is trained on once, and the work grows with the corpus.

A unit is a row, so what is trained together depends on the streams and not on how Spark deals out rows.
Weights are added up as whole numbers, in tasks first and then in `GATHER` partial sums, which reach the driver, so
their order does not matter either: the same corpus gives the same network under any partitioning.

Defined results: null and empty texts and texts without words have no tokens and score 0; before and after a text
stand pads; repeated rows count and score each by itself; ids are not read; on an
empty table the network stays at its first, seeded state.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm import bytearrays as B
from tallyboard.llm.vocabulary import CELLS, cells, token_table
from tallyboard.sources.scratch import discard, written

SIDE = 3
PLACES = tuple(d for d in range(-SIDE, SIDE + 1) if d)
#: Tokens are CLASSES times MEMBERS; FOLDED of them are shared by the rarer words.
CLASSES, MEMBERS, FOLDED = 32, 32, 128
TOKENS = CLASSES * MEMBERS
#: What stands beside a text, and the mark of a token that is context only.
PAD, CONTEXT = TOKENS, np.uint16(1 << 15)
HIDDEN = 24
ROUNDS, UNIT, LEAST_UNITS, SEGMENT = 8, 1 << 20, 4, 1 << 14
BATCH, LEAST_BATCH, STEPS, RATE = 8192, 256, 64, 0.02
SEED = 7
GATHER = 32
#: Weights are added as whole numbers of this fraction, times thousands of tokens.
_SCALE = float(1 << 20)


# ---------------------------------------------------------------- the network


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One entry of each row's log-softmax."""
    x -= x.max(axis=1, keepdims=True)
    own = x[np.arange(len(at)), at]
    return own - np.log(np.exp(x, out=x).sum(axis=1))


@dataclass
class Network:
    """tables: (places, TOKENS + 1, HIDDEN); hidden bias; classes (HIDDEN, CLASSES) with bias; members (CLASSES, HIDDEN, MEMBERS) with bias."""

    weights: list[np.ndarray]

    @staticmethod
    def new(counts: np.ndarray | None = None, seed: int = SEED) -> Network:
        """Small seeded weights; the biases give the tokens' shares of `counts`, one added to each."""
        rng = np.random.default_rng(seed)
        shapes = [(len(PLACES), TOKENS + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,), (CLASSES, HIDDEN, MEMBERS), (CLASSES, MEMBERS)]
        scale = [0.2, 0.0, 0.05, 0.0, 0.05, 0.0]
        weights = [(rng.standard_normal(s) * k).astype(np.float32) for s, k in zip(shapes, scale)]
        share = (np.zeros(TOKENS) if counts is None else counts).reshape(CLASSES, MEMBERS) + 1.0
        weights[3] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
        weights[5] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
        return Network(weights)

    def _hidden(self, context: np.ndarray) -> np.ndarray:
        tables, bias = self.weights[:2]
        x = tables[0][context[0]] + bias
        for k in range(1, len(PLACES)):
            x += tables[k][context[k]]
        return np.tanh(x, out=x)

    def _by_class(self, middle: np.ndarray):
        """The rows of each class that occurs."""
        of = (middle // MEMBERS).astype(np.uint16)
        order = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[order], np.arange(CLASSES + 1, dtype=np.uint16))
        return [(c, order[a:b]) for c, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]

    def log_prob(self, context: np.ndarray, middle: np.ndarray, step: int = 1 << 13) -> np.ndarray:
        """Of the masked tokens; `context` is (places, n)."""
        _, _, w_class, b_class, w_member, b_member = self.weights
        out = np.empty(len(middle), dtype=np.float64)
        for low in range(0, len(middle), step):
            own = middle[low : low + step]
            h = self._hidden(context[:, low : low + step])
            p = _log_softmax_at(h @ w_class + b_class, own // MEMBERS)
            for c, rows in self._by_class(own):
                p[rows] += _log_softmax_at(h[rows] @ w_member[c] + b_member[c], own[rows] % MEMBERS)
            out[low : low + step] = p
        return out

    def gradient(self, context: np.ndarray, middle: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted mean of the negative log-probabilities of the masked tokens."""
        tables, _, w_class, _, w_member, b_member = self.weights
        n = len(middle)
        share = (weight / weight.sum()).astype(np.float32)[:, None]
        h = self._hidden(context)
        d = _softmax(h @ w_class + self.weights[3])
        d[np.arange(n), middle // MEMBERS] -= 1
        d *= share
        dh = d @ w_class.T
        out = [np.zeros_like(tables), None, h.T @ d, d.sum(axis=0), np.zeros_like(w_member), np.zeros_like(b_member)]
        for c, rows in self._by_class(middle):
            own = h[rows]
            m = _softmax(own @ w_member[c] + b_member[c])
            m[np.arange(len(rows)), middle[rows] % MEMBERS] -= 1
            m *= share[rows]
            out[4][c], out[5][c] = own.T @ m, m.sum(axis=0)
            dh[rows] += m @ w_member[c].T
        dh *= 1 - h * h
        out[1] = dh.sum(axis=0)
        for k in range(len(PLACES)):
            order = np.argsort(context[k].astype(np.uint16), kind="stable")
            seen = context[k][order]
            first = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]]))
            out[0][k][seen[first]] = np.add.reduceat(dh[order], first, axis=0)
        return out

    def train(self, stream: np.ndarray, weight: np.ndarray, seed: list[int], rate: float) -> Network:
        """Adam steps over all windows of a unit's streams, each window once, in a seeded order."""
        net = Network([w.copy() for w in self.weights])
        at = np.random.default_rng(seed).permutation(np.flatnonzero(stream < TOKENS))
        tokens = (stream & ~CONTEXT).astype(np.int64)
        steps = max(1, -(-len(at) // min(BATCH, max(LEAST_BATCH, len(at) // STEPS))))
        first, second = ([np.zeros_like(w) for w in net.weights] for _ in range(2))
        for t, own in enumerate(np.array_split(at, steps), 1):
            context = np.stack([tokens[own + d] for d in PLACES])
            for w, m, v, g in zip(net.weights, first, second, net.gradient(context, tokens[own], weight[own])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= np.float32(rate / (1 - 0.9**t)) * m / (np.sqrt(v / np.float32(1 - 0.99**t)) + np.float32(1e-5))
        return net

    def flat(self) -> np.ndarray:
        return np.concatenate([w.reshape(-1) for w in self.weights])

    def of_flat(self, flat: np.ndarray) -> Network:
        edges = np.cumsum([w.size for w in self.weights])[:-1]
        return Network([x.reshape(w.shape).astype(np.float32) for w, x in zip(self.weights, np.split(flat, edges))])


# ---------------------------------------------------------------- streams


def padded(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows' tokens with SIDE pads before and after each row, and the place of every token among them."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.arange(len(tokens)) + SIDE * (row + 1)
    stream = np.full(len(tokens) + SIDE * len(first), PAD, dtype=np.uint16)
    stream[place] = tokens
    return stream, place


def segments(stream: np.ndarray) -> list[np.ndarray]:
    """A padded row in pieces of SEGMENT tokens; in each, SIDE tokens of the pieces beside it are context."""
    n = len(stream) - 2 * SIDE
    if n <= SEGMENT:
        return [stream] if n > 0 else []
    out = []
    for low in range(0, n, SEGMENT):
        own = stream[low : min(low + SEGMENT, n) + 2 * SIDE].copy()
        own[:SIDE] |= CONTEXT
        own[-SIDE:] |= CONTEXT
        out.append(own)
    return out


def _count(batches):
    total = np.zeros(CELLS, dtype=np.int64)
    for batch in batches:
        for part in B.chunks(batch, "text"):
            total += np.bincount(cells(part.column("text"))[0], minlength=CELLS)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["cell", "n"])


def _streams(table: np.ndarray):
    def run(batches):
        for batch in batches:
            for part in B.chunks(batch, "text"):
                own, first = cells(part.column("text"))
                tokens, out = table[own], []
                for a, b in zip(first, first[1:]):
                    if a < b:
                        out += [x.tobytes() for x in segments(padded(tokens[a:b], np.array([0, b - a]))[0])]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["stream"])

    return run


def _pack(batches):
    """Rows sorted by unit to one row a unit: its streams joined, and the length and count of each. A unit of twice UNIT and more is cut."""
    unit, held, size = None, [], 0

    def row():
        streams, counts = zip(*held)
        lengths = pa.array([[len(s) // 2 for s in streams]], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([unit], pa.int64()), pa.array([b"".join(streams)]), lengths, pa.array([list(counts)], pa.list_(pa.int64()))], names=["unit", "streams", "lengths", "counts"])

    for batch in batches:
        for u, stream, n in zip(*(batch.column(c).to_pylist() for c in ("unit", "stream", "n"))):
            if held and (u != unit or size > 2 * UNIT):
                yield row()
                held, size = [], 0
            unit = u
            held.append((stream, n))
            size += len(stream) // 2
    if held:
        yield row()


def units(docs: DataFrame, table: np.ndarray, total: int, text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """All streams of the corpus, one row a unit: unit, streams, lengths, counts; a unit's round is unit % rounds."""
    n = max(rounds * LEAST_UNITS, -(-total // UNIT))
    streams = docs.select(F.col(text_col).alias("text")).mapInArrow(_streams(table), "stream binary").groupBy("stream").agg(F.count("*").alias("n"))
    dealt = streams.withColumn("unit", F.pmod(F.xxhash64("stream"), F.lit(n)))
    parts = max(1, min(n, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // 64)))
    packed = dealt.repartition(parts, "unit").sortWithinPartitions("unit", "stream")
    return written(packed.mapInArrow(_pack, "unit long, streams binary, lengths array<long>, counts array<long>"))


# ---------------------------------------------------------------- training


def _train(network: Network, round_: int, rate: float):
    def run(batches):
        total, weight = np.zeros(sum(w.size for w in network.weights), dtype=np.int64), 0
        for batch in batches:
            for unit, streams, lengths, counts in zip(*(batch.column(c) for c in ("unit", "streams", "lengths", "counts"))):
                stream = np.frombuffer(streams.as_buffer(), dtype=np.uint16)
                each = np.repeat(counts.values.to_numpy().astype(np.float32), lengths.values.to_numpy())
                share = 1 + int(each[stream < TOKENS].sum()) // 1024
                own = network.train(stream, each, [SEED, round_, unit.as_py()], rate).flat()
                total += np.rint(own.astype(np.float64) * _SCALE).astype(np.int64) * share
                weight += share
        if weight:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([weight], pa.int64())], names=["weights", "n"])

    return run


def _sum(batches):
    total, weight = 0, 0
    for batch in batches:
        for x, n in zip(batch.column("weights"), batch.column("n").to_pylist()):
            total, weight = total + np.frombuffer(x.as_buffer(), dtype=np.int64), weight + n
    if weight:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([weight], pa.int64())], names=["weights", "n"])


@dataclass
class Scorer:
    """The token of every cell, and the network."""

    table: np.ndarray
    network: Network


def fit(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, rate: float = RATE) -> Scorer:
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(_count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = (found.column(c).to_numpy() for c in ("cell", "n"))
    table = token_table(cell, n, TOKENS, FOLDED)
    network = Network.new(np.bincount(table[cell], weights=n, minlength=TOKENS))
    if not len(cell):
        return Scorer(table, network)
    dealt = units(docs, table, int(n.sum()), text_col, rounds)
    for k in range(rounds):
        trained = dealt.where(F.col("unit") % rounds == k).mapInArrow(_train(network, k, rate * 0.5 ** (3 * k / rounds)), "weights binary, n long")
        parts = trained.repartition(GATHER).mapInArrow(_sum, "weights binary, n long").collect()
        if parts:
            total = sum(np.frombuffer(p["weights"], dtype=np.int64) for p in parts)
            network = network.of_flat(total / (_SCALE * sum(p["n"] for p in parts)))
    discard(dealt)
    return Scorer(table, network)


def _score(scorer: Scorer):
    def run(batches):
        for batch in batches:
            for part in B.chunks(batch, "text"):
                own, first = cells(part.column("text"))
                stream, place = padded(scorer.table[own], first)
                tokens = stream.astype(np.int64)
                values = scorer.network.log_prob(np.stack([tokens[place + d] for d in PLACES]), tokens[place])
                total = np.concatenate([[0.0], np.cumsum(values)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(first), pa.int64()), pa.array(total[first[1:]] - total[first[:-1]])], names=["id", "n_tokens", "log_prob"]
                )

    return run


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_tokens and log_prob, the sum of the tokens' conditional log-probabilities."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(_score(scorer), f"id {kind}, n_tokens long, log_prob double").withColumnRenamed("id", id_col)
