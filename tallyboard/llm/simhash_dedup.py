"""Near duplicates by SimHash with anchor-point covering (operator 9).

A fingerprint's 64 bits come from the XXH64 of its word shingles. Two documents link if their
fingerprints differ in `MOST_BITS` bits at most.

Anchors. The 23-bit binary Golay code is perfect: every 23-bit value lies within 3 bits of
exactly one of its 4096 words. One or two blocks of 23 fingerprint bits are covered by such
a code, and a choice of one word per block is an anchor. A fingerprint is at home at the
anchor that covers it. A fingerprint linked to it may have its blocks 3 bits further
away in total, so each fingerprint is replicated to every anchor whose words lie within
covering radius plus threshold (about 71 of 4096 with one block, 302 of 16.8 million with
two). Per anchor, members are compared with the fingerprints at home there on all 64 bits.
No link can be missed. Two blocks are taken above `ONE_BLOCK` fingerprints, so that the
comparisons per anchor do not grow without bound; both forms find the same links.

Skew. Equal fingerprints are one row, written, before anything is replicated, and are dealt to as many tasks as
keep each at about `TASK_ROWS` rows after it. The members of an anchor
are dealt over `SALTS` tasks, each with a copy of the anchor's home rows, and are streamed
past them in blocks. An anchor with more than `HOMES` home rows has these dealt to cells of about that many by
their hash, and its members go to every cell, so no task holds all home rows of an anchor. A block of
comparisons gives one row per fingerprint in it that has a link (its least connected fingerprint in
the block), never a row per pair.

Defined results: null and empty texts have fingerprint zero and link like any other; a null id
takes part and is never a component's name; repeated rows give repeated result rows;
further columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.llm import bytearrays as B
from tallyboard.llm.components import roots
from tallyboard.llm.names import free
from tallyboard.sources.scratch import written

MOST_BITS = 3
RADIUS = 3
SALTS = 4
ONE_BLOCK = 2_000_000
#: Rows that one task makes by replication, and home rows of an anchor that are compared by one task.
TASK_ROWS, HOMES = 1 << 22, 1 << 16
#: Hot anchors up to this number are broadcast, beyond it joined.
HOT_ANCHORS = 100_000
#: Anchors to which a fingerprint is replicated on average, by the number of blocks.
REPLICAS, REPLICAS_TWO = 71, 302
#: Pairs compared at once.
BLOCK = 1 << 21
#: Generator polynomial of the binary Golay code of length 23 (a fixed value).
_GENERATOR = 0b101011100011
_LENGTH, _CHECKS = 23, 11


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.translate(B.LOWER.tobytes()).split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(stops[:-1] + 1).tolist()]
    ends = stops.tolist()[shingle - 1 :] or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(begins, ends)], dtype=np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            for part in B.chunks(batch, "text"):
                values = np.array([fingerprint(t, shingle) for t in B.row_bytes(part.column("text"))], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(B.signed(values))], names=["id", "fp"])

    return run


@cache
def _golay():
    """Syndromes of all values by bytes, and for each syndrome the error patterns by excess over the radius."""

    def remainder(x: int) -> int:
        for bit in range(_LENGTH - 1, _CHECKS - 1, -1):
            if x >> bit & 1:
                x ^= _GENERATOR << (bit - _CHECKS)
        return x

    unit = np.array([remainder(1 << i) for i in range(_LENGTH)], dtype=np.int32)
    syndrome = np.zeros(1 << _LENGTH, dtype=np.int16)
    for i in range(_LENGTH):
        syndrome[1 << i : 2 << i] = syndrome[: 1 << i] ^ unit[i]
    weight = np.bitwise_count(np.arange(1 << _LENGTH, dtype=np.uint32))
    groups = []
    for excess in range(MOST_BITS + 1):
        found = np.flatnonzero(weight <= RADIUS if excess == 0 else weight == RADIUS + excess).astype(np.int32)
        found = found[np.argsort(syndrome[found], kind="stable")]
        first = np.searchsorted(syndrome[found], np.arange((1 << _CHECKS) + 1))
        groups.append((found, first))
    return syndrome, groups


def _patterns(values: np.ndarray, excess: int) -> tuple[np.ndarray, np.ndarray]:
    """Code words at RADIUS + excess from each value (within RADIUS for 0): positions in `values`, words."""
    syndrome, groups = _golay()
    found, first = groups[excess]
    s = syndrome[values]
    n = first[s + 1] - first[s]
    rows = np.repeat(np.arange(len(values)), n)
    offset = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return rows, values[rows] ^ found[first[s][rows] + offset]


def _parts(fps: np.ndarray, blocks: int) -> list[np.ndarray]:
    mask = np.uint64((1 << _LENGTH) - 1)
    return [((fps >> np.uint64(_LENGTH * k)) & mask).astype(np.int64) for k in range(blocks)]


def anchors_of_home(fps: np.ndarray, blocks: int) -> np.ndarray:
    """The anchor that covers each fingerprint."""
    home = np.zeros(len(fps), dtype=np.int64)
    for p in _parts(fps, blocks):
        home = home << _LENGTH | _patterns(p, 0)[1]
    return home


def anchors(fps: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The home anchor of each fingerprint, and all (position, anchor) to which it is replicated."""
    parts, home = _parts(fps, blocks), anchors_of_home(fps, blocks)
    rows, words = [np.arange(len(fps))], [np.zeros(len(fps), dtype=np.int64)]
    spent = [np.zeros(len(fps), dtype=np.int64)]
    for p in parts:
        now = [[], [], []]
        r, w, e = (np.concatenate(x) for x in (rows, words, spent))
        for excess in range(MOST_BITS + 1):
            allowed = np.flatnonzero(e + excess <= MOST_BITS)
            at, word = _patterns(p[r[allowed]], excess)
            at = allowed[at]
            now[0].append(r[at])
            now[1].append(w[at] << _LENGTH | word)
            now[2].append(e[at] + excess)
        rows, words, spent = now
    return home, np.concatenate(rows), np.concatenate(words)


def _replicate(blocks: int):
    """Rows (anchor, salt, member, fp): homes to every salt, members to the salt of their fingerprint. SALTS copies of the homes, and some 71 or 302 of the members."""

    def run(batches):
        for batch in batches:
            whole = B.unsigned(batch.column("fp").to_numpy(zero_copy_only=False))
            for low in range(0, len(whole), 1 << 13):
                fps = whole[low : low + (1 << 13)]
                home, rows, words = anchors(fps, blocks)
                salt = (B.mix(fps) % np.uint64(SALTS)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.tile(home, SALTS), words])),
                        pa.array(np.concatenate([np.repeat(np.arange(SALTS, dtype=np.int32), len(fps)), salt[rows]])),
                        pa.array(np.concatenate([np.zeros(SALTS * len(fps), bool), np.ones(len(rows), bool)])),
                        pa.array(B.signed(np.concatenate([np.tile(fps, SALTS), fps[rows]]))),
                    ],
                    names=["anchor", "salt", "member", "fp"],
                )

    return run


def _stars(home: np.ndarray, members: np.ndarray, most_bits: int):
    """Links of members and homes, as (fingerprint, least fingerprint connected with it), block by block."""
    step = max(1, BLOCK // len(home))
    for low in range(0, len(members), step):
        own = members[low : low + step]
        i, j = np.nonzero(np.bitwise_count(own[:, None] ^ home[None, :]) <= most_bits)
        if not (apart := own[i] != home[j]).any():
            continue
        u, v = own[i[apart]], home[j[apart]]
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        a, b = at[: len(u)], at[len(u) :]
        label = np.arange(len(nodes))
        while True:
            before = label.copy()
            np.minimum.at(label, a, before[b])
            np.minimum.at(label, b, label[a])
            label = label[label]
            if (label == before).all():
                break
        linked = label != np.arange(len(nodes))
        yield nodes[linked], nodes[label[linked]]


def _compare(most_bits: int):
    """Reads rows sorted by anchor, salt, cell and role, so a cell's homes stand before its members."""

    def run(batches):
        key, home = None, np.zeros(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, salt, cell = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "salt", "cell"))
            keys = np.stack([anchor, salt.astype(np.int64) << 32 | cell])
            member = batch.column("member").to_numpy(zero_copy_only=False)
            fps = B.unsigned(batch.column("fp").to_numpy(zero_copy_only=False))
            edges = [0, *(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist(), len(fps)]
            out_u, out_v = [], []
            for low, high in zip(edges, edges[1:]):
                if (now := tuple(keys[:, low].tolist())) != key:
                    key, home = now, np.zeros(0, np.uint64)
                split = low + int((~member[low:high]).sum())
                home = np.concatenate([home, fps[low:split]])
                if len(home) and split < high:
                    for u, v in _stars(home, fps[split:high], most_bits):
                        out_u.append(u)
                        out_v.append(v)
            if out_u:
                yield pa.RecordBatch.from_arrays([pa.array(B.signed(np.concatenate(x))) for x in (out_u, out_v)], names=["u", "v"])

    return run


def _home(blocks: int):
    def run(batches):
        for batch in batches:
            fps = B.unsigned(batch.column("fp").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(anchors_of_home(fps, blocks))], names=["anchor"])

    return run


def links(fps: DataFrame, blocks: int, most_bits: int = MOST_BITS, count: int | None = None) -> DataFrame:
    """Edges (u, v) that connect distinct fingerprints as all links within `most_bits` bits do. `count` is about the rows of `fps`."""
    count = fps.count() if count is None else count
    copies = SALTS + (REPLICAS if blocks == 1 else REPLICAS_TWO)
    # A number of partitions that is asked for is kept, while the fewer bytes before replication would be merged into few.
    parts = max(fps.sparkSession.sparkContext.defaultParallelism, -(-count * copies // TASK_ROWS))
    dealt = fps.select("fp").repartition(parts, "fp")
    spread = dealt.mapInArrow(_replicate(blocks), "anchor long, salt int, member boolean, fp long")
    hot = fps.select("fp").mapInArrow(_home(blocks), "anchor long").groupBy("anchor").count().where(F.col("count") > HOMES)
    hot = written(hot.select("anchor", F.ceil(F.col("count") / HOMES).cast("int").alias("cells")))
    if (n := hot.count()) == 0:
        spread = spread.withColumn("cell", F.lit(0))
    else:
        spread = spread.join(F.broadcast(hot) if n <= HOT_ANCHORS else hot, "anchor", "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
        own = F.array(F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int"))
        every = F.when(F.col("member"), F.sequence(F.lit(0), F.col("cells") - 1)).otherwise(own)
        spread = spread.withColumn("cell", F.explode(every)).drop("cells")
    compared = spread.repartition("anchor", "salt", "cell").sortWithinPartitions("anchor", "salt", "cell", "member")
    return compared.mapInArrow(_compare(most_bits), "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """One row per row of `docs`: id, fp (long) and component_id, the least id reachable over links."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    prints = written(base.mapInArrow(_fingerprints(shingle), f"id {kind}, fp long"))
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("least")))
    count = nodes.count()
    if blocks is None:
        blocks = 1 if count <= ONE_BLOCK else 2
    found = roots(links(nodes, blocks, count=count))
    placed = nodes.join(found, nodes["fp"] == found["u"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each component: one with the least id. Rows without an id are all kept."""
    found = near_duplicates(docs, shingle, id_col, text_col)
    own, n = free(docs, "_sd_id"), free(docs, "_sd_n")
    first = found.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias(own)).distinct()
    one = Window.partitionBy(own).orderBy(F.xxhash64(text_col))
    kept = docs.join(first, F.col(id_col) == F.col(own)).withColumn(n, F.row_number().over(one)).where(F.col(n) == 1)
    return kept.drop(own, n).unionByName(docs.where(F.col(id_col).isNull()))
