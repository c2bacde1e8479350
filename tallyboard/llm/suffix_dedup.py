"""Removal of byte strings that an earlier document already holds, by merged suffix orders (operator 13).

Every window of `window` bytes selects the least hash of the seeds (strings of half its length) inside it, its anchor, so equal windows
have equal anchors. Anchors that only one document has are out; neighbouring windows with one of the other
anchors form passages. All passages of an anchor meet in one bucket, where they are cut into shards whose
Burrows-Wheeler transforms are merged by `suffix_merge.intervals`. Its intervals of windows with a common prefix
of `window` bytes are the repeats; the least document of an interval owns them, and all others lose the bytes.

Rows and sizes. Documents are dealt to groups of about `group_bytes` of text and stored by group once; everything else that moves is
packed arrays between groups and buckets, one row for each pair of a group and a bucket. A group sends an anchor or a passage
once, with the number of its documents or their least id, and gets back which are repeated, so a
passage that a third of all documents share is one entry a group. An anchor of `hot` documents or more sends its windows
one by one, which go by their own content, so no bucket gathers all surroundings of a common line. A bucket is merged in parts of at most
PART_BYTES. Long texts are read in overlapping pieces of PIECE_BYTES. Seeds have hashes of 46 bits, which only choose what is compared;
within a group or a bucket passages count as equal by a hash of 64 bits and their length, windows by their bytes.

Defined results: a null text is empty. A document with a null id neither removes nor loses bytes; rows that share an id are one document's and
do not remove each other's bytes. Ids of any type that can be sorted. Kept bytes are binary: a cut may part a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyboard.llm import bytearrays as B
from tallyboard.llm.ids import with_places
from tallyboard.llm.suffix_merge import intervals, lay_out
from tallyboard.sources.scratch import bucketed, ordered_buckets, written

GROUP_BYTES, BUCKET_SEEDS, HOT = 8 << 20, 1 << 20, 1 << 15
PIECE_BYTES, PART_BYTES, SHARDS, RUN = 1 << 20, 1 << 18, 4, 64
_CLASSES = np.array([1, 2, 16, 256])
_SALT = np.uint64(0x5851F42D4C957F2D)


def _pack(values: np.ndarray) -> bytes:
    """Numbers of 48 bits in six bytes each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.reshape(-1).view("<u8")


def _blob(arrays: list[np.ndarray]) -> bytes:
    """Arrays in one compressed value, behind its length."""
    data = b"".join(np.int64(len(a)).tobytes() + a.tobytes() for a in arrays)
    return np.int64(len(data)).tobytes() + pa.Codec("zstd", 1).compress(data, asbytes=True)


def _arrays(data: bytes, kinds: str) -> list[np.ndarray]:
    data = pa.Codec("zstd", 1).decompress(data[8:], int(np.frombuffer(data, np.int64, 1)[0]), asbytes=True)
    out, at = [], 0
    for kind in kinds.split():
        n, size = int(np.frombuffer(data, np.int64, 1, at)[0]), np.dtype(kind).itemsize
        out.append(np.frombuffer(data, kind, n, at + 8))
        at += 8 + n * size
    return out


def _pieces(table: pa.Table, window: int):
    """The rows that have an id and a window: bytes of several short texts or of one piece of a long one, each row's edges in them, number and place in its text."""
    rows = np.flatnonzero(table.column("id").is_valid().to_numpy(zero_copy_only=False))
    texts = table.column("text").combine_chunks()
    held, size = [], 0

    def made(parts):
        at = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])
        return np.frombuffer(b"".join(p[0] for p in parts), np.uint8), at, np.array([p[1] for p in parts]), np.array([p[2] for p in parts])

    for i in rows.tolist():
        text = texts[i].as_buffer()
        text = memoryview(text) if text is not None else b""
        for low in range(0, max(0, len(text) - window + 1), PIECE_BYTES):
            piece = bytes(text[low : low + PIECE_BYTES + window - 1])
            held.append((piece, i, low))
            size += len(piece)
            if size >= PIECE_BYTES:
                yield made(held)
                held, size = [], 0
    if held:
        yield made(held)


def _anchors(data: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows of a text with one anchor, of RUN windows at most: first windows, their numbers of windows, anchors."""
    seed = max(1, window // 2)
    up, down = B._BYTES.get(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=prefix[1:])
    hashes = B.mix((prefix[seed:] - prefix[:-seed]) * down[: len(data) - seed + 1])
    least = B.sliding_min(hashes, window - seed + 1)
    new = np.concatenate([[True], least[1:] != least[:-1]])
    new[at[:-1][at[:-1] < len(new)]] = True
    # Windows over the edge of two texts form runs of their own, which go.
    over = at[1:-1] - window + 1
    new[over] = True
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(least)))
    inside = starts + window <= at[np.searchsorted(at, starts, side="right")]
    starts, sizes = starts[inside], sizes[inside]
    cuts = -(-sizes // RUN)
    of = np.repeat(np.arange(len(starts)), cuts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    return starts[of] + nth * RUN, np.minimum(RUN, sizes[of] - nth * RUN), B.mix(least[starts[of]] ^ _SALT)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by ranges of the upper 32 bits of a hash."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


_SEED_ROWS = "bucket int, g int, seeds binary"


def _seeds(window: int, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("seeds", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        held, ids = [], table.column("id").fill_null(-1).to_numpy()
        for data, at, row, _ in _pieces(table, window):
            starts, _, anchors = _anchors(data, at, window)
            held.append((anchors, ids[row[np.searchsorted(at, starts, side="right") - 1]]))
        if not held:
            return schema.empty_table()
        anchors, owners = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        order = np.lexsort((owners, anchors))
        anchors, owners = anchors[order], owners[order]
        fresh = np.append(True, anchors[1:] != anchors[:-1])
        first = np.flatnonzero(fresh)
        n = np.add.reduceat(fresh | np.append(True, owners[1:] != owners[:-1]), first, dtype=np.int64)
        anchors = anchors[first]
        kind = np.searchsorted(_CLASSES, n, side="right").astype(np.uint64) - np.uint64(1)
        packed = ((anchors >> np.uint64(16)) & ~np.uint64(3)) | kind
        edges = np.flatnonzero(np.diff(_bucket(anchors, buckets).astype(np.int64), prepend=-1))
        bucket = _bucket(anchors[edges], buckets).astype(np.int32)
        seeds = [_pack(packed[a:b]) for a, b in zip(edges, [*edges[1:], len(packed)])]
        return pa.table([bucket, np.full(len(edges), table.column("g")[0].as_py(), np.int32), pa.array(seeds, pa.binary())], schema=schema)

    return run


def _repeated(hot: int):
    """Back to each group: which of its seeds other documents have too, with the lowest bit set for hot ones."""
    schema = pa.schema([("g", pa.int32()), ("seeds", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        sent = [_unpack(s.as_py()) for s in table.column("seeds")]
        packed = np.concatenate(sent)
        keys, of = np.unique(packed >> np.uint64(2), return_inverse=True)
        n = np.bincount(of, weights=_CLASSES[(packed & np.uint64(3)).astype(np.int64)])
        back = (keys << np.uint64(2)) | (n >= hot).astype(np.uint64)
        out, at = [], 0
        for s in sent:
            own = of[at : at + len(s)]
            out.append(_pack(back[own[n[own] > 1]]))
            at += len(s)
        return pa.table([table.column("g"), pa.array(out, pa.binary())], schema=schema).filter(pc.greater(pc.binary_length(pa.array(out, pa.binary())), 0))

    return run


class _Occurrences:
    """Where a group's passages with repeated anchors occur, numbered by key and content: the same from the same texts and seeds."""

    def __init__(self, texts: pa.Table, seeds: pa.ChunkedArray, window: int, bodies: bool):
        known = np.sort(np.concatenate([np.zeros(0, np.uint64), *(_unpack(s.as_py()) for s in seeds)]))
        ids, held = texts.column("id").fill_null(-1).to_numpy(), []
        for data, at, row, base in _pieces(texts, window) if len(known) else ():
            starts, sizes, anchors = _anchors(data, at, window)
            own = (anchors >> np.uint64(16)) & ~np.uint64(3)
            found = np.minimum(np.searchsorted(known, own), len(known) - 1)
            use = (known[found] & ~np.uint64(3)) == own
            if not use.any():
                continue
            starts, sizes, anchors, is_hot = starts[use], sizes[use], anchors[use], (known[found[use]] & np.uint64(1)) > 0
            each = np.where(is_hot, sizes, 1)
            of = np.repeat(np.arange(len(starts)), each)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
            starts, sizes = starts[of] + nth, np.where(is_hot[of], 1, sizes[of])
            hashes = B.span_hashes(data, starts, starts + sizes + window - 1)
            keys = np.where(is_hot[of], B.mix(hashes ^ _SALT), anchors[of])
            part = np.searchsorted(at, starts, side="right") - 1
            first = np.unique(hashes, return_index=True)[1] if bodies else np.zeros(0, np.int64)
            long = sizes[first] + window - 1
            spots = np.repeat(starts[first] - (np.cumsum(long) - long), long) + np.arange(long.sum())
            held.append((hashes, keys, sizes, row[part], base[part] + starts - at[part], hashes[first], long, data[spots]))
        empty = [np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.uint64, np.int64, np.uint8)]
        hashes, self.keys, self.sizes, self.rows, self.places, *made = (np.concatenate([x, *(h[k] for h in held)]) for k, x in enumerate(empty))
        order = np.lexsort((hashes, self.keys))
        new = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (self.keys[order][1:] != self.keys[order][:-1]))[: len(order)]
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        #: Of each distinct passage one occurrence, and the least of its documents.
        self.lead = order[new]
        self.owner = np.full(len(self.lead), np.iinfo(np.int64).max)
        np.minimum.at(self.owner, self.number, ids[self.rows])
        self.hashes, self.made = hashes, made

    def bodies(self):
        """Sizes of all distinct passages' bytes, and a function that gives the bytes of some, one after the other; they come from the first piece that has them."""
        held, size, body = self.made
        at, by = np.concatenate([[0], np.cumsum(size)]), np.argsort(held, kind="stable")
        source = by[np.searchsorted(held[by], self.hashes[self.lead])]

        def of(low: int, high: int) -> np.ndarray:
            own = size[source[low:high]]
            return body[np.repeat(at[source[low:high]] - (np.cumsum(own) - own), own) + np.arange(own.sum())]

        return size[source], of


_PASSAGE_ROWS = "bucket int, g int, first int, passages binary"


def _passages(window: int, buckets: int):
    """Rows for buckets: key, size, owner and bytes of each distinct passage, and the number of the first."""
    schema = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("first", pa.int32()), ("passages", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _Occurrences(left, right.column("seeds"), window, True)
        if not len(found.lead):
            return schema.empty_table()
        sizes, bodies = found.bodies()
        keys = found.keys[found.lead]
        bucket = _bucket(keys, buckets).astype(np.int64)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        out = [_blob([keys[a:b], sizes[a:b].astype(np.int32), found.owner[a:b], bodies(a, b)]) for a, b in zip(edges, [*edges[1:], len(keys)])]
        g = np.full(len(out), left.column("g")[0].as_py(), np.int32)
        return pa.table([bucket[edges].astype(np.int32), g, edges.astype(np.int32), pa.array(out, pa.binary())], schema=schema)

    return run


def _owners(data: np.ndarray, at: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """For every window of the passages, one after the other, the least owner of an equal window: from the merged transforms of their shards."""
    cuts = np.unique(np.searchsorted(at, np.linspace(0, at[-1], SHARDS + 1)).clip(0, len(at) - 1))
    texts, starts, base = [], [], 0
    for a, b in zip(cuts, cuts[1:]):
        text, start = lay_out(data[at[a] : at[b]], at[a : b + 1] - at[a])
        texts.append(text)
        starts.append(start + base)
        base += len(text)
    starts, sizes = np.concatenate(starts), np.diff(at) - window + 1
    number = np.full(base, -1, np.int64)
    total = np.cumsum(sizes) - sizes
    windows = np.arange(sizes.sum())
    number[np.repeat(starts - total, sizes) + windows] = windows
    out = np.repeat(owner, sizes)
    suffixes, group = intervals(texts, window)
    own = number[suffixes]
    first = np.flatnonzero(np.diff(group, prepend=-1))
    if len(first):
        out[own] = np.repeat(np.minimum.reduceat(out[own], first), np.diff(np.append(first, len(group))))
    return out


def _merged(window: int):
    """Back to each group: runs of windows of its passages that have an owner before the group's own."""
    schema = pa.schema([("g", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        sent = [_arrays(p.as_py(), "u8 i4 i8 u1") for p in table.column("passages")]
        keys, sizes, owner, body = (np.concatenate([s[k] for s in sent]) for k in range(4))
        at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        edges = [np.concatenate([[0], np.cumsum(s[1], dtype=np.int64)]) for s in sent]
        hashes = np.concatenate([B.span_hashes(s[3], e[:-1], e[1:]) for s, e in zip(sent, edges)])
        order = np.lexsort((hashes, keys))
        new = np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]) | (keys[order][1:] != keys[order][:-1]) | (sizes[order][1:] != sizes[order][:-1])])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        lead = order[new]
        least = np.minimum.reduceat(owner[order], np.flatnonzero(new))
        # Parts hold whole keys: a key's passages stand together, and a part ends with the key that fills it.
        cost = np.cumsum(sizes[lead], dtype=np.int64)
        ends = np.flatnonzero(np.append(keys[lead][1:] != keys[lead][:-1], True)) + 1
        part = (cost[ends - 1] - sizes[lead[0]]) // PART_BYTES
        ends = ends[np.append(part[1:] != part[:-1], True)]
        owners = []
        for a, b in zip([0, *ends[:-1]], ends):
            size = sizes[lead[a:b]].astype(np.int64)
            spots = np.repeat(at[lead[a:b]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            owners.append(_owners(body[spots], np.concatenate([[0], np.cumsum(size)]), least[a:b], window))
        flat = np.concatenate(owners)
        n = sizes[lead].astype(np.int64) - window + 1
        begin = np.cumsum(n) - n
        of = np.repeat(np.arange(len(lead)), n)
        change = np.flatnonzero(np.concatenate([[True], (flat[1:] != flat[:-1]) | (of[1:] != of[:-1])]))
        stop = np.append(change[1:], len(flat))
        run_of, run_owner = of[change], flat[change]
        low, high = change - begin[run_of], stop - begin[run_of]
        run_at = np.searchsorted(run_of, np.arange(len(lead) + 1))
        out, done = [], 0
        for s, first in zip(sent, table.column("first").to_pylist()):
            mine = number[done : done + len(s[0])]
            done += len(s[0])
            count = run_at[mine + 1] - run_at[mine]
            nth = np.repeat(np.arange(len(mine)), count)
            spot = np.repeat(run_at[mine] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            use = run_owner[spot] < s[2][nth]
            spot, nth = spot[use], nth[use]
            out.append(_blob([(nth + first).astype(np.int32), low[spot].astype(np.int32), high[spot].astype(np.int32)]) if len(spot) else b"")
        g, data = table.column("g").combine_chunks(), pa.array(out, pa.binary())
        return pa.table([g, pa.array(np.ones(len(g), np.int32)), data], schema=schema).filter(pc.greater(pc.binary_length(data), 0))

    return run


def _stripped(window: int, schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n, texts = left.num_rows, left.column("text").combine_chunks()
        ids = left.column("id").fill_null(-1).to_numpy()
        kinds, data = right.column("kind").to_pylist(), right.column("data")
        seeds = right.filter(pc.equal(right.column("kind"), 0)).column("data")
        runs = [_arrays(d.as_py(), "i4 i4 i4") for k, d in zip(kinds, data) if k == 1]
        found = _Occurrences(left, seeds, window, False)
        later = ids[found.rows] > found.owner[found.number]
        row, low, high = found.rows[later], found.places[later], (found.places + found.sizes)[later]
        if runs:
            of, a, b = (np.concatenate([r[k] for r in runs]).astype(np.int64) for k in range(3))
            order = np.argsort(of, kind="stable")
            of, a, b = of[order], a[order], b[order]
            rows, places, number = found.rows[~later], found.places[~later], found.number[~later]
            begin = np.searchsorted(of, number)
            count = np.searchsorted(of, number, side="right") - begin
            nth = np.repeat(np.arange(len(number)), count)
            spot = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
            row, low, high = np.append(row, rows[nth]), np.append(low, places[nth] + a[spot]), np.append(high, places[nth] + b[spot])
        order = np.argsort(row, kind="stable")
        low, high, edges = low[order], high[order] + window - 1, np.searchsorted(row[order], np.arange(n + 1))
        lengths, lost, spans, kept = [], [], [], []
        for i in range(n):
            text = texts[i].as_buffer()
            text = np.frombuffer(text, np.uint8) if text is not None and len(text) else np.zeros(0, np.uint8)
            lengths.append(len(text))
            if edges[i] == edges[i + 1]:
                lost.append(0), spans.append(0), kept.append(text.tobytes())
                continue
            delta = np.zeros(len(text) + 1, np.int64)
            np.add.at(delta, low[edges[i] : edges[i + 1]], 1)
            np.add.at(delta, high[edges[i] : edges[i + 1]], -1)
            gone = np.cumsum(delta[:-1]) > 0
            lost.append(int(gone.sum())), spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())), kept.append(text[~gone].tobytes())
        return pa.table([left.column("own"), *(pa.array(x, pa.int64()) for x in (lengths, lost, spans)), pa.array(kept, pa.binary())], schema=schema)

    return run


def remove_repeats(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, group_bytes: int = GROUP_BYTES, bucket_seeds: int = BUCKET_SEEDS
) -> DataFrame:
    """One row per row of `docs`: id, n_bytes, n_removed, n_spans and the kept bytes. Texts have less than 2 GiB."""
    spark = docs.sparkSession
    base = with_places(docs.select(F.col(id_col).alias("own"), F.col(text_col).alias("text")), "own", "id")
    size = base.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    groups, buckets = max(1, -(-size // group_bytes)), max(1, -(-size // (bucket_seeds * max(1, window // 4))))
    tables = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = base.select((F.monotonically_increasing_id() % groups).cast("int").alias("g"), "own", "id", F.coalesce("text", F.lit("")).alias("text"))
    dealt = bucketed(dealt.repartition(tables, "g"), ["g"], tables)
    with ordered_buckets(spark):
        seeds = dealt.groupBy("g").applyInArrow(_seeds(window, buckets), _SEED_ROWS)
        repeated = written(seeds.groupBy("bucket").applyInArrow(_repeated(hot), "g int, seeds binary"))
        passages = dealt.groupBy("g").cogroup(repeated.groupBy("g")).applyInArrow(_passages(window, buckets), _PASSAGE_ROWS)
        # Where its passages occur a group finds out again from the same seeds: that is less than to keep.
        runs = written(passages.groupBy("bucket").applyInArrow(_merged(window), "g int, kind int, data binary"))
    found = repeated.select("g", F.lit(0).alias("kind"), F.col("seeds").alias("data")).union(runs)
    out = StructType().add("own", base.schema["own"].dataType).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")
    kept = dealt.groupBy("g").cogroup(found.groupBy("g")).applyInArrow(_stripped(window, to_arrow_schema(out)), out)
    return kept.withColumnRenamed("own", id_col)
