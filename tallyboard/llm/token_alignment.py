"""Alignment of two tokenizers over the same texts (operator 12).

Tokens of both tokenizers are laid over the bytes of space + text. The alignment is relational: tokens are exploded with
their places, a window adds up their lengths, a full outer equi-join of both sides on (segment, end) finds the ends
they share, and running counts of these cuts are the group ids. Between two neighbouring ends of either side lies one token
of each, and every overlapping pair has exactly one such interval, so the links are the joined ends with the next
token of either side filled in: an as-of form of the range join, linear even where two tokenizers never agree.

What is joined are not documents but their distinct segments. Both tokenizers always cut before a space or a
line feed that follows a character other than white space (checked against the vocabularies), so a document's tokens are those of
its segments one after the other, and the work grows with the distinct segments.

Rows and sizes. The segments of most occurrences, up to `hot_bytes` of them by their places in a histogram of counts, are broadcast
with their groups and links; all other segments meet their documents by joins, of which the side of documents is stored in
buckets once. A document's set of linked pairs meets in its own row, tasks add up their pairs before the shuffle, and counts
are looked up in blocks of at most `block_pairs` pairs. Hashes of segments have 64 bits and are compared with
the length.

Defined results: a null or empty text, and one whose joined token bytes differ from space + text (such as one with U+2581),
has no tokens: zeros and empty groups. Rows are documents of their own whatever their ids. Ties of the best count all count.
"""

from __future__ import annotations

import json
import re
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StructType

from tallyboard.llm import bytearrays as B
from tallyboard.sources.scratch import bucketed, discard, ordered_buckets, written

#: Bytes of the broadcast segments, of the pairs in a block of counts, of segments that one call encodes.
HOT_BYTES, BLOCK_PAIRS, CALL_BYTES = 32 << 20, 1 << 22, 1 << 20
_GUARD = " x"
_BINS = 8


def files(byte_bpe: str, pieces: str) -> tuple[bytes, bytes]:
    """The two vocabulary files, which only the driver needs to reach."""
    with open(byte_bpe, "rb") as a, open(pieces, "rb") as b:
        return a.read(), b.read()


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Side:
    """One tokenizer: `encode` gives ids of space + text, `pieces` each id's bytes and `lengths` their number."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)


@lru_cache(maxsize=2)
def _byte_bpe(data: bytes) -> _Side:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data.decode())
    tokenizer.encode_special_tokens = True
    letters, special = _byte_letters(), {t["id"] for t in json.loads(data).get("added_tokens", [])}
    by_id = {i: token for token, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    pieces = [by_id.get(i, "").encode() if i in special else bytes(letters[c] for c in by_id.get(i, "")) for i in range(max(by_id) + 1)]
    return _Side(lambda text: tokenizer.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, pieces)


@lru_cache(maxsize=2)
def _sentence_pieces(data: bytes) -> _Side:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=data)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            pieces.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i):
            pieces.append(b"")
        elif model.is_unknown(i):
            pieces.append(b"\0\0")  # equals no byte of a text, so a text with it has no tokens
        else:
            pieces.append(piece.replace("▁", " ").encode())
        if re.search(r"[^\s▁][ \n▁]", piece) and not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            raise ValueError(f"piece {i} goes over the start of a segment")
    return _Side(model.encode, pieces)


def _segment_tokens(side: _Side, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all segments in one array, and where each segment's begin and how many there are; none where their bytes are others than the segment's.

    Many segments are encoded at once behind a guard word: whatever stands before a segment does not change its tokens. Those after which none
    may stand are encoded alone.
    """
    own = [s for s in segments if "▁" not in s and _SAFE_END.search(s)]
    joint = np.array([bool("▁" not in s and _SAFE_END.search(s)) for s in segments], dtype=bool)
    text = _GUARD + "".join(own)
    ids = side.encode(text[1:])
    begin, count = np.zeros(len(segments), np.int64), np.zeros(len(segments), np.int64)
    flat = np.array(ids, dtype=np.int64)
    if own and b"".join([side.pieces[i] for i in ids]) == text.encode():
        ends = np.cumsum(side.lengths[flat])
        stops = len(_GUARD) + np.cumsum([0, *(len(s.encode()) for s in own)])
        cuts = np.searchsorted(ends, stops) + 1
        if (ends[cuts - 1] != stops).any():
            raise ValueError("a token goes over the start of a segment")
        begin[joint], count[joint] = cuts[:-1], np.diff(cuts)
    else:
        joint[:] = False
    guard, more, size = len(side.encode(_GUARD[1:])), [flat], len(flat)
    for i in np.flatnonzero(~joint):
        text = _GUARD + segments[i]
        ids = side.encode(text[1:])
        if b"".join([side.pieces[k] for k in ids]) == text.encode():
            begin[i], count[i] = size, len(ids) - guard
            more.append(np.array(ids[guard:], dtype=np.int64))
            size += count[i]
    return np.concatenate(more), begin, count


#: The last character of a segment that another may follow: no white space of any script, and no control character.
_SAFE_END = re.compile(r"[^\s\x00-\x20\x7f\x85\xa0]\Z")


def _segments(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of space + text of each row, the starts and ends of all segments, and each row's first segment; null and empty texts have none."""
    full = pc.if_else(pc.equal(pc.fill_null(texts, ""), ""), "", pc.binary_join_element_wise("", texts, " ")) if len(texts) else texts
    data, at = B.text_buffers(full)
    n = len(data)
    if not n:
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    last = np.zeros(n, np.uint8)
    last[1:] = data[:-1]
    cut = ((data == 0x20) | (data == 0x0A)) & (last > 0x20) & (last != 0x7F)
    at_wide = np.flatnonzero(cut & (last >= 0x80))
    second, third = data[at_wide - 2], np.where(at_wide > 2, data[at_wide - 3], 0)
    # White space and its neighbours among the characters of two and three bytes.
    white = ((second == 0xC2) & (last[at_wide] <= 0xA0)) | (np.isin(third, (0xE1, 0xE2, 0xE3)) & np.isin(second, (0x80, 0x81, 0x9A)))
    cut[at_wide[white]] = False
    cut[at[:-1][np.diff(at) > 0]] = True
    starts = np.flatnonzero(cut)
    return data, starts, np.append(starts[1:], n), np.searchsorted(starts, at)


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as strings."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    places = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[places].tobytes())])


def _counted():
    """Rows (seg, n) of a task's distinct segments, written out whenever many are held."""
    schema = pa.schema([("seg", pa.string()), ("n", pa.int64())])

    def merged(held: list) -> pa.RecordBatch:
        table = pa.table({"seg": pa.chunked_array([h[0] for h in held]), "n": pa.chunked_array([h[1] for h in held])})
        total = table.group_by("seg").aggregate([("n", "sum")]).combine_chunks()
        return pa.RecordBatch.from_arrays([pc.cast(total.column("seg").combine_chunks(), pa.string()), total.column("n_sum").combine_chunks()], schema=schema)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in B.chunks(batch, "text"):
                data, starts, ends, _ = _segments(part.column("text"))
                if not len(starts):
                    continue
                _, first, n = np.unique(B.span_hashes(data, starts, ends), return_index=True, return_counts=True)
                held.append((_strings(data, starts[first], ends[first]), pa.array(n)))
                size += int((ends[first] - starts[first]).sum()) + 16 * len(first)
                if size > 64 << 20:
                    yield merged(held)
                    held, size = [], 0
        if held:
            yield merged(held)

    return run


def _tokenized(data: Broadcast, call_bytes: int):
    item = pa.list_(pa.struct([("id", pa.int32()), ("len", pa.int32())]))
    schema = pa.schema([("seg", pa.string()), ("n", pa.int64()), ("a", item), ("b", item)])

    def lists(side: _Side, ids: np.ndarray, begin: np.ndarray, count: np.ndarray) -> pa.Array:
        at = np.concatenate([[0], np.cumsum(count)])
        ids = ids[np.repeat(begin - at[:-1], count) + np.arange(at[-1])]
        values = pa.StructArray.from_arrays([pa.array(ids, pa.int32()), pa.array(side.lengths[ids], pa.int32())], ["id", "len"])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)

    def run(batches):
        sides = _byte_bpe(data.value[0]), _sentence_pieces(data.value[1])
        for batch in batches:
            for part in B.chunks(batch, "seg", call_bytes):
                segments = part.column("seg").to_pylist()
                tokens = [_segment_tokens(side, segments) for side in sides]
                both = (tokens[0][2] > 0) & (tokens[1][2] > 0)
                columns = [lists(side, ids, begin, np.where(both, count, 0)) for side, (ids, begin, count) in zip(sides, tokens)]
                yield pa.RecordBatch.from_arrays([part.column("seg"), part.column("n"), *columns], schema=schema)

    return run


@contextmanager
def _in_place(spark: SparkSession):
    """Plans made within join on (segment, end) what lies in one partition by segment already, and group sorted rows as they come."""
    wanted = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.execution.replaceHashWithSortAgg": "true"}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _listed():
    """Per segment its counts, links and groups as text, from its joined ends in any order."""
    schema = pa.schema([("seg", pa.string()), ("n", pa.int64()), *((c, pa.int32()) for c in ("n_a", "n_b", "n_groups")), ("groups", pa.string()), ("links", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            ends, sizes = batch.column("ends").flatten(), pc.list_value_length(batch.column("ends")).to_numpy(zero_copy_only=False).astype(np.int64)
            seg = np.repeat(np.arange(batch.num_rows), sizes)
            field = lambda c: pc.fill_null(pc.struct_field(ends, c), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((field("end"), seg))
            seg, group, a, b = seg[order], field("group")[order], field("a_id")[order], field("b_id")[order]
            links, at = pa.array(field("link")[order]), np.concatenate([[0], np.cumsum(sizes)])
            # Groups count from the end of a segment; those of all segments are numbered from the start of the batch.
            fresh = np.concatenate([[True], (seg[1:] != seg[:-1]) | (group[1:] != group[:-1])]) if len(seg) else np.zeros(0, bool)
            number = np.cumsum(fresh) - 1
            count = lambda use, of, n: np.bincount(of[use], minlength=n)
            texts = []
            for side in (a, b):
                edges = np.concatenate([[0], np.cumsum(count(side >= 0, number, int(fresh.sum())))])
                ids = pa.array(side[side >= 0]).cast(pa.string())
                texts.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), ids), ","))
            groups = pc.binary_join_element_wise(*texts, "|")
            n_groups = count(fresh, seg, batch.num_rows)
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_groups)]), pa.int32()), groups), ";")
            columns = [count(a >= 0, seg, batch.num_rows), count(b >= 0, seg, batch.num_rows), n_groups]
            yield pa.RecordBatch.from_arrays(
                [batch.column("seg"), batch.column("n"), *(pa.array(c, pa.int32()) for c in columns), text, pa.ListArray.from_arrays(pa.array(at, pa.int32()), links)], schema=schema
            )

    return run


def align_segments(tokens: DataFrame, width: int) -> DataFrame:
    """seg, n, n_a, n_b, n_groups, groups and links (a_id * width + b_id, in order) of each segment that has tokens."""

    def side(name: str) -> DataFrame:
        each = tokens.select("seg", "n", F.posexplode(name).alias("pos", "token"))
        upto = Window.partitionBy("seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        return each.select("seg", F.col("n").alias(f"{name}_n"), F.sum("token.len").over(upto).alias("end"), F.col("token.id").alias(f"{name}_id"))

    ends = side("a").join(side("b"), ["seg", "end"], "full")
    from_end = Window.partitionBy("seg").orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    cut = (F.col("a_id").isNotNull() & F.col("b_id").isNotNull()).cast("int")
    over = lambda c: F.last(c, ignorenulls=True).over(from_end)
    link = (over("a_id").cast("long") * width + over("b_id")).alias("link")
    joined = ends.select("seg", "end", "a_id", "b_id", F.coalesce("a_n", "b_n").alias("n"), F.sum(cut).over(from_end).alias("group"), link)
    whole = joined.groupBy("seg").agg(F.max("n").alias("n"), F.collect_list(F.struct("end", "group", "a_id", "b_id", "link")).alias("ends"))
    return whole.mapInArrow(_listed(), "seg string, n long, n_a int, n_b int, n_groups int, groups string, links array<long>")


def _cost() -> Column:
    """Bytes of a broadcast segment."""
    return F.octet_length("seg") + F.octet_length("groups") + 8 * F.size("links") + 40


def _one(column: pa.ChunkedArray) -> pa.Array:
    """The column in one piece."""
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _packed():
    """Broadcast segments as the driver gets them: a hash and a length instead of the text."""
    schema = pa.schema([("hash", pa.int64()), ("size", pa.int32()), *((c, pa.int32()) for c in ("n_a", "n_b", "n_groups")), ("groups", pa.string()), ("links", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            data, at = B.text_buffers(batch.column("seg"))
            hashes = B.span_hashes(data, at[:-1], at[1:]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(np.diff(at), pa.int32()), *(batch.column(c) for c in schema.names[2:])], schema=schema)

    return run


_PACKED = "hash long, size int, n_a int, n_b int, n_groups int, groups string, links array<long>"


def _let_go() -> None:
    """Arrow's freed memory goes back to the system: the driver may have little."""
    pa.default_memory_pool().release_unused()


class _Hot:
    """The broadcast segments, sorted by hash: groups' texts, counts, and links as rows of one flat array."""

    def __init__(self, packed: DataFrame):
        columns = dict(zip(packed.columns, packed.toArrow().columns))  # each goes when it is read
        hashes = columns.pop("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.sizes = hashes[order], columns.pop("size").to_numpy()[order]
        self.counts = np.stack([columns.pop(c).to_numpy()[order] for c in ("n_a", "n_b", "n_groups")], axis=1).reshape(len(order), 3)
        self.groups = _one(columns.pop("groups")).take(pa.array(order))
        lists = _one(columns.pop("links")).take(pa.array(order))
        self.link_at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        self.links = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    def find(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Each segment's row, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where((self.hashes[at] == hashes) & (self.sizes[at] == sizes), at, -1)


def _compact(hot: Broadcast, schema: pa.Schema):
    """Per row the segments in order: a hot one's row, or -1 - k for the k-th of the row's other distinct segments, which are listed with their counts."""

    def run(batches):
        for batch in batches:
            for part in B.chunks(batch, "text"):
                data, starts, ends, first = _segments(part.column("text"))
                hashes = B.span_hashes(data, starts, ends)
                seq = hot.value.find(hashes, ends - starts)
                rare, row = np.flatnonzero(seq < 0), B.row_of_word(first)
                own = B.mix(hashes[rare] ^ B.mix(row[rare].astype(np.uint64) + np.uint64(1)))
                _, at, of, n = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
                order = np.argsort(at)  # first places go by row
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                at, n = rare[at[order]], n[order]
                edges = np.searchsorted(row[at], np.arange(part.num_rows + 1))
                seq[rare] = -1 - (rank[of] - edges[row[rare]])
                rest = pa.StructArray.from_arrays([_strings(data, starts[at], ends[at]).cast(pa.string()), pa.array(n, pa.int32())], ["seg", "n"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(seq, pa.int32())),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rest),
                    ],
                    schema=schema,
                )

    return run


def _slices(batch: pa.RecordBatch, limit: int = 1 << 18):
    """Slices of a batch with about `limit` segments each; a row is never split."""
    sizes = pc.fill_null(pc.list_value_length(batch.column("seq")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
    for low, high in zip(edges, edges[1:]):
        yield batch.slice(low, high - low)


class _Batch:
    """A batch of rows joined with their rare segments: `flat` numbers every occurrence, hot rows first, then the batch's rare segments."""

    def __init__(self, batch: pa.RecordBatch, hot: _Hot):
        n, seqs, rares = batch.num_rows, batch.column("seq"), batch.column("rare")
        self.n = n
        seq_sizes = pc.fill_null(pc.list_value_length(seqs), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        rare_sizes = pc.fill_null(pc.list_value_length(rares), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(seq_sizes)])
        rare_at = np.concatenate([[0], np.cumsum(rare_sizes)])
        self.row = np.repeat(np.arange(n), seq_sizes)
        seq = seqs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        fields = rares.flatten()
        self.rare_row, size = np.repeat(np.arange(n), rare_sizes), len(hot.hashes)
        # A rare segment without tokens is not in the list: the places of those that are there decide.
        place = {c: pc.struct_field(fields, c) for c in ("k", "n_a", "n_b", "n_groups", "groups", "links")}
        most = int(max(-seq.min(initial=0), 0)) + 1
        keys = self.rare_row * most + place["k"].to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(keys)
        keys = keys[order]
        other = np.flatnonzero(seq < 0)
        wanted = self.row[other] * most + (-1 - seq[other])
        found = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        there = keys[found] == wanted if len(keys) else np.zeros(len(wanted), bool)
        self.bad = np.zeros(n, bool)
        self.bad[self.row[other[~there]]] = True
        flat = seq.copy()
        flat[other] = size + (order[found] if len(keys) else 0)
        flat[other[~there]] = 0
        self.flat, self.size = flat, size
        self.groups, self.links = place["groups"], place["links"]
        self.counts = np.stack([place[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n_a", "n_b", "n_groups")], axis=1).reshape(len(fields), 3)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct (row, hot segment) of rows that have tokens."""
        use = (self.flat < self.size) & ~self.bad[self.row]
        keys = np.unique(self.row[use] * max(1, self.size) + self.flat[use])
        return keys // max(1, self.size), keys % max(1, self.size)


def _spread(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the items of `rows` in a flat array with offsets `at`, and which of the rows each belongs to."""
    sizes = at[rows + 1] - at[rows]
    total = np.concatenate([[0], np.cumsum(sizes)])
    return np.repeat(at[rows] - total[:-1], sizes) + np.arange(total[-1]), np.repeat(np.arange(len(rows)), sizes)


def _linked(hot: Broadcast):
    """Rows (link, n): how many of a task's rows hold each pair linked."""
    schema = pa.schema([("link", pa.int64()), ("n", pa.int64())])

    def summed(held: list) -> tuple[np.ndarray, np.ndarray]:
        keys, of = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(of, weights=np.concatenate([n for _, n in held]), minlength=len(keys)).astype(np.int64)

    def run(batches):
        held, size = [], 0
        for batch in (part for whole in batches for part in _slices(whole)):
            known, rows = hot.value, _Batch(batch, hot.value)
            row, segment = rows.distinct()
            place, of = _spread(known.link_at, segment)
            rare_sizes = pc.list_value_length(rows.links).to_numpy(zero_copy_only=False).astype(np.int64)
            rare_row, rare_links = np.repeat(rows.rare_row, rare_sizes), rows.links.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            fine = ~rows.bad[rare_row]
            links = np.concatenate([known.links[place], rare_links[fine]])
            pairs, code = np.unique(links, return_inverse=True)
            keys = np.unique(np.concatenate([row[of], rare_row[fine]]) * max(1, len(pairs)) + code)
            n = np.bincount(keys % max(1, len(pairs)), minlength=len(pairs))
            held.append((pairs, n))
            size += len(pairs)
            if size > 1 << 20:
                held = [summed(held)]
                size = len(held[0][0])
                if size > 1 << 19:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed(held)], schema=schema)

    return run


def _looked_up(block: tuple, links: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each link's count, and whether it is its A id's best; zeros for links of other blocks."""
    keys, counts, best = block
    if not len(keys) or not len(links):
        return np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
    at = np.minimum(np.searchsorted(keys, links), len(keys) - 1)
    n = np.where(keys[at] == links, counts[at], 0)
    return n, ((n > 0) & (n == best[np.minimum(links // width, len(best) - 1)])).astype(np.int64)


def _rare_sums(block: Broadcast, width: int):
    """Rows (row, count_sum, n_best): what a row's rare segments add to its links' sums, by one block of counts."""
    schema = pa.schema([("row", pa.int64()), ("count_sum", pa.int64()), ("n_best", pa.int64())])

    def run(batches):
        for batch in batches:
            fields = batch.column("rare").flatten()
            lists = pc.struct_field(fields, "links")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            links = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(sizes)])
            n = pc.struct_field(fields, "n").to_numpy(zero_copy_only=False).astype(np.int64)
            edges = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("rare")).to_numpy(zero_copy_only=False))]).astype(np.int64)
            sums = [B.row_sums(n * B.row_sums(x, at), edges) for x in _looked_up(block.value, links, width)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, sums)], schema=schema)

    return run


def _results(hot: Broadcast, hot_sums: Broadcast, schema: pa.Schema):
    def run(batches):
        for batch in (part for all_ in batches for part in _slices(all_)):
            known, rows = hot.value, _Batch(batch, hot.value)
            at, flat, whole = rows.at, rows.flat, ~rows.bad
            cold_links = pc.list_value_length(rows.links).to_numpy(zero_copy_only=False).astype(np.int64)
            table = np.concatenate([np.column_stack([known.counts, np.diff(known.link_at), *hot_sums.value]), np.column_stack([rows.counts, cold_links, np.zeros((len(cold_links), 2), np.int64)])])
            sums = [np.where(whole, B.row_sums(table[flat, c], at), 0) for c in range(6)]
            for c, name in ((4, "rare_sum"), (5, "rare_best")):
                sums[c] = sums[c] + np.where(whole, pc.fill_null(batch.column(name), 0).to_numpy(zero_copy_only=False), 0)
            used, of = np.unique(flat, return_inverse=True)
            near, far = used[used < rows.size], used[used >= rows.size] - rows.size
            texts = pa.chunked_array([known.groups.take(pa.array(near)), rows.groups.take(pa.array(far))]).combine_chunks()
            keep = whole[rows.row]
            kept_at = np.concatenate([[0], np.cumsum(np.where(whole, np.diff(at), 0))])
            lists = pa.LargeListArray.from_arrays(pa.array(kept_at, pa.int64()), texts.cast(pa.large_string()).take(pa.array(of[keep])))
            groups = pc.binary_join(lists, pa.scalar(";", pa.large_string()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, sums), groups.cast(schema.field("groups").type)], schema=schema)

    return run


def align(
    docs: DataFrame, vocabularies: tuple[bytes, bytes], id_col: str = "doc_id", text_col: str = "text", hot_bytes: int = HOT_BYTES, block_pairs: int = BLOCK_PAIRS
) -> DataFrame:
    """One row per row of `docs`: id, n_a, n_b, n_groups, n_links, count_sum, n_best and `groups`, such as `a1,a2|b1;a3|b2,b3`.

    `vocabularies` holds the files of a byte-level BPE (side A) and of a sentence-piece model (side B), as `files` reads them.
    A link's count is the number of rows that hold its pair of ids linked; it is best if no other pair of its A id has more.
    """
    spark = docs.sparkSession
    width = len(_sentence_pieces(vocabularies[1]).pieces)
    shared = spark.sparkContext.broadcast(vocabularies)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    counts = base.select("text").mapInArrow(_counted(), "seg string, n long").repartition(buckets, "seg").groupBy("seg").agg(F.sum("n").alias("n"))
    tokens = bucketed(counts.mapInArrow(_tokenized(shared, CALL_BYTES), "seg string, n long, a array<struct<id:int,len:int>>, b array<struct<id:int,len:int>>"), ["seg"], buckets)
    with _in_place(spark), ordered_buckets(spark):
        aligned = bucketed(align_segments(tokens, width), ["seg"], buckets)
    discard(tokens)
    shared.destroy()

    bin_ = F.floor(F.log2("n") * _BINS)
    total, least = 0, None
    for r in aligned.groupBy(bin_.alias("bin")).agg(F.sum(_cost().cast("long")).alias("cost")).orderBy(F.desc("bin")).collect():
        total += r.cost
        if total > hot_bytes:
            break
        least = r.bin
    hot = _Hot(aligned.where(F.lit(False) if least is None else bin_ >= least).select("seg", "n_a", "n_b", "n_groups", "groups", "links").mapInArrow(_packed(), _PACKED))
    known = spark.sparkContext.broadcast(hot)
    hot_links, link_at = hot.links, hot.link_at  # all that the driver reads again
    del hot
    _let_go()

    schema = StructType().add("id", base.schema["id"].dataType).add("seq", ArrayType(IntegerType())).add("rest", ArrayType(StructType().add("seg", "string").add("n", IntegerType())))
    numbered = base.mapInArrow(_compact(known, to_arrow_schema(schema)), schema).withColumn("row", F.monotonically_increasing_id())
    # Rows are wide: a bucket of them goes to Python as one batch.
    row_buckets = 4 * buckets
    compact = bucketed(numbered.repartition(row_buckets, "row"), ["row"], row_buckets)
    rare = compact.select("row", F.posexplode("rest").alias("k", "rest")).select("row", "k", F.col("rest.seg").alias("seg"), F.col("rest.n").alias("n"))
    payload = aligned.select("seg", "n_a", "n_b", "n_groups", "groups", "links")
    met = rare.join(payload, "seg").select("row", F.struct("k", "n", "n_a", "n_b", "n_groups", "groups", "links").alias("rare"))
    rare = bucketed(met.repartition(row_buckets, "row").groupBy("row").agg(F.collect_list("rare").alias("rare")), ["row"], row_buckets)
    discard(aligned)

    with ordered_buckets(spark):
        pairs = compact.join(rare, "row", "left").select("seq", "rare").mapInArrow(_linked(known), "link long, n long")
        pairs = written(pairs.groupBy("link").agg(F.sum("n").alias("n")))
    a_id = F.expr(f"link div {width}").cast("int")
    tops = pairs.groupBy(a_id.alias("a")).agg(F.max("n").alias("n")).toArrow()
    best = np.zeros(1 + (pc.max(tops.column("a")).as_py() or 0), np.int64)
    best[tops.column("a").to_numpy()] = tops.column("n").to_numpy()
    blocks = max(1, -(-pairs.count() // block_pairs))
    hot_sums, rare_sums, lent = [np.zeros(len(link_at) - 1, np.int64) for _ in range(2)], None, []
    for b in range(blocks):
        links, n = (c.to_numpy() for c in pairs.where(F.pmod(F.xxhash64("link"), F.lit(blocks)) == b).toArrow().columns)
        order = np.argsort(links)
        block = links[order], n[order], best
        del links, n, order
        _let_go()
        hot_sums = [s + B.row_sums(x, link_at) for s, x in zip(hot_sums, _looked_up(block, hot_links, width))]
        lent.append(spark.sparkContext.broadcast(block))
        part = rare.mapInArrow(_rare_sums(lent[-1], width), "row long, count_sum long, n_best long")
        rare_sums = part if rare_sums is None else rare_sums.union(part)
    del block
    rare_sums = written(rare_sums.groupBy("row").agg(F.sum("count_sum").alias("rare_sum"), F.sum("n_best").alias("rare_best")))
    for block in lent:  # read to the end: the driver's copies go as well
        block.destroy()

    out = StructType().add("id", base.schema["id"].dataType)
    for c in ("n_a", "n_b", "n_groups", "n_links", "count_sum", "n_best"):
        out = out.add(c, "long")
    out = out.add("groups", "string")
    joined = compact.join(rare, "row", "left").join(rare_sums, "row", "left").select("id", "seq", "rare", "rare_sum", "rare_best")
    found = joined.mapInArrow(_results(known, spark.sparkContext.broadcast(hot_sums), to_arrow_schema(out)), out)
    return found.withColumnRenamed("id", id_col)
