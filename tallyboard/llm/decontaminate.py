"""Benchmark passages in documents, by a prefix-filtered set join (operator 3).

An item's windows of 13 words (one shorter window for a shorter item) are sets of word
shingles, and a document contains a window only if it contains all of them. So of each window's
shingles, ordered by rarity in the documents, only the prefix that full containment
requires has to be joined: the one rarest shingle. An occurrence of it at word i of a
document, for a window that has it at place p, can only belong to a match that starts at
i - p; it is dropped unless all words of the window fit between the document's first and
last word there (the positional and length bounds). What is left is verified word by word.

The benchmark is dealt by hash into as many blocks as keep each at about `BLOCK_WINDOWS` windows.
The driver collects and broadcasts one block at a time, and the documents pass it without
a shuffle: one pass counts the block's shingles over all documents, one joins. Where there are several
blocks the documents are written once with a number, and a block writes what it finds for those it finds in;
this meets the documents at the end.

Blocks and documents carry numbers of windows, never lists of items: a window's items stay in a table, however
many share it. Documents in which the same windows were found have the same items, which are looked up once for each distinct set
of windows. `drop_contaminated` looks up none. Only the result's own list of a document's items is in one row.

Defined results: null and empty texts have no words; items without words have no windows; an
item without an id takes part under an empty name; repeated items and repeated documents
count each by themselves; an empty benchmark marks nothing; documents' ids are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm import bytearrays as B
from tallyboard.llm.names import free
from tallyboard.sources.scratch import written

WINDOW, SHINGLE = 13, 3
BLOCK_WINDOWS = 200_000
#: A document is contaminated if one word in so many is hit.
SHARE = 20
_BITMAP = 1 << 22
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))
_NAMES = ("_dc_words", "_dc_hit", "_dc_windows", "_dc_spans")
_TYPES = ("long", "long", "array<long>", "array<struct<start:int,n:int>>")


def _words(column: pa.Array):
    data, at = B.text_buffers(column)
    data = B.LOWER[data]
    starts, ends, first = B.word_spans(data, at, B.NOT_ALNUM)
    return data, starts, ends, first, B.span_hashes(data, starts, ends)


def _windows(window: int):
    """Rows (window, n, item): the words of every window, joined by one space."""

    def run(batches):
        for batch in batches:
            items, out = batch.column("item").to_pylist(), ([], [], [])
            for item, text in zip(items, B.row_bytes(batch.column("text"))):
                words = text.translate(_TRANSLATE).split()
                n = min(window, len(words))
                for i in range(len(words) - n + 1 if n else 0):
                    for column, value in zip(out, (b" ".join(words[i : i + n]).decode(), n, item)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string())], names=["window", "n", "item"])

    return run


_TRANSLATE = np.where(B.NOT_ALNUM, 0x20, np.arange(256)).astype(np.uint8)
_TRANSLATE[0x41:0x5B] = B.LOWER[0x41:0x5B]
_TRANSLATE = _TRANSLATE.tobytes()


@dataclass
class Block:
    """One block of the benchmark; windows are in the order of their rarest shingle."""

    texts: list[bytes]
    lengths: np.ndarray
    hashes: np.ndarray
    #: The windows' numbers in the table of windows.
    numbers: np.ndarray
    #: For each window its shingles' hashes; shorter than SHINGLE words, the window itself.
    shingles: list[np.ndarray]
    #: After `ordered`: the sorted rarest shingles, the windows of each, and its place in each window.
    keys: np.ndarray | None = None
    first: np.ndarray | None = None
    place: np.ndarray | None = None

    @staticmethod
    def of(rows) -> Block:
        texts = [r["window"].encode() for r in rows]
        lengths = np.array([r["n"] for r in rows], dtype=np.int64)
        data, _, _, first, words = _words(pa.array([r["window"] for r in rows], pa.string()))
        own = [words[a:b] for a, b in zip(first, first[1:])]
        hashes = np.array([B.window_hashes(w, len(w))[0] for w in own], dtype=np.uint64)
        shingles = [B.window_hashes(w, min(SHINGLE, len(w))) for w in own]
        return Block(texts, lengths, hashes, np.array([r["number"] for r in rows], dtype=np.int64), shingles)

    def widths(self) -> list[int]:
        return sorted({int(min(SHINGLE, n)) for n in self.lengths})

    def ordered(self, counts: dict[int, int]) -> Block:
        """Windows keyed by their rarest shingle; ties by hash, then by place."""
        place = np.array([min(range(len(s)), key=lambda p: (counts.get(int(s[p]), 0), int(s[p]), p)) for s in self.shingles], dtype=np.int64)
        rarest = np.array([s[p] for s, p in zip(self.shingles, place)], dtype=np.uint64)
        order = np.argsort(rarest, kind="stable")
        keys, first = np.unique(rarest[order], return_index=True)
        pick = lambda x: [x[i] for i in order]
        return Block(
            pick(self.texts), self.lengths[order], self.hashes[order], self.numbers[order], pick(self.shingles), keys, np.concatenate([first, [len(order)]]), place[order]
        )


class _Probe:
    """Which of many hashes are among a few: a bitmap first, then a binary search."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(_BITMAP, dtype=bool)
        self.bits[keys % np.uint64(_BITMAP)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        maybe = np.flatnonzero(self.bits[hashes % np.uint64(_BITMAP)])
        if not len(maybe):
            return maybe, maybe
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        sure = self.keys[at] == hashes[maybe]
        return maybe[sure], at[sure]


def _count(shared):
    """How often each of the block's shingles occurs."""

    def run(batches):
        block = shared.value
        keys = np.unique(np.concatenate(block.shingles))
        probe, total = _Probe(keys), np.zeros(len(keys), dtype=np.int64)
        for batch in batches:
            for part in B.chunks(batch, "text"):
                *_, first, words = _words(part.column("text"))
                for width in block.widths():
                    hashes = B.window_hashes(words, width)
                    where, at = probe(hashes)
                    inside = B.window_rows(first, width, len(hashes))[where]
                    total += np.bincount(at[inside], minlength=len(keys))
        seen = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(B.signed(keys[seen])), pa.array(total[seen])], names=["h", "n"])

    return run


def _matches(block: Block, probe: _Probe, column: pa.Array):
    """Windows found, their first words, the words of all rows; candidates pass both bounds and are verified."""
    data, starts, ends, first, words = _words(column)
    rows = B.row_of_word(first)
    of_length = {int(n): B.window_hashes(words, int(n)) for n in np.unique(block.lengths)}
    found, begin = [], []
    for width in block.widths():
        where, at = probe(B.window_hashes(words, width))
        n = block.first[at + 1] - block.first[at]
        window = np.repeat(block.first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        where = np.repeat(where, n)
        start = where - block.place[window]
        fits = (np.minimum(SHINGLE, block.lengths[window]) == width) & (start >= first[rows[where]]) & (start + block.lengths[window] <= first[rows[where] + 1])
        found.append(window[fits])
        begin.append(start[fits])
    window, start = np.concatenate(found), np.concatenate(begin)
    same = np.zeros(len(window), dtype=bool)
    for n, hashes in of_length.items():
        mine = np.flatnonzero(block.lengths[window] == n)
        same[mine] = hashes[start[mine]] == block.hashes[window[mine]] if len(hashes) else False
    window, start = window[same], start[same]
    raw = data.tobytes()
    exact = np.fromiter(
        (
            b" ".join(raw[a:b] for a, b in zip(starts[s : s + n], ends[s : s + n])) == block.texts[w]
            for w, s, n in zip(window.tolist(), start.tolist(), block.lengths[window].tolist())
        ),
        dtype=bool,
        count=len(window),
    )
    return window[exact], start[exact], first


def _found(block: Block, probe: _Probe, column: pa.Array) -> tuple[list[list[dict]], list[set[int]], np.ndarray]:
    """Of each row the spans and the numbers of the windows found, and the rows' first words."""
    spans, windows = [[] for _ in range(len(column))], [set() for _ in range(len(column))]
    window, start, first = _matches(block, probe, column)
    row = np.searchsorted(first, start, side="right") - 1
    for r, w, s in zip(row.tolist(), window.tolist(), (start - first[row]).tolist()):
        spans[r].append({"start": s, "n": int(block.lengths[w])})
        windows[r].add(int(block.numbers[w]))
    return spans, windows, first


def _hits(shared, text: str, number: str):
    """Rows (number, windows, spans) of the documents in which the block finds anything."""

    def run(batches):
        block = shared.value
        probe = _Probe(block.keys)
        for batch in batches:
            for part in B.chunks(batch, text):
                spans, windows, _ = _found(block, probe, part.column(text))
                hit = [r for r, own in enumerate(spans) if own]
                yield pa.RecordBatch.from_arrays(
                    [part.column(number).take(pa.array(hit, pa.int64())), pa.array([sorted(windows[r]) for r in hit], pa.list_(pa.int64())), pa.array([spans[r] for r in hit], _SPANS)],
                    names=[number, "windows", "spans"],
                )

    return run


def _join(shared, text: str, columns: list[str], only_clean: bool, names: tuple[str, ...], known: bool):
    """Adds the columns `names`; what several blocks found comes with the rows, if it is `known`."""

    def run(batches):
        block = shared.value
        probe = _Probe(block.keys) if block is not None else None
        for batch in batches:
            for part in B.chunks(batch, text):
                if block is None:
                    *_, first, _ = _words(part.column(text))
                    spans, windows = ([x or [] for x in part.column(c).to_pylist()] if known else [[] for _ in range(part.num_rows)] for c in (names[3], names[2]))
                else:
                    spans, windows, first = _found(block, probe, part.column(text))
                n_words = np.diff(first)
                hit = np.zeros(part.num_rows, dtype=np.int64)
                for r, own in enumerate(spans):
                    if own:
                        mark = np.zeros(n_words[r], dtype=bool)
                        for s in own:
                            mark[s["start"] : s["start"] + s["n"]] = True
                        hit[r] = mark.sum()
                added = [pa.array(n_words, pa.int64()), pa.array(hit), pa.array([sorted(x) for x in windows], pa.list_(pa.int64())), pa.array(spans, _SPANS)]
                if only_clean:
                    clean = pa.array(~((hit > 0) & (SHARE * hit >= n_words)))
                    yield part.select(columns).filter(clean)
                else:
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *added], names=[*columns, *names])

    return run


def _read_windows(benchmark: DataFrame, window: int, item_col: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """The benchmark's distinct windows (window, n, number), and which items have each: rows (window, item), one for each pair."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text"))
    pairs = written(items.mapInArrow(_windows(window), "window string, n int, item string").distinct())
    return written(pairs.select("window", "n").distinct().withColumn("number", F.monotonically_increasing_id())), pairs.select("window", "item")


def _search(docs: DataFrame, windows: DataFrame, text_col: str, columns: list[str], only_clean: bool, block_windows: int) -> tuple[DataFrame, tuple[str, ...]]:
    """`columns` of `docs`, of clean rows alone or with four more columns, and the names of these."""
    spark = docs.sparkSession
    n_blocks = max(1, -(-windows.count() // block_windows))
    names, number = tuple(free(docs, x) for x in _NAMES), free(docs, "_dc_number")
    out = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    if not only_clean:
        out = ", ".join([out, *(f"`{c}` {kind}" for c, kind in zip(names, _TYPES))])

    def block(k: int):
        rows = windows.where(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == k).collect()
        if not rows:
            return None
        shared = spark.sparkContext.broadcast(Block.of(rows))
        counts = docs.select(F.col(text_col).alias("text")).mapInArrow(_count(shared), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
        known = {int(h): n for h, n in zip(*(c.to_numpy() for c in _unsigned_columns(counts.toArrow())))}
        return spark.sparkContext.broadcast(shared.value.ordered(known))

    nothing = spark.sparkContext.broadcast(None)
    if n_blocks == 1:
        return docs.mapInArrow(_join(block(0) or nothing, text_col, columns, only_clean, names, False), out), names
    docs = written(docs.withColumn(number, F.monotonically_increasing_id()))
    finds = []
    for k in range(n_blocks):
        if shared := block(k):
            hits = docs.select(number, text_col).mapInArrow(_hits(shared, text_col, number), f"`{number}` long, windows {_TYPES[2]}, spans {_TYPES[3]}")
            finds.append(written(hits))
    all_ = lambda c: F.flatten(F.collect_list(c))
    each = reduce(DataFrame.unionByName, finds).groupBy(number).agg(all_("windows").alias(names[2]), all_("spans").alias(names[3]))
    return docs.join(each, number, "left").mapInArrow(_join(nothing, text_col, columns, only_clean, names, True), out), names


def _unsigned_columns(table: pa.Table):
    h = table.column("h").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64)
    return pa.array(h), table.column("n").combine_chunks()


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """One row per row of `docs`: id, n_words, n_hit, items (ids of items with a window in it), spans of words, contaminated."""
    windows, owners = _read_windows(benchmark, window, item_col, item_text)
    found, names = _search(docs.select(id_col, text_col), windows, text_col, [id_col], False, block_windows)
    words, hit, which, spans = names
    key, items = free(found, "_dc_set"), free(found, "_dc_items")
    found = written(found.withColumn(which, F.array_sort(which)))
    # A set of windows is a key that many documents may share: their items are listed once, and documents without any take no part.
    sets = found.where(F.size(which) > 0).select(F.col(which).alias(key)).distinct()
    pairs = sets.withColumn("number", F.explode(key)).join(windows, "number").join(owners, "window")
    listed = pairs.groupBy(key).agg(F.array_sort(F.collect_set("item")).alias(items))
    some = found.where(F.size(which) > 0).join(listed, F.col(which) == F.col(key))
    none = found.where(F.size(which) == 0).withColumn(items, F.array().cast("array<string>"))

    def named(rows: DataFrame) -> DataFrame:
        out = [rows[id_col], rows[words].alias("n_words"), rows[hit].alias("n_hit"), rows[items].alias("items"), rows[spans].alias("spans")]
        return rows.select(*out, ((rows[hit] > 0) & (SHARE * rows[hit] >= rows[words])).alias("contaminated"))

    return named(some).unionAll(named(none))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """The rows of `docs` that are not contaminated, as they are."""
    return _search(docs, _read_windows(benchmark, window, item_col, item_text)[0], text_col, docs.columns, True, block_windows)[0]
