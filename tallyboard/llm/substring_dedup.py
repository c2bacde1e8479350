"""Removal of passages that an earlier document already holds (operator 1).

Level-wise doubling. Level 1 looks at windows of half the wanted length. From each wanted
window one half-length window is selected by its content alone (the least hash inside it),
so equal windows select equal halves and about one half in thirteen needs to be compared.
Only windows whose half is repeated in another document are extended to twice that length
and compared at level 2, which decides what is removed: a repeat of any greater length is
covered by its windows of the wanted length. `longest_repeats` goes on from there. At each
level, windows repeated at length n in two halves are extended to 2 n, until no candidate is left.

Rows and sizes. Seeds and candidates travel as pairs of a hash and an id; texts travel once,
by document. Documents with exactly the same text as an earlier one are taken whole from
the class of equal texts and send no windows. A seed held by more than `hot` documents has
the rows of its windows dealt over salts: within one salt all but the smallest id are settled, and the
smallest ids meet in a second, small step. Seeds have hashes of 64 bits, which only choose what is
compared; windows are compared by such a hash and 32 bits of another of a different base, and count as equal if both are.

Defined results: a null text has no words; a null id neither removes nor loses words; rows
that share an id are one document's and do not remove each other's words, and being a whole copy
is a matter of each such row; ids are of any type that can be sorted; further columns are not read.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegralType

from tallyboard.llm import bytearrays as B
from tallyboard.llm.ids import with_places
from tallyboard.sources.scratch import written

SALTS = 64


def _seed_of_windows(words: np.ndarray, seed: int, window: int) -> np.ndarray:
    """For every window, the least seed hash inside it."""
    hashes = B.window_hashes(words, seed)
    width = window - seed + 1
    return B.sliding_min(hashes, width) if len(hashes) >= width else np.zeros(0, np.uint64)


def _second(words: np.ndarray, length: int) -> np.ndarray:
    """The upper 32 bits of the windows' second hash."""
    return (B.window_hashes(words, length, second=True) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _chunk_words(batch: pa.RecordBatch):
    data, at = B.text_buffers(batch.column("text"))
    starts, ends, first = B.word_spans(data, at, B.WHITE)
    return B.span_hashes(data, starts, ends), first


def _seeds(window: int, seed: int):
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in B.chunks(batch, "text"):
                ids = part.column("id").to_numpy(zero_copy_only=False)
                words, first = _chunk_words(part)
                least = _seed_of_windows(words, seed, window)
                out_ids, out_h = [], []
                for i in np.flatnonzero(np.diff(first) >= window):
                    own = np.unique(least[first[i] : first[i + 1] - window + 1])
                    out_h.append(own)
                    out_ids.append(np.full(len(own), ids[i], dtype=np.int64))
                if out_h:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(out_ids)), pa.array(B.signed(np.concatenate(out_h)))], schema=schema
                    )

    return run


def _candidates(window: int, seed: int):
    """Windows whose seed is repeated; hot ones are told apart so that they can be salted."""
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("g", pa.int32()), ("hot", pa.bool_())])

    def run(batches):
        for batch in batches:
            marked = batch.filter(pc.or_(pc.is_valid(batch.column("cold")), pc.is_valid(batch.column("hot"))))
            for part in B.chunks(marked, "text"):
                ids = part.column("id").to_numpy(zero_copy_only=False)
                words, first = _chunk_words(part)
                least = _seed_of_windows(words, seed, window)
                hashes, second = B.window_hashes(words, window), _second(words, window)
                cold, hot = part.column("cold"), part.column("hot")
                ids_out, h_out, g_out, hot_out = [], [], [], []
                for i in range(part.num_rows):
                    own = slice(first[i], max(first[i], first[i + 1] - window + 1))
                    for seeds, is_hot in ((cold[i].values, False), (hot[i].values, True)):
                        if seeds is None or not len(seeds) or own.stop <= own.start:
                            continue
                        table = np.sort(B.unsigned(seeds.to_numpy(zero_copy_only=False)))
                        at = np.flatnonzero(B.sorted_member(least[own], table)) + own.start
                        at = at[np.unique(hashes[at], return_index=True)[1]]
                        ids_out.append(np.full(len(at), ids[i], dtype=np.int64))
                        h_out.append(hashes[at])
                        g_out.append(second[at])
                        hot_out.append(np.full(len(at), is_hot))
                if h_out:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(ids_out)),
                            pa.array(B.signed(np.concatenate(h_out))),
                            pa.array(np.concatenate(g_out)),
                            pa.array(np.concatenate(hot_out)),
                        ],
                        schema=schema,
                    )

    return run


def _pairs(structs: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    return B.unsigned(structs.field("h").to_numpy(zero_copy_only=False)), structs.field("g").to_numpy(zero_copy_only=False)


def _strip(window: int, own: pa.DataType):
    schema = pa.schema([("own", own), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches):
        for batch in batches:
            for part in B.chunks(batch, "text"):
                words, first = _chunk_words(part)
                hashes, second = B.window_hashes(words, window), _second(words, window)
                repeats, copies = part.column("repeats"), part.column("copy").to_pylist()
                counts, removed, kept = np.diff(first), [], []
                for i, text in enumerate(B.row_bytes(part.column("text"))):
                    n, lost, tokens = int(counts[i]), 0, text.split()
                    if copies[i] and n >= window:
                        lost, tokens = n, []
                    elif n >= window and (seen := repeats[i].values) is not None and len(seen):
                        own = slice(first[i], first[i + 1] - window + 1)
                        gone = B.covered(np.flatnonzero(B.pair_member(hashes[own], second[own], _pairs(seen))), window, n)
                        lost, tokens = int(gone.sum()), list(compress(tokens, (~gone).tolist()))
                    removed.append(lost)
                    kept.append(b" ".join(tokens).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("own"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    schema=schema,
                )

    return run


def _doubled(length: int):
    """Windows of twice the length both of whose halves are repeated."""
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("g", pa.int32())])

    def run(batches):
        for batch in batches:
            for part in B.chunks(batch, "text"):
                ids = part.column("id").to_numpy(zero_copy_only=False)
                words, first = _chunk_words(part)
                halves, wholes = ((B.window_hashes(words, n), _second(words, n)) for n in (length, 2 * length))
                out_ids, out = [], ([], [])
                for i, known in enumerate(part.column("known")):
                    n = int(first[i + 1] - first[i]) - 2 * length + 1
                    if n > 0:
                        own = slice(first[i], first[i] + n + length)
                        held = B.pair_member(halves[0][own], halves[1][own], _pairs(known.values))
                        at = np.flatnonzero(held[:n] & held[length:]) + first[i]
                        at = at[np.unique(wholes[0][at], return_index=True)[1]]
                        for column, values in zip(out, wholes):
                            column.append(values[at])
                        out_ids.append(np.full(len(at), ids[i], dtype=np.int64))
                if out_ids:
                    h, g = (np.concatenate(x) for x in out)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_ids)), pa.array(B.signed(h)), pa.array(g)], schema=schema)

    return run


def _shared(rows: DataFrame) -> DataFrame:
    """Rows (id, h, g) whose window another document has too; hashes are counted before they meet the rows."""
    found = rows.groupBy("h", "g").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("h", "g")
    return rows.join(found, ["h", "g"]).select("id", "h", "g")


def longest_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and `longest`, the greatest of window, 2 * window, 4 * window ... for which the document has a window that another one has too.

    Documents without such a window have no row. A level is a table of the hashes that survive; the loop ends with the first empty one.
    """
    base = _with_ids(docs, id_col, text_col).where("id is not null and text is not null")
    names = base.select("id", F.col("own").alias(id_col)).distinct()
    rows = written(_shared(_level_two(base, base.mapInArrow(_seeds(window, max(1, window // 2)), "id long, h long"), window, 0).select("id", "h", "g")))
    length, found = window, None
    while not rows.isEmpty():
        here = rows.select("id").distinct().withColumn("longest", F.lit(length))
        found = here if found is None else found.unionByName(here)
        known = rows.groupBy("id").agg(F.collect_set(F.struct("h", "g")).alias("known"))
        rows = written(_shared(base.join(known, "id").mapInArrow(_doubled(length), "id long, h long, g int").distinct()))
        length *= 2
    if found is None:
        return names.select(id_col, F.lit(0).alias("longest")).limit(0)
    return found.groupBy("id").agg(F.max("longest").alias("longest")).join(names, "id").select(id_col, "longest")


def _with_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`own`, the documents' ids as they are, `id`, a whole number in their place, and `text`."""
    return with_places(docs.select(F.col(id_col).alias("own"), F.col(text_col).alias("text")), "own", "id")


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


def _is_copy() -> Column:
    """Whether a row's own text is among the digests of its id's whole copies."""
    return F.when(F.size("copies") > 0, F.coalesce(F.array_contains("copies", _digest()), F.lit(False))).otherwise(F.lit(False))


def _level_two(base: DataFrame, seeds: DataFrame, window: int, hot: int, copies: DataFrame | None = None) -> DataFrame:
    """Candidates (id, h, g, hot): the wanted windows whose selected half is repeated; none of documents that are whole copies."""
    repeated = (
        seeds.groupBy("h")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n"))
        .where("least < most")
        .select("h", (F.col("n") > hot).alias("hot"))
    )
    marks = seeds.join(repeated, "h").select("id", "h", "hot", F.lit(None).cast("binary").alias("d"))
    if copies is not None:
        marks = marks.unionByName(copies)
    per_doc = marks.groupBy("id").agg(
        F.collect_list(F.when(~F.col("hot"), F.col("h"))).alias("cold"),
        F.collect_list(F.when(F.col("hot"), F.col("h"))).alias("hot"),
        F.collect_set("d").alias("copies"),
    )
    # No filter after the left joins: both then read the one exchange of the texts.
    own = ~_is_copy()
    joined = base.join(per_doc, "id", "left").select("id", "text", F.when(own, F.col("cold")).alias("cold"), F.when(own, F.col("hot")).alias("hot"))
    return joined.mapInArrow(_candidates(window, max(1, window // 2)), "id long, h long, g int, hot boolean")


def remove_repeats(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", hot: int = 256
) -> DataFrame:
    """One row per row of `docs`: id, n_words, n_removed and the kept words joined by one space."""
    seed = max(1, window // 2)
    base = _with_ids(docs, id_col, text_col)
    # Whole numbers stand for themselves, so that both joins below read the one exchange of ids and texts.
    name = "id" if isinstance(base.schema["own"].dataType, IntegralType) else "own"
    own = base.schema[name].dataType
    known = base.where("id is not null and text is not null")

    digest = known.select("id", _digest().alias("d"))
    first = digest.groupBy("d").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    copies = digest.join(first, "d").where("id > least").select("id", F.lit(None).cast("long").alias("h"), F.lit(False).alias("hot"), "d")

    seeds = known.mapInArrow(_seeds(window, seed), "id long, h long")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(0))
    candidates = _level_two(base, seeds, window, hot, copies).withColumn("salt", salt)
    settled = candidates.withColumn("least", F.min("id").over(Window.partitionBy("h", "g", "salt")))
    within = settled.where("id > least").select("id", "h", "g")
    between = (
        settled.where("hot and id = least")
        .select("id", "h", "g")
        .withColumn("least", F.min("id").over(Window.partitionBy("h", "g")))
        .where("id > least")
        .select("id", "h", "g")
    )
    window_ = F.struct("h", "g")
    repeats = within.union(between).select("id", window_.alias("w"), F.lit(None).cast("binary").alias("d")).unionByName(copies.select("id", F.lit(None).cast("struct<h:bigint,g:int>").alias("w"), "d"))
    found = repeats.groupBy("id").agg(F.collect_list("w").alias("repeats"), F.collect_set("d").alias("copies"))
    return (
        base.join(found, "id", "left")
        .select(F.col(name).alias("own"), "text", "repeats", _is_copy().alias("copy"))
        .mapInArrow(_strip(window, to_arrow_type(own)), f"own {own.simpleString()}, n_words long, n_removed long, kept string")
        .withColumnRenamed("own", id_col)
    )
