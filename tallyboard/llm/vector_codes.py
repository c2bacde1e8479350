"""Product codes of vectors over integer codebooks (operator 11).

Components become integers, so distances, sums and floors are exact and the codes are the same
under any partitioning. A codebook is small (parts x entries x width integers, all parameters)
and is broadcast; an Arrow batch of vectors gets all its squared distances as |x|^2 - 2 x.c + |c|^2
by one int64 matrix product a part. A task adds up its vectors by part and entry before anything
moves: it sends parts x entries x width sums, which a grouped shuffle merges each round.

Integers beyond the int64 range saturate at it, and vectors too large for int64 products take Python's integers.

Defined results: a vector that is null or holds a null, NaN or infinite component has no row. The codebooks
start from the vectors of the least ids; of rows that share an id the least vector stands for it, and rows with a null id
start nothing but are coded. Vectors of another length than the least id's have a null code and error
and move no entry. Fewer ids than entries give fewer entries; without any id all codes are null. A length that `parts` does not
divide is cut at the rounded-down fractions of it. Errors saturate at the greatest long;
a label of uncoded rows alone has a null sum.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from dataclasses import dataclass
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallyboard.llm.names import free
from tallyboard.sources.scratch import written

MOST = (1 << 63) - 1
#: Labels of which the sums are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 1 << 16


@dataclass(frozen=True)
class Codebooks:
    """`entries[p]` holds the entries of part p as lists of integers; `dim` is the length of the vectors, None without any."""

    dim: int | None
    parts: int
    entries: tuple

    def bounds(self) -> list[int]:
        return [p * (self.dim or 0) // self.parts for p in range(self.parts + 1)]

    def listed(self) -> str:
        return ",".join(str(x) for part in self.entries for entry in part for x in entry)

    def sha256(self) -> str:
        return hashlib.sha256(self.listed().encode()).hexdigest()


def _usable(vector: str):
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.col(vector).isNotNull() & ~F.exists(F.coalesce(vector, F.array()), bad)


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(_usable("v"))


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), saturated."""
    with np.errstate(over="ignore"):
        x = np.floor(values * scale)
    out = np.where(np.abs(x) < 2.0**63, x, 0).astype(np.int64)
    out[x >= 2.0**63], out[x < -(2.0**63)] = MOST, -MOST - 1
    return out


def _matrix(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of length `dim`, and their vectors as one integer matrix."""
    rows = np.flatnonzero(pc.list_value_length(column).to_numpy(zero_copy_only=False) == dim)
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    return rows, scaled(values, scale).reshape(len(rows), dim)


def nearest(x: np.ndarray, entries: list) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the first nearest entry, and the squared distance (objects where it leaves int64)."""
    width = max(1, x.shape[1])
    safe = isqrt((1 << 60) // width)
    at, error = np.zeros(len(x), np.int64), np.zeros(len(x), object)
    small = (x <= safe).all(axis=1) & (x >= -safe).all(axis=1)
    if any(abs(v) > safe for e in entries for v in e):
        small[:] = False
    if small.any():
        c, own = np.array(entries, dtype=np.int64).reshape(len(entries), x.shape[1]), x[small]
        distance = (c * c).sum(axis=1) - 2 * (own @ c.T) + (own * own).sum(axis=1)[:, None]
        at[small] = distance.argmin(axis=1)
        error[small] = distance.min(axis=1)
    for i in np.flatnonzero(~small):
        distance = [sum((int(a) - b) ** 2 for a, b in zip(x[i], e)) for e in entries]
        error[i] = min(distance)
        at[i] = distance.index(error[i])
    return at, error


def _sums(books: Codebooks, shared, scale: int):
    """Rows (part, entry, place, total, n): a task's vectors added up by nearest entry."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0)), ("n", pa.int64())])
    bounds, dim = books.bounds(), books.dim

    def run(batches):
        entries = shared.value
        totals, counts = defaultdict(int), defaultdict(int)
        for batch in batches:
            _, x = _matrix(batch.column("v"), dim, scale)
            # Halves of 32 bits: the sum of a batch stays within int64 whatever the components are.
            high, low = x >> 32, x & 0xFFFFFFFF
            for p, (a, b) in enumerate(zip(bounds, bounds[1:])):
                if not len(x):
                    break
                at, _ = nearest(x[:, a:b], entries[p])
                order = np.argsort(at, kind="stable")
                used, first = np.unique(at[order], return_index=True)
                n = np.diff([*first, len(at)])
                for e, m in zip(used.tolist(), n.tolist()):
                    counts[p, e] += m
                for j in range(a, b):
                    tops, rests = (np.add.reduceat(half[order, j], first).tolist() for half in (high, low))
                    for e, top, rest in zip(used.tolist(), tops, rests):
                        totals[p, e, j - a] += (top << 32) + rest
        keys = sorted(totals)
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array([k[i] for k in keys], pa.int32()) for i in range(3)),
                pa.array([Decimal(totals[k]) for k in keys], pa.decimal128(38, 0)),
                pa.array([counts[k[:2]] for k in keys], pa.int64()),
            ],
            schema=schema,
        )

    return run


def _codes(books: Codebooks, shared, scale: int, schema: pa.Schema):
    bounds = books.bounds()

    def run(batches):
        for batch in batches:
            code, error = [None] * batch.num_rows, [None] * batch.num_rows
            entries = shared.value
            if books.dim is not None:
                rows, x = _matrix(batch.column("v"), books.dim, scale)
                each = [nearest(x[:, a:b], entries[p]) for p, (a, b) in enumerate(zip(bounds, bounds[1:]))]
                places, total = np.array([at for at, _ in each]).T, sum(e for _, e in each)
                for i, row, sum_ in zip(rows.tolist(), places.tolist(), total.tolist()):
                    code[i], error[i] = "".join(f"{k:02x}" for k in row), min(sum_, MOST)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], schema=schema)

    return run


def fit(df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> Codebooks:
    """Codebooks of `entries` (256 at most) integer entries for each of `parts` parts, after `rounds` rounds over all vectors."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index has two hex digits: 1 to 256 entries")
    vectors = _vectors(df, id_col, vector_col)
    known = vectors.where("id is not null")
    least = known.groupBy().agg(F.min("id").alias("id")).head().id
    if least is None:
        return Codebooks(None, parts, ((),) * parts)
    dim = len(known.where(F.col("id") == F.lit(least)).agg(F.min("v").alias("v")).head().v)
    whole = known.where(F.size("v") == dim)
    ids = [r.id for r in whole.select("id").distinct().orderBy("id").limit(entries).collect()]
    start = whole.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()
    matrix = np.array([scaled(np.array(r.v, dtype=np.float64), scale) for r in start], dtype=np.int64).reshape(len(start), dim)
    cuts = Codebooks(dim, parts, ()).bounds()
    books = Codebooks(dim, parts, tuple(tuple(tuple(row) for row in matrix[:, a:b].tolist()) for a, b in zip(cuts, cuts[1:])))
    for _ in range(rounds):
        shared = df.sparkSession.sparkContext.broadcast(books.entries)
        sums = vectors.where(F.size("v") == dim).mapInArrow(_sums(books, shared, scale), "part int, entry int, place int, total decimal(38,0), n long")
        merged = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
        moved = [[list(e) for e in part] for part in books.entries]
        for r in merged:
            moved[r.part][r.entry][r.place] = int(r.total) // r.n
        books = Codebooks(dim, parts, tuple(tuple(map(tuple, part)) for part in moved))
    return books


def encode(df: DataFrame, books: Codebooks, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, code, error and label_error (error summed over equal labels) of every usable vector."""
    label = free(df.select(id_col), "label")
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label")).where(_usable("v"))
    out = rows.select("id", "label").schema.add("code", "string").add("error", "long")

    shared = df.sparkSession.sparkContext.broadcast(books.entries)
    coded = written(rows.mapInArrow(_codes(books, shared, scale, to_arrow_schema(out)), out))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    total = F.when(total > F.lit(Decimal(MOST)), F.lit(MOST)).otherwise(total.cast("long"))
    by_label = written(coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")))
    if by_label.count() <= BROADCAST_LABELS:
        by_label = F.broadcast(by_label)
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select(F.col("id").alias(id_col), F.col("label").alias(label), "code", "error", "label_error")
