"""Vector compression by product codes, in integers only.

Every component becomes an integer; vectors are cut into equal parts, and each
part is replaced by the index of the nearest entry of its position's codebook.
Distances are summed over integer Walsh-Hadamard coefficients of the zero-padded
parts and entries, in sequency order. The transform scales every squared distance
by the padded length, so a sum over the first coefficients is a lower bound of
the scaled distance, and an entry goes as soon as its bound is above another
entry's whole distance. No floating point takes part, so sums do not depend on
the order in which tasks add them, and reruns agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import Scratch, small

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# sums travel in digits of this many bits, so that Spark adds them as longs
LIMB = 32
MOST = (1 << 63) - 1


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of ``rows``, zero-padded to a power of two, by rising sequency (sign changes)."""
    m, width = rows.shape
    n = 1 << max(0, width - 1).bit_length()
    out = np.zeros((m, n), rows.dtype)
    out[:, :width] = rows
    half = 1
    while half < n:
        pairs = out.reshape(m, n // (2 * half), 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(m, n)
        half *= 2
    return out[:, sequency_order(n)]


def sequency_order(n: int) -> np.ndarray:
    """Hadamard rows by their number of sign changes: row r has changes where its bits, reversed, are a Gray code."""
    bits = n.bit_length() - 1
    gray = [k ^ (k >> 1) for k in range(n)]
    return np.array([int(format(g, f"0{bits}b")[::-1], 2) if bits else 0 for g in gray], dtype=np.int64)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of every part; ties go to the lower index.

    Both are integer arrays of equal width: 64-bit if no sum can leave 64 bits, else Python integers.
    """
    if not len(parts):
        return np.empty(0, np.int64), np.empty(0, parts.dtype)
    x, e = transform(parts), transform(entries)
    m, n = x.shape
    bound = (x[:, :1] - e[None, :, 0]) ** 2
    # the whole distance to the entry nearest in the first coefficient is the first limit
    guess = np.argmin(bound, axis=1)
    limit = ((x - e[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(bound <= limit[:, None])
    total, done = bound[row, entry], 1
    while done < n:
        upto = min(n, 2 * done)
        total = total + ((x[row, done:upto] - e[entry, done:upto]) ** 2).sum(axis=1)
        near = total <= limit[row]
        row, entry, total, done = row[near], entry[near], total[near], upto
    # rows are in order and entries rise within a row: the first of the least distances is the lower index
    starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    least = np.minimum.reduceat(total, starts)
    hits = np.flatnonzero(total == least[np.cumsum(np.concatenate(([0], row[1:] != row[:-1])))])
    first = hits[np.concatenate(([True], row[hits][1:] != row[hits][:-1]))]
    return entry[first], least // n


def integers(vectors: pa.Array, dim: int, width: int, parts: int, known: int = 0) -> np.ndarray:
    """``floor(4096 x)`` of all components as (row, part, position); vectors shorter than ``dim`` end in zeros.

    64-bit integers if no distance to a component below ``known`` can leave 64 bits, else Python integers.
    """
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    n = 1 << max(0, width - 1).bit_length()
    most = max(known, floor(Fraction(float(np.abs(values).max(initial=0.0))) * SCALE) + 1)
    if 4 * n * n * most * most <= MOST:
        whole = np.floor(values * SCALE).astype(np.int64)
    else:
        whole = np.array([floor(Fraction(float(v)) * SCALE) for v in values] or [0], dtype=object)[: len(values)]
    out = np.zeros((len(lengths), parts * width), whole.dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = whole
    return out.reshape(len(lengths), parts, width)


def _code(vectors: pa.Array, books: list, dim: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(integers, indexes by row and part, distances by row and part)."""
    known = max((abs(v) for b in books for e in b for v in e), default=0)
    whole = integers(vectors, dim, width, len(books), known)
    found = [nearest(whole[:, p], np.array(b, dtype=whole.dtype).reshape(len(b), width)) for p, b in enumerate(books)]
    return whole, np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(batches: Iterator[pa.RecordBatch], books: list, dim: int, width: int) -> Iterator[pa.RecordBatch]:
    """Counts (place -1) and component sums of the parts of every entry, in digits of 32 bits; one task's rows at most."""
    shape = (len(books), len(books[0]))
    sums, counts = np.zeros((*shape, width), object), np.zeros(shape, np.int64)
    for batch in batches:
        whole, index, _ = _code(batch.column(0), books, dim, width)
        for p in range(len(books) if len(index) else 0):
            part = np.zeros((shape[1], width), whole.dtype)
            np.add.at(part, index[:, p], whole[:, p])
            sums[p] += part.astype(object)
            counts[p] += np.bincount(index[:, p], minlength=shape[1])
    rows = []
    for p, k in zip(*np.nonzero(counts)):
        for place, value in [(-1, int(counts[p, k])), *enumerate(int(v) for v in sums[p, k])]:
            limb = 0
            while value not in (0, -1) or limb == 0:
                rows.append((int(p), int(k), place, limb, value & ((1 << LIMB) - 1)))
                value, limb = value >> LIMB, limb + 1
            if value:  # the sign
                rows.append((int(p), int(k), place, limb, -1))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["part", "entry", "place", "limb", "value"])


def _coded(batches: Iterator[pa.RecordBatch], books: list, dim: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        _, index, far = _code(batch.column(2), books, dim, width)
        codes = [i.astype(np.uint8).tobytes().hex() for i in index]
        errors = pa.array([min(MOST, int(e)) for e in far.sum(axis=1)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes), errors], names=["vec_id", "label", "code", "error"])


def compress_vectors(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, list]:
    """``(vec_id, label, code, error)`` per usable vector, and the codebooks as lists by part, entry and position.

    A vector is usable if it is not null and holds no null, NaN or infinite component;
    others are left out. The codebook of a part starts as that part of the ``entries``
    vectors of smallest id (null last; equal ids by vector); with fewer vectors it has
    fewer entries. Every round assigns all parts and moves each entry to its parts'
    componentwise floor of the mean; an unused entry stays.

    Dimensions that ``parts`` does not divide, and vectors shorter than the longest,
    end in zeros, so empty vectors are all zero. Components of any finite size are
    exact (Python integers where 64 bits could overflow); an error above the largest
    long is reported as that. Repeated rows are rows each; other columns are ignored;
    an empty table gives no rows and no codebooks. At most 256 entries: a code has two
    hex digits for each part.

    Each round is one scan with sums per task, added up by Spark; the driver holds
    codebooks and one row per entry component only.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits has 1 to 256 entries")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    ).filter(F.col("vector").isNotNull() & ~F.exists("vector", bad))
    dim = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-dim // parts))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    whole = integers(pa.array([r[0] for r in first], pa.list_(pa.float64())), dim, width, parts)
    books = [[[int(v) for v in whole[k, p]] for k in range(len(first))] for p in range(parts)]
    shape = StructType([StructField("vec_id", rows.schema["vec_id"].dataType), StructField("label", rows.schema["label"].dataType),
                        StructField("code", StringType()), StructField("error", LongType())])
    if not first:
        return rows.sparkSession.createDataFrame([], shape), []
    only = rows.select("vector")
    for _ in range(rounds):
        books = _moved(only, books, dim, width)
    return rows.mapInArrow(lambda b, books=books: _coded(b, books, dim, width), shape), books


def _moved(only: DataFrame, books: list, dim: int, width: int) -> list:
    """The codebooks after one round."""
    digits = only.mapInArrow(lambda b: _sums(b, books, dim, width), "part long, entry long, place long, limb long, value long")
    # the digits of one sum are few; a count and the sums of an entry are one row
    sums: dict[tuple, int] = {}
    for r in digits.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect():
        key = (r.part, r.entry, r.place)
        sums[key] = sums.get(key, 0) + (r.value << (LIMB * r.limb))
    moved = [[list(e) for e in b] for b in books]
    for (p, k, place), total in sums.items():
        if place >= 0:
            moved[p][k][place] = total // sums[p, k, -1]
    return moved


def codebooks_digest(books: list) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()


def code_report(vectors: DataFrame, **options) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``: codes with the errors summed over equal labels.

    Null labels are one label. A sum above the largest long is reported as that.
    """
    coded, books = compress_vectors(vectors, **options)
    scratch = Scratch(vectors.sparkSession, "vector-codes")
    coded = scratch.save(coded, "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("bigint")
    totals, seen = scratch.save_counted(coded.groupBy(F.col("label").alias("l")).agg(total.alias("label_error")), "totals")
    joined = coded.join(small(totals, seen["n"], 64), F.col("label").eqNullSafe(F.col("l")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
