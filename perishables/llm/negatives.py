"""Hard negatives by rotated one-bit codes with deterministic intervals.

Vectors are integers, ``floor(scale * x)``.  A code is built in levels.  A level rotates what the levels above left of a vector, keeps
the signs of its components (one bit each, the code) and how far the vector goes along that code (the stored alignment: its inner product
with the unit vector of the signs); what is left over goes to the next level.  So a vector is the sum of
alignment * code over the levels, plus a residual whose length is stored.

An inner product with a query is estimated as the sum of alignment * <query, code>.  <query, code> is a popcount: the rotated query is
quantised to a few bit planes, and its signed sum over a code's bits is the popcounts of plane AND code.  By Cauchy-Schwarz the estimate is
off by at most |query| * |residual| plus, for each level, |alignment| * |quantisation error of the query|.  This
interval is certain, so a row is dropped only if no value in it could enter a result.  What survives is scored in integers.

Queries (anchors) come in blocks of about ``BLOCK`` rows, a stated set against all rows: a block is broadcast, the tasks scan the rows and
keep the best few of each anchor as they go (their last place is the bound that intervals are held against), and a window joins the tasks'
lists.  The first scan of a block finds positives, the second, whose windows follow from the positives' scores, the negatives.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part; shorter vectors count as
filled up with zeros; components beyond ``+-limit`` (the largest whose inner products still fit 63 bits) count as ``+-limit``; rows with the same id
are rows of their own, and ties go to the smaller id (no id: last), then to the row read first; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perishables.llm.common import ARROW_BYTES, store
from perishables.session import scratch_path

SEED = 12
LEVELS = 3         # codes of a vector, each of what the codes above left
PLANES = 8         # bits of a rotated query's component
BLOCK = 4096       # anchors of a block, about
PAIRS = 1 << 19    # (anchor, row) pairs that a task looks at once
SCORED = 1 << 17   # pairs that a task scores at once
ARROW_ROWS = 8192  # rows of a batch handed to Python
SLACK = 1e-9       # of the lengths, for rounding in the intervals
NO_ID = np.iinfo(np.int64).max
LOWEST = np.iinfo(np.int64).min


# ---------------------------------------------------------------- codes
def rotation(dim: int, level: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, level]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def component_limit(dim: int) -> int:
    return math.isqrt((1 << 62) // max(dim, 1))


def to_integers(vectors: pa.Array, dim: int, scale: float) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit integers, zeros behind short vectors."""
    sizes = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    out = np.zeros((len(sizes), dim), np.float64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.floor(scale * flat)
    limit = component_limit(dim)
    return np.clip(out, -limit, limit).astype(np.int64)


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits by rows as 64-bit words."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


class Codes(NamedTuple):
    bits: np.ndarray       # rows x levels x words
    along: np.ndarray      # rows x levels: alignment
    rest: np.ndarray       # rows: length of the residual


def encode(vectors: np.ndarray, levels: int = LEVELS) -> Codes:
    dim = vectors.shape[1]
    left = vectors.astype(np.float64)
    bits, along = [], []
    for level in range(levels):
        turn = rotation(dim, level)
        z = left @ turn.T
        positive = z >= 0
        length = np.abs(z).sum(axis=1) / math.sqrt(dim)
        bits.append(_words(positive))
        along.append(length)
        left = (z - np.where(positive, 1.0, -1.0) * (length / math.sqrt(dim))[:, None]) @ turn
    return Codes(np.stack(bits, 1), np.stack(along, 1), np.linalg.norm(left, axis=1))


class Queries(NamedTuple):
    """Anchors of a block, quantised per level."""
    planes: np.ndarray     # anchors x levels x planes x words
    step: np.ndarray       # anchors x levels: value of one quantum
    base: np.ndarray       # anchors x levels: value of quantum zero
    total: np.ndarray      # anchors x levels: sum of the quantised components
    error: np.ndarray      # anchors x levels: length of the quantisation error
    length: np.ndarray     # anchors


def quantise(vectors: np.ndarray, levels: int = LEVELS, planes: int = PLANES) -> Queries:
    dim, top = vectors.shape[1], (1 << planes) - 1
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    for level in range(levels):
        z = vectors.astype(np.float64) @ rotation(dim, level).T
        low = z.min(axis=1)
        step = np.maximum((z.max(axis=1) - low) / top, np.finfo(np.float64).tiny)
        u = np.clip(np.rint((z - low[:, None]) / step[:, None]), 0, top).astype(np.int64)
        near = low[:, None] + step[:, None] * u
        made = (np.stack([_words((u >> p) & 1 == 1) for p in range(planes)], 1), step, low, near.sum(axis=1), np.linalg.norm(z - near, axis=1))
        for column, value in zip(out, made):
            column.append(value)
    return Queries(*(np.stack(c, 1) for c in out), np.linalg.norm(vectors.astype(np.float64), axis=1))


def intervals(asked: Queries, codes: Codes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible inner product of every anchor with every row."""
    shape = (len(asked.length), len(codes.rest))
    centre, width = np.zeros(shape), asked.length[:, None] * codes.rest[None, :]
    planes = asked.planes.shape[2]
    kind = next(k for k in (np.uint16, np.uint32, np.uint64) if dim * ((1 << planes) - 1) <= np.iinfo(k).max)
    both, ones = np.empty(shape, np.uint64), np.empty(shape, np.uint8)
    for level in range(codes.along.shape[1]):
        bits = codes.bits[:, level]
        inside = np.zeros(shape, kind)    # sum of the quanta where the code has a one, from the highest plane down
        for p in reversed(range(planes)):
            inside <<= 1
            for w in range(bits.shape[1]):
                np.bitwise_count(np.bitwise_and(asked.planes[:, level, p, w, None], bits[None, :, w], out=both), out=ones)
                inside += ones
        # <query, code> = 2 * (sum over the ones) - (sum over all)
        constant = 2.0 * asked.base[:, level, None] * np.bitwise_count(bits).sum(axis=1, dtype=np.int64)[None, :] - asked.total[:, level, None]
        along = codes.along[:, level][None, :]
        centre += (constant + (2.0 * asked.step[:, level, None]) * inside) * (along / math.sqrt(dim))
        width += asked.error[:, level, None] * along
    width += SLACK * (asked.length[:, None] * (codes.rest + codes.along.sum(axis=1))[None, :] + 1.0)
    return centre - width, centre + width


# ---------------------------------------------------------------- stored rows
class Rows(NamedTuple):
    row: np.ndarray
    id: np.ndarray         # NO_ID where there is none
    label: np.ndarray
    vector: np.ndarray
    codes: Codes


def _unpack(batch: pa.RecordBatch, dim: int, levels: int) -> Rows:
    n = batch.num_rows

    def matrix(name: str, kind, *shape: int) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(n, *shape)

    ids = batch.column("id")
    return Rows(batch.column("row").to_numpy(zero_copy_only=False), ids.fill_null(NO_ID).to_numpy(zero_copy_only=False),
                batch.column("label").to_numpy(zero_copy_only=False), matrix("vector", np.int64, dim),
                Codes(matrix("bits", np.uint64, levels, -(-dim // 64)), matrix("along", np.float64, levels),
                      batch.column("rest").to_numpy(zero_copy_only=False)))


def coded_rows(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: float, levels: int) -> tuple[DataFrame, int]:
    """The rows that take part, numbered, with integers and codes, stored; and the dimension."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    whole = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), label.cast("bigint").alias("label"), vector.alias("vector")) \
        .filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    dim = max(1, whole.select(F.max(F.size("vector"))).first()[0] or 1)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SCORED // 64):
                part = batch.slice(at, SCORED // 64)
                whole_numbers = to_integers(part.column("vector"), dim, scale)
                codes = encode(whole_numbers, levels)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("id"), part.column("label"), pa.array([r.tobytes() for r in whole_numbers], pa.binary()),
                     pa.array([r.tobytes() for r in codes.bits], pa.binary()), pa.array([r.tobytes() for r in codes.along], pa.binary()),
                     pa.array(codes.rest)], names=["row", "id", "label", "vector", "bits", "along", "rest"])

    numbered = whole.select(F.monotonically_increasing_id().alias("row"), "id", "label", "vector")
    return store(numbered.mapInArrow(code, "row bigint, id bigint, label bigint, vector binary, bits binary, along binary, rest double"),
                 "negative-rows"), dim


# ---------------------------------------------------------------- scans
class Best:
    """The best ``size`` rows of each slot so far, and the score that a row must reach to enter."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.slot, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))
        self.bound = np.full(slots, LOWEST)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids, row = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids), (self.row, row)))
        order = np.lexsort((row, ids, -score, slot))
        slot, score, ids, row = slot[order], score[order], ids[order], row[order]
        first = np.searchsorted(slot, slot, "left")
        place = np.arange(len(slot)) - first
        keep = place < self.size
        last = place == self.size - 1
        self.bound[slot[last]] = score[last]
        self.slot, self.score, self.id, self.row = slot[keep], score[keep], ids[keep], row[keep]


def _pieces(rows: Rows, anchors: int) -> Iterator[Rows]:
    step = max(1, PAIRS // max(anchors, 1))
    for at in range(0, len(rows.row), step):
        cut = slice(at, at + step)
        yield Rows(rows.row[cut], rows.id[cut], rows.label[cut], rows.vector[cut], Codes(*(c[cut] for c in rows.codes)))


def _scores(anchors: np.ndarray, rows: np.ndarray, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), np.int64)
    for at in range(0, len(a), SCORED):
        cut = slice(at, at + SCORED)
        out[cut] = np.einsum("ij,ij->i", anchors[a[cut]], rows[r[cut]])
    return out


def scan_positives(block: Rows, asked: Queries, parts: Iterator[Rows], size: int) -> Best:
    """Of each anchor, the best other rows of its label."""
    best, dim = Best(len(block.row), size), block.vector.shape[1]
    for part in parts:
        for rows in _pieces(part, len(block.row)):
            _, most = intervals(asked, rows.codes, dim)
            a, r = np.nonzero((block.label[:, None] == rows.label[None, :]) & (block.row[:, None] != rows.row[None, :])
                              & (most >= best.bound[:, None]))
            score = _scores(block.vector, rows.vector, a, r)
            enters = score >= best.bound[a]
            best.add(a[enters], score[enters], rows.id[r[enters]], rows.row[r[enters]])
    return best


def scan_negatives(block: Rows, asked: Queries, parts: Iterator[Rows], size: int, low: np.ndarray, high: np.ndarray) -> Best:
    """Of each (anchor, place of its positive), the best rows of other labels with ``low <= score <= high``.
    A slot is anchor * places + place; ``low`` and ``high`` are anchors x places, ``low > high`` where there is no positive."""
    places, dim = low.shape[1], block.vector.shape[1]
    best = Best(low.size, size)
    for part in parts:
        for rows in _pieces(part, len(block.row)):
            least, most = intervals(asked, rows.codes, dim)
            need = np.maximum(low, best.bound.reshape(low.shape))
            able = np.zeros(least.shape, bool)
            for p in range(places):
                able |= (most >= need[:, p, None]) & (least <= high[:, p, None]) & (low[:, p] <= high[:, p])[:, None]
            a, r = np.nonzero(able & (block.label[:, None] != rows.label[None, :]))
            score = _scores(block.vector, rows.vector, a, r)
            for p in range(places):
                fits = (score >= need[a, p]) & (score <= high[a, p])
                best.add(a[fits] * places + p, score[fits], rows.id[r[fits]], rows.row[r[fits]])
    return best


def _listed(best: Best) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (best.slot, best.score, best.id, best.row)], names=["slot", "score", "id", "row"])


def _first(found: DataFrame, size: int) -> DataFrame:
    """The tasks' lists joined: each slot's best ``size`` rows with their rank."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


LISTED = "slot bigint, score bigint, id bigint, row bigint"


def _block(spark: SparkSession, rows: DataFrame, anchors: DataFrame, dim: int, levels: int, positives: int, negatives: int,
           window: tuple[int, int]) -> DataFrame | None:
    """Both scans for one block of anchors."""
    table = anchors.orderBy("row").toArrow().combine_chunks()
    if not table.num_rows:
        return None
    block = _unpack(table.to_batches()[0], dim, levels)
    shared = spark.sparkContext.broadcast((block, quantise(block.vector, levels)))

    def positive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _listed(scan_positives(*shared.value, (_unpack(b, dim, levels) for b in batches), positives))

    # a block's positives: at most BLOCK * positives rows
    found = _first(rows.mapInArrow(positive, LISTED), positives).toArrow()
    slot, rank = found.column("slot").to_numpy(), found.column("rank").to_numpy() - 1
    score = np.zeros((len(block.row), positives), np.int64)
    known = np.zeros(score.shape, bool)
    ids, numbers = np.zeros_like(score), np.zeros_like(score)
    score[slot, rank], known[slot, rank] = found.column("score").to_numpy(), True
    ids[slot, rank], numbers[slot, rank] = found.column("id").to_numpy(), found.column("row").to_numpy()
    low = np.array([[-(-window[0] * int(s) // 100) for s in row] for row in score], np.int64).reshape(score.shape)
    high = np.array([[window[1] * int(s) // 100 for s in row] for row in score], np.int64).reshape(score.shape)
    low, high = np.where(known, low, 1), np.where(known, high, 0)
    bounds = spark.sparkContext.broadcast((low, high))

    def negative(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _listed(scan_negatives(*shared.value, (_unpack(b, dim, levels) for b in batches), negatives, *bounds.value))

    mined = _first(rows.mapInArrow(negative, LISTED), negatives)
    a, p = np.nonzero(known)
    pairs = spark.createDataFrame(pa.table({
        "slot": a * positives + p, "anchor": block.id[a], "anchor_row": block.row[a], "positive": ids[a, p], "positive_row": numbers[a, p],
        "positive_score": score[a, p]}))
    return mined.join(pairs, "slot").select("anchor", "anchor_row", "positive", "positive_row", "rank", F.col("id").alias("negative"),
                                            F.col("row").alias("negative_row"), "positive_score", F.col("score").alias("negative_score"))


FOUND = ("anchor bigint, anchor_row bigint, positive bigint, positive_row bigint, rank int, negative bigint, negative_row bigint, "
         "positive_score bigint, negative_score bigint")


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label",
                   scale: float = 256.0, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90),
                   levels: int = LEVELS, block: int = BLOCK) -> DataFrame:
    """``(anchor, positive, rank, negative, positive_score, negative_score)`` and the row numbers of the three.

    Anchors are the rows for which ``anchor`` (over the id, as ``id``) holds.  Their positives are the best other rows of the label; a
    positive's negatives are the best rows of other labels whose score lies within ``window`` per cent of the positive's.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    rows, dim = coded_rows(vectors, id_col, vector_col, F.col(f"`{label}`") if isinstance(label, str) else label, scale, levels)
    asking = store(rows.filter(F.coalesce(anchor, F.lit(False))), "negative-anchors")
    anchors = asking.count()
    if not anchors:
        return spark.createDataFrame([], FOUND)
    blocks = -(-anchors // block)
    folder = scratch_path(spark, "negatives")
    for number in range(blocks):
        found = _block(spark, rows, asking.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number), dim, levels, positives, negatives, window)
        if found is not None:
            found.write.parquet(f"{folder}/block={number}")
    absent = F.lit(NO_ID).cast("bigint")
    found = spark.read.schema(FOUND).parquet(folder)
    return found.select(*(F.nullif(F.col(c), absent).alias(c) if c in ("anchor", "positive", "negative") else F.col(c)
                          for c in (f.name for f in found.schema) if c != "block"))
