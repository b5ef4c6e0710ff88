"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are 64 bits over three-word shingles (XXH64, seed 42).  Two fingerprints link when
at most two bits differ, and linked fingerprints form components.

Search over the distinct fingerprints:

* Top of the index: the 64 bits are split into three blocks.  Fingerprints within two bits agree on at
  least one whole block, so each fingerprint stands under three nodes (block, its bits there), and all
  others are pruned without being compared.  A node with more than ``NODE_ROWS`` fingerprints is split
  the same way by three blocks of its remaining bits, and such a node once more.  A node of the third
  level has at most 20 free bits, so no node, however hot, holds over 2**20 fingerprints.
* Below: a node's fingerprints are sorted by Gray rank, so neighbours share most bits.  Runs of
  ``FAN_OUT`` become index nodes that hold the shared bits as (mask, pattern), level upon level.
  A query goes down from the root, adds the differences in the bits that a node newly shares, and
  drops the whole group once they exceed the limit.

Each node returns a forest of its links (never all pairs); components are joined by distributed star steps.

Defined cases: a null text, or one without words, has fingerprint zero and links like any other; fewer
than three words hash as a whole; rows with the same id are rows of their own; an id that is null counts only
where no other is reachable; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perishables.llm.common import small_batches, store, utf8
from perishables.llm.components import connected_components

BITS, SEED = 64, 42
FAN_OUT = 8           # children of an index node
NODE_ROWS = 512       # fingerprints of a block node before its other bits split it
SEARCH_ROWS = 1 << 15  # fingerprints that a task indexes at once (whole nodes)
FRONTIER = 1 << 20    # (query, node) pairs that a search holds at once


# ---------------------------------------------------------------- fingerprints
def shingles(raw: bytes | None, size: int) -> list[bytes]:
    words = raw.lower().split() if raw else []
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def fingerprint(raw: bytes | None, size: int = 3) -> int:
    """Bits set in more than half of the shingle hashes."""
    parts = shingles(raw, size)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at:at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def row_keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    """128 bits that name a row by its id and text; repeated rows share them."""
    row_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return (F.xxhash64(row_id, F.lit(1), text).alias("k1"), F.xxhash64(text, F.lit(2), row_id).alias("k2"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, k1, k2, fp)`` of every row; ``fp`` is the fingerprint as a signed 64-bit number."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), *row_keys(id_col, text_col), utf8(text_col).alias("raw"))
    named = ["id", "k1", "k2"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column("raw")
            fps = np.fromiter((fingerprint(raw.as_py(), size) for raw in raws), np.uint64, len(raws))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in named), pa.array(fps.view(np.int64))],
                                             names=[*named, "fp"])

    return slim.mapInArrow(step, slim.select(*named, F.lit(0).cast("bigint").alias("fp")).schema)


# ---------------------------------------------------------------- upper nodes
def _thirds(bits: list[int]) -> list[list[int]]:
    n = len(bits)
    return [bits[: n // 3], bits[n // 3: 2 * n // 3], bits[2 * n // 3:]]


def _mask(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def block_masks(depth: int) -> dict[int, list[tuple[int, int]]]:
    """For each node number of the level above, its (number, mask of the bits it holds) at this level."""
    out: dict[int, list[tuple[int, int]]] = {}
    held: dict[int, list[int]] = {0: []}
    for _ in range(depth):
        out, below = {}, {}
        for number, bits in held.items():
            free = [b for b in range(BITS) if b not in set(bits)]
            for k, third in enumerate(_thirds(free)):
                below[3 * number + k + 1] = bits + third
                out.setdefault(number, []).append((3 * number + k + 1, _mask(bits + third)))
        held = below
    return out


def _under_blocks(rows: DataFrame, depth: int) -> DataFrame:
    """Each row under the three nodes of this level below its node."""
    children: Column | None = None
    for number, nodes in block_masks(depth).items():
        here = F.array(*(F.struct(F.lit(n).alias("node"), F.col("fp").bitwiseAND(F.lit(mask).cast("bigint")).alias("bits"))
                         for n, mask in nodes))
        children = here if children is None else F.when(F.col("node") == number, here).otherwise(children)
    return rows.select("fp", F.explode(children).alias("child")).select("fp", "child.node", "child.bits")


def _nodes(fps: DataFrame) -> DataFrame:
    """``(node, bits, fp)`` such that fingerprints within two bits share a node of bounded size."""
    rows, done = _under_blocks(fps.select("fp", F.lit(0).alias("node")), 1), []
    for depth in (1, 2, 3):
        rows = store(rows, "simhash-nodes")
        sizes = rows.groupBy("node", "bits").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
        sized = rows.join(sizes, ["node", "bits"])
        if depth == 3:
            return _union([*done, sized.select("node", "bits", "fp")])
        done.append(sized.filter(F.col("rows") <= NODE_ROWS).select("node", "bits", "fp"))
        rows = _under_blocks(sized.filter(F.col("rows") > NODE_ROWS), depth + 1)
        if sizes.filter(F.col("rows") > NODE_ROWS).isEmpty():
            return _union(done)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


# ------------------------------------------------------------- Gray-order index
def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of each bit pattern in the Gray sequence."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _level(starts: np.ndarray, owner: np.ndarray, mask: np.ndarray, pattern: np.ndarray):
    """The index nodes above nodes with these masks and patterns: ``starts`` are the first children."""
    first = pattern[starts][owner]
    shared = np.bitwise_and.reduceat(mask & ~(pattern ^ first), starts)
    return shared, pattern[starts] & shared


def index_links(group: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions, first below second, within ``limit`` bits in the same group.

    Rows come sorted by group and, within it, by Gray rank.
    """
    full = np.full(len(fps), np.uint64(2**64 - 1))
    levels = [(full, fps, None, None)]  # mask, pattern, first child, end of children
    owner_group = group
    while True:
        mask, pattern = levels[-1][:2]
        new = np.flatnonzero(np.diff(owner_group, prepend=owner_group[:1] - 1))
        if len(new) == len(owner_group):
            break
        place = np.arange(len(owner_group)) - np.repeat(new, np.diff(np.append(new, len(owner_group))))
        starts = np.flatnonzero(place % FAN_OUT == 0)
        ends = np.append(starts[1:], len(owner_group))
        owner = np.repeat(np.arange(len(starts)), ends - starts)
        levels.append((*_level(starts, owner, mask, pattern), starts, ends))
        owner_group = owner_group[starts]
    lasts = [np.arange(len(fps))]  # the last fingerprint below each node
    for _, _, _, ends in levels[1:]:
        lasts.append(lasts[-1][ends - 1])
    root = np.searchsorted(owner_group, group)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    queries = np.arange(len(fps))
    stack = [(len(levels) - 1, queries, root, np.zeros(len(fps), np.int16), np.zeros(len(fps), np.uint64))]
    while stack:
        depth, query, node, differ, seen = stack.pop()
        if len(query) > FRONTIER:
            half = len(query) // 2
            stack += [(depth, query[:half], node[:half], differ[:half], seen[:half]),
                      (depth, query[half:], node[half:], differ[half:], seen[half:])]
            continue
        mask, pattern, starts, ends = levels[depth]
        # differences in the bits that this node shares beyond the node above
        own = mask[node]
        differ = differ + np.bitwise_count((fps[query] ^ pattern[node]) & own & ~seen)
        keep = (differ <= limit) & (lasts[depth][node] > query)
        query, node, differ, own = query[keep], node[keep], differ[keep], own[keep]
        if not len(query):
            continue
        if depth == 0:
            found.append((query, node))
            continue
        many = ends[node] - starts[node]
        child = np.repeat(starts[node] - np.cumsum(many) + many, many) + np.arange(many.sum())
        stack.append((depth - 1, np.repeat(query, many), child, np.repeat(differ, many), np.repeat(own, many)))
    if not found:
        return queries[:0], queries[:0]
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least position linked with each position, directly or over others."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        np.minimum.at(label, before, label)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label


def _links(rows: DataFrame, limit: int) -> DataFrame:
    """``(a, b)``: a forest of the links within each node."""
    def solve(node: np.ndarray, bits: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        code = fp.view(np.uint64)
        order = np.lexsort((gray_rank(code), bits, node))
        node, bits, code = node[order], bits[order], code[order]
        group = np.cumsum((np.diff(node, prepend=node[:1]) != 0) | (np.diff(bits, prepend=bits[:1]) != 0))
        label = forest(len(code), *index_links(group, code, limit))
        linked = label != np.arange(len(code))
        return pa.RecordBatch.from_arrays([pa.array(code[linked].view(np.int64)), pa.array(code[label[linked]].view(np.int64))],
                                          names=["a", "b"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def joined() -> list[np.ndarray]:
            return [np.concatenate(parts) for parts in zip(*held)]

        for batch in batches:
            held.append([np.asarray(batch.column(c)) for c in ("node", "bits", "fp")])
            if sum(len(x[0]) for x in held) >= SEARCH_ROWS:
                node, bits, fp = joined()
                edge = np.flatnonzero((node != node[-1]) | (bits != bits[-1]))
                whole = edge[-1] + 1 if len(edge) else 0  # the last node may go on in the next batch
                if whole:
                    yield solve(node[:whole], bits[:whole], fp[:whole])
                held = [[node[whole:], bits[whole:], fp[whole:]]]
        if held and len(held[0][0]):
            yield solve(*joined())

    dealt = rows.repartition("node", "bits").sortWithinPartitions("node", "bits")
    return dealt.mapInArrow(step, "a bigint, b bigint")


# -------------------------------------------------------------------- operator
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                    limit: int = 2) -> DataFrame:
    """``(id, k1, k2, fp, root, component)`` per row: ``root`` is the least fingerprint (as a number) and
    ``component`` the least id that linked fingerprints reach."""
    if not 0 <= limit <= 2:
        raise ValueError("three blocks find at most two differing bits")
    rows = store(fingerprints(docs, id_col, text_col, size), "simhash")
    distinct = store(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = connected_components(_links(_nodes(distinct), limit))
    labels = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    groups = labels.groupBy("root").agg(F.min("least").alias("component"))
    labels = labels.join(groups, "root").select("fp", "root", "component")
    return rows.join(labels, "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
             limit: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one with the least id (null ids last; of rows that share
    id and component, the one with the least fingerprint; of repeated rows, any)."""
    found = near_duplicates(docs, id_col, text_col, size, limit)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp", "k1", "k2")).alias("first")
    kept = found.groupBy("root").agg(first).select("first.k1", "first.k2")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), *row_keys(id_col, text_col))
    # the window finds rows dealt and sorted by the join; it only drops repeated rows
    same = Window.partitionBy("k1", "k2").orderBy("k1")
    return keyed.join(kept, ["k1", "k2"]).withColumn("copy", F.row_number().over(same)) \
        .filter(F.col("copy") == 1).select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
