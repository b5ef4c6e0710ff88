"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The model file's pieces and scores are read as they are; its path is a parameter.  A text becomes the
sequence of pieces with the greatest sum of scores.  A character that no piece spells costs ten
below the least score and falls back to byte pieces (or the unknown piece).  Blanks are written
as the marker U+2581, with one in front of the text; decoding turns them back and drops the first.

No piece of such a vocabulary holds a marker behind another character, so the best path splits
exactly where a word's marker stands: words are solved once, many at a time, and kept in a cache of bounded
size.  The vocabulary is checked for this; a model with such pieces is solved text by text.  Long words (and such
texts) are split further, wherever two characters meet that stand side by side in no piece: every path passes there too.

Defined cases: a null text has null ids; an empty one none.  A text that itself holds U+2581 decodes it
as a blank (the format's own rule).  Other columns are carried along or not looked at.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perishables.llm.common import small_batches

MARK = "▁".encode()
UNKNOWN_PENALTY = 10.0
# piece types of the file format
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE_WORDS = 200_000   # solved words that a Python worker keeps
BLOCK_CELLS = 1 << 19   # cells of a block of words that is solved together
LONG_WORD = 64          # bytes of a word that is split between characters
SPACED = re.compile(rb" +[^ ]*")


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message: varints as numbers, the rest as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, raw[at:at + size]
        at += size


@dataclass
class PieceModel:
    """Pieces of a model file and the double-array trie over their UTF-8 bytes."""

    pieces: list[bytes]
    scores: np.ndarray
    kinds: list[int]
    byte_fallback: bool

    @classmethod
    def read(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            raw = f.read()
        pieces, scores, kinds, fallback = [], [], [], False
        prefix, squeeze, charsmap = True, True, b""
        for number, value in _fields(raw):
            if number == 1:
                piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(_fields(value))
                pieces.append(piece[1])
                scores.append(struct.unpack("<f", piece[2])[0])
                kinds.append(piece[3])
            elif number == 2:
                fallback = bool(dict(_fields(value)).get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                charsmap, prefix, squeeze = spec.get(2, b""), spec.get(3, 1), spec.get(4, 1)
        if charsmap or squeeze or not prefix:
            raise ValueError("only models that keep the text as it is, with a marker in front, are supported")
        return cls(pieces, np.array(scores), kinds, fallback)

    def __post_init__(self) -> None:
        spelled = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in (NORMAL, USER, UNUSED) and p}
        self.unknown = self.kinds.index(UNKNOWN)
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.unknown_score = float(min((self.scores[i] for i in spelled.values()), default=0.0)) - UNKNOWN_PENALTY
        self.longest = max(map(len, spelled), default=1)
        self.splits_at_marks = not any(MARK in _unmarked(p) for p in spelled)
        self.splits_at_breaks = not any(b"\n" in p for p in spelled)
        #: characters that stand side by side in some piece
        self.joined = {pair for p in spelled for chars in [p.decode("utf-8", "surrogateescape")] for pair in map("".join, zip(chars, chars[1:]))}
        self._build(sorted(spelled.items()))
        self.surface = [self._surface(i) for i in range(len(self.pieces))]
        self.surfaces = pa.array(self.surface + [s[1:] if s[:1] == b" " else s for s in self.surface], pa.binary())
        self.silent = np.array([not s for s in self.surface])

    def _surface(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        return {CONTROL: b"", UNKNOWN: " ⁇ ".encode()}.get(self.kinds[i], self.pieces[i].replace(MARK, b" "))

    def _build(self, entries: list[tuple[bytes, int]]) -> None:
        """base/check/value arrays: the child of ``s`` by byte ``c`` is ``base[s] + c`` where ``check`` there is ``s``."""
        size = max(1024, 4 * sum(len(p) for p, _ in entries))
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        check[0] = 0
        used = bytearray(size)
        used[0] = 1
        free = 1
        todo = [(0, 0, len(entries), 0)]
        while todo:
            node, lo, hi, depth = todo.pop()
            if lo < hi and len(entries[lo][0]) == depth:
                value[node] = entries[lo][1]
                lo += 1
            runs: list[tuple[int, int, int]] = []
            while lo < hi:
                byte, at = entries[lo][0][depth], lo
                while lo < hi and entries[lo][0][depth] == byte:
                    lo += 1
                runs.append((byte, at, lo))
            if not runs:
                base[node] = -256  # a leaf: every child is outside
                continue
            while used[free]:
                free += 1
            begin = start = max(1, free - runs[0][0])
            while any(used[start + byte] for byte, _, _ in runs):
                start += 1
            if start - begin > 64:  # what lies before is nearly full
                free = max(free, start)
            base[node] = start
            for byte, a, b in runs:
                used[start + byte] = 1
                check[start + byte] = node
                todo.append((start + byte, a, b, depth + 1))
        end = len(used) - next(i for i, x in enumerate(reversed(used)) if x) + 256
        self.base, self.check, self.value = base[:end].copy(), check[:end].copy(), value[:end].copy()

    # ---------------------------------------------------------------- Viterbi
    def solve(self, words: list[bytes]) -> list[bytes]:
        """The ids (little-endian int32) of the best path of each marked word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        out: list[bytes] = [b""] * len(words)
        at = 0
        while at < len(order):
            # the block's cells are its rows times its longest word
            cells = (np.arange(len(order) - at) + 1) * (sizes[order[at:]] + 1)
            stop = at + max(1, int(np.searchsorted(cells, BLOCK_CELLS, "right")))
            block = order[at:stop].tolist()
            for i, ids in zip(block, self._solve_block([words[i] for i in block], sizes[order[at:stop]])):
                out[i] = ids
            at = stop
        return out

    def _solve_block(self, words: list[bytes], sizes: np.ndarray) -> list[bytes]:
        width = int(sizes[-1])
        cells = np.zeros((len(words), width + 1), np.int32)
        cells[np.arange(width + 1) < sizes[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        lead = np.where(cells < 0x80, 1, np.where(cells < 0xE0, 2, np.where(cells < 0xF0, 3, 4)))
        best = np.full((len(words), width + 5), -np.inf)
        best[:, 0] = 0
        came = np.zeros(best.shape, np.int32)
        piece = np.full(best.shape, -1, np.int32)
        for start in range(width):
            first = int(np.searchsorted(sizes, start, "right"))  # shorter words have ended
            rows = first + np.flatnonzero(best[first:, start] > -np.inf)
            begin, char = best[rows, start], lead[rows, start]
            single = np.zeros(len(rows), bool)
            alive, state = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for end in range(start + 1, min(width, start + self.longest) + 1):
                inside = sizes[rows[alive]] >= end
                alive, state = alive[inside], state[inside]
                child = self.base[state] + cells[rows[alive], end - 1]
                child[child < 0] = 0
                ok = (self.check[child] == state) & (child > 0)
                alive, state = alive[ok], child[ok]
                if not len(alive):
                    break
                found = self.value[state]
                ends = found >= 0
                who, found = alive[ends], found[ends]
                single[who[char[who] == end - start]] = True
                self._better(best, came, piece, rows[who], start, end, begin[who] + self.scores[found], found)
            for length in (1, 2, 3, 4):
                who = np.flatnonzero(~single & (char == length))
                if len(who):
                    self._better(best, came, piece, rows[who], start, start + length,
                                 begin[who] + self.unknown_score, np.full(len(who), -1, np.int32))
        return self._paths(words, sizes, came, piece)

    def _paths(self, words: list[bytes], sizes: np.ndarray, came: np.ndarray, piece: np.ndarray) -> list[bytes]:
        """Each word's ids from the back pointers, all words at once; those with unknown characters one by one."""
        rows, at = np.arange(len(words)), sizes.copy()
        steps: list[np.ndarray] = []
        odd = np.zeros(len(words), bool)
        while (going := at > 0).any():
            ids = np.where(going, piece[rows, at], 0)
            odd |= ids < 0
            steps.append(np.where(going, ids, -2))
            at = came[rows, at]  # 0 stays 0
        if not steps:
            return [b""] * len(words)
        table = np.stack(steps[::-1], axis=1)
        used = table != -2
        raw = table[used].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(used.sum(axis=1))).tolist()
        out = [raw[a:b] for a, b in zip([0, *ends], ends)]
        for row in np.flatnonzero(odd).tolist():
            out[row] = self._path_with_unknown(words[row], came[row], piece[row])
        return out

    def _path_with_unknown(self, word: bytes, came: np.ndarray, piece: np.ndarray) -> bytes:
        ids: list[int] = []
        at = len(word)
        while at:
            start, i = int(came[at]), int(piece[at])
            if i >= 0:
                ids.append(i)
            elif self.byte_fallback:
                ids.extend(self.byte_ids[b] for b in reversed(word[start:at]))
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
            at = start
        return np.array(ids[::-1], np.int32).tobytes()

    @staticmethod
    def _better(best, came, piece, rows, start, end, score, found) -> None:
        up = score > best[rows, end]
        rows = rows[up]
        best[rows, end], came[rows, end], piece[rows, end] = score[up], start, found[up]

    def parts(self, marked: bytes) -> list[bytes]:
        """A marked word in stretches that no piece spans; without byte pieces unknown characters would join, so it stays whole."""
        if len(marked) <= LONG_WORD or not self.byte_fallback:
            return [marked]
        chars = marked.decode("utf-8", "surrogateescape")
        cuts = [0, *(i for i, pair in enumerate(map("".join, zip(chars, chars[1:])), 1) if pair not in self.joined), len(chars)]
        return [chars[a:b].encode("utf-8", "surrogateescape") for a, b in zip(cuts, cuts[1:])]

    def encode(self, raws: list[bytes | None], cache: dict[bytes, bytes]) -> list[bytes | None]:
        """Ids (little-endian int32) of each text; ``cache`` keeps solved words."""
        split: list[list[bytes] | None] = []
        whole: dict[int, list[bytes]] = {}  # stretches of texts that aren't split at markers, by place
        for raw in raws:
            if not raw:
                split.append(None if raw is None else [])
                continue
            raw = raw.replace(MARK, b" ")
            if not self.splits_at_marks or b"\x01" in raw:
                whole[len(split)] = self.parts(MARK + raw.replace(b" ", MARK))
                split.append([])
                continue
            # a line break that no piece holds starts a word of its own, without a marker
            broken = raw.replace(b"\n", b" \x01\n") if self.splits_at_breaks else raw
            if b"  " in broken or broken[:1] == b" " or broken[-1:] == b" ":
                # further blanks stay in front of their word; the first one is understood
                split.append([word[1:] for word in SPACED.findall(b" " + raw)])
            else:
                split.append(broken.split(b" "))
            if max(map(len, split[-1]), default=0) > LONG_WORD:
                split[-1] = [part for word in split[-1] for part in (
                    [word] if len(word) <= LONG_WORD else [b"\x01" + p for p in self.parts(_marked(word))])]
        if len(cache) > CACHE_WORDS:
            cache.clear()
        new = [word for word in {w for words in split if words for w in words} if word not in cache]
        solved = dict(zip(new, self.solve([_marked(word) for word in new])))
        known = {**cache, **solved} if len(new) > CACHE_WORDS else cache
        known.update(solved)
        out = [None if words is None else b"".join(map(known.__getitem__, words)) for words in split]
        ids = iter(self.solve([part for parts in whole.values() for part in parts]))
        for place, parts in whole.items():
            out[place] = b"".join(next(ids) for _ in parts)
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(pa.array([ids], pa.list_(pa.int32())))[0].as_py()

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The text of each list of ids (null: null); bytes that are no UTF-8 become U+FFFD."""
        offsets = ids.offsets.to_numpy()
        values = ids.values.to_numpy(zero_copy_only=False).astype(np.int64)
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        if self.silent[values[first]].any():   # the blank to drop may stand in a later piece
            joined = [b"".join(map(self.surface.__getitem__, values[a:b].tolist())) for a, b in zip(offsets, offsets[1:])]
            raw = pa.array([r[1:] if r[:1] == b" " else r for r in joined], pa.binary())
        else:
            values[first] += len(self.surface)   # without the blank in front
            spelled = self.surfaces.take(pa.array(values))
            # the pieces of a list follow each other, so their bytes are its text
            ends = np.frombuffer(spelled.buffers()[1], np.int32)[:len(values) + 1][offsets]
            raw = pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int32)), spelled.buffers()[2]])
        valid = ids.is_valid()
        try:
            return pc.if_else(valid, raw.cast(pa.string()), pa.scalar(None, pa.string()))
        except pa.ArrowInvalid:
            return pa.array([r.decode("utf-8", "replace") if v else None for r, v in zip(raw.to_pylist(), valid.to_pylist())], pa.string())


def _marked(word: bytes) -> bytes:
    """A word of ``encode`` as it is solved: \x01 says that no marker stands in front."""
    return word[1:] if word[:1] == b"\x01" else MARK + word.replace(b" ", MARK)


def _unmarked(piece: bytes) -> bytes:
    while piece.startswith(MARK):
        piece = piece[len(MARK):]
    return piece


_CACHES: dict[str, dict[bytes, bytes]] = {}  # of this Python worker, by model


def _ids_array(encoded: list[bytes | None]) -> pa.ListArray:
    sizes = np.fromiter((len(e or b"") // 4 for e in encoded), np.int64, len(encoded))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(e or b"" for e in encoded), np.int32))
    null = np.array([e is None for e in encoded])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array(null))


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of each whole text as ``ids_col`` (a column of that name is replaced)."""
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(PieceModel.read(model_path))  # as large as the model file
    kept = [c for c in docs.columns if c.lower() != ids_col.lower()]
    out = docs.select(*(F.col(f"`{c}`") for c in kept))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _CACHES.setdefault(model_path, {})
        for batch in batches:
            raws = batch.column(text_col).cast(pa.string()).cast(pa.binary()).to_pylist()
            ids = _ids_array(model.value.encode(raws, cache))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*kept, ids_col])

    return out.mapInArrow(step, T.StructType([*out.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of the ids as ``text_col`` (a column of that name is replaced)."""
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(PieceModel.read(model_path))
    kept = [c for c in docs.columns if c.lower() != text_col.lower()]
    out = docs.select(*(F.col(f"`{c}`") for c in kept))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, model.value.decode_all(batch.column(ids_col))], names=[*kept, text_col])

    return out.mapInArrow(step, T.StructType([*out.schema.fields, T.StructField(text_col, T.StringType())]))
