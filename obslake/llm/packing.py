"""Best-fit packing of documents into training sequences.

Vector best-fit: every open sequence has residual capacities for tokens,
documents and attention cost (the sum of squared piece lengths).  Pieces are
taken longest first; among the sequences that can hold a piece under every
constraint, the one with the smallest weighted residual norm afterwards (or
the largest weighted dot product of residual and piece) gets it.

Documents are dealt to tasks by a hash, so each sees the lengths of the whole
table however the input is ordered.  A task tokenizes its documents and packs
them window by window.  Sequences that a window leaves well filled are given
out; the pieces of the others join the next window, or are handed on when they
fill half of it.  What is handed on, and what the tasks have left at their end,
is packed all together in a second round, whatever the windows were: the counts
of pieces by length, at most ``capacity`` numbers, are packed by the same rule,
equal sequences at a time, and every piece finds its place by its number among
those of its length.  Memory is bounded by the window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import utf8, written
from obslake.llm.tokens import encoder

SCHEMA = ("doc_id bigint, piece int, start bigint, length bigint, ids binary, "
          "sequence_id bigint, offset bigint")
# Pieces that are handed on have the number of their task, and their number
# among its pieces of that length.
FIRST_ROUND = f"{SCHEMA}, task int, nth bigint"
WINDOW_TOKENS = 1 << 22  # tokens held by a task: 16 MB of ids
GIVEN_OUT_FROM = 0.995  # of the capacity; emptier sequences wait for the next window
ROWS_OUT = 2_000
SECOND_ROUND = 1 << 62  # added to its sequence ids
RANK_BITS = 46  # of a key that holds a length and a piece's number among those of it


class VectorBestFit:
    """Open sequences as rows of residual (tokens, documents, attention)."""

    def __init__(self, capacities: tuple[int, int, int], weights: tuple[float, float, float], rule: str):
        if rule not in ("norm", "dot"):
            raise ValueError("rule is norm or dot")
        self.capacities = np.array(capacities, dtype=np.int64)
        self.weights = np.array(weights) / self.capacities.astype(float) ** 2
        self.rule = rule

    def fits_alone(self, length: int) -> bool:
        return bool((self._vector(length) <= self.capacities).all())

    @staticmethod
    def _vector(length: int) -> np.ndarray:
        return np.array([length, 1, length * length], dtype=np.int64)

    def place(self, lengths: np.ndarray) -> list[list[int]]:
        """Indices of ``lengths`` by sequence, in order of placement."""
        order = np.argsort(-lengths, kind="stable")
        shortest = int(lengths.min()) if len(lengths) else 0
        sequences: list[list[int]] = []
        left = np.empty((64, 3), dtype=np.int64)
        who = np.empty(64, dtype=np.int64)
        n = 0
        for i in order:
            v = self._vector(int(lengths[i]))
            can = np.flatnonzero((left[:n, 0] >= v[0]) & (left[:n, 1] >= v[1]) & (left[:n, 2] >= v[2]))
            if len(can):
                at = can[self._best(left[can], v)]
                left[at] -= v
                sequences[who[at]].append(int(i))
            else:
                if n == len(who):
                    left, who = np.concatenate([left, left]), np.concatenate([who, who])
                at, who[n] = n, len(sequences)
                left[at] = self.capacities - v
                sequences.append([int(i)])
                n += 1
            if left[at, 0] < shortest or left[at, 1] < 1:  # nothing more fits: close it
                n -= 1
                left[at], who[at] = left[n], who[n]
        return sequences


    def place_counts(self, counts: dict[int, int]) -> tuple[np.ndarray, int]:
        """The same for ``counts`` of pieces by length, equal sequences at a
        time.  Rows (length, first piece of that length, first sequence, pieces
        in each, offset), and the number of sequences.

        Sequences with equal contents are one class; a length goes to the best
        class, as many into each as the rule would put there one by one."""
        rows: list[tuple[int, int, int, int, int]] = []
        shortest = min(counts, default=0)
        left = np.empty((64, 3), dtype=np.int64)
        first, size = np.empty(64, dtype=np.int64), np.empty(64, dtype=np.int64)
        n = opened = 0

        def keep(residual: np.ndarray, at: int, many: int) -> None:
            nonlocal n, left, first, size
            if not many or residual[0] < shortest or residual[1] < 1:
                return
            if n == len(first):
                left, first, size = (np.concatenate([x, x]) for x in (left, first, size))
            left[n], first[n], size[n] = residual, at, many
            n += 1

        for length in sorted(counts, reverse=True):
            v, more, done = self._vector(length), counts[length], 0
            while more:
                can = np.flatnonzero((left[:n] >= v).all(axis=1))
                if len(can):
                    x = can[int(self._best(left[can], v))]
                    residual, at, many = left[x].copy(), int(first[x]), int(size[x])
                    n -= 1
                    left[x], first[x], size[x] = left[n], first[n], size[n]
                else:
                    residual, at, many = self.capacities, opened, more
                fit = int((residual // v).min())
                if fit < 1:
                    raise ValueError(f"a piece of {length} tokens exceeds a capacity")
                # A tight sequence gets tighter with each piece, so the norm
                # stays with it; the dot product turns to the next one.
                each = min(fit if self.rule == "norm" or not len(can) else 1, more)
                taken = min(many, more // each)
                rows.append((length, done, at, each, int(self.capacities[0] - residual[0])))
                done, more = done + taken * each, more - taken * each
                if not len(can):
                    opened += taken
                else:
                    keep(residual, at + taken, many - taken)
                keep(residual - each * v, at, taken)
        rows.sort()
        return np.array(rows, dtype=np.int64).reshape(-1, 5), opened

    def _best(self, open_: np.ndarray, v: np.ndarray) -> int:
        if self.rule == "norm":
            return int(np.argmin((((open_ - v) ** 2) * self.weights).sum(axis=1)))
        return int(np.argmax((open_ * v * self.weights).sum(axis=1)))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
                   max_documents: int | None = None, max_attention: int | None = None,
                   weights: tuple[float, float, float] = (1.0, 1e-4, 1e-4), rule: str = "norm",
                   window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids`` (little-endian
    unsigned 32-bit), ``sequence_id, offset``.

    A document is its ids and ``end_id``; one longer than ``capacity`` is cut
    into pieces of that many tokens, the last may be shorter.  By default
    documents and attention are bounded by what ``capacity`` tokens imply
    (``capacity`` pieces, ``capacity`` squared); tighter bounds hold too, and
    a piece that alone exceeds one raises ``ValueError``.

    Null or empty text: one piece with the end id.  Null doc_id: packed, with
    a null id.  Rows that repeat an id are packed once each, every row with
    pieces from 0.  Ties go to the sequence opened first.  Empty table: no
    rows.  Other columns are ignored.
    """
    capacities = (capacity, max_documents or capacity, max_attention or capacity * capacity)

    Piece = tuple[int | None, int, int, bytes]  # doc_id, piece, start, ids

    def tokenized() -> Callable[[pa.RecordBatch], Iterator[Piece]]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], dtype="<u4").tobytes()

        def cut(batch: pa.RecordBatch) -> Iterator[Piece]:
            for doc, text in zip(batch.column(0), utf8(batch.column(1))):
                ids = encode(text) + end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    yield doc.as_py(), piece, start // 4, ids[start:start + 4 * capacity]

        return cut

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, read, task = VectorBestFit(capacities, weights, rule), tokenized(), TaskContext.get().partitionId()
        next_id = task << 36
        handed: dict[int, int] = {}  # pieces handed on, by length
        out: list[tuple] = []
        held: list[tuple] = []
        held_tokens = 0

        def given(rows: list[tuple]) -> pa.RecordBatch:
            names = [f.split()[0] for f in FIRST_ROUND.split(", ")]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names)

        def close(pieces: list[tuple]) -> None:
            nonlocal next_id
            at = 0
            for doc, piece, start, ids in pieces:
                out.append((doc, piece, start, len(ids) // 4, ids, next_id, at, None, None))
                at += len(ids) // 4
            next_id += 1

        def hand_on(pieces: list[tuple]) -> None:
            for doc, piece, start, ids in pieces:
                length = len(ids) // 4
                nth = handed.get(length, 0)
                handed[length] = nth + 1
                out.append((doc, piece, start, length, ids, None, None, task, nth))

        def pack(last: bool) -> None:
            nonlocal held, held_tokens
            lengths = np.array([len(p[3]) // 4 for p in held], dtype=np.int64)
            waiting: list[tuple] = []
            for sequence in fit.place(lengths):
                pieces = [held[i] for i in sequence]
                if lengths[sequence].sum() >= GIVEN_OUT_FROM * capacity:
                    close(pieces)
                else:
                    waiting += pieces
            held, held_tokens = waiting, sum(len(p[3]) // 4 for p in waiting)
            if last or held_tokens > window_tokens // 2:  # these lengths do not fill sequences here
                hand_on(held)
                held, held_tokens = [], 0

        for batch in batches:
            for row in read(batch):
                length = len(row[3]) // 4
                if not fit.fits_alone(length):
                    raise ValueError(f"a piece of {length} tokens exceeds a capacity")
                if length == capacity:
                    close([row])
                else:
                    held.append(row)
                    held_tokens += length
                if held_tokens >= window_tokens:
                    pack(last=False)
                while len(out) >= ROWS_OUT:
                    yield given(out[:ROWS_OUT])
                    del out[:ROWS_OUT]
        pack(last=True)
        while out:
            yield given(out[:ROWS_OUT])
            del out[:ROWS_OUT]

    dealt = docs.select(F.col("doc_id").cast("bigint"), F.col("text")).repartition(F.xxhash64("doc_id", "text"))
    first = written(dealt.mapInArrow(first_round, FIRST_ROUND), "packed")
    rest = first.filter("sequence_id IS NULL")
    by_task = rest.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = written(by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "handed-on", narrow=True)
    counts = {r[0]: r[1] for r in by_task.groupBy("length").agg(F.sum("n")).collect()}  # capacity rows at most
    places, _ = VectorBestFit(capacities, weights, rule).place_counts(counts)

    def second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = places[:, 0] << RANK_BITS | places[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = places[np.searchsorted(keys, length << RANK_BITS | rank, side="right") - 1].reshape(-1, 5)
            nth = rank - at[:, 1]
            sequence = SECOND_ROUND + at[:, 2] + nth // at[:, 3]
            offset = at[:, 4] + nth % at[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in range(5)], pa.array(sequence), pa.array(offset)],
                [f.split()[0] for f in SCHEMA.split(", ")])

    ranked = rest.join(by_task, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids", (F.col("before") + F.col("nth")).alias("rank"))
    return first.filter("sequence_id IS NOT NULL").drop("task", "nth").unionByName(ranked.mapInArrow(second_round, SCHEMA))
