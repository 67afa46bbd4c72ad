"""Alignment of two tokenizers over the same bytes by interval coalescing.

Every token is a byte interval.  The intervals of both tokenizers are
lexsorted by start; with the running maximum of their ends
(``maximum.accumulate``), a group breaks where a start reaches that maximum,
which is where tokens of both sides end.  Inside a group the overlapping pairs
are expanded into links.

Texts repeat words, and neither tokenizer has a token across a lone space or
line feed (checked for the files at hand).  So a text is cut there into units,
and a task numbers the distinct units of a chunk of documents: each is encoded
and coalesced once, and a document is written as the numbers of its units.  A
chunk is bounded by the units of its documents and by the distinct ones.  Links
and groups never go across a unit, as both sides end there.

How often two ids are linked in the whole corpus is one aggregation over the
chunks' pairs; the counts go back to the chunks that hold a pair, never to
every task, and a document sums them over its units.  Texts are read once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import utf8, written
from obslake.llm.tokens import _byte_letters

BATCH_BYTES = 1 << 21  # text whose new units are encoded together
CHUNK_UNITS = 1 << 20  # units of the documents of a chunk, and
CHUNK_DISTINCT = 1 << 17  # distinct ones, before the chunk is closed
TOGETHER = 4_096  # units that are one text for the tokenizers
PAIR = 32  # bits of a pair's key that hold the B id
ALIGNED = ("chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "units array<int>, pairs array<bigint>, times array<bigint>, ends array<int>, links array<int>")
SCORED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
          "groups_sha256 string")

_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
_NO_EDGE = "\u180e\u200b\ufeff"  # taken for white space, as tables of it differ


def pieces_of(text: bytes) -> list[bytes]:
    """What stands between the spaces of space + text; a line feed starts a
    piece of its own."""
    return text.replace(b"\n", b" \n").split(b" ")


def unit_text(key: bytes) -> bytes:
    """The bytes of a unit: a piece with the space before it, or several
    pieces (which have a space inside, or start with a line feed)."""
    return key if key.startswith(b"\n") or b" " in key else b" " + key


def joined(pieces: list[bytes]) -> bytes:
    """The key of a unit of several pieces."""
    return b"".join([p if p.startswith(b"\n") else b" " + p for p in pieces])


def edges(key: bytes) -> int:
    """1: the text may be cut before this piece; 2: after it.  There is no cut
    next to other white space."""
    if key and 32 < key[0] < 127 and 32 < key[-1] < 127:
        return 3
    text = key.decode("utf-8", "replace")
    body = text[1:] if text.startswith("\n") else text
    if not body:
        return 0
    return sum(bit for bit, c in ((1, body[0]), (2, body[-1])) if not c.isspace() and c not in _NO_EDGE)


class ByteLevel:
    """A byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are plain text
        byte_of = {c: bytes([b]) for b, c in enumerate(_byte_letters())}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = b"".join([byte_of.get(c, c.encode()) for c in token])
        self.length = np.array([len(x) for x in self.bytes], dtype=np.int64)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        # its rule keeps a lone space with what follows it, and a lone line
        # feed by itself
        self.cuts = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                     and not pre["add_prefix_space"] and pre["use_regex"])

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of a text as it is."""
        found = self.tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)
        return np.array(found[0].ids, dtype=np.uint32)


class Pieces:
    """A sentencepiece model that puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode()
                      for p in pieces]
        self.length = np.array([len(x) for x in self.bytes], dtype=np.int64)
        self.space = self.model.piece_to_id("▁")
        # a piece with a space after anything else, or with a line feed, would
        # go across a cut
        self.cuts = not any(re.search("[^▁]▁|\n", p) for p in pieces) and self.model.encode("\na")[0] == self.space

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of a text as it is: the model adds a first space."""
        if text.startswith(b" "):
            ids = self.model.encode(text[1:].decode("utf-8", "replace"))
        else:
            ids = self.model.encode(text.decode("utf-8", "replace"))
            ids = ids[1:] if ids and ids[0] == self.space else ids
        return np.array(ids, dtype=np.uint32)


def coalesce(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of both sides, sorted, and where groups start among them.

    Both sides cover the same bytes from 0 on without gaps; ``*_ends`` are the
    ends of their tokens.  Tokens are numbered A first, then B."""
    starts = np.concatenate([np.append(0, a_ends[:-1]) if len(a_ends) else a_ends,
                             np.append(0, b_ends[:-1]) if len(b_ends) else b_ends])
    ends = np.concatenate([a_ends, b_ends])
    side = np.repeat(np.array([0, 1], dtype=np.int8), [len(a_ends), len(b_ends)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.append(True, starts[order][1:] >= reach[:-1]) if len(order) else np.zeros(0, dtype=bool)
    return order, np.flatnonzero(breaks)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (A token, B token) whose byte intervals overlap, both sides
    covering the same bytes; by A token, then B token."""
    if not len(a_ends):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    a_starts = np.append(0, a_ends[:-1])
    first = np.searchsorted(b_ends, a_starts, side="right")
    last = np.searchsorted(np.append(0, b_ends[:-1]), a_ends, side="left")
    count = last - first
    a = np.repeat(np.arange(len(a_ends)), count)
    b = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    return a, b


SIGNS = b",|;"  # after an id inside a group's side, between its sides, after the group


@cache
def signed(n: int) -> list[list[bytes]]:
    """Ids up to ``n`` with each sign after them."""
    return [[b"%d%c" % (i, c) for i in range(n)] for c in SIGNS]


class Chunk:
    """The documents of a chunk as places of units, and its dictionary of
    units: their tokens one after another, and their groups as text.  A unit
    that a tokenizer changes has no tokens."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.edges = np.zeros(0, dtype=np.uint8)  # by number, as is
        self.place = np.zeros(0, dtype=np.int32)  # the place of a unit; -1: a piece that was only looked at
        self.shown: list[bytes] = []
        self.sizes = np.zeros((0, 3), dtype=np.int64)  # A tokens, B tokens, groups
        self.tokens: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        self.docs: list[tuple] = []  # doc_id, n_a, n_b, n_groups, units, sha256
        self.n_units = 0
        self.text = signed(max(len(a.bytes), len(b.bytes)))

    def full(self) -> bool:
        return self.n_units >= CHUNK_UNITS or len(self.number) >= CHUNK_DISTINCT

    def cut(self, texts: list[bytes]) -> list[np.ndarray]:
        """Unit numbers of texts."""
        number = self.number
        if not (self.a.cuts and self.b.cuts):
            return [np.array([number[b" " + t]], dtype=np.int32) for t in texts]
        split = [pieces_of(t) for t in texts]
        numbers = [np.array([number[p] for p in pieces], dtype=np.int32) for pieces in split]
        if len(number) > len(self.edges):
            more = [edges(k) for k in islice(number, len(self.edges), None)]
            self.edges = np.append(self.edges, np.array(more, dtype=np.uint8))
        out = []
        for pieces, mine in zip(split, numbers):
            e = self.edges[mine]
            cuts = (e[:-1] & 2).astype(bool) & (e[1:] & 1).astype(bool)
            if not cuts.all() or len(mine) == 1 and not pieces[0]:
                bounds = [0, *(np.flatnonzero(cuts) + 1).tolist(), len(pieces)]
                mine = np.array([number[pieces[s]] if t - s == 1 and pieces[s] else number[joined(pieces[s:t])]
                                 for s, t in zip(bounds, bounds[1:])], dtype=np.int32)
            out.append(mine)
        return out

    def learn(self, numbers: np.ndarray, units: list[bytes]) -> bool:
        """Encodes units as one text and coalesces it; false (and nothing
        learned) where a tokenizer changes it or has a token across units."""
        whole = b"".join(units)
        ids = [side.encode(whole) for side in (self.a, self.b)]
        if any(b"".join([side.bytes[t] for t in of.tolist()]) != whole for side, of in zip((self.a, self.b), ids)):
            return False
        a_ends, b_ends = (np.cumsum(side.length[of]) for side, of in zip((self.a, self.b), ids))
        unit_ends = np.cumsum([len(u) for u in units])
        last = [np.searchsorted(ends, unit_ends) for ends in (a_ends, b_ends)]
        if any((ends[at] != unit_ends).any() for ends, at in zip((a_ends, b_ends), last)):
            return False
        order, first = coalesce(a_ends, b_ends)
        n = len(order)
        group = np.zeros(n, dtype=np.int64)
        group[first[1:]] = 1
        group = np.cumsum(group)
        side = order >= len(a_ends)
        by_side = np.lexsort((side, group))  # a group's A tokens before its B tokens
        side, group, of = side[by_side], group[by_side], np.concatenate(ids)[order][by_side]
        end_of_group = np.append(group[1:] != group[:-1], True)
        sign = np.where(end_of_group, 2, np.where(np.append(side[1:] != side[:-1], True), 1, 0))
        shown = [self.text[x][t] for x, t in zip(sign.tolist(), of.tolist())]
        to = (last[0] + last[1] + 2).tolist()
        self.shown += [b"".join(shown[s:t])[:-1] for s, t in zip([0, *to], to)]
        groups = np.append(0, np.cumsum(end_of_group))[[0, *to]]
        self.sizes = np.concatenate([self.sizes, np.stack(
            [np.diff(last[0] + 1, prepend=0), np.diff(last[1] + 1, prepend=0), np.diff(groups)], axis=1)])
        self.place[numbers] = np.arange(len(self.shown) - len(units), len(self.shown))
        for kept, new in zip(self.tokens, ids):
            kept.append(new)
        return True

    def add(self, doc_ids: list[int | None], texts: list[bytes]) -> None:
        cut = self.cut(texts)
        more = len(self.number) - len(self.place)
        self.place = np.append(self.place, np.full(more, -1, dtype=np.int32))
        # units of several pieces are no pieces
        self.edges = np.append(self.edges, np.zeros(len(self.number) - len(self.edges), dtype=np.uint8))
        used = np.unique(np.concatenate(cut))
        new = used[self.place[used] < 0]
        if len(new):
            keys = list(self.number)
            # units that may be cut on both sides are one text; the others,
            # and those of a text that does not hold, are texts of their own
            plain = new[self.edges[new] == 3] if self.a.cuts and self.b.cuts else new[:0]
            for first in range(0, len(plain), TOGETHER):
                some = plain[first:first + TOGETHER]
                self.learn(some, [unit_text(keys[u]) for u in some.tolist()])
            for u in new[self.place[new] < 0].tolist():
                if not self.learn(np.array([u]), [unit_text(keys[u])]):
                    self.place[u] = len(self.shown)
                    self.shown.append(b"")
                    self.sizes = np.concatenate([self.sizes, np.zeros((1, 3), dtype=np.int64)])
        shown = self.shown
        for doc, mine in zip(doc_ids, cut):
            mine = self.place[mine]
            sizes = self.sizes[mine]
            if not sizes[:, 2].all():  # a tokenizer changes one of them
                self.add_empty(doc)
                continue
            text = b";".join([shown[u] for u in mine.tolist()])
            self.docs.append((doc, *sizes.sum(axis=0).tolist(), mine, hashlib.sha256(text).hexdigest()))
            self.n_units += len(mine)

    def add_empty(self, doc_id: int | None) -> None:
        self.docs.append((doc_id, 0, 0, 0, np.zeros(0, dtype=np.int32), ""))

    def rows(self, number: int) -> pa.RecordBatch:
        """One row for each document and one for the dictionary: the distinct
        linked pairs, how often the chunk links them, and the pairs of each
        unit (``links`` up to ``ends``)."""
        none = np.zeros(0, dtype=np.uint32)
        a, b = (np.concatenate([none, *side]).astype(np.int64) for side in self.tokens)
        n_units = len(self.shown)
        at_a, at_b = overlaps(np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b]))
        pairs, links = np.unique(a[at_a] << PAIR | b[at_b], return_inverse=True)
        links = links.ravel()
        of_unit = np.repeat(np.arange(n_units), self.sizes[:, 0])[at_a]
        per_unit = np.bincount(of_unit, minlength=n_units)
        everything = np.concatenate([np.zeros(0, dtype=np.int32), *[d[4] for d in self.docs]])
        used = np.bincount(everything, minlength=n_units)
        times = np.zeros(len(pairs), dtype=np.int64)  # whole numbers: no float on the way
        np.add.at(times, links, used[of_unit])
        bounds = np.cumsum([0, *[len(d[4]) for d in self.docs]])
        total = np.append(0, np.cumsum(per_unit[everything])) if len(everything) else np.zeros(1, dtype=np.int64)
        n_links = total[bounds[1:]] - total[bounds[:-1]]
        n = len(self.docs)

        def listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
            """Null for documents, one list for the dictionary."""
            offsets = pa.array([0] * (n + 1) + [len(values)], pa.int32())
            return pa.ListArray.from_arrays(offsets, pa.array(values, kind), mask=pa.array([True] * n + [False]))

        units = pa.ListArray.from_arrays(pa.array(np.append(bounds, bounds[-1]), pa.int32()), pa.array(everything, pa.int32()))
        doc_id, n_a, n_b, n_groups, _, sha = zip(*self.docs) if n else ((), (), (), (), (), ())
        long = pa.int64()
        return pa.RecordBatch.from_arrays([
            pa.array([number] * (n + 1), long), pa.array([*doc_id, None], long), pa.array([*n_a, None], long),
            pa.array([*n_b, None], long), pa.array([*n_groups, None], long),
            pa.array([*n_links.tolist(), None], long), pa.array([*sha, None], pa.string()), units,
            listed(pairs, long), listed(times, long), listed(np.cumsum(per_unit), pa.int32()), listed(links, pa.int32())],
            [f.split()[0] for f in ALIGNED.split(", ")])


_SIDES: dict[tuple[str, str], tuple[ByteLevel, Pieces]] = {}


def sides(byte_level: str, pieces: str) -> tuple[ByteLevel, Pieces]:
    """One pair per Python worker and files: workers outlive tasks."""
    key = byte_level, pieces
    if key not in _SIDES:
        _SIDES[key] = ByteLevel(byte_level), Pieces(pieces)
    return _SIDES[key]


def aligned_chunks(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Rows of :meth:`Chunk.rows` for all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(byte_level, pieces)
        number = TaskContext.get().partitionId() << 36
        chunk = Chunk(a, b)
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                if not text:
                    chunk.add_empty(doc)
                    continue
                ids.append(doc)
                texts.append(text)
                held += len(text)
                if held >= BATCH_BYTES:
                    chunk.add(ids, texts)
                    ids, texts, held = [], [], 0
                    if chunk.full():
                        yield chunk.rows(number)
                        number, chunk = number + 1, Chunk(a, b)
        if ids:
            chunk.add(ids, texts)
        if chunk.docs:
            yield chunk.rows(number)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, count, best``: how many links of the corpus hold a pair of ids,
    and whether its B id has no pair with more."""
    pairs = aligned.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counted = pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("count"))
    # a B id has at most as many pairs as A has ids
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << PAIR) - 1)))
    return counted.withColumn("best", F.col("count") == F.max("count").over(of_b))


def scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a chunk with the corpus counts of its pairs (``right``:
    at, count, best) summed over their groups."""
    has_pairs = pc.is_valid(left.column("pairs"))
    book, docs = left.filter(has_pairs), left.filter(pc.invert(has_pairs))
    links = book.column("links").combine_chunks().flatten().to_numpy()
    ends = book.column("ends").combine_chunks().flatten().to_numpy()
    n = right.num_rows
    count, best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    at = right.column("at").to_numpy()
    count[at] = right.column("count").to_numpy()
    best[at] = right.column("best").to_numpy().astype(np.int64)
    units = docs.column("units").combine_chunks()
    bounds = np.append(0, np.cumsum(np.array(pc.list_value_length(units).fill_null(0), dtype=np.int64)))
    mine = units.flatten().to_numpy()

    def summed(values: np.ndarray) -> pa.Array:
        of_links = np.append(0, np.cumsum(values[links]))
        per_unit = of_links[ends] - of_links[np.append(0, ends[:-1])] if len(ends) else ends
        total = np.append(0, np.cumsum(per_unit[mine]))
        return pa.array(total[bounds[1:]] - total[bounds[:-1]], pa.int64())

    named = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    return pa.table(named | {"n_best": summed(best), "count_sum": summed(count)}).select(
        [f.split()[0] for f in SCORED.split(", ")])


def align(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links`` (pairs of
    tokens whose bytes overlap), ``n_best`` (links whose pair is the commonest
    of its B id in the corpus, ties included), ``count_sum`` (corpus counts
    over all links) and ``groups_sha256`` (of ``a1,a2|b1;a3|b2,b3``).

    A is a byte-level BPE file, encoding space + text; B is a sentencepiece
    model, which adds the space.  Strings of special tokens in a text are plain
    text.  Null and empty texts, and those that a tokenizer changes (its
    tokens' bytes are not space + text), have no tokens: zeros, and ''.  Null
    and repeated doc_ids: a row each.  Empty table: no rows.  Other columns are
    ignored.  A very long run without a lone space or line feed is encoded in one piece.
    """
    aligned = written(aligned_chunks(docs, byte_level, pieces), "aligned")
    places = aligned.filter("pairs IS NOT NULL").select("chunk", F.posexplode("pairs").alias("at", "pair"))
    counts = places.join(written(pair_counts(aligned), "pair-counts"), "pair").select(
        F.col("chunk").alias("of_chunk"), "at", "count", "best")
    # a chunk without links has its rows on the left only
    return aligned.drop("times").groupBy("chunk").cogroup(counts.groupBy("of_chunk")).applyInArrow(scored, SCORED)
