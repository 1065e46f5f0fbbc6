"""Best-fit packing of documents into token sequences, with large-item matching.

Lengths are whole numbers up to the capacity, so a packing is decided on the counts of each length alone: at most as many numbers
as the capacity has tokens, however large the corpus. Pieces above a third of the capacity go at most two to a sequence; from the
longest on, each is matched with the longest other that still fits. The rest, from the longest on, go into the smallest gap that holds
them. Equal cases are settled many at a time, which gives the same bins as one after the other.

The pieces are then dealt to the places by rank within their length. Ranks come from a range partitioning on (length, a hash of the
id): a length that very many pieces have, such as the full one, is spread over as many partitions as it needs, and what the driver
gathers is one count for each partition and length in it, not more than partitions + capacity numbers.

Defined results: a null or empty text has only the end-of-document id, so it is one piece of length 1. Rows that repeat an id are packed
each for itself. No rows give no rows. Further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.bpe import PATTERN, codec, ranks
from tracewell.llm.spark_util import cut

CAPACITY, END = 2048, 0
#: White space in a row that makes a text one for the linear encoder.
LONG_RUN = 10_000
_long_run = re.compile(r"\s{%d}" % LONG_RUN).search
_SLOT = 40


class _Bins:
    """Groups of alike bins by the room that they have left, and the places dealt out in them."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.bins = capacity, 0
        self.groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: (first bin, number of bins)
        self.rooms = 0  # bit r: there is a group with room r
        self.dealt: Counter[int] = Counter()
        self.places: list[tuple[int, int, int, int]] = []  # length, first rank, first bin, offset

    def put(self, first: int, n: int, room: int) -> None:
        if n and room:
            self.groups[room].append((first, n))
            self.rooms |= 1 << room

    def new(self, n: int) -> int:
        self.bins += n
        return self.bins - n

    def place(self, length: int, first: int, n: int, offset: int) -> None:
        if n:
            self.places.append((length, self.dealt[length], first, offset))
            self.dealt[length] += n

    def fill(self, length: int, n: int, first: int, bins: int, room: int) -> int:
        """Puts up to n items of one length into alike bins, each filled before the next; returns how many are left."""
        each, offset = room // length, self.capacity - room
        full = min(bins, n // each)
        for j in range(each):
            self.place(length, first, full, offset + j * length)
        self.put(first, full, room - each * length)
        n -= full * each
        if n and full < bins:
            for j in range(n):  # fewer than go into one bin
                self.place(length, first + full, 1, offset + j * length)
            self.put(first + full, 1, room - n * length)
            n, full = 0, full + 1
        self.put(first + full, bins - full, room)
        return n

    def best_fit(self, length: int, n: int) -> None:
        while n:
            above = self.rooms >> length
            if not above:
                bins = -(-n // (self.capacity // length))
                n = self.fill(length, n, self.new(bins), bins, self.capacity)
                continue
            room = length + (above & -above).bit_length() - 1
            first, bins = self.groups[room].pop()
            if not self.groups[room]:
                self.rooms &= ~(1 << room)
            n = self.fill(length, n, first, bins, room)


def pack_lengths(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Places as rows (length, first rank, first sequence, offset), sorted, and the number of sequences.

    Ranks r of a length from a place's first rank up to the next place's go to the sequence first + r - first rank.
    """
    left, bins = Counter({k: v for k, v in counts.items() if v}), _Bins(capacity)
    if left and not 1 <= min(left) <= max(left) <= capacity:
        raise ValueError("a length is out of range")
    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for x in large:
        while left[x]:
            mate = next((y for y in large if y <= min(x, capacity - x) and left[y] > (y == x)), None)
            n = left[x] if mate is None else left[x] // 2 if mate == x else min(left[x], left[mate])
            first = bins.new(n)
            bins.place(x, first, n, 0)
            left[x] -= n
            if mate is not None:
                bins.place(mate, first, n, x)
                left[mate] -= n
            bins.put(first, n, capacity - x - (mate or 0))
    for x in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        bins.best_fit(x, left[x])
    return np.array(sorted(bins.places), np.int64).reshape(-1, 4), bins.bins


_fast: dict = {}


def encode(text: str | None, vocabulary: str) -> np.ndarray:
    """Ids of a text by a vocabulary file, as the library gives them.

    The fastest of the equal encoders takes the text, with ranks and special tokens from the file. Its pattern goes back over white space step by
    step, which long runs make too deep, so texts with a run of LONG_RUN go to this subpackage's own encoder, which is linear in any text.
    """
    if not text:
        return np.zeros(0, np.uint32)
    if len(text) >= LONG_RUN and _long_run(text):
        return codec(vocabulary).encode(text)
    if vocabulary not in _fast:
        import tiktoken

        tokens, special = ranks(vocabulary)
        _fast[vocabulary] = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=tokens, special_tokens=special)
    return _fast[vocabulary].encode_to_numpy(text, allowed_special="all")


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each document: its ids and the end id; only longer ones are cut, the first piece is the shorter one.

    Ids are the library's; see encode.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, int, int, int, int]] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encode(text.as_py(), vocabulary), end).astype("<u4")
                first = len(ids) % capacity or capacity
                for k, to in enumerate(range(first, len(ids) + 1, capacity)):
                    at = max(0, to - capacity) if k else 0
                    out.append((doc, k, at, to - at, zlib.crc32(ids[at:to].tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length (1 to capacity)."""
    pieces = cut(pieces)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places, _ = pack_lengths(counts, capacity)
    keys, first_rank, first_bin, offset = places[:, 0] << _SLOT | places[:, 1], places[:, 1], places[:, 2], places[:, 3]

    spread = cut(pieces.repartitionByRange("length", F.xxhash64("doc_id", "piece")).sortWithinPartitions("length", F.xxhash64("doc_id", "piece"), "doc_id", "piece"))
    spread = spread.withColumn("part", F.spark_partition_id())
    starts: dict[tuple[int, int], int] = {}
    seen: Counter[int] = Counter()
    for r in sorted(spread.groupBy("part", "length").count().collect()):
        starts[r["part"], r["length"]] = seen[r["length"]]
        seen[r["length"]] += r["count"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: dict[int, int] = {}
        for b in batches:
            part, length = b.column("part").to_numpy(), b.column("length").to_numpy()
            rank = np.empty(len(length), np.int64)
            for x in np.unique(length).tolist():
                where = np.flatnonzero(length == x)
                at = here.get(x, starts[int(part[0]), x])
                rank[where] = at + np.arange(len(where))
                here[x] = at + len(where)
            j = np.searchsorted(keys, length << _SLOT | rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(first_bin[j] + rank - first_rank[j]), pa.array(offset[j])], names=[*names, "sequence_id", "offset"])

    names = pieces.columns
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return spread.mapInArrow(run, schema)
