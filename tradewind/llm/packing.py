"""Packing of token ids into windows by multiway differencing.

A task tokenizes its documents, cuts off whole windows, cuts what remains into pieces of at most half a
window, and gathers pieces until they fill ``GROUP_WINDOWS`` windows.  Such a group is packed by
Karmarkar-Karp differencing: every piece starts as a partial partition with one loaded window; the two
partitions with the largest imbalance are merged, the fullest windows of one onto the emptiest of the
other, until one partition is left.  If a window exceeds the capacity, the number of windows rises and the
group is packed anew.  Groups are bounded and there is no shuffle, so neither a hot source nor a long
document gathers in one task.  A task that is run again reads the same rows and gives the same windows.

Defined cases: a null or empty text is the end-of-document id alone; a repeated row is packed again under
its ``doc_id``; an empty table gives no pieces.  Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import texts

CAPACITY = 1024
END = 0
GROUP_WINDOWS = 256
CACHED_PARTS = 300_000
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def default_tokenizer() -> str:
    """The ranks of the byte-level vocabulary; its ids equal those of ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder(dict):
    """Little-endian 32-bit ids of a text, through a bounded cache of space-separated parts.

    The tokenizer's split never joins a part to the space before it unless white space follows that space, so
    the ids of the parts, each with its space, are the ids of the text.  Texts with such a space are
    encoded whole; so is a text that starts or ends with a space.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def __missing__(self, part: str) -> bytes | None:
        if len(self) >= CACHED_PARTS:
            self.clear()
        ids = self[part] = self.whole(" " + part) if part and not part[0].isspace() else None
        return ids

    def encode(self, text: str) -> bytes:
        first, *parts = text.split(" ")
        if not first:
            return self.whole(text)
        try:
            return self.whole(first) + b"".join(map(self.__getitem__, parts))
        except TypeError:
            return self.whole(text)


def differencing(lengths: list[int], windows: int) -> tuple[np.ndarray, int]:
    """Window of each piece, and the fullest window's load."""
    nodes: list[tuple] = []
    heap = []
    for at, length in enumerate(lengths):
        load = np.zeros(windows, np.int64)
        load[0] = length
        nodes.append((load, None))
        heap.append((-length if windows > 1 else 0, at))
    heapq.heapify(heap)
    while len(heap) > 1:
        first, second = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        load = nodes[first][0] + nodes[second][0][::-1]
        order = np.argsort(-load, kind="stable")
        load = load[order]
        nodes[first], nodes[second] = (None, nodes[first][1]), (None, nodes[second][1])
        nodes.append((load, (first, second, order)))
        heapq.heappush(heap, (int(load[-1] - load[0]), len(nodes) - 1))
    placed = np.zeros(len(lengths), np.int64)
    todo = [(heap[0][1], np.arange(windows))]
    while todo:
        node, names = todo.pop()
        if nodes[node][1] is None:
            placed[node] = names[0]
            continue
        first, second, order = nodes[node][1]
        own = np.empty(windows, np.int64)
        own[order] = names
        todo += [(first, own), (second, own[::-1])]
    return placed, int(nodes[heap[0][1]][0][0])


def assign(lengths: list[int], capacity: int) -> np.ndarray:
    """Window of each piece; the number of windows rises until none exceeds the capacity."""
    windows = max(1, -(-sum(lengths) // capacity))
    while True:
        placed, fullest = differencing(lengths, windows)
        if fullest <= capacity:
            return placed
        windows += 1 + windows // 256


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces with their ids (little-endian 32-bit), the window they lie in and the place there.

    ``start`` counts the document's ids before the piece, ``doc_tokens`` all its ids with the end id.
    """
    path, most = tokenizer or default_tokenizer(), max(1, capacity // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, mark = Encoder(path), np.array([end], "<u4").tobytes()
        context = TaskContext.get()
        base, used, out, waiting, load = (context.partitionId() if context else 0) << 33, 0, [], [], 0

        def settle() -> None:
            nonlocal used, load
            if not waiting:
                return
            placed = assign([x[2] for x in waiting], capacity)
            number, offsets = {}, {}
            for piece, window in zip(waiting, placed.tolist()):
                if window not in number:
                    number[window] = used
                    used += 1
                at = offsets.get(window, 0)
                out.append((*piece, base + number[window], at))
                offsets[window] = at + piece[2]
            waiting.clear()
            load = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), (*[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 3))],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
                out.clear()

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                name, ids = name.as_py(), encoder.encode(text.as_py()) + mark
                total, start = len(ids) // 4, 0
                while start < total:
                    length = capacity if total - start >= capacity else min(most, total - start)
                    piece = (name, start, length, ids[4 * start: 4 * (start + length)], total)
                    start += length
                    if length == capacity:
                        out.append((*piece, base + used, 0))
                        used += 1
                        continue
                    waiting.append(piece)
                    load += length
                    if load >= GROUP_WINDOWS * capacity:
                        settle()
                if len(out) >= 2000:
                    yield from flush()
            yield from flush()
        settle()
        yield from flush()

    return texts(docs).mapInArrow(run, PIECES)


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
