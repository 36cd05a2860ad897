"""Order-preserving packing of token streams into fixed windows.

The documents of an input partition form one stream, in their order. A dynamic program chooses where
windows end: at a document end (free), a sentence end (small penalty) or inside a sentence (larger
penalty), against the padding this costs. With p the position of a cut and f its least cost,

    f(j) = pen(j) + capacity - p(j) + min { f(i) + p(i) : p(j) - capacity <= p(i) < p(j) }

so a monotone queue of f(i) + p(i) gives each transition in constant amortised time. The rest of a
chunk shorter than ``capacity`` is cut into powers of two, which need no padding.

No shuffle: a partition is packed by the task that reads it, in chunks of about ``chunk_tokens``
(ended at a document's end), so memory holds one chunk, or one document where that is longer.
"""

from __future__ import annotations

import base64
import re
import unicodedata
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

CAPACITY = 2048
END_ID = 1
#: Cost of a cut in padding tokens.
SENTENCE_PENALTY, INNER_PENALTY = 6.0, 14.0
#: Distance of the cuts offered inside a sentence.
INNER_STEP = 16


#: Characters below this are classed alike by every Unicode version in use.
SETTLED = 0x500
#: Entries of the cache from pre-token to ids that a worker keeps.
CACHE = 250_000


def _class(kind: str) -> str:
    """Body of a character class: the characters below SETTLED of a Unicode category, given by its first letter."""
    return "".join(re.escape(chr(c)) for c in range(SETTLED) if unicodedata.category(chr(c))[0] == kind)


class Encoder:
    """Ids without special tokens (their strings in a text are ordinary text). Where all characters lie below
    SETTLED, the text is split as the vocabulary's pre-tokenizer splits it, and the ids of each split are looked
    up; ``tokenizers`` itself encodes all other texts."""

    def __init__(self, json_path: str, ranks_path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_path)
        self.whole.encode_special_tokens = True
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        letter, number, space = _class("L"), _class("N"), "\t-\r\x20\x85\xa0"
        pattern = f" ?[{letter}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
        self.split = re.compile(pattern).findall
        self.one = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}
        self.type = np.uint16 if max(max(ranks.values()), self.whole.get_vocab_size()) < 1 << 16 else np.uint32
        self.ends = np.zeros(max(ranks.values()) + 2, bool)
        for token, i in ranks.items():
            self.ends[i] = token.endswith((b".", b"!", b"?", b"\n"))

    def __call__(self, text: str) -> np.ndarray:
        if not text.isascii() and ord(max(text)) >= SETTLED:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.type)
        known, pieces = self.known, self.split(text)
        try:
            return np.frombuffer(b"".join([known[x] for x in pieces]), self.type)
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for x in pieces:
                if x not in known:
                    known[x] = np.array(self.one(x), self.type).tobytes()
            return np.frombuffer(b"".join([known[x] for x in pieces]), self.type)


@lru_cache(maxsize=2)
def encoder(json_path: str, ranks_path: str) -> Encoder:
    return Encoder(json_path, ranks_path)


def vocabulary_paths(name: str = "byte_bpe_50k") -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


def cut_points(doc_ends: np.ndarray, sentence_ends: np.ndarray, step: int = INNER_STEP) -> tuple[np.ndarray, np.ndarray]:
    """Positions a window may end at, and the penalty of each; position 0 comes first."""
    soft = np.union1d(sentence_ends, doc_ends)
    left = np.concatenate(([0], soft[:-1]))
    inner = (soft - left - 1) // step
    first = np.cumsum(inner) - inner
    hard = np.repeat(left, inner) + step * (np.arange(int(inner.sum())) - np.repeat(first, inner) + 1)
    at = np.concatenate(([0], soft, hard))
    pen = np.concatenate(([0.0], np.where(np.isin(soft, doc_ends), 0.0, SENTENCE_PENALTY), np.full(len(hard), INNER_PENALTY)))
    order = np.argsort(at, kind="stable")
    return at[order], pen[order]


def choose_cuts(at: list[int], pen: list[float], capacity: int = CAPACITY) -> list[int]:
    """Ends of the windows of least total cost. Steps between points must be at most ``capacity``."""
    n = len(at)
    cost, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    push, drop, shift = queue.append, queue.pop, queue.popleft
    for j in range(1, n):
        p = at[j]
        low = p - capacity
        while at[queue[0][1]] < low:
            shift()
        best, i = queue[0]
        back[j] = i
        f = cost[j] = best + capacity - p + pen[j]
        g = f + p
        while queue and queue[-1][0] >= g:
            drop()
        push((g, j))
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


def binary_tail(start: int, end: int, capacity: int = CAPACITY) -> list[int]:
    """Ends of windows over [start, end) whose sizes are falling powers of two."""
    out = []
    while start < end:
        start += min(capacity, 1 << ((end - start).bit_length() - 1))
        out.append(start)
    return out


def pack_chunk(docs: list[np.ndarray], ends: np.ndarray, capacity: int = CAPACITY):
    """Pieces of a chunk: arrays of document index, start in it, length, window, offset there; and the stream."""
    stream = np.concatenate(docs)
    doc_ends = np.cumsum([len(d) for d in docs])
    at, pen = cut_points(doc_ends, np.flatnonzero(ends[np.minimum(stream, len(ends) - 1)]) + 1, min(INNER_STEP, capacity))
    cuts = choose_cuts(at.tolist(), pen.tolist(), capacity)
    last = cuts[-2] if len(cuts) > 1 else 0
    windows = np.array(cuts[:-1] + binary_tail(last, cuts[-1], capacity))
    edges = np.union1d(windows, doc_ends)
    begin = np.concatenate(([0], edges[:-1]))
    doc = np.searchsorted(doc_ends, begin, side="right")
    window = np.searchsorted(windows, begin, side="right")
    doc_begin = np.concatenate(([0], doc_ends[:-1]))
    window_begin = np.concatenate(([0], windows[:-1]))
    return doc, begin - doc_begin[doc], edges - begin, window, begin - window_begin[window], stream, begin


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, paths: tuple[str, str] | None = None, chunk_tokens: int = 1 << 20, with_ids: bool = True) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    A null or empty text is its end token alone. Repeated rows are packed as often as they come. A null id stays
    null. Other columns are not read, whatever their names. An empty table gives no pieces. A very long text
    spans windows; a task holds it whole. sequence_id is the partition's number times 2^33 plus a counter, so a
    task that runs again gives the same.
    """
    paths = paths or vocabulary_paths()
    id_type = docs.schema[id_col].dataType
    schema = f"{id_col} {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids

    def run(batches):
        encode = encoder(*paths)
        ends = encode.ends
        keys, held, size, sequences = [], [], 0, TaskContext.get().partitionId() << 33

        def flush():
            nonlocal keys, held, size, sequences
            doc, start, length, window, offset, stream, begin = pack_chunk(held, ends, capacity)
            raw = memoryview(stream.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * b : 4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
            totals = np.array([len(d) for d in held])
            columns = [pa.concat_arrays(keys).take(pa.array(doc)), start, length, crc, totals[doc], window + sequences, offset]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(stream)), pa.int32()), pa.array(stream.astype(np.int32))))
            sequences += int(window[-1]) + 1
            keys, held, size = [], [], 0
            arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, pa.int64()) for c in columns]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][: len(arrays)]
            yield from pa.Table.from_arrays(arrays, names=names).to_batches(max_chunksize=50_000)

        for batch in batches:
            ids = batch.column(0)
            for k, text in enumerate(batch.column(1)):
                held.append(np.append(encode(text.as_py()), encode.type(END_ID)))
                keys.append(ids.slice(k, 1))
                size += len(held[-1])
                if size >= chunk_tokens:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, schema)
