"""Alignment of two tokenizations of the same texts, and how often their ids meet in the corpus.

Both tokenizers cut the bytes of a space and the text. The union of their token ends divides these into elementary intervals; each lies in
one token of either side, found by binary search, and each overlap of two tokens is one interval. An end both share closes a group of
tokens, and the tokens of a group may be expanded into all its pairs.

Neither tokenizer looks across certain places: the byte-level vocabulary splits before white space that follows something else, and no
piece of the other holds such white space after another character (checked when it is loaded). Texts are cut there, ends
meet there, and what a chunk gives is computed once per task and chunk, for all new chunks of a batch together.

A task writes one row a document, with its linked id pairs, and with these rows the number of its documents by pair, summed
before they are shuffled. The pairs of most documents, ``TOP`` at most, go to the tasks that finish the documents;
a document's other pairs are joined.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of
from .packing import SETTLED, encoder, vocabulary_paths

#: Characters with the property White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"
SPACE = "▁"
#: A pair of ids is one number: a * BASE + b.
BASE = 1 << 20
#: Chunks in either half of what a worker keeps; document-pair counts that a task sums before it writes them; pairs sent to every task.
CACHE, PENDING, TOP = 250_000, 4_000_000, 1 << 20


class Aligner:
    """Both tokenizers, and what each chunk seen so far gives: its tokens on either side, its groups as text, and its pairs."""

    def __init__(self, json_path: str, ranks_path: str, piece_path: str) -> None:
        import sentencepiece

        self.a = encoder(json_path, ranks_path)
        decode = _byte_decoder()
        entries = self.a.whole.get_vocab(with_added_tokens=True)
        size = max(entries.values()) + 1
        self.a_bytes = [b""] * size
        for token, i in entries.items():
            self.a_bytes[i] = b"".join(decode[c] if c in decode else c.encode() for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.space = self.b.piece_to_id(SPACE)
        byte = re.compile(r"<0x([0-9A-F]{2})>").fullmatch
        self.b_bytes = [bytes([int(m[1], 16)]) if self.b.is_byte(i) and (m := byte(p)) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        # white space before which neither side looks back: no piece holds it after another character
        inner = {c for p in pieces for c in p[1:].lstrip(SPACE).replace(SPACE, " ")}
        free = "".join(c for c in WHITE if c not in inner)
        bound = "".join(c for c in WHITE if c in inner)
        white, bound = re.escape(WHITE), re.escape(bound)
        more = f"(?:[{bound}][{white}]*)?" if bound else ""
        self.chunks = re.compile(f"[{white}]*(?:[^{white}]+{more})+|[{white}]+").findall if " " in free else lambda text: [text]
        self.a_size, self.b_size = (np.array([len(x) for x in each]) for each in (self.a_bytes, self.b_bytes))
        self.known: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}
        self.words: dict[str, list[int]] = {}
        self.names: dict[int, bytes] = {}

    def b_ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks as they stand inside a text: the space that the tokenizer puts in front stands for a chunk's own first one, or is taken off."""
        ids = self.b.encode([c[1:] if c[:1] == " " else c for c in chunks], num_threads=1)
        return [own if c[:1] == " " and len(c) > 1 else [self.space] if c == " " else _without_space(own, self.b_bytes) for own, c in zip(ids, chunks, strict=True)]

    def a_ids(self, chunk: str) -> list[int]:
        if not chunk.isascii() and ord(max(chunk)) >= SETTLED:
            return self.a.whole.encode(chunk, add_special_tokens=False).ids
        pieces, words = self.a.split(chunk), self.words
        if len(pieces) == 1:  # a word that is new as a chunk is new as a piece
            return self.a.one(chunk)
        ids: list[int] = []
        for x in pieces:
            if x not in words:
                words[x] = self.a.one(x)
            ids += words[x]
        return ids

    def learn(self, chunks: list[str]) -> None:
        """What new chunks give: n_a, n_b, n_groups, groups, pairs, products; None where the bytes of either side differ from the chunk's."""
        if len(self.words) > CACHE:
            self.words.clear()
        raws = [c.encode("utf-8", "replace") for c in chunks]
        all_a, all_b = [self.a_ids(c) for c in chunks], self.b_ids(chunks)
        sides = ((all_a, self.a_bytes), (all_b, self.b_bytes))
        for k, raw in enumerate(raws):
            if any(ids[k] is None or b"".join([of[i] for i in ids[k]]) != raw for ids, of in sides):
                self.known[chunks[k]] = all_a[k] = all_b[k] = None
        good = [k for k, own in enumerate(all_a) if own is not None]
        if good:
            for k, found in zip(good, self.align([all_a[k] for k in good], [all_b[k] for k in good]), strict=True):
                self.known[chunks[k]] = found

    def named(self, pair: int) -> bytes:
        """A group of one token on either side, as text."""
        found = self.names.get(pair)
        if found is None:
            found = self.names[pair] = b"%d|%d" % divmod(pair, BASE)
        return found

    def align(self, all_a: list[list[int]], all_b: list[list[int]]) -> list[tuple]:
        """Elementary intervals of many chunks laid end to end; the ends of chunks are shared, so no interval or group spans two."""
        a, b = (np.array([i for ids in each for i in ids], np.int64) for each in (all_a, all_b))
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.union1d(a_ends, b_ends)
        a_owner, b_owner = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        pairs = a[a_owner] * BASE + b[b_owner]
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)  # each closes a group
        a_stop, b_stop = np.searchsorted(a_ends, shared) + 1, np.searchsorted(b_ends, shared) + 1
        stop = np.searchsorted(ends, shared) + 1
        single = (np.diff(a_stop, prepend=0) == 1) & (np.diff(b_stop, prepend=0) == 1)
        groups = [self.named(p) if one else None for p, one in zip(pairs[stop - 1].tolist(), single.tolist(), strict=True)]
        for k in np.flatnonzero(~single).tolist():
            left_a, left_b = (int(a_stop[k - 1]), int(b_stop[k - 1])) if k else (0, 0)
            groups[k] = b"%b|%b" % tuple(b",".join([b"%d" % i for i in own.tolist()]) for own in (a[left_a : a_stop[k]], b[left_b : b_stop[k]]))
        products = np.diff(a_stop, prepend=0) * np.diff(b_stop, prepend=0)
        # a chunk ends with the group that holds its last token
        last = np.searchsorted(a_stop, np.cumsum([len(x) for x in all_a])) + 1
        out, g, i = [], 0, 0
        for own_a, own_b, h in zip(all_a, all_b, last.tolist(), strict=True):
            j = int(stop[h - 1])
            out.append((len(own_a), len(own_b), h - g, b";".join(groups[g:h]), pairs[i:j].tobytes(), int(products[g:h].sum())))
            g, i = h, j
        return out

    def documents(self, texts: list[str]) -> list[tuple | None]:
        """Per text n_a, n_b, n_groups, groups_sha256, pairs, products; None for a text without tokens."""
        cut = [None if not t or SPACE in t else self.chunks(" " + t) for t in texts]
        if len(self.known) > CACHE:  # what is met again moves on from the old half, the rest of it goes
            self.old, self.known, self.names = self.known, {}, {}
        known, old, new = self.known, self.old, []
        for c in set(chain.from_iterable(chunks for chunks in cut if chunks)):
            if c not in known:
                if c in old:
                    known[c] = old[c]
                else:
                    new.append(c)
        for k in range(0, len(new), 20_000):
            self.learn(new[k : k + 20_000])
        out: list[tuple | None] = []
        for chunks in cut:
            found = [known[c] for c in chunks] if chunks else [None]
            if None in found:
                out.append(None)
                continue
            n_a, n_b, n_groups, groups, pairs, products = zip(*found, strict=True)
            out.append((sum(n_a), sum(n_b), sum(n_groups), hashlib.sha256(b";".join(groups)).hexdigest(), np.frombuffer(b"".join(pairs), np.int64), sum(products)))
        return out


def _without_space(ids: list[int], of: list[bytes]) -> list[int] | None:
    return ids[1:] if ids and of[ids[0]] == b" " else None


def _byte_decoder() -> dict[str, bytes]:
    """The byte each character of a byte-level entry stands for: itself where it is printable, and the others in turn from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): bytes([b]) for b in own} | {chr(256 + k): bytes([b]) for k, b in enumerate(rest)}


@lru_cache(maxsize=1)
def aligner(json_path: str, ranks_path: str, piece_path: str) -> Aligner:
    return Aligner(json_path, ranks_path, piece_path)


def piece_path(name: str = "piece_bpe_32k") -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.model")


_DOCUMENT = "n_a long, n_b long, n_groups long, n_products long, groups_sha256 string"


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paths: tuple[str, str, str] | None = None) -> DataFrame:
    """Rows of two kinds: a document (id_col, counts, digest, its distinct pairs and how often each comes), and, without counts, pairs with the number
    of a task's documents that hold them."""
    paths = paths or (*vocabulary_paths(), piece_path())
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, {_DOCUMENT}, pairs array<long>, times array<long>"

    def run(batches):
        align, pending, size, names = aligner(*paths), [], 0, None

        def summed(kind):
            pairs, n = np.unique(np.concatenate(pending), return_counts=True)
            for k in range(0, len(pairs), 100_000):
                own, times = pairs[k : k + 100_000], n[k : k + 100_000]
                cols = [pa.nulls(1, kind), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), pa.array([own], pa.list_(pa.int64())), pa.array([times], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=names)

        names = ["id", "n_a", "n_b", "n_groups", "n_products", "groups_sha256", "pairs", "times"]
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            texts = batch.column(1).to_pylist()
            for k in range(0, len(texts), 500):
                found = align.documents(texts[k : k + 500])
                each = [np.unique(f[4], return_counts=True) if f else (np.zeros(0, np.int64),) * 2 for f in found]
                starts = pa.array(np.cumsum([0, *(len(p) for p, _ in each)]), pa.int32())
                lists = [pa.ListArray.from_arrays(starts, pa.array(np.concatenate([e[x] for e in each]).astype(np.int64))) for x in (0, 1)]
                counts = [pa.array([f[x] if f else 0 for f in found], pa.int64()) for x in (0, 1, 2, 5)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 500), *counts, pa.array([f[3] if f else "" for f in found]), *lists], names=names)
                pending += [p for p, _ in each if len(p)]
                size += sum(len(p) for p, _ in each)
                if size >= PENDING:
                    yield from summed(kind)
                    pending, size = [], 0
        if pending:
            yield from summed(kind)

    return docs.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, schema)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paths: tuple[str, str, str] | None = None, top: int | None = None) -> DataFrame:
    """id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_products (pairs of all groups, expanded).

    A link is an overlap of two token occurrences; its count is the number of documents that hold its id pair linked, and it is a best one if
    no other pair of its A id has a larger count. A text that is null or empty, holds U+2581, or does not come back from
    either tokenizer byte by byte has zeros and an empty digest. Repeated rows count, and come back, as often as they come; a null
    id stays null; an empty table gives no rows; a very long text is one row of its task. Other columns are not
    read, whatever their names."""
    top = TOP if top is None else top
    rows = stage(tokenized(docs, id_col, text_col, paths), "alignment")
    parts = rows.where("n_a IS NULL").select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.times").alias("n"))
    counts = stage(parts.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-counts").withColumn("a", F.floor(F.col("pair") / BASE))
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = stage(counts.join(best, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-best")
    known = sorted((r["pair"], r["n"], r["best"]) for r in counts.orderBy(F.desc("n"), "pair").limit(top).collect())  # at most ``top`` rows of fixed size
    pair, n, is_best = (np.array([k[x] for k in known], kind) for x, kind in ((0, np.int64), (1, np.int64), (2, bool)))
    sent = docs.sparkSession.sparkContext.broadcast((pair, n, is_best))
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(batches):
        pair, n, is_best = sent.value
        for batch in batches:
            at = [batch.column(k) for k in (6, 7)]
            size = np.diff(at[0].offsets.to_numpy())
            own, times = (c.flatten().to_numpy(zero_copy_only=False) for c in at)
            place = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
            hit = pair[place] == own if len(pair) else np.zeros(len(own), bool)
            row = np.repeat(np.arange(len(size)), size)

            def total(x):
                return pa.array(np.bincount(row, x, len(size)).astype(np.int64))

            good, number = np.where(hit, is_best[place], False) if len(pair) else hit, np.where(hit, n[place], 0) if len(pair) else np.zeros(len(own))
            starts = pa.array(np.append(0, np.cumsum(np.bincount(row[~hit], minlength=len(size)))), pa.int32())
            rest = [pa.ListArray.from_arrays(starts, pa.array(x[~hit])) for x in (own, times)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], total(times), total(times * good), total(times * number), *rest], names=[*names, "n_links", "n_best", "count_sum", "pairs", "times"])

    names = ["id", "n_a", "n_b", "n_groups", "n_products", "groups_sha256"]
    done = rows.where("n_a IS NOT NULL").mapInArrow(finish, f"id {kind}, {_DOCUMENT}, n_links long, n_best long, count_sum long, pairs array<long>, times array<long>")
    result = [F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_products"]
    if len(known) < top:  # all pairs were sent
        return done.select(*result)
    done = stage(done.withColumn("row", F.monotonically_increasing_id()), "alignment-done")
    open_pairs = done.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    rest = open_pairs.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more"))
    whole = done.join(rest, "row", "left")
    whole = whole.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0)))
    return whole.select(*result)
