"""Jaccard join of documents on word shingles, by chosen paths.

A document is the set of 64-bit hashes of its five-word shingles. In each run a document chooses, at every level,
the tokens of its set whose hash of that run and level lies below ``CHOICE / (threshold * size)``: two
sets of similarity at least the threshold share ``CHOICE`` chosen tokens on average. A path of chosen
tokens names a bucket. Buckets of more than ``LIMIT`` sets are split by the tokens of the next level; others are
compared by brute force, as are those of the last level, whatever their size. Runs are repeated until a pair at
the threshold that is split at all levels is missed with a probability below ``MISS``; one that is not split,
with one below 1e-9.

Sets equal to each other are one class and take part once. The sets of a bucket meet in the cell of
the bucket's smallest class, which makes the many buckets of a group of copies a few cells. Most sets
that meet share a passage only. So short sketches are compared first: the least values of the set under
``SKETCH`` hash functions, a byte of each. Links agree in 80 % of them on average; a pair that agrees in fewer than
half, or whose sizes forbid the similarity, is put aside (a link at the threshold with a probability of 1e-8). For the few
sets that remain, the texts are read again and whole sets are sent, by which all pairs of a cell are verified with exact
intersection sizes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph
from .common import release, stage, text_of
from .lm import words_of

WORDS, THRESHOLD = 5, 0.8
CHOICE, LEVELS, LIMIT, MISS, SKETCH = 1.6, 3, 4096, 5e-5, 64


def runs_needed(choice: float = CHOICE, levels: int = LEVELS, miss: float = MISS) -> int:
    """Runs after which a pair at the threshold, split at all levels, is missed with a probability below ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (1 - math.exp(-choice)) ** levels))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted sets of 64-bit shingle hashes, one after the other, and their sizes. A text of fewer than ``width`` words
    is one shingle of all its words; one without words is the empty set."""
    words = [words_of(t) for t in texts]
    n = np.array([len(w) for w in words])
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter((digest(w) for doc in words for w in doc), np.uint64, int(n.sum()))
    sums = np.zeros(max(len(h) - width + 1, 0), np.uint64)
    for k in range(width if len(sums) else 0):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(sums)]
    ends = np.cumsum(n)
    doc = np.repeat(np.arange(len(texts)), n)[: len(sums)]
    inside = np.arange(len(sums)) + width <= ends[doc]
    token, doc = _mix(sums[inside]), doc[inside]
    short = np.flatnonzero((n > 0) & (n < width))
    own = np.array([digest(b" ".join(words[i])) for i in short.tolist()], np.uint64)
    token, doc = np.concatenate((token, own)), np.concatenate((doc, short)).astype(np.uint16)
    order = np.argsort(token)
    order = order[np.argsort(doc[order], kind="stable")]  # by document, then token
    token, doc = token[order], doc[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
    return token[fresh], np.bincount(doc[fresh], minlength=len(texts))


def packed(tokens: np.ndarray) -> bytes:
    """Sorted tokens as differences, byte planes apart: the highest plane is nearly all zeros and compresses away."""
    return np.diff(tokens, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T)
    return np.cumsum(planes.view(np.uint64).ravel(), dtype=np.uint64)


def _list(doc: np.ndarray, n: int, values: np.ndarray) -> pa.Array:
    order = np.argsort(doc, kind="stable")
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))), pa.int32()), pa.array(values[order]))


def _lists(doc: np.ndarray, n: int, *fields: tuple[str, np.ndarray]) -> pa.Array:
    """List of structs for each of ``n`` documents, from flat arrays."""
    order = np.argsort(doc, kind="stable")
    offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n))))
    values = pa.StructArray.from_arrays([pa.array(x[order]) for _, x in fields], [name for name, _ in fields])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _hashes(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and addends of ``n`` hash functions of 32-bit values."""
    draw = np.random.default_rng(17)
    return draw.integers(0, 1 << 31, n, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1), draw.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)


def names_of(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each set."""
    ends = np.cumsum(size)
    raw = [flat[e - s : e].tobytes() for e, s in zip(ends.tolist(), size.tolist(), strict=True)]
    return np.array([(xxhash.xxh3_64_intdigest(t), xxhash.xxh3_64_intdigest(t, 1)) for t in raw], np.uint64).reshape(-1, 2).view(np.int64)


def sketches(high: np.ndarray, size: np.ndarray, factors: np.ndarray, addends: np.ndarray) -> list[bytes]:
    """The size of each set, and a byte of the least value of each hash function; of an empty set the size alone."""
    full = np.flatnonzero(size)
    starts = (np.cumsum(size) - size)[full]
    out = [np.uint32(0).tobytes()] * len(size)
    if len(full):
        least = np.stack([np.minimum.reduceat(high * a + b, starts) for a, b in zip(factors, addends, strict=True)], 1).astype(np.uint8)
        for i, row in zip(full.tolist(), least, strict=True):
            out[i] = np.uint32(size[i]).tobytes() + row.tobytes()
    return out


#: Documents that a task shingles at once, and rows that it passes to its worker at once.
SLICE, BATCH = 256, 1024
_SETS = "doc_id long, x long, size long, h1 long, h2 long, sketch binary, p array<long>" + "".join(f", t{k} array<struct<r: int, t: int>>" for k in range(2, LEVELS + 1))


def sets(docs: DataFrame, id_col: str, text_col: str, threshold: float, runs: int, carry: list[str]) -> DataFrame:
    """Per row a hash x of its text, the size and two hashes of its set, its sketch, first buckets (the run in the six lowest bits), and
    the tokens chosen at the further levels."""
    factors, addends = _hashes(runs * LEVELS + SKETCH)
    odd, shift = factors[SKETCH:].reshape(runs, LEVELS), addends[SKETCH:].reshape(runs, LEVELS)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                flat, size = shingle_sets(batch.column(2).to_pylist())
                high, n = (flat >> np.uint64(32)).astype(np.uint32), len(size)
                doc = np.repeat(np.arange(n), size)
                limit = np.minimum(CHOICE / threshold / np.maximum(size, 1) * 2.0**32, 2.0**32 - 1).astype(np.uint32)[doc]
                levels = []
                for level in range(LEVELS):
                    picked = [np.flatnonzero(high * odd[r, level] + shift[r, level] <= limit) for r in range(runs)]
                    levels.append((np.concatenate(picked), np.repeat(np.arange(runs, dtype=np.int32), [len(x) for x in picked])))
                where, r = levels[0]
                name = _mix(flat[where] ^ (r.astype(np.uint64) << np.uint64(48)))
                bucket = (name & ~np.uint64(63) | r.astype(np.uint64)).view(np.int64)
                h = names_of(flat, size)
                columns = [batch.column(0), batch.column(1), pa.array(size.astype(np.int64)), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(sketches(high, size, factors[:SKETCH], addends[:SKETCH]), pa.binary()), _list(doc[where], n, bucket)]
                columns += [_lists(doc[w], n, ("r", r), ("t", high[w].view(np.int32))) for w, r in levels[1:]]
                yield pa.RecordBatch.from_arrays(columns + batch.columns[3:], names=[*names, *carry])

    own = docs.select(*carry)
    names = ["doc_id", "x", "size", "h1", "h2", "sketch", "p", *(f"t{k}" for k in range(2, LEVELS + 1))]
    schema = ", ".join([_SETS, *(f"{f.name} {f.dataType.simpleString()}" for f in own.schema)])
    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("x"), text.alias("text"), *carry).mapInArrow(run, schema)


def whole_sets(docs: DataFrame, text_col: str, members: DataFrame) -> DataFrame:
    """x, h1, data: the whole sets of the texts that ``members`` (x, h1) name, one row each; some others may come as well. The texts are read
    again and each is shingled once a task, so that copies are not sent."""

    def run(batches):
        seen: set[int] = set()
        for whole in batches:
            x = whole.column(0).to_pylist()
            first = [k for k, v in enumerate(x) if not (v in seen or seen.add(v))]
            for at in range(0, len(first), SLICE):
                batch = whole.take(pa.array(first[at : at + SLICE]))
                flat, size = shingle_sets(batch.column(1).to_pylist())
                ends, h = np.cumsum(size), names_of(flat, size)
                data = [packed(flat[e - s : e]) for e, s in zip(ends.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h[:, 0].copy()), pa.array(data, pa.binary())], names=["x", "h1", "data"])

    text = text_of(text_col)
    rows = graph.only_nodes(docs.select(F.xxhash64(text).alias("x"), text.alias("text")), members, "x")
    return rows.mapInArrow(run, "x long, h1 long, data binary").dropDuplicates(["x", "h1"])


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of two lists of sets; values of one set only are left out first."""
    sets = [*a, *b]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    wide, both = int((count > 1).sum()), np.zeros((len(a), len(b)))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = min(8192, (1 << 24) // max(len(sets), 1) + 1)
    for at in range(0, wide, width):
        lo, hi = np.searchsorted(column, (at, at + width))
        x = np.zeros((len(sets), min(width, wide - at)), np.float32)
        x[row[lo:hi], column[lo:hi] - at] = 1
        both += x[: len(a)] @ x[len(a) :].T
    return both


def similar_sketches(threshold: float):
    """Pairs that can be links: half the hash functions agree, and the sizes allow the similarity."""

    def similar(a: list[bytes], b: list[bytes]) -> np.ndarray:
        def side(rows):
            raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
            return np.ascontiguousarray(raw[:, :4]).view(np.uint32).ravel().astype(float), np.ascontiguousarray(raw[:, 4:].T)

        (n, x), (m, y) = side(a), side(b)
        agree = np.zeros((len(n), len(m)), np.uint8)
        for u, v in zip(x, y, strict=True):
            agree += u[:, None] == v[None, :]
        near = np.minimum(n[:, None], m[None, :]) >= (threshold - 1e-9) * np.maximum(n[:, None], m[None, :])
        return near & (agree >= SKETCH // 2)

    return similar


def similar_sets(threshold: float):
    """Matrix of links between two lists of token sets, by exact intersection sizes."""
    scale = 1_000_000
    least = round(threshold * scale)

    def similar(a: list[bytes], b: list[bytes]) -> np.ndarray:
        x, y = [unpacked(s) for s in a], [unpacked(s) for s in b]
        both = _common(x, y)
        n, m = np.array([len(s) for s in x]), np.array([len(s) for s in y])
        union = n[:, None] + m[None, :] - both
        return both * scale >= least * union

    return similar


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, carry: list[str] = ()) -> DataFrame:
    """doc_id, class_id, n_links, copy_id, kept: for every row its class (the smallest id that links of similarity at
    least ``threshold`` reach, its own included), the number of other rows it links with directly, the smallest id
    of the rows with the same set, and whether it is the one its class keeps (of rows repeated with the class's
    id, one).

    Rows with an equal set link with each other. A null, empty or blank text has no set and links with nothing; it is
    its own class. A null id links with nothing either: its class is null, and it is kept. An id that comes with
    different texts has a class for each. Columns in ``carry`` are passed on; their names may not be among those
    above. Other columns are not read. Long texts are taken whole.
    """
    runs = runs_needed()
    base = stage(sets(docs, id_col, text_col, threshold, runs, list(carry)).withColumn("rid", F.monotonically_increasing_id()), "sets", BATCH)
    real = base.where("size > 0 AND doc_id IS NOT NULL")
    first = F.min(F.struct("rid", "x")).alias("first")
    classes = real.groupBy("h1", "h2").agg(first, F.count("*").alias("weight"), F.min("doc_id").alias("copy_id"), F.min("size").alias("items"))
    classes = stage(classes.select("h1", "h2", F.col("first.rid").alias("node"), F.col("first.x").alias("x"), "weight", "copy_id", "items"), "classes")

    later = [f"t{k}" for k in range(2, LEVELS + 1)]
    # a class is dealt to its buckets once: rows of classes that may have copies are joined with the one that stands for them
    many = graph.bitmap(classes.where("weight > 1"), "h1")
    alone = graph.sieve(real, many, "h1", "left_anti").select("h1", "p")
    chosen = graph.sieve(real, many, "h1").select("rid", "h1", "p").join(classes.select(F.col("node").alias("rid")), "rid", "left_semi").select("h1", "p")
    rows, cells = alone.union(chosen).select("h1", F.explode("p").alias("b")), None
    for level in range(1, LEVELS + 1):
        counts = rows.groupBy("b").agg(F.count("*").alias("n"), F.min("h1").alias("cell"), F.max("h1").alias("last")).where("cell <> last").drop("last")
        # a sort-merge join at every size, which splits a bucket that very many sets choose
        met = stage(rows.hint("merge").join(stage(counts, f"buckets{level}"), "b"), f"met{level}")
        small = (met if level == LEVELS else met.where(F.col("n") <= LIMIT)).select("cell", "h1")
        cells = small if cells is None else cells.union(small)
        if level == LEVELS:
            break
        large = met.where(F.col("n") > LIMIT).distinct()
        if level == 1:  # the tokens of the further levels are fetched for those that need them, once a class
            needed = stage(classes.join(large.select("h1").distinct(), "h1").select("h1", "node"), "needed")
            further = needed.join(graph.only_nodes(base.select(F.col("rid").alias("node"), *later), needed), "node").drop("node")
            own = F.array(*(F.expr(f"transform(filter({t}, x -> x.r = (b & 63)), x -> x.t)") for t in later))
            large = large.join(further, "h1").select("h1", "b", own.alias("next"))
        rows = stage(large.select("h1", F.expr("explode(transform(next[0], t -> xxhash64(b, t)))").alias("b"), F.expr("slice(next, 2, size(next))").alias("next")), f"paths{level}")

    members = cells.repartition("h1").distinct().join(classes.select("h1", "x", "node", "weight", "items"), "h1")
    members = stage(members.select("cell", "node", "weight", "items", F.lit(True).alias("home"), "x", "h1"), "members")
    short = graph.only_nodes(base.select(F.col("rid").alias("node"), F.col("sketch").alias("data")), members)
    members = stage(graph.plausible(members, short, similar_sketches(threshold)), "plausible")
    base, whole = stage(base.select("doc_id", "rid", "h1", "h2", "size", *carry), "rows"), base
    release(whole)
    found = stage(graph.compare(members, whole_sets(docs, text_col, members), similar_sets(threshold), ["x", "h1"]), "links", BATCH)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reach = graph.components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.join(links, "node", "left").join(reach, "node", "left").select("h1", "h2", "copy_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"), "node")
    named = known.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    known = stage(known.join(named, "root"), "known")
    # the row a class keeps: the first of those that bear its id
    rows = base.select("doc_id", "rid", "h1", "h2", *carry, (F.col("size") > 0).alias("real")).join(known, ["h1", "h2"], "left")
    rows = rows.withColumn("real", F.col("real") & F.col("doc_id").isNotNull())
    first = stage(rows.where(F.col("real") & (F.col("doc_id") == F.col("class_id"))).groupBy("root").agg(F.min("rid").alias("first")), "first")
    rows = rows.join(first, "root", "left")
    own = lambda a, b: F.when(F.col("real"), a).otherwise(b)
    return rows.select("doc_id", own(F.col("class_id"), F.col("doc_id")).alias("class_id"), own(F.col("n_links"), F.lit(0)).alias("n_links"), own(F.col("copy_id"), F.col("doc_id")).alias("copy_id"), own(F.col("rid") == F.col("first"), F.lit(True)).alias("kept"), *carry)
