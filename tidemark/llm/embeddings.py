"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative a group.

Vectors of a label are dealt to the cells of a tree of centroids, of one level or two, about ``CELL`` vectors a cell. The
tree comes from spherical k-means over a bounded sample, at most ``MOST_CENTROIDS`` leaves in all. A vector goes to
the cell of its nearest centroid a, and to each cell c for which its distance to the plane between a and c is at most
half the chord of two vectors at the threshold. That loses no link: for two linked vectors with different cells a and
c, the distances to the plane add up to at most the chord, so that one of the two is also in the other's cell, where the
other is at home. On the second level the same holds among the leaves of a cell. Vectors that lie apart from each other in
many dimensions are near many planes, and in many cells, but only as guests, which are not compared with each other.
A cheap test comes first: components as signed bytes, with a bound on what rounding can change, show which vectors have
a partner at all.

Equal vectors take part once. Cells of any size are compared block by block (see graph).
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph
from .common import stage

THRESHOLD = 0.93
#: Vectors of a cell; children of a centroid; leaves in all; sampled vectors a leaf, and in all; rounds of k-means.
CELL, FAN, MOST_CENTROIDS, PER_LEAF, SAMPLE, ROUNDS = 512, 256, 65_536, 24, 131_072, 10
#: Rows a task compares with centroids at once.
SLICE = 2048


def margin_of(threshold: float) -> float:
    """Half the chord of two unit vectors at the threshold."""
    return math.sqrt(max(0.0, 2 - 2 * threshold)) / 2 + 1e-9


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of unit rows on the unit sphere; a centroid that loses all rows keeps its place."""
    k = min(k, len(x))
    centre = x[np.random.default_rng(19).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        home = (x @ centre.T).argmax(1)
        sums = np.zeros_like(centre)
        np.add.at(sums, home, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centre)
    return centre


def grow(x: np.ndarray, leaves: int) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """Centroids of the first level, and of the second for each of them (None: it is a leaf)."""
    if leaves <= FAN:
        top = kmeans(x, leaves)
        return top, [None] * len(top)
    top = kmeans(x, max(2, round(math.sqrt(leaves))))
    home = np.concatenate([(x[at : at + SLICE] @ top.T).argmax(1) for at in range(0, len(x), SLICE)])
    share = np.bincount(home, minlength=len(top)) / len(x) * leaves
    return top, [kmeans(x[home == c], round(n)) if round(n) >= 2 else None for c, n in enumerate(share)]


def cells_of(x: np.ndarray, centre: np.ndarray, margin: float) -> np.ndarray:
    """Which cells each unit row is in."""
    score = x @ centre.T
    home = score.argmax(1)
    apart = np.sqrt(np.maximum(2 - 2 * (centre @ centre.T), 0))[home]
    inside = score[np.arange(len(x)), home][:, None] - score <= margin * apart
    inside[np.arange(len(x)), home] = True
    return inside


def place(x: np.ndarray, tree: tuple[np.ndarray, list[np.ndarray | None]] | None, margin: float) -> list[list[tuple[int, int, bool]]]:
    """The leaves, as (child, grandchild, whether it is at home there), that each unit row is in. At home is a row in the leaf that is nearest in
    any cell it is in: two rows that meet in a cell of the first level are so in each other's leaves, or in one's at home."""
    if tree is None:
        return [[(0, 0, True)]] * len(x)
    out: list[list[tuple[int, int, bool]]] = [[] for _ in x]
    top, below = tree
    for at in range(0, len(x), SLICE):
        part = x[at : at + SLICE]
        inside, nearest = cells_of(part, top, margin), (part @ top.T).argmax(1)
        for c, leaves in enumerate(below):
            rows = np.flatnonzero(inside[:, c])
            if leaves is None:
                for r in rows.tolist():
                    out[at + r].append((c, 0, bool(nearest[r] == c)))
            elif len(rows):
                own = (part[rows] @ leaves.T).argmax(1)
                for r, g in np.argwhere(cells_of(part[rows], leaves, margin)).tolist():
                    out[at + int(rows[r])].append((c, g, bool(own[r] == g)))
    return out


def similar_rows(threshold: float):
    def similar(a: list[bytes], b: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(a), np.float64).reshape(len(a), -1) @ np.frombuffer(b"".join(b), np.float64).reshape(len(b), -1).T >= threshold

    return similar


def rounded(x: np.ndarray) -> list[bytes]:
    """Rows as signed bytes, in units of their largest component; the unit and the length of what rounding took away come first."""
    unit = np.abs(x).max(1) / 127
    whole = np.rint(x / unit[:, None])
    lost = np.linalg.norm(x - whole * unit[:, None], axis=1)
    return [np.array(head, np.float32).tobytes() + row.tobytes() for head, row in zip(zip(unit, lost, strict=True), whole.astype(np.int8), strict=True)]


def similar_rounded(threshold: float):
    """Pairs that can reach the threshold: for unit rows x = p + e and y = q + f, x.y is at most p.q + |e| + |f| (as |x| = |y| = 1, and the
    product of the errors is taken in with a margin)."""

    def similar(a: list[bytes], b: list[bytes]) -> np.ndarray:
        def side(rows):
            raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
            head = np.ascontiguousarray(raw[:, :8]).view(np.float32).astype(np.float64)
            return raw[:, 8:].view(np.int8) * head[:, :1].astype(np.float32), head[:, 1]

        (p, e), (q, f) = side(a), side(b)
        return (p @ q.T).astype(np.float64) + e[:, None] + f[None, :] + e[:, None] * f[None, :] + 1e-4 >= threshold

    return similar


def learn_trees(classes: DataFrame, reps: DataFrame) -> dict[tuple[str, int], tuple]:
    """Trees by label and length. ``classes`` has g (label, d) for each distinct vector, ``reps`` also v; labels of fewer than four
    vectors are one cell, and so are labels beyond the MOST_CENTROIDS largest."""
    sizes = classes.groupBy("g").count().where("count >= 4").orderBy(F.desc("count"), "g").limit(MOST_CENTROIDS).collect()
    scale = min(1.0, MOST_CENTROIDS / max(1, sum(max(2, -(-r["count"] // CELL)) for r in sizes)))
    wanted = {(r["g"]["label"], r["g"]["d"]): max(2, math.ceil(scale * r["count"] / CELL)) for r in sizes}
    if not wanted:
        return {}
    total = sum(r["count"] for r in sizes)
    part = min(1.0, min(SAMPLE, PER_LEAF * sum(wanted.values()) + 4096) / total)
    drawn = reps.where(F.pmod(F.xxhash64("node"), F.lit(1_000_003)) < math.ceil(part * 1_000_003)).select("label", "d", "v").collect()  # about SAMPLE rows
    by: dict[tuple[str, int], list] = {}
    for r in drawn:
        by.setdefault((r["label"], r["d"]), []).append(r["v"])
    trees = {}
    for key, k in wanted.items():
        x = np.array(by.get(key, []))
        if len(x) >= 4:
            x = x / np.abs(x).max(1, keepdims=True)
            trees[key] = grow(x / np.linalg.norm(x, axis=1, keepdims=True), min(k, len(x) // 2))
    return trees


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id (named like ``id_col``), n_links, component_id, kept for each row.

    Rows are compared where labels are equal and vectors equally long. A null label, and a vector that is null, empty,
    zero or holds a null or non-finite component, links with nothing; so does a row with a null id, whose component
    is null and which is kept. Equal vectors link with each other. An id that is repeated with different vectors
    has a component for each. An empty table gives an empty one; other columns are not read.
    """
    label = F.col(label_col) if label_col else F.lit(0)
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = F.expr("coalesce(id IS NOT NULL AND label IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0), false)")
    base = stage(plain.withColumn("sound", sound).withColumn("h1", F.xxhash64("label", "v")).withColumn("h2", F.xxhash64(F.lit(1), "v", "label")).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    real = base.where("sound")
    classes = stage(real.groupBy("h1", "h2").agg(F.min("rid").alias("node"), F.count("*").alias("weight"), F.min("id").alias("least"), F.min(F.struct(F.col("label"), F.size("v").alias("d"))).alias("g")), "vector-classes")
    reps = classes.join(real.select(F.col("rid").alias("node"), "v"), "node").select("node", "weight", "g.label", "g.d", "v")
    sent = vectors.sparkSession.sparkContext.broadcast(learn_trees(classes, reps))
    margin = margin_of(threshold)

    def name(label: str, d: int, leaf: tuple) -> int:
        raw = f"{label}\n{d}\n{leaf[0]}\n{leaf[1]}".encode()
        return struct.unpack("<q", struct.pack("<II", zlib.crc32(raw), zlib.crc32(raw, 7)))[0]

    def run(batches):
        for batch in batches:
            labels, sizes = batch.column("label").to_pylist(), batch.column("d").to_pylist()
            groups: dict = {}
            for i, key in enumerate(zip(labels, sizes, strict=True)):
                groups.setdefault(key, []).append(i)
            cells, homes, data, short, known = [[]] * len(labels), [[]] * len(labels), [b""] * len(labels), [b""] * len(labels), {}
            for key, rows in groups.items():
                x = np.array(batch.column("v").take(pa.array(rows)).flatten()).reshape(len(rows), -1)
                x = x / np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for i, row, leaves, less in zip(rows, x, place(x, sent.value.get(key), margin), rounded(x), strict=True):
                    cells[i] = [known[key, leaf[:2]] if (key, leaf[:2]) in known else known.setdefault((key, leaf[:2]), name(*key, leaf)) for leaf in leaves]
                    homes[i] = [leaf[2] for leaf in leaves]
                    data[i], short[i] = row.tobytes(), less
            arrays = [batch.column("node"), batch.column("weight"), pa.array(cells, pa.list_(pa.int64())), pa.array(homes, pa.list_(pa.bool_())), pa.array(data, pa.binary()), pa.array(short, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "weight", "cells", "homes", "data", "short"])

    placed = stage(reps.mapInArrow(run, "node long, weight long, cells array<long>, homes array<boolean>, data binary, short binary"), "placed")
    members = placed.select(F.explode(F.arrays_zip("cells", "homes")).alias("c"), "node", "weight", F.expr("octet_length(data) DIV 8").alias("items"))
    members = members.select(F.col("c.cells").alias("cell"), "node", "weight", "items", F.col("c.homes").alias("home"))
    members = stage(graph.plausible(members, placed.select("node", F.col("short").alias("data")), similar_rounded(threshold)), "vector-plausible")
    found = stage(graph.compare(members, placed.select("node", "data"), similar_rows(threshold)), "vector-links")
    reach = graph.components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(reach, "node", "left")
    known = known.select("h1", "h2", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    known = stage(known.join(known.groupBy("root").agg(F.min("least").alias("component_id")), "root").drop("root"), "vector-known")
    rows = base.select("id", "h1", "h2", "sound").join(known, ["h1", "h2"], "left")
    own = lambda a, b: F.when(F.col("sound"), a).otherwise(b)
    out = rows.select(F.col("id").alias(id_col), own(F.col("n_links"), F.lit(0)).alias("n_links"), own(F.col("component_id"), F.col("id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
