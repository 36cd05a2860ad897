"""Links between nodes that share cells, found in blocks, and the components they form.

``compare`` takes nodes dealt to cells, a node to one or more, as a resident (``home``) or as a guest; two guests are not
compared. A cell is cut into blocks of residents and blocks of guests, and each pair of blocks is a task of its own, so
that a cell of any size spreads over the cluster and a task holds two blocks.
A pair of nodes that is compared in several cells counts in the first of them. A task returns, for each of its
nodes, a number of links and the root of its component there; pairs never become rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import n_partitions, stage

#: Nodes of a block: a tenth of the cell's, within these, and no more than hold so many payload items. A node is sent
#: once for each block of its cell.
LEAST, MOST, ITEMS = 512, 2048, 2_000_000


#: Bits of the filter that keeps rows of no member from being shuffled.
FILTER_BITS = 1 << 21


def bitmap(members: DataFrame, column: str = "node") -> DataFrame:
    """filter_word, filter_bits: the words of a bitmap of fixed size, hashed from the members' values of ``column``; words of zeros do not come."""
    words = members.select(_place(column).alias("h")).groupBy(F.shiftright("h", 6).alias("filter_word"))
    return stage(words.agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 AS int))")).alias("filter_bits")), "bitmap")


def sieve(rows: DataFrame, words: DataFrame, column: str = "node", kind: str = "left_semi") -> DataFrame:
    """``rows`` whose ``column`` may be among the values of a ``bitmap``, which goes to all tasks; with left_anti, those whose is not. It takes
    some others for members, more as it fills, and never misses one. No Python worker is started for it."""
    here = F.expr(f"shiftright(filter_bits, cast(pmod(xxhash64(`{column}`), {FILTER_BITS}) & 63 AS int)) & 1 = 1")
    return rows.join(F.broadcast(words), (F.shiftright(_place(column), 6) == F.col("filter_word")) & here, kind)


def _place(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def only_nodes(rows: DataFrame, members: DataFrame, column: str = "node") -> DataFrame:
    """``rows`` without most of those whose ``column`` is in no row of ``members`` (see sieve); a join must follow."""
    return sieve(rows, bitmap(members, column), column)


def groups(batches, keys: int):
    """Record batches sorted by their first ``keys`` columns, as one table for each value of these."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)])
        cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            own = tuple(marks[:, a].tolist())
            if own != last and held:
                yield last, pa.Table.from_batches(held).combine_chunks()
                held = []
            last = own
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held).combine_chunks()


def _met(c_a: list, h_a: list, c_b: list, h_b: list, cell: int) -> np.ndarray | None:
    """Which pairs are compared in an earlier cell as well: they share one where either is a resident. c_, h_: the cells a node is in, and
    those it is a resident of. None if no pair does."""
    early = lambda lists: [[x for x in own if x < cell] for own in lists]
    c_a, h_a, c_b, h_b = map(early, (c_a, h_a, c_b, h_b))
    flat = lambda lists: {x for own in lists for x in own}
    common = (flat(h_a) & flat(c_b)) | (flat(c_a) & flat(h_b))
    if not common:
        return None
    at = {c: i for i, c in enumerate(common)}

    def rows(lists):
        out = np.zeros((len(lists), len(at)), np.float32)
        for i, own in enumerate(lists):
            out[i, [at[c] for c in own if c in at]] = 1
        return out

    return rows(h_a) @ rows(c_b).T + rows(c_a) @ rows(h_b).T > 0


def roots(linked: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The smallest node of each row's component under a symmetric matrix of links."""
    label = nodes.copy()
    far = np.iinfo(np.int64).max
    while True:
        least = [np.where(rows, label, far).min(1) for rows in np.array_split(linked, len(nodes) // 512 + 1)]
        new = np.minimum(label, np.concatenate(least))
        if (new == label).all():
            return label
        label = new


def _blocks(members: DataFrame, payload: DataFrame, with_cells: bool, key: list[str]) -> DataFrame:
    """Rows of the tasks: every node of a cell once for each block its own block is compared with."""
    sizes = members.groupBy("cell").agg(F.count_if("home").alias("n"), F.count_if(~F.col("home")).alias("guests"), F.avg("items").alias("mean"))
    sizes = stage(sizes.where("n > 0 AND n + guests > 1"), "cells")
    block = F.greatest(F.lit(8), F.least(F.greatest(F.lit(LEAST), F.floor(F.col("n") / 10)), F.lit(MOST), F.floor(ITEMS / F.greatest(F.col("mean"), F.lit(1.0)))))
    sizes = sizes.select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"), F.ceil(F.col("guests") / block).cast("int").alias("outer"))
    dealt = members.join(sizes, "cell")
    if with_cells:
        dealt = stage(dealt, "dealt")
        dealt = dealt.join(dealt.groupBy(*key).agg(F.collect_set("cell").alias("cells"), F.collect_set(F.when(F.col("home"), F.col("cell"))).alias("homes")), key)
    else:
        none = F.array().cast("array<long>")
        dealt = dealt.withColumn("cells", none).withColumn("homes", none)
    mark = F.xxhash64("node")
    own = F.when(F.col("home"), F.pmod(mark, F.col("blocks"))).otherwise(F.col("blocks") + F.pmod(mark, F.col("outer"))).cast("int")
    rows = dealt.join(payload, key).withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1 + CASE WHEN home THEN outer ELSE 0 END)")))
    rows = rows.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cells", "homes", "data", *(c for c in members.columns if c != "cell"))
    return rows.repartition(n_partitions(members.sparkSession), "cell", "i", "j").sortWithinPartitions("cell", "i", "j")


def _pairs(batches, similar: Callable):
    """Per task: cell, its nodes in order, the positions of both blocks, their matrix of links, and the task's rows."""
    for (cell, i, j), t in groups(batches, 3):
        order = np.argsort(t["node"].to_numpy(), kind="stable")
        t = t.take(pa.array(order))
        own, data = t["own"].to_numpy(), t["data"].to_pylist()
        a = np.flatnonzero(own == i)
        b = a if i == j else np.flatnonzero(own == j)
        if not len(a) or not len(b) or len(own) < 2:
            continue
        linked = similar([data[k] for k in a], [data[k] for k in b])
        if i == j:
            np.fill_diagonal(linked, False)
        if linked.any():
            yield cell, t, a, b, linked


def plausible(members: DataFrame, sketches: DataFrame, similar: Callable, key: list[str] = ("node",)) -> DataFrame:
    """The rows of ``members`` (cell, node, weight, items, home, ...) that have a partner in their cell by a cheap test on ``sketches`` (node, data).
    The test must hold for all pairs that are links. A sketch counts as 32 items."""

    def run(batches):
        for _, t, a, b, linked in _pairs(batches, similar):
            keep = np.union1d(a[linked.any(1)], b[linked.any(0)])
            yield from t.select(names).take(pa.array(keep)).to_batches()

    names = members.columns
    some = members.withColumn("true_items", F.col("items")).withColumn("items", F.lit(32))
    rows = _blocks(some, sketches, False, list(key)).withColumn("items", F.col("true_items"))
    return rows.mapInArrow(run, members.schema).distinct()


def compare(members: DataFrame, payload: DataFrame, similar: Callable, key: list[str] = ("node",)) -> DataFrame:
    """node, links, root from ``members`` (cell, node, weight, items, home; one row a cell and node) and ``payload`` (node, data binary, of
    about ``items`` items); ``similar(a, b)`` gives the matrix of links of two lists of payloads. links adds the weights
    of the nodes linked. A node may come several times; nodes without links do not come. Payloads may be found by other
    columns of ``members`` that name a node, ``key``."""

    def run(batches):
        for cell, t, a, b, linked in _pairs(batches, similar):
            node, weight, cells, homes = t["node"].to_numpy(), t["weight"].to_numpy(), t["cells"].to_pylist(), t["homes"].to_pylist()
            whole = np.zeros((len(node), len(node)), bool)
            whole[np.ix_(a, b)] = linked
            whole |= whole.T
            met = _met([cells[k] for k in a], [homes[k] for k in a], [cells[k] for k in b], [homes[k] for k in b], cell)
            fresh = np.zeros_like(whole)
            fresh[np.ix_(a, b)] = linked if met is None else linked & ~met
            fresh |= fresh.T
            root, links = roots(whole, node), fresh @ weight
            keep = np.flatnonzero(whole.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(links[keep].astype(np.int64)), pa.array(root[keep])], names=["node", "links", "root"])

    return _blocks(members, payload, True, list(key)).mapInArrow(run, "node long, links long, root long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root (the smallest node that links reach) for all nodes of ``edges`` (a, b) but the roots, by alternating large and small
    stars. Minima are staged before they are joined back, so that a node with very many edges can be split."""

    def mark(e):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    def star(e, both: bool):
        """From each node's edges to the smallest node among it and its neighbours."""
        out = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if both:
            out = out.union(e.select("b", "a"))
        least = stage(out.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        far = out.join(least, "u").where("v > u" if both else "true").select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not both:
            far = far.union(least.select("u", "m"))
        return far.where("a <> b").distinct()

    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = mark(now)
    for _ in range(most_rounds):
        now = stage(star(stage(star(now, True), "edges"), False), "edges")
        new = mark(now)
        if new == seen:
            break
        seen = new
    else:
        raise RuntimeError(f"components not stable after {most_rounds} rounds")
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
