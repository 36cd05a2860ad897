"""Interaction of document filters: what each removes, alone and in every order, by part of the corpus.

Filters A to D look at a document's own words; E fails copies of a document with a smaller id. Copies are found by
sorting: rows are dealt to ranges of (fingerprint, id) and sorted there by (fingerprint, text, id), so a row is a copy if the row before
it has its text. A task streams its range with the first row of one group at hand. Ranges may cut a group of
equal texts: rows of a range's first and last fingerprint carry their text's digest, and the smallest id of each such digest, from two
rows a range and not from the texts, tells which of them are copies after all.

The failures of a document are five bits. Only counters of these leave a part: how many documents have which mask, how many of
them are good or toxic. Every order, step and share follows from at most 32 counters a part.
"""

from __future__ import annotations

import hashlib
import re
from itertools import combinations, permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 200, 50, 2
_SYMBOLS = re.compile(rb"[#$%&*|]").search
_UPPER = bytes(range(65, 91))


def own_mask(raw: bytes, code_points: int) -> int:
    """Failures A to D of one text in UTF-8 as bits 0 to 3. ``bytes.split`` splits at ASCII white space only."""
    words = raw.split()
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return (
        (len(words) < LEAST_WORDS)
        + 2 * (100 * len(set(words)) < LEAST_DISTINCT * len(words))
        + 4 * (100 * upper > MOST_UPPER * code_points)
        + 8 * (_SYMBOLS(raw) is not None)
    )


def _sorted_masks(batches):
    """Rows (id, part, text, fp) sorted by fp, text, id -> id, part, mask and edge. A row of the range's first fingerprint has its text's digest
    as edge unless a smaller id in the range has its text; a row without a mask, at the end, gives the smallest id of each
    text of the last fingerprint. Held: the texts of one fingerprint, which are one but for collisions."""
    first = last = group = group_id = own = None
    closing: list[tuple[bytes, object]] = []
    kind = part = None
    for batch in batches:
        kind, part = batch.column(0).type, batch.column(1).type
        raws = batch.column(2).cast(pa.large_binary() if pa.types.is_large_string(batch.column(2).type) else pa.binary())
        ids, points, fps = batch.column(0).to_pylist(), pc.utf8_length(batch.column(2)).to_pylist(), batch.column(3).to_pylist()
        masks, edges = [], []
        for k, fp in enumerate(fps):
            raw = raws[k].as_py()
            if fp != last:
                closing, last, group = [], fp, None
                first = fp if first is None else first
            if raw != group:
                group, group_id, own = raw, ids[k], own_mask(raw, points[k])
                closing.append((raw, ids[k]))
            copy = ids[k] != group_id
            edges.append(None if copy or fp != first else hashlib.sha256(raw).digest())
            masks.append(own + 16 * copy)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(edges, pa.binary())], names=["id", "part", "mask", "edge"])
    if closing:
        n, digests = len(closing), [hashlib.sha256(raw).digest() for raw, _ in closing]
        yield pa.RecordBatch.from_arrays([pa.array([i for _, i in closing], kind), pa.nulls(n, part), pa.nulls(n, pa.int32()), pa.array(digests, pa.binary())], names=["id", "part", "mask", "edge"])


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """id, part, mask, n: how many rows of ``docs`` with this id and part fail what the mask's bits 0 to 4 say, failures of A to E.

    A null text counts as empty, a null part as the empty string. Repeated rows, equal in id and text, are no copies of each other; a
    null id counts as larger than all others. An empty table gives no rows; very long texts are read whole; other
    columns are not read, whatever their names."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(part_col).alias("part"), text_of(text_col).alias("text"))
    rows = rows.withColumn("fp", F.xxhash64("text")).withColumn("at", F.spark_partition_id())  # the last lets ranges cut rows repeated very often
    by_id = F.col("id").asc_nulls_last()
    ranged = rows.repartitionByRange(F.col("fp"), by_id, F.col("at")).sortWithinPartitions("fp", "text", by_id).drop("at")
    found = stage(ranged.mapInArrow(_sorted_masks, f"id {kind}, part string, mask int, edge binary"), "filter-masks")
    least = found.where("mask IS NULL").groupBy("edge").agg(F.min("id").alias("least"))
    counted = found.where("mask IS NOT NULL").groupBy("id", "part", "mask", "edge").agg(F.count("*").alias("n"))
    # a row of an edge is a copy if a range before ends with a smaller id of its text; a range has one such text but for collisions
    late = F.when(F.coalesce(F.col("least") < F.col("id"), F.col("id").isNull() & F.col("least").isNotNull()), 16).otherwise(0)
    mended = counted.where("edge IS NOT NULL").join(least, "edge", "left").select("id", "part", F.col("mask").bitwiseOR(late).alias("mask"), "n")
    return counted.where("edge IS NULL").select("id", "part", "mask", "n").unionByName(mended)


def counters(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """part, mask, n, good, toxic, from ``failures``. A document is good (toxic) if any of its label rows says so."""
    says = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(says("quality").alias("g"), says("toxic").alias("t"))
    each = failed.join(marks, "id", "left")
    return each.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.col("n") * F.col("g")), F.lit(0)).alias("good"), F.coalesce(F.sum(F.col("n") * F.col("t")), F.lit(0)).alias("toxic"))


def interactions(counts: DataFrame) -> DataFrame:
    """part, filter_order, step and the counters of that step, for all orders of the five filters, from ``counters``.

    What a step does depends on its filter and on the set before it: 80 pairs, which a part's counters are summed into at once."""
    pairs = [(f, sum(1 << b for b in before)) for f in range(5) for k in range(5) for before in combinations([b for b in range(5) if b != f], k)]
    options = F.array(*(F.struct(F.lit(f).alias("f"), F.lit(s).alias("before")) for f, s in pairs))
    wide = counts.withColumn("o", F.explode(options)).select("part", "mask", "n", "good", "toxic", "o.*")
    bit = F.expr("shiftleft(1, f)")
    fails, gone = F.col("mask").bitwiseAND(bit) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0))
    # of 120 orders, a filter that fails with k - 1 others stands before all of these in 120 / k
    share = F.when(fails, F.col("n") * (F.lit(120) / F.bit_count("mask")).cast("long")).otherwise(0)
    each = wide.groupBy("part", "f", "before").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"), total(F.col("mask") == bit).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"), total(fails & ~gone, "toxic").alias("toxic_lost"), F.sum(share).alias("shapley"),
    )
    steps = [(int(f), sum(1 << b for b in order[:k]), "".join(FILTERS[b] for b in order), k + 1) for order in permutations(range(5)) for k, f in enumerate(order)]
    table = counts.sparkSession.createDataFrame(steps, "f int, before int, filter_order string, step int")
    return each.join(F.broadcast(table), ["f", "before"]).drop("f", "before").select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The whole report. Without documents it is empty; a document without a label is neither good nor toxic."""
    return interactions(stage(counters(failures(docs), labels), "filter-counters"))

