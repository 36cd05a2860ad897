"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

A document's key is exponential, scaled by its quality weight: -ln(u) / weight, u from a hash of its id
and text. Within a source the documents with the smallest keys come first; a prefix sum of their sizes
meets the source's budget. Complete epochs precede this selection, and the document at which the budget
ends gives only its first words, so that a source meets its target to the word.

A source may hold most rows, so its documents are never sorted in one task. Keys fall into buckets by their
logarithm: whatever the weights, a bucket of width 1/r holds less than 0.37/r of a source's distinct keys. Sums per
bucket give each bucket's place in the prefix sum. The bucket in which the budget ends is summed again by key, id
and input partition, which parts even rows that are equal in both, and only rows equal in all three are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WS, stage

#: Weights of the sources in code-point order, repeating; most epochs of a source.
WEIGHTS, MOST = (5.0, 2.0, 1.0), 3
_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#$%&*+<=>@[\\]^_{|}~!"
#: Sources whose edges go to all tasks, some 80 bytes each; more are joined by a shuffle.
MOST_SOURCES = 100_000
#: Before every bucket: of a source without a budget nothing is taken beyond its epochs.
NO_EDGE = -(1 << 40)
#: Buckets a unit of the keys' logarithm, at least, and rows that the bucket in which a budget ends may hold.
BUCKETS, BUCKET_ROWS = 64, 100_000


def word_count(text: Column) -> Column:
    """Words, runs of characters other than ASCII white space; a null text has none."""
    return F.length(F.regexp_replace(F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE)), f"[^{WS}]++[{WS}]*+", "x")).cast("long")


def text_quality(text: Column) -> Column:
    """A weight in (0, 1] that falls with the share of symbols in a text; 1 for an empty one."""
    text = F.coalesce(text, F.lit(""))
    n = F.length(text)
    return 1 / (1 + 10 * (n - F.length(F.translate(text, _SYMBOLS, ""))) / F.greatest(n, F.lit(1)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST, quality: Column | None = None, keep: list[str] | None = None, buckets: int = BUCKETS, seed: int = 7) -> DataFrame:
    """Columns: row (a struct of the columns in ``keep``, by default all), size, source_size, target, epochs, taken.

    taken = epochs * size, plus size or a part of it for selected documents. Sources rank by code point, null
    last, and share the corpus's words by weight; a target stops at ``most`` times its source's size and the
    excess is shared anew, which is the level L at which the sum of min(most * size, L * weight) is all words.
    Null texts have size 0 and are never selected; a null or non-positive quality counts as 1e-6. Equal keys
    are ordered by the id, nulls first; rows equal in id and text are interchangeable. An empty table gives an
    empty one. Columns that clash with those named here are safe inside ``row``.
    """
    text = F.col(text_col).cast("string")
    weight = F.greatest(F.coalesce(quality if quality is not None else text_quality(text), F.lit(0.0)), F.lit(1e-6))
    mark = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.coalesce(text, F.lit("")))
    u = (F.shiftrightunsigned(mark, 11) + 0.5) / float(1 << 53)
    base = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(source_col).alias("source"), F.col(id_col).cast("string").alias("id"), word_count(text).alias("size"), (-F.log(u) / weight).alias("key"))
    base = stage(base.withColumn("rid", F.monotonically_increasing_id()), "mix")
    fine = max(buckets, int(0.37 * base.count() / BUCKET_ROWS) + 1)
    base = base.withColumn("bucket", F.floor(F.log(F.greatest("key", F.lit(1e-300))) * fine))

    cells = base.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    ranked = cells.groupBy("source").agg(F.sum("words").alias("source_size")).withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1)).withColumn("most", F.col("source_size") * float(most))
    filling = Window.orderBy(F.col("most") / F.col("w"), "rank")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.sum("source_size").over(everything) - before) / F.sum("w").over(filling.rowsBetween(0, Window.unboundedFollowing))
    levelled = ranked.withColumn("level", level).withColumn("level", F.min(F.when(F.col("level") <= F.col("most") / F.col("w"), F.struct((F.col("most") / F.col("w")).alias("r"), "rank", "level"))).over(everything)["level"])
    target = F.least(F.col("most"), F.col("level") * F.col("w"))
    targets = levelled.withColumn("target", target).withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    targets = targets.select("source", "source_size", "target", "epochs", (F.round("target").cast("long") - F.col("epochs") * F.col("source_size")).alias("budget"))

    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("above", F.coalesce(F.sum("words").over(along), F.lit(0))).alias("c").join(targets.alias("t"), F.expr("c.source <=> t.source"))
    at_edge = F.expr("budget > 0 AND above < budget AND above + words >= budget")
    edges = placed.groupBy("t.source", "source_size", "target", "epochs", "budget").agg(F.coalesce(F.min(F.when(at_edge, F.col("bucket"))), F.lit(NO_EDGE)).alias("edge"), F.coalesce(F.min(F.when(at_edge, F.col("above"))), F.lit(0)).alias("above"))
    edges = stage(edges.withColumnRenamed("source", "own"), "mix-edges")  # a row a source
    few = edges.count() <= MOST_SOURCES

    joined = base.join(F.broadcast(edges) if few else edges, F.expr("source <=> own")).drop("own")
    cell = ["source", "key", "id", F.shiftright("rid", 33).alias("part")]  # a row of equal key and id, and the partition it was written by
    sums = joined.where("bucket = edge").groupBy(*cell).agg(F.sum("size").alias("words"))
    sums = sums.select(*(F.col(c).alias(f"c_{c}") for c in ("source", "key", "id", "part")), F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("key", "id", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("gone"))
    inner = joined.where("bucket = edge").withColumn("part", F.shiftright("rid", 33)).join(sums, F.expr("key = c_key AND part = c_part AND id <=> c_id AND source <=> c_source"))
    inner = inner.withColumn("gone", F.col("gone") + F.coalesce(F.sum("size").over(Window.partitionBy("source", "key", "id", "part").orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = inner.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("above") - F.col("gone")))).select(*joined.columns, "extra")
    outer = joined.where("bucket <> edge").withColumn("extra", F.expr("CASE WHEN bucket < edge THEN size ELSE 0L END"))
    return outer.unionByName(inner).select("row", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"))


def materialise(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents of a mix as often as it takes them: whole copies, then the first words of one taken in part.
    Documents without words come once an epoch. Returns the columns of ``row``; n_chars follows a shortened text."""
    names = mixed.schema["row"].dataType.names
    copies = F.expr("CASE WHEN size > 0 THEN taken DIV size ELSE epochs END")
    part = F.expr("CASE WHEN size > 0 THEN taken % size ELSE 0L END")
    each = mixed.withColumn("copies", copies).withColumn("part", part).withColumn("words", F.explode(F.expr("concat(array_repeat(-1L, cast(copies AS int)), CASE WHEN part > 0 THEN array(part) ELSE array() END)")))
    short = F.expr(f"regexp_extract(row.`{text_col}`, concat('^(?:[{WS}]*+[^{WS}]++){{', words, '}}+'), 0)".replace("\\", "\\\\"))
    text = F.when(F.col("words") < 0, F.col("row")[text_col]).otherwise(short)
    made = each.select("row", text.alias("text"))
    own = {text_col: F.col("text"), "n_chars": F.length("text").cast("long")}
    return made.select(*(own[n].alias(n) if n in own else F.col("row")[n].alias(n) for n in names))
