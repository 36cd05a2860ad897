"""Allow and block rules over urls, by a sort-merge range join.

A host's canonical key is its labels reversed, each followed by a dot: ``blog.example.net`` becomes
``net.example.blog.``. The keys of a host and its subdomains are then those with one prefix, an interval
of the byte order. Rules and urls sorted by key are swept once; a stack holds the nested rules whose
interval is open, each with its path.

Rules whose keys and paths take at most ``broadcast_bytes`` go to every task, which sorts and sweeps the
urls it reads: no shuffle, and a frequent host or url does not gather anywhere. Larger rule sets are
dealt to key ranges together with the urls; a key that fills several ranges is spread over all of them.
"""

from __future__ import annotations

import bisect
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import n_partitions

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BROADCAST_BYTES = 16 << 20


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _best(stack, path: str):
    """The longest open rule whose path the url's starts with; of equal lengths the one with the longer host. Of a host's rules it is that with
    the longest path, looked up by each length its paths have."""
    best = None
    for _, rules, lengths in stack:  # hosts get longer
        for n in lengths:
            rule = rules.get(path[:n]) if n <= len(path) else None
            if rule:
                if best is None or len(rule[0]) + n >= len(best[0]) + len(best[1]):
                    best = rule
                break
    return best


def _open(stack, key: bytes) -> None:
    while stack and not key.startswith(stack[-1][0]):
        stack.pop()


def _push(stack, key: bytes, rule) -> None:
    """Add a rule (host, path, action) to its host's; of two with one path a block holds."""
    if not stack or stack[-1][0] != key:
        stack.append((key, {}, []))
    _, rules, lengths = stack[-1]
    path = rule[1]
    if path not in rules or rule[2] == "block":
        rules[path] = rule
    if len(path) not in lengths:
        bisect.insort(lengths, len(path), key=lambda n: -n)


def sweep(keys: list[bytes], paths: list[str], rules: list[tuple[bytes, tuple[str, str, str]]]):
    """The best rule (host, path, action) or None of each url; ``rules`` are sorted by key, urls are sorted here."""
    out, stack, n = [None] * len(keys), [], 0
    for i in sorted(range(len(keys)), key=keys.__getitem__):
        key = keys[i]
        while n < len(rules) and rules[n][0] <= key:
            _open(stack, rules[n][0])
            _push(stack, *rules[n])
            n += 1
        _open(stack, key)
        out[i] = _best(stack, paths[i])
    return out


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """id_col, host, path, rule, verdict for each url; ``rules`` has host, path, action (allow or block).

    A url that is null or has no ``://`` has an empty host and path and no rule. A url without a rule gets
    ``default``. Rules with a null or empty host or a null action fit nothing; a null path counts as empty;
    rule hosts are lower-cased; repeated rules count once. Repeated urls give repeated rows, an empty table an
    empty one. Other columns of either table are not read.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, host string, path string, rule string, verdict string"
    names = [id_col, "host", "path", "rule", "verdict"]
    url = F.col(url_col).cast("string")
    urls = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path")).withColumn("key", F.encode(host_key(F.col("host")), "UTF-8"))
    clean = (
        rules.select(F.translate(F.col("host"), _UPPER, _LOWER).alias("host"), F.coalesce(F.col("path"), F.lit("")).alias("path"), F.col("action"))
        .where("host <> '' AND action IS NOT NULL").distinct().withColumn("key", F.encode(host_key(F.col("host")), "UTF-8"))
    )

    def result(ids, hosts, paths, found):
        return pa.RecordBatch.from_arrays([ids, pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array([r and r[0] + r[1] for r in found], pa.string()), pa.array([r[2] if r else default for r in found], pa.string())], names=names)

    size = clean.agg(F.sum(2 * F.octet_length("key") + F.octet_length("path") + 40)).first()[0] or 0
    if size <= broadcast_bytes:
        table = sorted((bytes(r["key"]), (r["host"], r["path"], r["action"])) for r in clean.collect())

        def local(batches):
            for batch in batches:
                keys, paths = batch.column("key").to_pylist(), batch.column("path").to_pylist()
                yield result(batch.column("id"), batch.column("host").to_pylist(), paths, sweep(keys, paths, table))

        return urls.mapInArrow(local, schema)

    parts = n_partitions(pages.sparkSession)
    share = min(1.0, 32 * parts / max(1, urls.count()))  # about 32 keys a range are drawn for the bounds, at any size, row by row
    drawn = sorted(bytes(r[0]) for r in urls.select("key").sample(False, share, 7).collect())
    bounds = [drawn[len(drawn) * k // parts] for k in range(1, parts)] if drawn else []
    dealt = f"bucket int, id {kind}, host string, path string, key binary, action string"

    def ranges(low: bytes, high: bytes) -> tuple[int, int]:
        return bisect.bisect_left(bounds, low), bisect.bisect_right(bounds, high)

    def deal_urls(batches):
        for batch in batches:
            buckets = []
            for k, (key, path, i) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "path", "id")), strict=True)):
                a, b = ranges(key, key)
                buckets.append(a + zlib.crc32(f"{path}\n{i}\n{k}".encode()) % (b - a + 1))
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), *(batch.column(c) for c in ("id", "host", "path", "key")), pa.nulls(len(buckets), pa.string())], names=["bucket", "id", "host", "path", "key", "action"])

    def deal_rules(batches):
        for batch in batches:
            take, buckets = [], []
            for k, key in enumerate(batch.column("key").to_pylist()):
                a, b = ranges(key, key + b"\xff")
                take += [k] * (b - a + 1)
                buckets += range(a, b + 1)
            own = batch.take(pa.array(take, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), own.column("id"), *(own.column(c) for c in ("host", "path", "key", "action"))], names=["bucket", "id", "host", "path", "key", "action"])

    def swept(batches):
        stack, bucket = [], None
        for batch in batches:
            keep, found = [], []
            columns = [batch.column(c).to_pylist() for c in ("bucket", "key", "host", "path", "action")]
            for k, (own, key, host, path, action) in enumerate(zip(*columns, strict=True)):
                if own != bucket:
                    stack, bucket = [], own
                _open(stack, key)
                if action is not None:
                    _push(stack, key, (host, path, action))
                else:
                    keep.append(k)
                    found.append(_best(stack, path))
            if keep:
                own = batch.take(pa.array(keep))
                yield result(own.column("id"), own.column("host").to_pylist(), own.column("path").to_pylist(), found)

    both = urls.mapInArrow(deal_urls, dealt).union(clean.withColumn("id", F.lit(None).cast(kind)).mapInArrow(deal_rules, dealt))
    return both.repartition(parts, "bucket").sortWithinPartitions("bucket", "key", F.col("action").isNull()).mapInArrow(swept, schema)
