"""Content hashes that do not depend on row order, file layout or writer."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .decimals import canonical_text

#: The order of the fields in a line, the parts of a body that count for its hash, and the fields of the stored
#: pages' indexes, named by what they hash.
PRICES = ("open", "high", "low", "close", "volume", "turnover")
ENVELOPE = ("retCode", "retMsg", "result")
INDEXES = {
    "logical": ("page_start_ms", "page_end_ms", "endpoint", "params_json", "raw_sha256", "payload_sha256", "raw_bytes", "raw_rows"),
    "payload": ("page_start_ms", "page_end_ms", "endpoint", "params_json", "payload_sha256", "raw_rows"),
    "aux": ("request_key", "stream", "range_start_ms", "range_end_ms", "endpoint", "params_json", "raw_sha256", "payload_sha256", "raw_bytes", "raw_rows"),
    "aux_payload": ("request_key", "stream", "range_start_ms", "range_end_ms", "endpoint", "params_json", "payload_sha256", "raw_rows"),
}
FUNDING_ROW = ("symbol", "funding_rate_timestamp_ms", "funding_rate", "mark_price", "mark_source", "mark_approximate", "hour_aligned", "sampled_exact_1m", "sampled_1m_open", "mark_60m_open", "sample_match")


def sha256(value: Column) -> Column:
    return F.sha2(value, 256)


def bar_line(symbol: Column | str = "symbol") -> Column:
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    return F.concat(F.concat_ws("\t", symbol, F.col("start_ms").cast("string"), *(canonical_text(F.col(c)) for c in PRICES)), F.lit("\n"))


def logical_hash(bars: DataFrame, keys: list[str], order: str = "start_ms", line: Column | None = None) -> DataFrame:
    """sha256 over the sorted lines of each group. A group is one symbol-month, at most 44 640 lines: its bound."""
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), (bar_line() if line is None else line).alias("line"))))
    return bars.groupBy(*keys).agg(sha256(F.array_join(F.transform(lines, lambda x: x["line"]), "")).alias("logical_sha256"), F.count("*").alias("row_count"))


def json_line_hash(rows: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """sha256 over JSON lines, fields in alphabetical order, sorted by ``order``: the index hashes of stored pages."""
    line = F.concat(F.to_json(F.struct(*(F.col(f) for f in sorted(fields)))), F.lit("\n"))
    lines = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("at"), line.alias("line"))))
    return rows.groupBy(*keys).agg(sha256(F.array_join(F.transform(lines, lambda x: x["line"]), "")).alias("index_sha256"))


def index_hash(pages: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """The index hash named ``kind`` (see INDEXES) of each group of stored pages, in the order of their ranges."""
    order = ["stream", "range_start_ms", "endpoint", "params_json"] if kind.startswith("aux") else ["page_start_ms"]
    return json_line_hash(pages, keys, order, list(INDEXES[kind]))


def funding_hash(valued: DataFrame, keys: list[str]) -> DataFrame:
    """sha256 over the JSON array of each group's valued events (columns FUNDING_ROW), by time; nulls are written. A group is one
    symbol-month."""
    row = F.to_json(F.struct(*sorted(FUNDING_ROW)), {"ignoreNullFields": "false"})
    rows = F.array_sort(F.collect_list(F.struct(F.col("funding_rate_timestamp_ms").alias("at"), row.alias("row"))))
    joined = F.concat(F.lit("["), F.array_join(F.transform(rows, lambda x: x["row"]), ","), F.lit("]"))
    return valued.groupBy(*keys).agg(sha256(joined).alias("funding_sha256"), F.count("*").alias("funding_rows"))


@F.pandas_udf(T.StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """JSON with the keys of every object sorted and no blanks; what is no JSON raises. Row by row, as no column function sorts keys at
    any depth; meant for records of some kilobytes."""
    return text.map(lambda x: None if x is None else json.dumps(json.loads(x), sort_keys=True, separators=(",", ":")))


def request_key(endpoint: Column, params: Column) -> Column:
    """Key of a request: endpoint, newline, parameters (a map) as JSON with sorted names."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(params)))
    return sha256(F.concat(endpoint, F.lit("\n"), F.to_json(ordered)))


def cache_key(url: Column, method: Column, path: Column, params: Column, version: Column) -> Column:
    ordered = F.map_from_entries(F.array_sort(F.map_entries(params)))
    return sha256(F.to_json(F.struct(method.alias("method"), ordered.alias("params"), path.alias("path"), url.alias("url"), version.alias("version"))))


@F.pandas_udf(T.StringType())
def payload_hash(body: pd.Series) -> pd.Series:
    """Semantic hash of response bodies: retCode, retMsg and result with sorted keys. What is no JSON object raises. Row by row, as
    no column function sorts keys at any depth; a body is one page of at most 1000 rows."""

    def one(text):
        if text is None:
            return None
        whole = json.loads(text)
        if not isinstance(whole, dict):
            raise ValueError("a payload must be a JSON object")
        kept = {k: whole[k] for k in ENVELOPE if k in whole}
        return hashlib.sha256(json.dumps(kept, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    return body.map(one)


def sample_1_in(symbol: Column, t: Column, denominator: int = 100) -> Column:
    """Deterministic sample: the first 8 bytes of sha256(symbol:t) as an unsigned number, modulo the denominator, are 0."""
    head = F.conv(F.substring(sha256(F.concat_ws(":", symbol, t.cast("string"))), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(head, F.lit(denominator).cast("decimal(20,0)")) == 0
