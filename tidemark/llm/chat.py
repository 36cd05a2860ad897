"""Chat formatting by schema fingerprints.

A record is JSON. Its fingerprint is the hash of its sorted nested field paths (``messages[].role``);
a registry maps fingerprints to declarative mappings, which name the paths of the turns. Turns are then
rendered by a template that marks each turn and escapes its own control strings inside texts, so that
the output can be parsed back. The mask lists the spans of the assistant's texts in the output.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
#: Role names of the layouts and the canonical name of each.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


@dataclass(frozen=True)
class Mapping:
    """turns: (role or path of the role, path of the text) in order; with ``each`` they are read once for each
    element of that list; ``rename`` gives its roles their canonical names. Optional fields may be absent; a turn whose optional text is absent or empty is left out."""

    name: str
    turns: tuple[tuple[str, str], ...]
    each: str | None = None
    optional: tuple[str, ...] = field(default=())
    rename: bool = False

    def paths(self) -> list[frozenset[str]]:
        base = f"{self.each}[]." if self.each else ""
        own = {base + p[1:] for turn in self.turns for p in turn if p.startswith(".")}
        free = {base + p[1:] for p in self.optional}
        return [frozenset(own - set(gone)) for n in range(len(free) + 1) for gone in combinations(sorted(free), n)]


#: A leading dot marks a path; other roles are constants.
MAPPINGS = (
    Mapping("messages", ((".role", ".content"),), each="messages"),
    Mapping("messages_text", ((".role", ".text"),), each="messages"),
    Mapping("sharegpt", ((".from", ".value"),), each="conversations", rename=True),
    Mapping("prompt", (("user", ".prompt"), ("assistant", ".response"))),
    Mapping("prompt_completion", (("user", ".prompt"), ("assistant", ".completion"))),
    Mapping("instruction", (("system", ".system"), ("user", ".instruction"), ("user", ".input"), ("assistant", ".output")), optional=(".system", ".input")),
    Mapping("question", (("system", ".system"), ("user", ".question"), ("assistant", ".answer")), optional=(".system",)),
)


def _quoted(key: str) -> str:
    """A key in which nothing reads as part of a path: signs of paths, and line ends, which part paths, are quoted."""
    return re.sub(r"[\\.\[\]{}\n]", lambda m: f"\\{ord(m[0]):x};", key) or "\\"


def field_paths(value, at: str = "") -> set[str]:
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{_quoted(k)}" if at else _quoted(k)) for k, v in value.items())) if value else {f"{at}{{}}"}
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def registry(mappings=MAPPINGS) -> dict[str, Mapping]:
    known = {fingerprint(p): m for m in mappings for p in m.paths()}
    return known | {fingerprint({f"{m.each}[]"}): m for m in mappings if m.each}


def turns_of(record, mapping: Mapping) -> list[tuple[str, str]]:
    def get(item, path):
        for part in path[1:].split("."):
            item = item.get(part) if isinstance(item, dict) else None
        return item

    out = []
    for item in (record[mapping.each] or []) if mapping.each else [record]:
        for role, path in mapping.turns:
            text = get(item, path)
            if path in mapping.optional and not text:
                continue
            role = get(item, role) if role.startswith(".") else role
            role = "" if role is None else str(role)
            out.append((ROLES.get(role, role) if mapping.rename else role, "" if text is None else str(text)))
    return out


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("<", "\\<").replace(":", "\\:") if re.search(r"[\\#<:]", text) else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(turns: list[tuple[str, str]], trained: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the spans (code points, end exclusive) of the texts of the role that is trained."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + MIDDLE, escape(text)
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*) </turn>\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def format_records(records: DataFrame, id_col: str, json_col: str, mappings=MAPPINGS, trained: str = "assistant") -> DataFrame:
    """id_col, fingerprint, layout, n_turns, formatted, mask (array of start and end) for each record.

    A record that is null, no JSON, or of an unknown fingerprint has layout ``null`` and null outputs; so has one that is nested
    deeper than Python reads, or whose texts are no Unicode (lone surrogates). Null roles
    and texts count as empty; an empty list of messages gives an empty text. Repeated records give repeated rows, an empty
    table an empty one. Other columns are not read. Work is row by row in Arrow batches; a task holds one batch.
    """
    kind, known = records.schema[id_col].dataType.simpleString(), registry(mappings)
    names = [id_col, "fingerprint", "layout", "n_turns", "formatted", "mask"]
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def one(text):
        try:
            record = json.loads(text)
            mark = fingerprint(field_paths(record))
        except (TypeError, ValueError, RecursionError):
            return None, None, None, None, None
        if mark not in known:
            return mark, None, None, None, None
        turns = turns_of(record, known[mark])
        formatted, mask = render(turns, trained)
        try:
            formatted.encode()
        except UnicodeEncodeError:
            return mark, None, None, None, None
        return mark, known[mark].name, len(turns), formatted, [{"start": a, "end": b} for a, b in mask]

    def run(batches):
        for batch in batches:
            rows = [one(x.as_py()) for x in batch.column(1)]
            types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(span))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[c] for r in rows], t) for c, t in enumerate(types))], names=names)

    return records.select(id_col, json_col).mapInArrow(run, f"{id_col} {kind}, fingerprint string, layout string, n_turns long, formatted string, mask array<struct<start: long, end: long>>")


def digests(formatted: DataFrame, id_col: str) -> DataFrame:
    """What can be read back from formatted records: id_col, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars; nulls for a record that has no formatted text."""
    kind = formatted.schema[id_col].dataType.simpleString()
    names = [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def one(text, mask):
        if text is None:
            return None, None, None, None, None
        turns = parse(text)
        loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
        return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)

    def run(batches):
        for batch in batches:
            rows = [one(x.as_py(), m.as_py()) for x, m in zip(batch.column(1), batch.column(2), strict=True)]
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[c] for r in rows], t) for c, t in enumerate(types))], names=names)

    return formatted.select(id_col, "formatted", "mask").mapInArrow(run, f"{id_col} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def conversations_as_records(rows: DataFrame) -> DataFrame:
    """One JSON record a conversation, from rows of conv_id, turn, role, text; equal turns are ordered by role, then text, and null turns
    come first. A user's turn that one assistant's turn follows is a prompt and its response; other conversations are lists of
    messages, whose texts are called content or, where conv_id is odd, text. A conversation is one record by its nature, so
    its rows meet in one group; conversations do not."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    named = lambda name: F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias(name))).alias("messages")))
    pair = F.expr("size(t) = 2 AND t[0].role = 'user' AND t[1].role = 'assistant'")
    exchange = F.to_json(F.struct(F.expr("t[0].text").alias("prompt"), F.expr("t[1].text").alias("response")))
    odd = F.coalesce(F.pmod("conv_id", F.lit(2)) == 1, F.lit(False))
    return whole.select("conv_id", F.when(pair, exchange).when(odd, named("text")).otherwise(named("content")).alias("record"))
