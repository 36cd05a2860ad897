"""Personal data by candidate gradient boosting, in DataFrame operations only.

Fixed rules find e-mail addresses, IP addresses, payment cards and phone numbers. Besides, generators of
high recall propose spans: keys (long runs with digits), numbers (7 to 19 digits in groups) and contacts
(addresses, also spelled with (at) and (dot)). Each has format and context features, all binary. A candidate that
overlaps a span of the fixed rules is covered by these; all others could be added, and boosted trees of
depth two learn from all of them which look like personal data. No labels are given, so positives are those whose
surroundings or form give them away: keys assigned to a name such as token or password, numbers and
contacts behind a word such as phone or e-mail, and contacts spelled out with (at) and (dot). The candidates
are counted by their features before anything leaves the executors, so the trees are fitted on at most 2^13
rows a fold. A threshold calibrated to a precision, on texts that the trees did not learn from, selects candidates.

Every text is searched once; what was found is written to the shared folder, counted there for the fit, and
selected from. Positions come from splitting a text at the matches and adding up lengths, in chunks, so that a text
with very many matches takes time in proportion. Every pattern runs in time linear in the text: runs start
where they cannot have started earlier, and repetitions are possessive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, unused

_NAME = "A-Za-z0-9._%+-"
#: Fixed rules: kind, pattern, and whether a match is valid. A pattern finds the same matches as the plain form.
BASE = (
    ("email", rf"(?:(?<![{_NAME}])|\G)[{_NAME}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"m rlike r'^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$'"),
    ("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){15,18}+(?![ -]?[0-9])", "luhn_check(translate(m, ' -', ''))"),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", "length(translate(m, '+ ().-', '')) BETWEEN 8 AND 15"),
)
#: Candidate generators: kind of the spans they may add, and pattern.
GENERATORS = (
    ("secret", r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+={0,2}+"),
    ("number", r"(?<![0-9])\(?+[0-9](?:[ ().-]{0,2}+[0-9]){6,18}+(?![0-9])"),
    ("contact", rf"(?:(?<![{_NAME}])|\G)[{_NAME}]++ ?+(?:@|\(at\)|\[at\]) ?+[A-Za-z0-9-]++(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z0-9-]++)++"),
)
KINDS = tuple(k for k, *_ in BASE) + tuple(k for k, _ in GENERATORS)
_ASSIGNED = r"(?i)(?:token|secret|passw(?:or)?d|api[_ -]?key|access[_ -]?key)[\x22' ]{0,3}[=:][\x22' ]{0,3}$"
_CALLED = r"(?i)(?:^|[^A-Za-z])(?:tel|telephone|phone|mobile|cell|fax|call)(?: (?:me|us|at|on|no|number))?[.]?[\x22' ]{0,3}[=:]?[\x22' ]{0,3}$"
_WRITTEN = r"(?i)(?:^|[^A-Za-z])(?:e-?mail|mail|contact|write to|reach)(?: (?:me|us|at|to|address))?[\x22' ]{0,3}[=:]?[\x22' ]{0,3}$"
#: What makes a candidate x of each generator a positive to learn from.
HITS = {
    "secret": f'x.b rlike r"{_ASSIGNED}"',
    "number": f"""x.b rlike r"{_CALLED}" AND length(translate(x.m, ' ().-', '')) BETWEEN 8 AND 15""",
    "contact": f'x.b rlike r"{_WRITTEN}" OR x.m rlike r"[(\\[]at[)\\]].*[(\\[]dot[)\\]]"',
}
#: Features of a candidate c: its text c.m, the 32 characters before it c.b.
FEATURES = (
    ("number", "c.g = 'number'"),
    ("contact", "c.g = 'contact'"),
    ("hex", "c.m rlike '^[0-9A-Fa-f]+$'"),
    ("long", "length(c.m) >= 32"),
    ("mixed", "c.m rlike '[A-Za-z]' AND c.m rlike '[0-9]'"),
    ("grouped", "c.m rlike '[ ().-]'"),
    ("phone_digits", "length(translate(c.m, ' ().-', '')) BETWEEN 9 AND 12"),
    ("card_digits", "length(translate(c.m, ' ().-', '')) BETWEEN 16 AND 19"),
    ("spelled", r"c.m rlike r'[(\[](?:at|dot)[)\]]'"),
    ("luhn", "coalesce(luhn_check(translate(c.m, ' ().-', '')), false)"),
    ("quoted", "c.b rlike r\"[\\x22']$\""),
    ("assigned", "c.b rlike r\"[=:][\\x22' ]{0,3}$\""),
    ("named", "c.b rlike '(?i)(?:tel|phone|call|mobile|fax|mail|token|secret|passw|key|card|account)'"),
)
ROUNDS, RATE, PRECISION = 30, 0.3, 0.95
#: Parts of the texts, each of which is scored by trees of the others to calibrate the threshold.
FOLDS = 4


#: Items that one step of a long fold takes together: copying the list it builds stays cheap.
CHUNK = 256


def _fold(items: str, carry: dict[str, str], kind: str, step: str) -> str:
    """SQL of an array of ``kind``: a fold over the array ``items`` with named carried values. ``step`` is a struct of the new carried
    values and the list f, over a (the carried values and f so far) and x (an item). The list grows within a chunk and
    chunks are put together at the end, so work is linear in the number of items."""
    names = ", ".join(f"{{0}}.{n} AS {n}" for n in carry)
    inner = f"aggregate(c, struct({names.format('o')}, cast(array() AS array<{kind}>) AS f), (a, x) -> {step})"
    outer = f"transform(array({inner}), r -> struct({names.format('r')}, concat(o.f, array(r.f)) AS f))[0]"
    start = ", ".join(f"{v} AS {n}" for n, v in carry.items())
    return f"flatten(aggregate({_chunks(items)}, struct({start}, cast(array() AS array<array<{kind}>>) AS f), (o, c) -> {outer}, o -> o.f))"


def _chunks(items: str) -> str:
    return f"transform(array({items}), whole -> CASE WHEN size(whole) = 0 THEN array(whole) ELSE transform(sequence(0, (size(whole) - 1) DIV {CHUNK}), k -> slice(whole, k * {CHUNK} + 1, {CHUNK})) END)[0]"


def _spans(text: str, pattern: str, keep: str, context: int = 0) -> str:
    """SQL of an array of structs s, e, m (and b, the last characters before it), one for each match that ``keep`` holds for."""
    quoted = "r\"" + pattern + "\""
    kind = "struct<s: int, e: int, m: string" + ", b: string" * bool(context) + ">"
    before = ", substring(concat(a.t, x.u), -" + str(context) + ") AS b" if context else ""
    tail = f", substring(concat(a.t, x.u, x.m), -{context}) AS t" if context else ""
    own = keep.replace("m rlike", "x.m rlike").replace("(m,", "(x.m,")
    grown = f"concat(a.f, array(struct(a.p + length(x.u) AS s, a.p + length(x.u) + length(x.m) AS e, x.m AS m{before})))"
    step = f"struct(a.p + length(x.u) + length(x.m) AS p{tail}, CASE WHEN ({own}) THEN {grown} ELSE a.f END AS f)"
    pairs = f"slice(zip_with(split({text}, {quoted}, -1), ms, (u, m) -> struct(u AS u, m AS m)), 1, size(ms))"
    carry = {"p": "0"} | ({"t": "''"} if context else {})
    return f"transform(array(regexp_extract_all({text}, {quoted}, 0)), ms -> CASE WHEN size(ms) = 0 THEN cast(array() AS array<{kind}>) ELSE {_fold(pairs, carry, kind, step)} END)[0]"


def _base(text: str) -> str:
    """SQL of an array of structs k (number of the kind), s, e: the spans of the fixed rules in order."""
    return "concat(" + ", ".join(f"transform({_spans(text, p, keep)}, x -> struct({n} AS k, x.s AS s, x.e AS e))" for n, (_, p, keep) in enumerate(BASE)) + ")"


def _candidates(text: str) -> str:
    """SQL of an array of structs k, s, e, code (bit i: feature i), hit (a positive to learn from), over (whether it overlaps one of
    ``base``). Candidates of a generator are in order and apart, so a chunk of them meets few spans of ``base``."""
    parts = []
    for n, (kind, p) in enumerate(GENERATORS):
        code = " + ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, (_, cond) in enumerate(FEATURES))
        code = code.replace("c.g", f"'{kind}'").replace("c.", "x.")
        hit = f"({HITS[kind]})"
        item = lambda over: f"struct({len(BASE) + n} AS k, x.s AS s, x.e AS e, {code} AS code, {hit} AS hit, {over} AS over)"  # noqa: B023, E731
        near = "filter(base, y -> y.s < element_at(c, -1).e AND y.e > c[0].s)"
        over = "exists(near, y -> y.s < x.e AND x.s < y.e)"
        met = f"flatten(transform({_chunks('found')}, c -> transform(array({near}), near -> transform(c, x -> {item(over)}))[0]))"
        parts.append(f"transform(array({_spans(text, p, 'true', 32)}), found -> CASE WHEN size(found) = 0 OR size(base) = 0 THEN transform(found, x -> {item('false')}) ELSE {met} END)[0]")
    return "concat(" + ", ".join(parts) + ")"


@dataclass(frozen=True)
class Boosted:
    """Trees: (feature, feature if it holds, feature if not, four leaves); a score is bias plus the leaves reached."""

    bias: float
    trees: tuple[tuple[int, int, int, tuple[float, ...]], ...]
    threshold: float

    def score(self, code: int) -> float:
        return self.bias + sum(leaf[2 * (code >> a & 1) + (code >> (b if code >> a & 1 else c) & 1)] for a, b, c, leaf in self.trees)

    def sql(self, code: str) -> str:
        bit = lambda i: f"{code} & {1 << i} <> 0"
        tree = [f"CASE WHEN {bit(a)} THEN CASE WHEN {bit(b)} THEN {l[3]!r}D ELSE {l[2]!r}D END ELSE CASE WHEN {bit(c)} THEN {l[1]!r}D ELSE {l[0]!r}D END END" for a, b, c, l in self.trees]
        return " + ".join([f"{self.bias!r}D", *tree])


def fit_trees(counts: dict[int, tuple[float, float]], judged: list[tuple[float, float, float]] | None = None, rounds: int = ROUNDS, rate: float = RATE, precision: float = PRECISION) -> Boosted:
    """Logistic boosting over feature codes with (candidates, positives); leaves are regularised Newton steps. The
    threshold is the lowest score down to which the candidates of ``judged`` (score, candidates, positives) hold ``precision`` of
    positives, or infinite. Without ``judged`` it is read from the counts themselves."""
    rows = [(code, n, pos) for code, (n, pos) in sorted(counts.items())]
    n_all, pos_all = sum(r[1] for r in rows), sum(r[2] for r in rows)
    bias = math.log((pos_all + 1) / (n_all - pos_all + 1))
    score, trees = {code: bias for code, *_ in rows}, []
    for _ in range(rounds if rows else 0):
        slopes = []
        for code, n, pos in rows:
            p = 1 / (1 + math.exp(-score[code]))
            slopes.append((code, pos - n * p, n * p * (1 - p)))

        def best(part):
            def gain(i):
                sums = [[0.0, 1.0], [0.0, 1.0]]
                for code, g, h in part:
                    side = sums[code >> i & 1]
                    side[0] += g
                    side[1] += h
                return sum(g * g / h for g, h in sums), sums

            found = [(gain(i)[0], -i) for i in range(len(FEATURES))]
            i = -max(found)[1]
            return i, gain(i)

        def split(i):
            return [[r for r in slopes if r[0] >> i & 1 == side] for side in (0, 1)]

        gains = []
        for a in range(len(FEATURES)):
            off, on = split(a)
            c, (x, no) = best(off)
            b, (y, yes) = best(on)
            gains.append((x + y, -a, b, c, tuple(rate * max(-4.0, min(4.0, g / h)) for g, h in (no[0], no[1], yes[0], yes[1]))))
        _, a, b, c, leaves = max(gains)
        trees.append((-a, b, c, leaves))
        one = Boosted(0.0, (trees[-1],), 0.0)
        for code, *_ in rows:
            score[code] += one.score(code)
    whole = Boosted(bias, tuple(trees), 0.0)
    judged = sorted(judged or ((whole.score(code), n, pos) for code, (n, pos) in counts.items()), reverse=True)
    threshold, n_in, pos_in = math.inf, 0.0, 0.0
    for k, (at, n, pos) in enumerate(judged):
        n_in, pos_in = n_in + n, pos_in + pos
        last = k + 1 == len(judged) or judged[k + 1][0] < at  # codes of one score come in together
        if last and pos_in >= precision * n_in:
            threshold = at
    return Boosted(bias, tuple(trees), threshold - 1e-9)


def search(docs: DataFrame, text_col: str = "text", out: str = "found") -> DataFrame:
    """``docs`` with the struct column ``out``: base (the spans of the fixed rules) and candidates, found in one pass. A null text counts
    as empty."""
    text = f"coalesce(cast(`{text_col}` AS string), '')"
    found = f"transform(array({text}), t -> transform(array({_base('t')}), base -> struct(base AS base, {_candidates('t')} AS candidates, cast(pmod(xxhash64(t), {FOLDS}) AS int) AS fold))[0])[0]"
    return docs.withColumn(out, F.expr(found))


def fit_found(found: DataFrame, column: str = "found") -> Boosted:
    """Boost trees on the candidates of all texts that no span of the fixed rules overlaps, as only these can be added, counted by
    features (at most 2^13 rows a fold). The threshold is calibrated on scores of the same candidates by trees that did not learn
    from their text: texts fall into ``FOLDS`` folds by their hash, and each fold is scored by trees of the others. Positives of a
    single fold cannot be judged by trees of other folds; the threshold then comes from the counts. Without positives nothing is added."""
    seen = found.select(F.col(column)["fold"].alias("fold"), F.explode(F.col(column)["candidates"]).alias("c")).where("NOT c.over")
    rows = seen.groupBy("fold", F.col("c.code").alias("code")).agg(F.count("*").alias("n"), F.count_if("c.hit").alias("pos")).collect()
    folds = sorted({r["fold"] for r in rows})

    def counts(which) -> dict[int, tuple[int, int]]:
        out: dict[int, tuple[int, int]] = {}
        for r in rows:
            if r["fold"] in which:
                n, pos = out.get(r["code"], (0, 0))
                out[r["code"]] = (n + r["n"], pos + r["pos"])
        return out

    judged = []
    for f in folds if len({r["fold"] for r in rows if r["pos"]}) > 1 else []:
        others = fit_trees(counts(set(folds) - {f}))
        judged += [(others.score(code), n, pos) for code, (n, pos) in counts({f}).items()]
    return fit_trees(counts(folds), judged)


def select(found: DataFrame, model: Boosted, column: str = "found", out: str = "spans") -> DataFrame:
    """``found`` with ``column`` replaced by the array column ``out`` of structs kind, start, end (code points, end exclusive): the spans of
    the fixed rules by kind and start, then the added ones, which overlap none of these nor each other."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    kind = "struct<k: int, s: int, e: int>"
    if math.isinf(model.threshold):
        added = f"cast(array() AS array<{kind}>)"
    else:
        chosen = f"filter(`{column}`.candidates, c -> NOT c.over AND {model.sql('c.code')} >= {model.threshold!r}D)"
        ordered = f"array_sort(transform({chosen}, c -> struct(c.s AS s, -c.e AS e, c.k AS k)))"
        step = "CASE WHEN x.s >= a.p THEN struct(-x.e AS p, concat(a.f, array(struct(x.k AS k, x.s AS s, -x.e AS e))) AS f) ELSE a END"
        added = f"array_sort({_fold(ordered, {'p': '0'}, kind, step)})"
    spans_ = f"transform(concat(`{column}`.base, {added}), x -> struct({names}[x.k] AS kind, x.s AS start, x.e AS end))"
    made = F.expr(spans_)
    return found.select(*(F.col(f"`{c}`") for c in found.columns if c not in (column, out)), made.alias(out))


def fit(docs: DataFrame, text_col: str = "text") -> Boosted:
    """The model of the candidates of all texts; see fit_found."""
    return fit_found(search(docs.select(text_col), text_col))


def spans(docs: DataFrame, model: Boosted | None = None, text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with the array column ``out`` (see select). Without a model one is fitted on ``docs``: the texts are then searched once, what
    was found is written down, counted and selected from. A null or empty text has no spans; repeated rows get the same; a
    column called like ``out`` is replaced, at the end; long texts are searched whole. An empty table stays empty."""
    held = unused(docs, "found")
    found = search(docs, text_col, held)
    if model is None:
        found = stage(found, "pii-found")
        model = fit_found(found, held)
    return select(found, model, held, out)


def digest(spans_col: str = "spans") -> dict[str, Column]:
    """Counts and texts of a span array: n_<kind> of the fixed rules, base_sha256, spans, and n_spans of all kinds."""
    base = ", ".join(f"'{k}'" for k, *_ in BASE)
    joined = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    counts = {f"n_{k}": F.expr(f"cast(size(filter({spans_col}, x -> x.kind = '{k}')) AS bigint)") for k, *_ in BASE}
    return counts | {"base_sha256": F.sha2(F.expr(joined.format(f"filter({spans_col}, x -> x.kind IN ({base}))")), 256), "spans": F.expr(joined.format(spans_col)), "n_spans": F.size(spans_col).cast("long")}


def redact(docs: DataFrame, model: Boosted | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of a text replaced by its kind in brackets, e.g. [EMAIL]; overlapping spans become one
    mark, of the first. A null text stays null. All columns are kept, whatever their names. Without a model, as in spans."""
    held = unused(docs, "spans")
    marked = spans(docs, model, text_col, held)
    ordered = f"array_sort(transform(`{held}`, x -> struct(x.start AS s, x.end AS e, x.kind AS k)))"
    step = "CASE WHEN x.s >= a.p THEN struct(x.e AS p, concat(a.f, array(substring(w, a.p - o.p + 1, x.s - a.p), '[', upper(x.k), ']')) AS f) ELSE struct(greatest(a.p, x.e) AS p, a.f AS f) END"
    inner = f"aggregate(c, struct(o.p AS p, cast(array() AS array<string>) AS f), (a, x) -> {step})"
    # a chunk of spans cuts its own part out of the text once, so a text is not read anew for every span
    window = f"substring(`{text_col}`, o.p + 1, greatest(0, aggregate(c, 0, (m, x) -> greatest(m, x.e)) - o.p))"
    outer = f"transform(array({window}), w -> transform(array({inner}), r -> struct(r.p AS p, concat(o.f, array(array_join(r.f, ''))) AS f))[0])[0]"
    whole = f"aggregate({_chunks(ordered)}, struct(0 AS p, cast(array() AS array<string>) AS f), (o, c) -> {outer}, o -> concat(array_join(o.f, ''), substring(`{text_col}`, o.p + 1)))"
    text = F.expr(f"CASE WHEN size(`{held}`) = 0 THEN `{text_col}` ELSE {whole} END")
    return marked.select(*(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
