"""Secret scan: rules are regular expressions, found through an inverted index of trigrams.

Each rule's pattern is turned into a Boolean query over trigrams that every match must
contain. The index has one posting per (trigram, document); the postings of a document
are intersected as a bit mask and only documents that satisfy a rule's query are verified
with its pattern. A rule from which no trigram follows scans every document. Only
DataFrame functions are used.

Positions are code points, end exclusive. They come from the lengths of the gaps and the
matches: ``\\G(.*?)(pattern)`` walks from match to match, so gaps and matches tile the text.

Defined results: a null text counts as empty and has no spans. Documents are told apart
by (id, hash of the text), null ids included, so repeated rows each get the same answer.
Columns of the input other than the id and text are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.tables import BROADCAST_ROWS, small_side, stored

_parse = re._parser  # the standard library's own parser of patterns
MAX_STRINGS = 48
MASK_BITS = 60


class SecretRule(NamedTuple):
    """`pattern` must mean the same to Java, Python and RE2. A match is dropped if its
    group `group` (0: the whole match) has fewer than `least` characters. A match of a rule with
    `body` is a first line: what follows up to its END line is redacted as well."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    body: bool = False


def _strings(tree) -> list[set[str] | None]:
    """A pattern as a sequence of finite sets of strings; None stands for anything."""
    parts: list[set[str] | None] = []
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            parts.append({chr(arg)})
        elif name == "IN" and len(arg) <= 8 and all(str(o) == "LITERAL" for o, _ in arg):
            parts.append({chr(a) for _, a in arg})
        elif name == "SUBPATTERN":
            parts += _strings(arg[3])
        elif name == "BRANCH":
            options = [_joined(_strings(x)) for x in arg[1]]
            whole = all(len(o) == 1 and o[0] is not None for o in options)
            parts.append(set().union(*(o[0] for o in options)) if whole else None)
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] == 1 and arg[0] == 0:
            inner = _joined(_strings(arg[2]))
            parts.append(inner[0] | {""} if len(inner) == 1 and inner[0] is not None else None)
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] == arg[1] and arg[0] <= 8:
            parts += _strings(arg[2]) * arg[0]
        else:
            parts.append(None)
    return parts


def _joined(parts: list[set[str] | None]) -> list[set[str] | None]:
    """Neighbouring sets become the set of their concatenations while that stays small."""
    out: list[set[str] | None] = []
    for part in parts:
        if part is not None and out and out[-1] is not None and len(out[-1]) * len(part) <= MAX_STRINGS:
            out[-1] = {a + b for a, b in product(out[-1], part)}
        else:
            out.append(part)
    return out or [{""}]


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """All of these must hold: any of the alternatives, each of which needs all its trigrams.

    Case is folded, so the query also serves patterns that ignore it. Empty: no trigram is mandatory."""
    query = []
    for part in _joined(_strings(_parse.parse(pattern))):
        texts = {s.lower() for s in part or ()}
        if texts and all(len(s) >= 3 for s in texts):
            needs = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in texts}
            query.append(sorted((n for n in needs if not any(m < n for m in needs)), key=sorted))
    return query


def _holds(query: list[list[frozenset[str]]], masks: Sequence[str], number: dict[str, int]) -> Column:
    """Intersection and union of postings, on the masks of one document."""

    def needs(trigrams: frozenset[str]) -> Column:
        test = F.lit(True)
        for w, name in enumerate(masks):
            bits = sum(1 << (number[t] % MASK_BITS) for t in trigrams if number[t] // MASK_BITS == w)
            if bits:
                test = test & (F.col(name).bitwiseAND(F.lit(bits)) == F.lit(bits))
        return test

    holds = F.lit(True)
    for alternatives in query:
        some = F.lit(False)
        for trigrams in alternatives:
            some = some | needs(trigrams)
        holds = holds & some
    return holds


def trigram_index(docs: DataFrame, trigrams: Sequence[str], key: Sequence[str], text: str) -> DataFrame:
    """Postings (trigram number, key...) of the wanted trigrams; case folded."""
    folded = docs.select(*key, F.lower(F.col(text)).alias("__low"))
    present = F.array_compact(F.array(*[F.when(F.contains("__low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))
    return folded.select(F.explode(present).alias("trigram"), *key)


def candidates(docs: DataFrame, rules: Sequence[SecretRule], key: Sequence[str], text: str) -> DataFrame:
    """Keys of documents whose postings satisfy a rule's query, with one flag per rule (flag_<kind>)."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted({t for q in queries.values() for part in q for need in part for t in need})
    number = {t: i for i, t in enumerate(trigrams)}
    masks = [f"__mask{w}" for w in range(len(trigrams) // MASK_BITS + 1)]
    bit = F.expr(f"shiftleft(1L, cast(trigram % {MASK_BITS} AS INT))")
    word = F.floor(F.col("trigram") / MASK_BITS)
    postings = trigram_index(docs, trigrams, key, text)
    found = postings.groupBy(*key).agg(*[F.bit_or(F.when(word == w, bit).otherwise(F.lit(0).cast("long"))).alias(m) for w, m in enumerate(masks)])
    flags = [_holds(queries[r.kind], masks, number).alias(f"flag_{r.kind}") for r in rules]
    return found.select(*key, *flags).where(" OR ".join(f"flag_{r.kind}" for r in rules))


def _spans(text: Column, rule: SecretRule, order: int) -> Column:
    """Array of (start, rank, kind, end) of a rule's matches in a text."""
    walk = rf"(?s)\G(.*?)({rule.pattern})"
    gaps = F.regexp_extract_all(text, F.lit(walk), F.lit(1))
    whole = F.regexp_extract_all(text, F.lit(walk), F.lit(2))
    tested = F.regexp_extract_all(text, F.lit(walk), F.lit(rule.group + 2)) if rule.group else whole
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), tested.alias("tested"))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,size:int>>")

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["whole"])
        one = F.struct(
            start.alias("start"), F.lit(order).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"), F.length(x["tested"]).alias("size")
        )
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    walked = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    # a text without any match costs one plain search
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), F.filter(walked, lambda s: s["size"] >= rule.least)).otherwise(none)


def find_secrets(docs: DataFrame, rules: Sequence[SecretRule], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: the id, the key column text_hash and `spans`, an array of
    (start, rank, kind, end, size) ordered by start, then by the rank of the rule."""
    key = [id_column, "text_hash"]
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.select(F.col(id_column), text.alias("__text")).select(id_column, F.xxhash64("__text").alias("text_hash"), "__text")
    ranked = list(enumerate(rules))
    indexed = [(i, r) for i, r in ranked if trigram_query(r.pattern)]
    scanned = [(i, r) for i, r in ranked if not trigram_query(r.pattern)]
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,size:int>>")
    base = keyed.select(*key, F.concat(none, *[_spans(F.col("__text"), r, i) for i, r in scanned]).alias("__scanned"))
    if not indexed:
        return base.select(*key, F.array_sort("__scanned").alias("spans"))

    # the candidates are stored: their number decides how they meet the texts, and two joins read them
    wanted = stored(candidates(keyed, [r for _, r in indexed], key, "__text"), "secret-candidates")
    few = wanted.count() <= BROADCAST_ROWS
    side = F.broadcast(wanted) if few else wanted
    side = side.select(*[F.col(k).alias(f"__{k}") for k in key], *[f"flag_{r.kind}" for _, r in indexed])
    same = F.col(id_column).eqNullSafe(F.col(f"__{id_column}")) & (F.col("text_hash") == F.col("__text_hash"))
    verified = keyed.join(side, same).select(
        *key, F.concat(*[F.when(F.col(f"flag_{r.kind}"), _spans(F.col("__text"), r, i)).otherwise(none) for i, r in indexed]).alias("__found")
    )
    found = verified.where(F.size("__found") > 0).dropDuplicates(key)
    found = found.select(*[F.col(k).alias(f"__{k}") for k in key], "__found")
    joined = base.join(found, same, "left")
    return joined.select(*key, F.array_sort(F.concat("__scanned", F.coalesce("__found", none))).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


DASHES = "-----"
END_LINE = r"^-----END [A-Z ]*PRIVATE KEY-----"
# without an END line: header lines, then the lines of base64 that follow, also with line breaks written as \n
BREAK = r"(?:\s|\\[rn])"
HEADERS = rf"^(?:{BREAK}*+[A-Za-z0-9-]{{1,40}}: [^\n\\]*+){{0,16}}"  # two are defined
BASE64_LINE = r"(?:[A-Za-z0-9+/=]{32,}+|[A-Za-z0-9+/]{1,31}+={1,2}(?![A-Za-z0-9+/=]))"
# the end of the lines: a break that no such line follows, or what is neither. Searched for, so that any number of lines is passed
BODY_END = rf"{BREAK}++(?!{BASE64_LINE})|(?!{BREAK})[^A-Za-z0-9+/=]"


def with_bodies(text: Column, spans: Column, rules: Sequence[SecretRule]) -> Column:
    """The spans; those of rules with a body end after the END line, or after the base64 lines if there is none."""
    kinds = [r.kind for r in rules if r.body]
    if not kinds:
        return spans

    def longer(s):
        rest = F.substring(text, s["end"] + 1, F.length(text))
        body = F.instr(rest, F.lit(DASHES)) - 1
        line = F.length(F.regexp_extract(F.substring(rest, body + 1, F.length(rest)), END_LINE, 0))
        more = F.when((body >= 0) & (line > 0), body + line).otherwise(_open_body(rest))
        return F.when(s["kind"].isin(kinds), s.withField("end", (s["end"] + more).cast("int"))).otherwise(s)

    return F.transform(spans, longer)


def _open_body(rest: Column) -> Column:
    """Characters of a key without an END line: nothing if no line of base64 follows."""
    headers = F.length(F.regexp_extract(rest, HEADERS, 0))
    lines = F.substring(rest, headers + 1, F.length(rest))
    stop = F.regexp_instr(lines, F.lit(BODY_END))
    size = F.when(stop > 0, stop - 1).otherwise(F.length(lines))
    return F.when(F.regexp_like(lines, F.lit(rf"^{BREAK}*+{BASE64_LINE}")), headers + size).otherwise(0)


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by [kind]; overlapping spans become one, named by the one that starts first."""

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        piece = F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]"))
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), piece.alias("out"))).otherwise(longer)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def without_secrets(docs: DataFrame, rules: Sequence[SecretRule], id_column: str = "doc_id", text_column: str = "text", size_column: str = "n_chars") -> DataFrame:
    """All rows of docs, with secrets in the text replaced and the size of changed texts brought up to date."""
    found = find_secrets(docs, rules, id_column, text_column).where(F.size("spans") > 0).dropDuplicates([id_column, "text_hash"])
    found = stored(found.select(F.col(id_column).alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans")), "secrets")
    key = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
    met = docs.withColumn("__key", key).join(small_side(found), F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__hash")), "left")
    changed = F.col("__spans").isNotNull()
    met = met.withColumn(text_column, F.when(changed, redacted(F.col(text_column), with_bodies(F.col(text_column), F.col("__spans"), rules))).otherwise(F.col(text_column)))
    if size_column in docs.columns:
        size = F.length(text_column).cast(docs.schema[size_column].dataType)
        met = met.withColumn(size_column, F.when(changed, size).otherwise(F.col(size_column)))
    return met.select(*docs.columns)
