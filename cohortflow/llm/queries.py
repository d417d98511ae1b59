"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import (
    centroids, decontaminate, imatch, language, mixing, pieces, secret_scan, simhash, squares, token_scan, toxicity, transcripts, urls,
)
from cohortflow.llm.tables import labelled, table

#: Folder of the public vocabulary files, on the driver.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
# The pre-tokenizer of the public byte-level vocabulary, and its free id as separator.
BYTE_BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKEN_FILES = token_scan.TokenFormat(separator=50256, width=2)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed values of the contract: host and path rules of the URL filter.
URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]

# Fixed values of the contract: the first three rules. The others are public token formats.
SECRET_RULES = [
    secret_scan.SecretRule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    secret_scan.SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    secret_scan.SecretRule("hex", r"[0-9a-f]{24,}", 0, 24),
    secret_scan.SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", body=True),
    secret_scan.SecretRule("github", r"(ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    secret_scan.SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    secret_scan.SecretRule("google", r"AIza[A-Za-z0-9_-]{35}"),
    secret_scan.SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    secret_scan.SecretRule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]{16,}"),
]
BASE_KINDS = 3


def query(name: str, oracle: str | None = None):
    def register(f):
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f

    return register


def _url_sql() -> str:
    host = "translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rules = sorted(URL_RULES, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    fit = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in rules]
    text = " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in zip(fit, rules, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fit, rules, strict=True))
    return f"""
    WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    part AS (SELECT page_id, {host} AS host, regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM cut),
    named AS (SELECT *, CASE WHEN host = '' THEN NULL ELSE regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '(\\.html|/)$', '') END AS canonical,
      CASE {text} END AS rule, CASE {verdict} END AS by_rule FROM part),
    twice AS (SELECT canonical FROM named WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1)
    SELECT n.page_id, n.host, n.path, n.rule, coalesce(n.by_rule, CASE WHEN t.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
      n.canonical, t.canonical IS NOT NULL AS listed FROM named n LEFT JOIN twice t ON n.canonical = t.canonical"""


@query("op4_url_filter", _url_sql())
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.filter_urls(pages, URL_RULES, urls.claimed_twice(pages))


def _secret_sql() -> str:
    """Marks each match with private-use characters, cuts the text at the marks and adds up the lengths."""

    def found(i: int, r: secret_scan.SecretRule) -> str:
        pattern = r.pattern.replace("'", "''")
        size = f"length(regexp_extract(piece, '{pattern}', {r.group}))" if r.group else "length(piece)"
        return f"""
        SELECT doc_id, no, {i} AS rank, '{r.kind}' AS kind, first AS start, first + length(piece) AS stop, {size} AS size FROM (
          SELECT doc_id, no, piece, place, coalesce(sum(length(piece)) OVER (PARTITION BY no ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first
          FROM (SELECT doc_id, no, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS place FROM (
            SELECT doc_id, no, string_split(regexp_replace(text, '({pattern})', chr(57344) || '\\1' || chr(57344), 'g'), chr(57344)) AS pieces
            FROM docs WHERE regexp_matches(text, '{pattern}')))) WHERE place % 2 = 0"""

    every = " UNION ALL ".join(f"SELECT * FROM ({found(i, r)}) WHERE size >= {r.least}" for i, r in enumerate(SECRET_RULES))
    text = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    counts = ", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in SECRET_RULES[:BASE_KINDS])
    sums = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in SECRET_RULES[:BASE_KINDS])
    return f"""
    WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS text FROM documents),
    hits AS MATERIALIZED ({every}),
    summed AS (SELECT no, {sums}, {text} FILTER (WHERE rank < {BASE_KINDS}) AS base, {text} AS spans FROM hits GROUP BY no)
    SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN summed USING (no)"""


@query("op8_secret_scan", _secret_sql())
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"), SECRET_RULES)

    def count(rank: int):
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(SECRET_RULES[:BASE_KINDS])]
    base = secret_scan.span_text(F.filter("spans", lambda s: s["rank"] < BASE_KINDS))
    return found.select(
        "doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans")
    )


def _imatch_sql() -> str:
    terms = r"list_filter(list_distinct(string_split_regex(lower({}), '[^\p{{L}}]+')), lambda x: x <> '')"
    slots = ", ".join(f"CASE WHEN number % {m} < {imatch.SUBSETS} THEN number % {m} + {first} END" for m, first in imatch.LEVELS)

    def like(a: str, b: str) -> str:
        equal = f"list_intersect({a}, {b})"
        filled = f"list_distinct(list_concat(list_transform({a}, lambda x: x[1:2]), list_transform({b}, lambda x: x[1:2])))"
        tests, best = [], []
        for _, first in imatch.LEVELS:
            inside = f"lambda x: x >= '{first:02x}' AND x < '{first + imatch.SUBSETS:02x}'"
            n, e = f"len(list_filter({filled}, {inside}))", f"len(list_filter({equal}, {inside}))"
            tests.append(f"{n} >= {imatch.FILLED}")
            best.append(f"CASE WHEN {n} >= {imatch.FILLED} THEN {e} / {n} ELSE 0.0::DOUBLE END")
        return f"CASE WHEN {' OR '.join(tests)} THEN greatest({', '.join(best)}) ELSE len({equal}) / len({filled}) END"

    return f"""
    WITH docs AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS no, doc_id, text
      FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
    total AS MATERIALIZED (SELECT count(*) AS n FROM docs),
    chained AS MATERIALIZED (SELECT no, doc_id, text, length(text) AS n_chars, CASE WHEN no = n THEN 1 ELSE no + 1 END AS next_no FROM docs, total),
    pairs AS MATERIALIZED (SELECT a.no, a.doc_id, a.n_chars, a.next_no, a.text,
      left(a.text, a.n_chars - a.n_chars // 4) || left(b.text, a.n_chars // 4) AS edited FROM chained a JOIN docs b ON a.next_no = b.no),
    own AS MATERIALIZED (SELECT no, 0 AS kind, unnest({terms.format("text")}) AS term FROM pairs),
    other AS MATERIALIZED (SELECT no, 1 AS kind, unnest({terms.format("edited")}) AS term FROM pairs),
    band AS MATERIALIZED (SELECT term, list_filter([{slots}], lambda x: x IS NOT NULL) AS slots FROM (
      SELECT term, ('0x' || left(md5(term), 8))::BIGINT AS number FROM own, total GROUP BY term, n
      HAVING count(*) >= {imatch.MIN_SHARE} * n AND count(*) <= greatest({imatch.MAX_SHARE} * n, 1))),
    hits AS MATERIALIZED (SELECT no, kind, term, unnest(slots) AS slot FROM (SELECT * FROM own UNION ALL SELECT * FROM other) JOIN band USING (term)),
    entries AS MATERIALIZED (SELECT no, kind, list_sort(list(entry)) AS entries FROM (
      SELECT no, kind, lpad(printf('%x', slot::BIGINT), 2, '0') || left(md5(string_agg(term, ' ' ORDER BY term)), 6) AS entry
      FROM hits GROUP BY no, kind, slot) GROUP BY no, kind),
    marked AS MATERIALIZED (SELECT p.no, doc_id, n_chars, next_no, sha256(edited) AS edited_sha256,
      coalesce(a.entries, ['~' || left(md5(text), 16)]) AS own, coalesce(b.entries, ['~' || left(md5(edited), 16)]) AS changed
      FROM pairs p LEFT JOIN entries a ON p.no = a.no AND a.kind = 0 LEFT JOIN entries b ON p.no = b.no AND b.kind = 1)
    SELECT m.doc_id, m.n_chars, m.edited_sha256, array_to_string(m.own, ',') AS fingerprint, array_to_string(m.changed, ',') AS edited_fingerprint,
      {like("m.own", "m.changed")} AS near_edited, {like("m.own", "f.own")} AS near_next
    FROM marked m JOIN marked f ON m.next_no = f.no"""


@query("op5_imatch", _imatch_sql())
def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = imatch.fingerprints(table(spark, sf_dir, "documents"))
    return marked.select(
        "doc_id", "n_chars", "edited_sha256", F.array_join("own", ",").alias("fingerprint"), F.array_join("edited", ",").alias("edited_fingerprint"),
        imatch.likeness(F.col("own"), F.col("edited")).alias("near_edited"), imatch.likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = token_scan.read_ranks(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return token_scan.token_counts(table(spark, sf_dir, "documents"), ranks, BYTE_BPE_PATTERN, TOKEN_FILES)


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.read_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    return pieces.encode_texts(table(spark, sf_dir, "documents"), vocabulary)


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, ~labelled("doc_id", 5, 0))
    found = language.identify(docs, model)
    return found.select("doc_id", F.coalesce(labelled("doc_id", 5, 0), F.lit(False)).alias("held_out"), "lang_pred", "score", "spans")


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~labelled("doc_id", 4, 2))
    found = toxicity.score_texts(docs, model)
    return found.select("doc_id", F.coalesce(labelled("doc_id", 4, 2), F.lit(False)).alias("held_out"), "score", "predicted", "clauses")


@query("op10_chat_format")
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    lines = transcripts.as_transcript(turns)
    model = transcripts.train(lines.where(~labelled("conv_id", 5, 0)))
    return transcripts.recover(lines.drop("role"), model)


def _with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; of every tenth document by crc32 of its id the words from word a on repeat with period p."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cut = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    a = F.col("g") % F.greatest(n, F.lit(1))
    times = 3 + F.col("g") % 8
    placed = cut.withColumns({"a": a.cast("int"), "p": (1 + F.floor((n - a) / times)).cast("int"), "times": times.cast("int")})
    again = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.col("times") + 1)), F.lit(1), F.size("words") - F.col("a"))
    edited = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return placed.select("doc_id", F.when(F.size("words") > 0, edited).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = squares.periodic_runs(_with_repeats(table(spark, sf_dir, "documents")))
    # lists are in order of start and period, so the first of equal exponents is kept
    most = F.reduce("runs", F.expr("CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>)"), _more_periods)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    runs_text = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    top = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), most.alias("top"), runs_text.alias("listed"), "collapsed")
    return top.select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period", F.expr("1000 * top.length DIV top.period").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _more_periods(best, run):
    return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)


CLUSTERS, CLUSTER_ROUNDS, COMPONENTS, COMPONENT_SCALE = 16, 3, 64, 64


def _clusters_sql() -> str:
    gap = f"list_sum(list_transform(range(1, {COMPONENTS + 1}), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))::BIGINT"
    steps = []
    for i in range(CLUSTER_ROUNDS + 1):
        steps.append(f"""
    near{i} AS MATERIALIZED (SELECT k.no, min(struct_pack(distance := {gap}, c := c.c)) AS best FROM kept k, cent{i} c GROUP BY k.no)""")
        if i < CLUSTER_ROUNDS:
            steps.append(f"""
    sums{i} AS MATERIALIZED (SELECT n.best.c AS c, p.p AS p, sum(k.v[p.p]) AS s, count(*) AS n
      FROM near{i} n JOIN kept k USING (no), (SELECT unnest(range(1, {COMPONENTS + 1})) AS p) p GROUP BY n.best.c, p.p),
    cent{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM cent{i} c LEFT JOIN
      (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY p) AS v FROM sums{i} GROUP BY c) m USING (c))""")
    return f"""
    WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS no, vec_id, list_transform(embedding, lambda x: floor({COMPONENT_SCALE} * x::DOUBLE)::BIGINT) AS v
      FROM embeddings WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    cent0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1)::INTEGER AS c, v FROM kept
      ORDER BY sha256('1:' || vec_id) NULLS LAST, v LIMIT {CLUSTERS}),{",".join(steps)}
    SELECT k.vec_id, n.best.c AS cluster, n.best.distance AS distance, sum(n.best.distance) OVER (PARTITION BY n.best.c)::BIGINT AS cluster_inertia,
      sum(n.best.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
    FROM kept k JOIN near{CLUSTER_ROUNDS} n USING (no) JOIN cent{CLUSTER_ROUNDS} f ON f.c = n.best.c"""


@query("op12_centroids", _clusters_sql())
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"), k=CLUSTERS, rounds=CLUSTER_ROUNDS, dimensions=COMPONENTS, scale=COMPONENT_SCALE)
    text = F.array_join(F.transform("components", lambda x: x.cast("string")), ",")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(text.cast("binary"), 256).alias("centroid_sha256"))


def _mix_sql() -> str:
    weights = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    return f"""
    WITH docs AS MATERIALIZED (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}'))::BIGINT AS size,
      md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS hash FROM documents),
    numbered AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM docs GROUP BY source),
    weighed AS (SELECT source, source_size, {weights}[(number - 1) % {len(mixing.WEIGHTS)} + 1]::BIGINT AS weight, {mixing.MOST} * source_size AS most FROM numbered),
    -- in order of limit over weight, the full sources come first
    ordered AS (SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER earlier, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS others
      FROM weighed WINDOW earlier AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    marked AS (SELECT *, most * others < weight * rest AS is_full FROM ordered),
    level AS (SELECT sum(source_size) - coalesce(sum(most) FILTER (WHERE is_full), 0) AS rest, sum(weight) FILTER (WHERE NOT is_full) AS others FROM marked),
    targets AS MATERIALIZED (SELECT source, source_size, CASE WHEN is_full THEN most::DOUBLE ELSE level.rest::DOUBLE * weight / level.others::DOUBLE END AS target FROM marked, level),
    needs AS MATERIALIZED (SELECT *, target - times * source_size AS need FROM
      (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times FROM targets)),
    running AS (SELECT source, hash, words, sum(words) OVER (PARTITION BY source ORDER BY hash) - words AS below
      FROM (SELECT source, hash, sum(size) AS words FROM docs GROUP BY source, hash)),
    edge AS MATERIALIZED (SELECT r.source, r.hash, 2 * (n.need - r.below) > r.words AS with_it FROM running r JOIN needs n ON r.source IS NOT DISTINCT FROM n.source
      WHERE n.need > 0 AND r.below < n.need AND r.below + r.words >= n.need)
    SELECT d.doc_id, d.size, n.source_size, n.target,
      d.size * (n.times + CASE WHEN d.hash < e.hash OR (d.hash = e.hash AND e.with_it) THEN 1 ELSE 0 END) AS taken
    FROM docs d JOIN needs n ON d.source IS NOT DISTINCT FROM n.source LEFT JOIN edge e ON d.source IS NOT DISTINCT FROM e.source"""


@query("op13_mixing", _mix_sql())
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.col("targets")[0].alias("target"), F.col("taken")[0].alias("taken"))
