"""I-Match fingerprints: sorted distinct terms of an idf band, hashed per randomised sub-lexicon.

Terms whose share of documents lies in [min_share, max_share] form the lexicon. Three levels of
32 random sub-lexicons each keep one term in 32, 256 and 2048, so that short and long texts
both have sub-lexicons that hold few of their terms. A fingerprint lists, for every sub-lexicon
that meets the text, its number and a hash of the text's sorted distinct terms in it. Two
fingerprints are as alike as the share of entries they agree on, on the best level that
both fill. A text without any lexicon term is known by a hash of the whole text alone.

Only DataFrame functions. Texts move once: documents are dealt to ranges of ids of bounded
size, in which the next document, all terms and both aggregations are found without another
exchange. The lexicon holds at most (mean distinct terms of a document) / min_share terms,
whatever the number of documents; it is broadcast if it has few enough, else joined by shuffle.

Defined results: a null text is empty. Documents are ordered by id, then text; null ids come
first, and rows that are equal in both follow each other. After the last document comes the
first, so a single document is its own next one. Columns other than id and text are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cohortflow.llm.tables import small_side, stored
from cohortflow.operators.binning import with_steps

MIN_SHARE, MAX_SHARE = 0.002, 0.05
SUBSETS = 32
#: Modulus and first slot of each level; slots of a level are its first 32 residues.
LEVELS = ((32, 0), (256, 32), (2048, 64))
FILLED = 8
DOCS_PER_RANGE = 2000
MAX_RANGES = 200_000
SENTINEL = ""


def terms_of(text: Column) -> Column:
    """Distinct lower-case runs of letters."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), SENTINEL)


def idf_lexicon(docs: DataFrame, text: str, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """Terms of the band with their slots, counted over all documents."""
    total = docs.count()
    counted = docs.select(F.explode(terms_of(F.coalesce(F.col(text), F.lit("")))).alias("term")).groupBy("term").count()
    band = counted.where((F.col("count") >= min_share * total) & (F.col("count") <= max(max_share * total, 1)))
    number = F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 8), 16, 10).cast("long")
    slots = [F.when(number % m < SUBSETS, (number % m + first).cast("int")) for m, first in LEVELS]
    return band.select("term", F.array_compact(F.array(*slots)).alias("slots")).where(F.size("slots") > 0)


def range_borders(docs: DataFrame, id_column: str, per_range: int = DOCS_PER_RANGE) -> list[int]:
    """Ids that cut the documents into ranges of about equal size."""
    total = docs.count()
    parts = min(MAX_RANGES, total // per_range)
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(id_column, shares, max(10_000, 4 * parts)).alias("b")).first()["b"]
    return sorted(set(found or ()))


def with_next(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Columns part, place, guest, id, text and next_text. `guest` marks the first document of a
    part that is dealt to the part before as well, only to be its last document's next one."""
    narrow = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    placed = with_steps(narrow, {"id": range_borders(narrow.select("id"), "id")}, "__part")
    placed = placed.select("id", "text", F.coalesce(F.col("id__part"), F.lit(0)).alias("part"))
    # the first id of each part: MAX_RANGES rows at most
    least = F.when(F.max(F.col("id").isNull()), None).otherwise(F.min("id"))
    heads = sorted((r["part"], r["head"]) for r in placed.groupBy("part").agg(least.alias("head")).collect())
    spark = docs.sparkSession
    schema = StructType([StructField("head", narrow.schema["id"].dataType), StructField("before", IntegerType())])
    before = spark.createDataFrame([(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)], schema)
    led = placed.join(F.broadcast(before), F.col("id").eqNullSafe(F.col("head")), "left")
    here = F.struct(F.col("part"), F.lit(False).alias("guest"))
    there = F.struct(F.col("before").alias("part"), F.lit(True).alias("guest"))
    both = F.when(F.col("before").isNull(), F.array(here)).otherwise(F.array(here, there))
    window = Window.partitionBy("part").orderBy("guest", F.col("id").asc_nulls_first(), "text")
    dealt = led.select("id", "text", F.inline(both))
    return dealt.select("*", F.row_number().over(window).alias("place"), F.lead("text").over(window).alias("next_text"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries on the best level that the two fill, over all levels if they fill none."""
    equal = F.array_intersect(a, b)
    filled = F.array_union(F.transform(a, _slot), F.transform(b, _slot))
    best, all_equal, all_filled = F.lit(0.0), F.size(equal), F.size(filled)
    enough = F.lit(False)
    for _, first in LEVELS:
        n, e = _on_level(filled, first), _on_level(equal, first)
        best = F.greatest(best, F.when(n >= FILLED, e / n).otherwise(0.0))
        enough = enough | (n >= FILLED)
    return F.when(enough, best).otherwise(all_equal / all_filled)


def _on_level(entries: Column, first: int) -> Column:
    low, high = f"{first:02x}", f"{first + SUBSETS:02x}"
    return F.size(F.filter(entries, lambda s: (s >= low) & (s < high)))


def _slot(entry: Column) -> Column:
    return F.substring(entry, 1, 2)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, n_chars, edited_sha256 and the entries of the text (own), of the edited text (edited) and of the next document (next)."""
    lexicon = stored(idf_lexicon(docs, text_column), "lexicon")
    lexicon = small_side(lexicon.union(docs.sparkSession.createDataFrame([(SENTINEL, [-1])], lexicon.schema)))
    chained = with_next(docs, id_column, text_column).withColumn("n_chars", F.length("text"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    head = F.substring(F.col("text"), F.lit(1), F.col("n_chars") - quarter)
    edited = F.concat(head, F.coalesce(F.substring(F.col("next_text"), F.lit(1), quarter), F.lit("")))
    chained = chained.withColumn("edited", F.when(F.col("guest"), "").otherwise(edited))

    def whole(text: str) -> Column:
        return F.concat(F.lit("~"), F.substring(F.md5(F.col(text).cast("binary")), 1, 16))

    info = F.struct(
        "id", "guest", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        whole("text").alias("whole0"), whole("edited").alias("whole1"),
    )
    blank = F.when(F.lit(False), info)

    def items(kind: int, text: str) -> Column:
        return F.transform(terms_of(F.col(text)), lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term"), blank.alias("info")))

    # a text's sentinel is in the lexicon, so that texts without a lexicon term stay; it also carries the row's own values
    sentinel = F.array(F.struct(F.lit(0).alias("kind"), F.lit(SENTINEL).alias("term"), info.alias("info")))
    exploded = chained.select("part", "place", F.inline(F.concat(sentinel, items(0, "text"), items(1, "edited"))))
    in_band = exploded.join(lexicon, "term").select("part", "place", "kind", "term", "info", F.explode("slots").alias("slot"))
    hashed = in_band.groupBy("part", "place", "kind", "slot").agg(
        F.collect_list("term").alias("terms"), F.first("info", ignorenulls=True).alias("info")
    )
    digest = F.substring(F.md5(F.array_join(F.array_sort("terms"), " ").cast("binary")), 1, 6)
    entry = F.when(F.col("slot") >= 0, F.concat(F.lpad(F.lower(F.hex("slot")), 2, "0"), digest))
    rows = hashed.select("part", "place", "info", F.struct("kind", entry.alias("entry")).alias("hit"))
    grouped = rows.groupBy("part", "place").agg(F.collect_list("hit").alias("hits"), F.first("info", ignorenulls=True).alias("info"))

    def entries(kind: int) -> Column:
        own = F.transform(F.filter("hits", lambda h: (h["kind"] == kind) & h["entry"].isNotNull()), lambda h: h["entry"])
        return F.when(F.size(own) > 0, F.array_sort(own)).otherwise(F.array(F.col(f"info.whole{kind}")))

    marked = grouped.select("part", "place", "info.*", entries(0).alias("own"), entries(1).alias("edited"))
    marked = marked.withColumn("next", F.lead("own").over(Window.partitionBy("part").orderBy("place")))
    return marked.where(~F.col("guest")).select(F.col("id").alias(id_column), "n_chars", "edited_sha256", "own", "edited", "next")
