import pytest
from pyspark.sql import functions as F

from cohortflow.llm import imatch, urls
from cohortflow.llm.queries import ORACLE, QUERIES, URL_RULES
from tests import oracle
from tests.llm.test_odd_tables import connect


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, sf_dir, name):
    assert oracle.compare(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLE[name]) == []


def test_many_ranges_same_as_sql(spark, odd_dir, monkeypatch):
    monkeypatch.setattr(imatch, "DOCS_PER_RANGE", 4)
    monkeypatch.setattr(imatch, "range_borders", lambda docs, column, per_range=4: borders(docs, column, per_range))
    assert oracle.compare(QUERIES["op5_imatch"](spark, odd_dir), connect(odd_dir), ORACLE["op5_imatch"]) == []


borders = imatch.range_borders


def test_edited_texts_are_nearer_than_the_next(spark):
    rows = QUERIES["op5_imatch"](spark, "/root/testdata/sf0.01").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) >= 0.9 * len(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)


def test_equal_texts_have_equal_fingerprints(spark, odd_dir):
    texts = {r["text"] for r in spark.read.parquet(f"{odd_dir}/documents.parquet").where("text is not null").collect()}
    own = imatch.fingerprints(spark.createDataFrame([(i, t) for i, t in enumerate(sorted(texts) * 2)], "doc_id long, text string")).collect()
    by_id = {r["doc_id"]: r["own"] for r in own}
    assert all(by_id[i] == by_id[i + len(texts)] for i in range(len(texts)))


def test_filter_larger_than_a_broadcast(spark, monkeypatch):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.org/"), F.col("id") % 1000).alias("url"))
    listed = spark.range(0, 1000, 3).select(F.concat(F.lit("h.org/"), "id").alias("canonical"))
    want = None
    for bound in (1 << 18, 0):
        monkeypatch.setattr(urls, "BROADCAST_BLOCKS", bound)
        got = sorted((r["page_id"], r["listed"]) for r in urls.filter_urls(pages, URL_RULES, listed).collect())
        assert got == [(i, i % 1000 % 3 == 0) for i in range(3000)]
        assert want in (None, got)
        want = got


def test_bloom_has_no_false_negatives_and_few_positives(spark):
    listed = spark.range(2000).select(F.concat(F.lit("a/"), "id").alias("canonical"))
    blocks = urls.bloom_blocks(listed, "canonical", 128)
    other = spark.range(4000).select(F.concat(F.lit("a/"), "id").alias("canonical"), F.col("id"))
    probe = other.withColumn("block", urls._block(F.col("canonical"), 128))
    for i, m in enumerate(urls._masks(F.col("canonical"))):
        probe = probe.withColumn(f"m{i}", m)
    passes = " AND ".join(f"(w{i} & m{i}) = m{i}" for i in range(urls.WORDS))
    got = {r["id"] for r in probe.join(blocks, "block").where(passes).collect()}
    assert set(range(2000)) <= got and len(got) < 2100
