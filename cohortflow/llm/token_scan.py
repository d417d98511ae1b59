"""Token counts of flat token files: a vectorised search for the end-of-document id.

A flat file holds token ids of fixed width one after the other, each document followed by the
separator id, without any index. Every file is searched in blocks; a block gives its
separators, the tokens before the first one and those after the last one. What a document
has in earlier blocks comes from a prefix scan of the block summaries: within runs of
blocks first, then over the totals of the runs, so no task holds more than one run.

Files up to `whole_file_bytes` are read whole (their size is bounded by the writer's
documents per file); larger ones are read as fixed-length records, of a length that divides the
file, so memory stays bounded for any file.

Writing: a text without tokens gives a document of length 0. A null text counts as empty. Equal
documents are written each. Ids are kept beside the tokens in the order of the documents, one
pair of files per task, so counts can be named; rows may have null ids. Other columns are
ignored. No rows give files without documents. Tokens after a file's last separator are an
unfinished document, reported with `closed` false. A file whose length is no multiple of the
width is refused.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm.tables import stored
from cohortflow.sources.scratch import scratch_path

BLOCK_TOKENS = 1 << 16
BLOCKS_PER_RUN = 256
DOCS_PER_FILE = 20_000
WHOLE_FILE_BYTES = 256 << 20
NO_ID = struct.pack("<?q", False, 0)


class TokenFormat(NamedTuple):
    separator: int
    width: int = 2  # bytes of an id, little-endian

    @property
    def dtype(self) -> str:
        return f"<u{self.width}"

    @property
    def end(self) -> bytes:
        return self.separator.to_bytes(self.width, "little")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file of a byte-level BPE."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def write_tokens(docs: DataFrame, path: str, ranks: dict[bytes, int], pattern: str, form: TokenFormat, id_column: str, text_column: str) -> None:
    """Files under path/kind=tokens, and the ids of their documents under path/kind=ids.

    Spark's text writer puts the line end after every row; with the separator as line end and raw
    bytes as rows it writes exactly the flat format. One task writes both files of a pair."""
    coders = []

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        if not coders:
            coders.append(tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))
        seq = 0
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                tokens = [np.array(coders[0].encode_ordinary(t), form.dtype).tobytes() for t in part["text"]]
                ids = [NO_ID if pd.isna(i) else struct.pack("<?q", True, int(i)) for i in part["id"]]
                n = len(part)
                yield pd.DataFrame(
                    {"kind": ["ids"] * n + ["tokens"] * n, "seq": list(range(seq, seq + n)) * 2, "value": ids + tokens}
                )
                seq += n

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = narrow.mapInPandas(each, "kind string, seq long, value binary").sortWithinPartitions("kind", "seq")
    (
        rows.select("kind", F.col("value").cast("string").alias("value"))
        .write.partitionBy("kind").option("lineSep", form.end.decode("latin-1")).option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", DOCS_PER_FILE).text(path)
    )


SUMMARY = "file string, block long, stop long, n_sep long, last_sep long, seps array<long>"


def block_summary(file: str, block: int, first: int, tokens: np.ndarray, separator: int) -> tuple:
    """Where a block ends, how many separators it has, the last one and all their places in the file."""
    at = np.flatnonzero(tokens == separator) + first
    return file, block, first + len(tokens), len(at), int(at[-1]) if len(at) else None, at.tolist()


def scan_blocks(
    spark: SparkSession, path: str, form: TokenFormat, block_tokens: int = BLOCK_TOKENS, whole_file_bytes: int = WHOLE_FILE_BYTES
) -> DataFrame:
    """One row per block of every file below path."""
    size, names = form.width, [c.split()[0] for c in SUMMARY.split(", ")]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)

    def rows(file: str, first: int, tokens: np.ndarray) -> list[tuple]:
        cuts = range(0, len(tokens), block_tokens)
        return [block_summary(file, (first + at) // block_tokens, first + at, tokens[at : at + block_tokens], form.separator) for at in cuts]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                if len(content) % size:
                    raise ValueError(f"{file}: {len(content)} bytes are no multiple of {size}")
                found = pd.DataFrame(rows(file, 0, np.frombuffer(content, form.dtype)), columns=names)
                yield found.astype({"last_sep": "Int64"})

    out = files.where(F.col("length") <= whole_file_bytes).select("path", "content").mapInPandas(each, SUMMARY)
    for file, length in files.where(F.col("length") > whole_file_bytes).select("path", "length").collect():
        if length % size:
            raise ValueError(f"{file}: {length} bytes are no multiple of {size}")
        n = length // size
        per = next(k for k in range(min(n, block_tokens), 0, -1) if n % k == 0)  # records tile the file
        records = spark.sparkContext.binaryRecords(file, per * size).zipWithIndex()
        cut = _record_cutter(file, per, form)
        out = out.unionByName(spark.createDataFrame(records.map(cut), SUMMARY))
    return out


def _record_cutter(file: str, per: int, form: TokenFormat):
    def cut(record):
        content, i = record
        return block_summary(file, i, i * per, np.frombuffer(content, form.dtype), form.separator)

    return cut


def stitch(blocks: DataFrame, blocks_per_run: int = BLOCKS_PER_RUN) -> DataFrame:
    """Documents from block summaries: file, doc_no (from 0 in its file), first_token, n_tokens, closed.

    A document starts after the separator before it, which may be many blocks away. The scan carries
    two values forward, the number of separators so far and the place of the last one."""
    blocks = stored(blocks.withColumn("run", F.floor(F.col("block") / blocks_per_run)), "blocks")

    def carried(df: DataFrame, keys: list[str], order: str, suffix: str) -> DataFrame:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        count, last = F.coalesce(F.sum("n_sep").over(before), F.lit(0)), F.max("last_sep").over(before)
        return df.withColumns({f"count_{suffix}": count, f"last_{suffix}": last})

    runs = blocks.groupBy("file", "run").agg(F.sum("n_sep").alias("n_sep"), F.max("last_sep").alias("last_sep"))
    runs = carried(runs, ["file"], "run", "run").drop("n_sep", "last_sep")
    placed = carried(blocks.where("n_sep > 0"), ["file", "run"], "block", "in").join(runs, ["file", "run"])
    before = F.coalesce("last_in", "last_run", F.lit(-1).cast("long"))
    starts = F.transform(F.concat(F.array(before), F.slice("seps", 1, F.size("seps") - 1)), lambda p: p + 1)
    pairs = F.arrays_zip(starts.alias("first_token"), F.col("seps").alias("sep"))
    ended = placed.select("file", (F.col("count_in") + F.col("count_run")).alias("base"), F.posexplode(pairs).alias("i", "d"))
    ended = ended.select(
        "file", (F.col("base") + F.col("i")).alias("doc_no"), F.col("d.first_token").alias("first_token"),
        (F.col("d.sep") - F.col("d.first_token")).alias("n_tokens"), F.lit(True).alias("closed"),
    )
    files = blocks.groupBy("file").agg(F.sum("n_sep").alias("doc_no"), F.max("stop").alias("stop"), F.max("last_sep").alias("last"))
    start = F.coalesce("last", F.lit(-1).cast("long")) + 1
    rest = files.where(F.col("stop") > start).select("file", "doc_no", start.alias("first_token"), (F.col("stop") - start).alias("n_tokens"), F.lit(False).alias("closed"))
    return ended.unionByName(rest)


def read_ids(spark: SparkSession, path: str, form: TokenFormat) -> DataFrame:
    """Columns file, doc_no and id of the files that write_tokens put beside the tokens."""
    record = np.dtype([("known", "?"), ("id", "<i8"), ("end", f"S{form.width}")])

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                got = np.frombuffer(content, record)
                ids = pd.array(got["id"].astype(np.int64), "Int64")
                ids[~got["known"]] = pd.NA
                yield pd.DataFrame({"file": file, "doc_no": np.arange(len(got)), "id": ids})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(each, "file string, doc_no long, id long")


def token_counts(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, form: TokenFormat, id_column: str = "doc_id", text_column: str = "text",
    block_tokens: int = BLOCK_TOKENS, blocks_per_run: int = BLOCKS_PER_RUN, whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """Write the documents as flat token files, find their ends by the scan and name each count: id,
    shard, doc_no, first_token, n_tokens."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, ranks, pattern, form, id_column, text_column)
    shard = F.regexp_extract("file", r"(part-\d+).*(c\d+)\.txt$", 1), F.regexp_extract("file", r"(part-\d+).*(c\d+)\.txt$", 2)
    named = F.concat_ws("-", *shard)
    if docs.isEmpty():
        return spark.createDataFrame([], f"{id_column} long, shard string, doc_no long, first_token long, n_tokens long")
    found = stitch(scan_blocks(spark, f"{path}/kind=tokens", form, block_tokens, whole_file_bytes), blocks_per_run)
    found = found.withColumn("shard", named).drop("file")
    ids = read_ids(spark, f"{path}/kind=ids", form).select(named.alias("shard"), "doc_no", F.col("id").alias(id_column))
    return found.join(ids, ["shard", "doc_no"]).select(id_column, "shard", "doc_no", "first_token", "n_tokens")
