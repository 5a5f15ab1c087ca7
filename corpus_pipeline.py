"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Every stage is a function of (spark, docs, sf_dir); all but the last return the columns of documents. A document is a row:
rows that repeat an id are judged each by itself.

A stage's intermediate tables are deleted when a later stage begins, as its result has been written by then.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleframe.llm.decontamination import leaks
from aisleframe.llm.encoding import encode
from aisleframe.llm.ngram_join import near_duplicate_groups
from aisleframe.llm.quality import quality_verdicts
from aisleframe.llm.shared import bound_batches, drop_stashes, part, stash
from aisleframe.llm.substring_dedup import repeated_spans, strip_spans

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
STAGE_TABLES = "stage"


#: Keys of at most so many rows go to every executor (16 MB of keys); more are joined by a shuffle. The rows are the same.
SENT_KEYS = 1 << 20


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with a key of all their columns that also tells which of them are null."""
    missing = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in COLUMNS])
    return docs.select(*COLUMNS).withColumn("row_key", F.xxhash64(*COLUMNS, missing))


def _without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key is not among the given ones, a written table of row_key. Few keys spare the texts a shuffle."""
    few = keys.count() <= SENT_KEYS
    return rows.join(F.broadcast(keys) if few else keys, "row_key", "left_anti")


def _stage(work):
    """The stage with its intermediate tables in a part of the shared folder that only the stage at work uses."""
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        drop_stashes(spark, STAGE_TABLES)
        with part(STAGE_TABLES):
            return work(spark, docs, sf_dir)
    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the plain rules and are no outliers of their language and source."""
    rows = _keyed(docs)
    rejected = quality_verdicts(rows, keep=("row_key",)).filter(~F.col("kept")).select("row_key").distinct()
    return _without(rows, stash(rejected)).select(*COLUMNS)


@_stage
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, 80 percent): one with the smallest id, null ids last.

    Rows are told apart by a key of all their columns, so rows that share an id but not a text go only where they are linked
    themselves, and rows without an id like any others. Rows without words link with nothing and stay.
    """
    rows = _keyed(docs)
    groups = near_duplicate_groups(rows.select(F.col("row_key").alias("doc_id"), "text")).filter("n_shingles > 0").groupBy(
        F.col("doc_id").alias("row_key"), "component_id").agg(F.count("*").alias("k"))
    ids = rows.groupBy("row_key").agg(F.min("doc_id").alias("doc_id"))
    groups = stash(groups.join(ids, "row_key"))
    # written, so that a component with very many rows can be split in the join
    first = stash(groups.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))["row_key"].alias("first")))
    marked = stash(groups.join(first, "component_id").select("row_key", "k", (F.col("row_key") == F.col("first")).alias("stays")))
    kept = _without(rows, stash(marked.filter("not stays").select("row_key")))
    several = marked.filter("stays and k > 1").select("row_key")
    once = kept.join(several, "row_key", "left_semi").dropDuplicates(["row_key"])
    return kept.join(several, "row_key", "left_anti").select(*COLUMNS).unionByName(once.select(*COLUMNS))


@_stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of spans that repeat; texts that lose nothing stay as they are."""
    rows = _keyed(docs)
    spans = stash(repeated_spans(rows.select("row_key", "text")))
    cut = strip_spans(rows.join(spans, "row_key", "left"), [*COLUMNS])
    whole = F.col("n_removed") == 0
    text = F.when(whole, F.col("text")).otherwise(F.col("kept_text"))
    chars = F.when(whole, F.col("n_chars")).otherwise(F.length("kept_text").cast("long"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", chars.alias("n_chars"))


@_stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    rows = _keyed(docs)
    leaking = stash(leaks(rows.select("row_key", "text"), benchmark, keep="row_key", short_items=True).select("row_key").distinct())
    return _without(rows, leaking).select(*COLUMNS)


@_stage
def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, with their number and whether decoding them gives the text again."""
    return encode(docs, keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]
#: Robust covariances, repeated spans of texts already changed, and encoding are not written in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents table, each over all that the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
