"""From raw documents to token ids: toxic texts, near copies, repeats and benchmark text go.

Every stage takes (spark, docs, sf_dir), works on all rows the stage before it kept, and
returns the columns of ``documents``; the last one has token ids in place of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelworks.llm import bpe, decontamination, minhash_dedup, substring_dedup, toxicity
from parcelworks.session import stage_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOXIC_SCORE = 0.3
NEAR_SHINGLE, NEAR_PERCENT = 5, 80
REPEAT_WORDS = 50
BENCHMARK_WORDS, BENCHMARK_SHARE = 13, 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the limit; ids of one fold in four never lend their label.

    Null and empty texts are scored like any other, and repeated rows each. Rows without an id
    take no part in the fit. Without labels, or with those of one kind alone, every text has
    the same score, the share of toxic ones. An empty table stays empty; columns other than
    those of ``documents`` are dropped.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    labels = _table(spark, sf_dir, "labels").where(fold != 2)
    model = toxicity.train(docs, labels, label="toxic")
    return toxicity.score(docs, model).where(F.col("score") < TOXIC_SCORE).select(*COLUMNS)


def _once(docs: DataFrame) -> DataFrame:
    """Rows of equal id and text only once; only such rows are shuffled with their texts."""
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.coalesce("text", F.lit("none")))
    marked = docs.select(*COLUMNS, key.alias("row_key"))
    again = marked.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row_key")
    single = marked.join(again, "row_key", "left_anti").select(*COLUMNS)
    return single.unionByName(marked.join(again, "row_key", "left_semi").select(*COLUMNS).dropDuplicates(["doc_id", "text"]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by near copies: the one with the least id.

    Of rows with equal id and text one stays, whatever else they hold; so of equal texts without
    an id. Otherwise texts without an id are compared with none and stay, as do texts without
    words. Different texts of one id stay if they belong to the least id of their group.
    An empty table stays empty; columns other than those of ``documents`` are dropped.
    """
    found = minhash_dedup.near_duplicates(_once(docs), shingle=NEAR_SHINGLE, percent=NEAR_PERCENT)
    return found.where("kept").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document of smaller id holds too are cut out; other texts stay as they are.

    Rows that share an id cut nothing out of each other; a null id counts as the largest. Null
    and empty texts stay so, and an empty table stays empty; columns other than those
    of ``documents`` are dropped. ``n_chars`` follows a text that was cut.
    """
    found = substring_dedup.remove_repeats(docs.select(*COLUMNS), width=REPEAT_WORDS)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.select("doc_id", text.alias("text"), "lang", "source", chars.alias("n_chars"))


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage that fills a twentieth of them.

    Rows are judged one by one, whether they have an id or not; null and empty texts hold no
    passage and stay. An empty table, or an empty benchmark, drops nothing; columns other
    than those of ``documents`` are dropped.
    """
    items = _table(spark, sf_dir, "benchmark")
    found = decontamination.find_contamination(docs.select(*COLUMNS), items, width=BENCHMARK_WORDS, share=BENCHMARK_SHARE)
    return found.where("not contaminated").select(*COLUMNS)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and whether they decode to the text again.

    The text itself is left out: the ids hold it. Null and empty texts have no tokens; rows
    are independent of each other, and an empty table stays empty.
    """
    import public_tokenizers

    coded = bpe.encode_checked(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_benchmark_text),
    ("bpe", to_tokens),
]

#: A fitted model takes part, so SQL cannot give these rows; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
