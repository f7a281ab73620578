"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), where ``docs`` is what the stage before it kept,
read from Parquet, and returns a frame; all but the last return the columns of documents.
The first four take any extra columns along. Decisions depend on the rows of their own input:
quality and sizes are counted on what reached the stage, and toxicity learns from the labels
of the documents that did.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acopio.llm import banding, mixing, packing, quality, shingles, simhash, toxicity
from acopio.llm.queries import table, toxicity_model
from acopio.session import scratch_path, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: SQL can't express fingerprints, dictionaries and packing; tests compare with brute-force versions.
ORACLE_SQL = None


def _whole(docs: DataFrame):
    """The row as one column, so that no name of an extra column meets one of the operators'."""
    return F.struct(*(f"`{c}`" for c in docs.columns)).alias("row")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and that the weighed rules find good."""
    votes = stage(quality.with_votes(quality.with_metrics(docs.select("text", _whole(docs)))).drop("text"), "judged")
    return quality.judged(votes, quality.learn(votes)).where("kept").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(_whole(docs), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.where(F.col("score") < 0.5).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id, then the first row.

    Texts whose SimHash fingerprints, here of five-word shingles, differ in three bits at most are
    near copies, directly or by others. So are texts that share four fifths of all these shingles,
    of which fingerprints find few: what they leave apart is looked for by banded keys (see
    ``banding``) and verified.
    Texts without words are copies of each other.
    """
    text = F.col("text")
    rows = stage(docs.select(F.monotonically_increasing_id().alias("at"), "doc_id", simhash.fingerprint(text, shingles.SHINGLE).alias("fp"), banding.marks(text).alias("m"), _whole(docs)), "marked")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "at")
    # a set of five-word shingles is a node; its texts may differ in repeats, and so in fingerprints
    prints = stage(rows.groupBy("m.key", "fp").agg(F.min("at").alias("node"), F.min(order).alias("first")), "prints")
    nodes = stage(prints.groupBy("key").agg(F.min("node").alias("node"), F.min("first").alias("first")), "sets")
    of_node = stage(prints.select("key", "fp").join(nodes.select("key", "node"), "key").select("node", "fp"), "node-prints")
    linked = simhash.near_duplicates(of_node, "node").where("node <> component_id").select(F.col("node").alias("a"), F.col("component_id").alias("b"))
    sets = stage(rows.select(F.col("at").alias("node"), "m.n", "m.bits", "m.bands").join(nodes.select("node"), "node", "left_semi"), "set-marks")
    texts = rows.select(F.col("at").alias("node"), F.col("row.text").alias("text"))
    found = nodes.drop("key").join(banding.near_copies(sets, texts, stage(linked, "linked")), "node", "left")
    first = found.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("first")["at"].alias("at"))
    # whole rows are matched with the few that go, not with the many that stay
    gone = stage(rows.select("at").join(first, "at", "left_anti"), "copies")
    return rows.select("at", "row").join(gone, "at", "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in which training sequence."""
    return packing.pack(packing.clusters(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_good),
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("best-fit packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        target = scratch_path(spark, name.replace(" ", "-"))
        step(spark, docs, sf_dir).write.parquet(target)
        docs = spark.read.parquet(target)
    return docs
