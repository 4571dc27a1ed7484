"""What the operators share: reading a table, cutting lineage, joining components."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; everything between it is a word.
SPACES = r"[\x20\x09-\x0D]+"


def reachable(df: DataFrame) -> DataFrame:
    """Let Python workers import this package where it is not installed for them."""
    root = str(Path(__file__).resolve().parents[2])
    environment = df.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see: ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets one of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='oreflow-llm-')}"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and go on from there.

    Lost executors then cost no recomputation, and a plan that uses the rows
    more than once reads them back instead of making them again.
    """
    path = os.path.join(shared_folder(df.sparkSession), f"cut-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    pieces = F.split(F.coalesce(text, F.lit("")), SPACES)
    return F.filter(pieces, lambda w: w != "")


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, however often they are used.

    Behind a one-row generator Spark neither copies an expression into its
    users nor evaluates it again inside their lambdas.
    """
    packed = F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))
    return df.select("*", F.inline(packed))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over links (a, b).

    Alternates large-star and small-star steps until nothing moves: each step
    hangs neighbours on the smallest one, so the number of rounds grows with
    the logarithm of the longest chain. Minima are combined inside tasks before
    the shuffle; a hub with very many links is one key of a join that AQE can
    split. Nodes without a link are not in the result.
    """
    edges = cut(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = large.where("a <> b").distinct()
        lowest = stars.groupBy("a").agg(F.min("b").alias("m"))
        small = stars.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select("a", F.col("m").alias("b")))
        edges = cut(small.where("a <> b").distinct())
        now = tuple(edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.groupBy("a").agg(F.min("b").alias("component")).select(
                F.col("a").alias("node"), "component").unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        state = now
