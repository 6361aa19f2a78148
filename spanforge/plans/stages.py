"""The stages from hits to copies as tables under one folder, each of which goes on where it stopped.

    python -m spanforge stage0 --hits hits.parquet --work folder [--class-map map.tsv] [--settings s.json] [--linkage strict|lenient]
    python -m spanforge stage1 --hits hits.parquet --work folder [--top N | --cluster KEY ... | --clusters-file FILE] [--skip-existing]

Stage 0 writes edges, clusters, evidence and candidates. Stage 1 writes the copies of the clusters
chosen, ``batch`` clusters at a time: their partitions of the copies table are replaced, then
their keys are added to the table of finished ones. A run that ends early leaves the batches
before it, and with skip-existing the next run takes only clusters that aren't finished.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.operators import copies, linkage, selection
from spanforge.operators.evidence import family_evidence
from spanforge.settings import DEFAULT, Settings
from spanforge.sources.formats import read_table
from spanforge.sources.store import read_or_none

log = logging.getLogger(__name__)

COPIES = ["cluster_key", "mode", "tool", "family", "chrom", "start", "end", "strand", "n_fragments", "is_full"]


def member() -> Column:
    return F.concat_ws(":", "tool", "family")


def stage0(spark: SparkSession, hits: DataFrame, work: str, class_map: DataFrame | None = None, settings: Settings = DEFAULT, mode: str = "strict") -> DataFrame:
    """Edges, clusters, evidence and candidates of hits, written under work; the candidates.

    class_map(label, tool, path): see ``linkage.class_paths``; without it no cluster has a vote.
    """
    linkage.edges(hits, settings.min_joint, settings.min_reciprocal).write.mode("overwrite").parquet(f"{work}/edges")
    edges = spark.read.parquet(f"{work}/edges")
    found = linkage.clusters(linkage.mutual_best(edges)).drop("cluster_id") if mode == "strict" else linkage.lenient_clusters(edges, settings.density)
    found.select("cluster_key", "n_members", "member").write.mode("overwrite").parquet(f"{work}/clusters")
    family_evidence(hits).withColumn("member", member()).write.mode("overwrite").parquet(f"{work}/evidence")
    clusters, evidence = spark.read.parquet(f"{work}/clusters"), spark.read.parquet(f"{work}/evidence")
    rows = clusters.join(evidence, "member", "left")
    rows = rows.select("cluster_key", "member", F.split("member", ":", 2)[0].alias("tool"), F.split("member", ":", 2)[1].alias("family"), F.col("n_full_len").cast("double").alias("n_full_len"), F.col("genomic_bp").cast("double").alias("genomic_bp"), F.col("cov_ge3_frac").alias("cov"), "div_median", F.lit(None).cast("double").alias("frac_tandem"))
    paths = rows.withColumn("path", F.lit(None).cast("string")) if class_map is None else linkage.class_paths(rows, "family", class_map)
    votes = linkage.weighted_vote(paths.select("cluster_key", "member", F.col("path").alias("vote"), F.col("genomic_bp").alias("weight")), linkage.VAGUE_PATHS)
    pooled = rows.groupBy("cluster_key").agg(F.coalesce(F.sum("n_full_len"), F.lit(0.0)).alias("pooled_full_len"), F.coalesce(F.sum("genomic_bp"), F.lit(0.0)).alias("pooled_bp"))
    linkage.gates(rows, votes, settings).join(pooled, "cluster_key").write.mode("overwrite").parquet(f"{work}/candidates")
    log.info("wrote edges, clusters, evidence and candidates to %s", work)
    return spark.read.parquet(f"{work}/candidates")


def chosen(candidates: DataFrame, top: int | None = None, keys: list[str] | None = None, names: DataFrame | None = None) -> DataFrame:
    """Candidates by key or from names(cluster_key), or else the ``top`` ones, all by default."""
    if names is not None:
        return selection.keep_members(candidates.filter("candidate"), names, "cluster_key")
    if keys is not None:
        return candidates.filter("candidate").filter(F.col("cluster_key").isin(keys))
    return candidates.filter("candidate") if top is None else selection.top_candidates(candidates, top)


def cluster_copies(hits: DataFrame, clusters: DataFrame, evidence: DataFrame, wanted: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Copies of the wanted clusters' members, merged always and with the gap veto of all hits outside the cluster."""
    named = hits.withColumn("member", member()).join(clusters.select("member", "cluster_key"), "member", "left")
    named = named.withColumn("cluster", F.coalesce("cluster_key", "member"))
    own = named.join(wanted.select("cluster_key").distinct(), "cluster_key", "left_semi")
    made = [
        copies.merge_copies(own).withColumn("mode", F.lit("merge_always")),
        copies.merge_copies(own, True, settings.veto, F.col("cluster"), named).withColumn("mode", F.lit("gap_aware")),
    ]
    lengths = evidence.select("tool", "family", F.col("modal_len").cast("double").alias("modal_len"))
    rows = made[0].unionByName(made[1]).withColumn("member", member()).join(clusters.select("member", "cluster_key"), "member").join(lengths, ["tool", "family"], "left")
    return rows.withColumn("is_full", copies.near_full(F.col("modal_len"), settings.full_edge, settings.full_share)).select(COPIES)


def stage1(spark: SparkSession, hits: DataFrame, work: str, wanted: DataFrame, settings: Settings = DEFAULT, skip_existing: bool = False, batch: int = 64) -> DataFrame:
    """Copies of the wanted candidates written by cluster under work, batch by batch; all copies there are, an empty table where no cluster was taken yet."""
    clusters, evidence = spark.read.parquet(f"{work}/clusters"), spark.read.parquet(f"{work}/evidence")
    finished = read_or_none(spark, f"{work}/finished", "cluster_key string, n_copies bigint")
    if skip_existing and finished is not None:
        wanted = selection.skip_existing(wanted, finished, "cluster_key")
    # keys of the clusters asked for: a list that a user chose, or one row a candidate
    keys = [r["cluster_key"] for r in wanted.select("cluster_key").distinct().orderBy("cluster_key").collect()]
    log.info("stage 1 takes %d clusters", len(keys))
    for i in range(0, len(keys), batch):
        some = spark.createDataFrame([(k,) for k in keys[i : i + batch]], "cluster_key string")
        made = cluster_copies(hits, clusters, evidence, some, settings)
        made.write.partitionBy("cluster_key").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{work}/copies")
        counts = some.join(_copies(spark, work), "cluster_key", "left").groupBy("cluster_key").agg(F.count("mode").alias("n_copies"))
        counts.write.mode("append").parquet(f"{work}/finished")
        log.info("wrote the copies of %d clusters to %s/copies", min(batch, len(keys) - i), work)
    return _copies(spark, work)


def _copies(spark: SparkSession, work: str) -> DataFrame:
    # keys of digits only would be read as numbers
    schema = "mode string, tool string, family string, chrom string, start bigint, end bigint, strand string, n_fragments bigint, is_full boolean, cluster_key string"
    found = read_or_none(spark, f"{work}/copies", schema)
    return (spark.createDataFrame([], schema) if found is None else found).select(COPIES)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="spanforge", description=__doc__.split("\n")[0])
    parser.add_argument("stage", choices=["stage0", "stage1"])
    for name in ("hits", "work"):
        parser.add_argument(f"--{name}", required=True)
    for name in ("class-map", "settings", "clusters-file"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--linkage", choices=["strict", "lenient"], default="strict")
    parser.add_argument("--top", type=int)
    parser.add_argument("--cluster", action="append")
    parser.add_argument("--skip-existing", action="store_true")
    given = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(f"spanforge-{given.stage}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        hits = spark.read.parquet(given.hits)
        settings = Settings.from_json(spark.read.text(given.settings, wholetext=True).first()[0]) if given.settings else DEFAULT
        if given.stage == "stage0":
            mapped = read_table(spark, given.class_map, "label string, tool string, path string") if given.class_map else None
            stage0(spark, hits, given.work, mapped, settings, given.linkage)
        else:
            names = read_table(spark, given.clusters_file, "cluster_key string", True) if given.clusters_file else None
            wanted = chosen(spark.read.parquet(f"{given.work}/candidates"), given.top, given.cluster, names)
            stage1(spark, hits, given.work, wanted, settings, given.skip_existing)
    finally:
        spark.stop()
