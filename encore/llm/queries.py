"""The queries of this folder, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.centroids import centroid_clusters
from encore.llm.decontaminate import contaminated
from encore.llm.dialogue import repair_conversations
from encore.llm.mixing import mix_sources, word_count
from encore.llm.mixscore import score_texts
from encore.llm.neighbours import nearest_neighbours
from encore.llm.quality import score_quality
from encore.llm.secrets import find_secrets
from encore.llm.simhash import near_duplicates
from encore.llm.tokenfiles import token_table
from encore.llm.toxicity import score_toxicity
from encore.llm.urls import judge_urls, rules_frame
from encore.llm.voronoi import top_products
from encore.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(prepare(spark), folder.rstrip("/"))

    QUERIES[function.__name__] = run
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op7_url_rules(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages, rules_frame(spark)).drop("url")


@query
def op8_pivotal_mix(spark, folder):
    sized = table(spark, folder, "documents").select("doc_id", "source", word_count().alias("words"))
    mixed = mix_sources(sized, size="words")
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query
def op10_secret_spans(spark, folder):
    return find_secrets(table(spark, folder, "documents"))


@query
def op4_simhash_groups(spark, folder):
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_subword_quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return score_quality(docs, table(spark, folder, "labels")).drop("text")


@query
def op9_benchmark_overlaps(spark, folder):
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op3_toxicity_grades(spark, folder):
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_cross_polytope_neighbours(spark, folder):
    """Queries: the ids divisible by 100, against every row."""
    return nearest_neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op6_token_files(spark, folder):
    return token_table(table(spark, folder, "documents"))


@query
def op1_context_mixing(spark, folder):
    return score_texts(table(spark, folder, "documents"))


@query
def op11_glr_repair(spark, folder):
    return repair_conversations(table(spark, folder, "conversations"))


@query
def op12_hadamard_clusters(spark, folder):
    return centroid_clusters(table(spark, folder, "embeddings"))


@query
def op13_voronoi_top_k(spark, folder):
    """Queries: the ids divisible by 100, against every row."""
    return top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)
