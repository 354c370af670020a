"""The queries of the operators here. Each takes whole tables and derives its digest from what the operator gives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (bpe, centroids, decontaminate, importance, lines, lm, quality, secrets, sharding, simhash, sql, substrings, suffixes,
                          token_shards)
from millrace.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare(spark), folder)

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(sql.DECONTAMINATION)
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Hits of benchmark windows in every document."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = F.aggregate("ranges", F.lit(0), lambda n, r: n + r["word_end"] - r["word"]).cast("bigint")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


@query()
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents whose fingerprints are linked."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query()
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of every document."""
    found = quality.quality(table(spark, folder, "documents"))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *measures, "base_failed", "kept", "good_probability")


@query()
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """24 shards of equal weight, and where one more would move each document."""
    found = sharding.sharded(table(spark, folder, "documents"), [1.0] * 24)
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query(sql.secrets_sql(secrets.RULES))
def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every document, scanned blob by blob into a fresh ledger."""
    found = secrets.secret_spans(table(spark, folder, "documents"))
    base = [rule.name for rule in secrets.RULES[:3]]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    of_base = F.filter("spans", lambda s: s["rule"].isin(base))

    def count(name: str):
        return F.size(F.filter("spans", lambda s: s["rule"] == name)).cast("bigint").alias(f"n_{name}")

    counts = [count(name) for name in base]
    return found.select("doc_id", *counts, F.sha2(joined(of_base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query()
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded, and its ids decoded again."""
    vocabulary = bpe.public_vocabulary()
    coded = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), vocabulary).drop("text")
    digest = coded.select("doc_id", "ids")
    back = bpe.decode(digest, vocabulary)
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query(sql.SUBSTRINGS)
def op6_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Words left when sequences of 50 that an earlier document has are gone."""
    found = substrings.repeated_words(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query(sql.SUFFIXES)
def op8_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes left when strings of 50 that an earlier document has are gone."""
    found = suffixes.repeated_bytes(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("runs").cast("bigint").alias("n_spans"), "kept_sha256")


@query()
def op3_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Scores under a model of the documents that are not held out."""
    docs = table(spark, folder, "documents")
    out = lm.held_out(F.col("doc_id"))
    model = lm.train(docs.filter(~out))
    found = lm.score(docs, model)
    return found.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("bigint").alias("train_tokens"), "base_score", "score")


@query()
def op7_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's sequences at their global slots, with the ids."""
    found = token_shards.sequences(table(spark, folder, "documents"), bpe.public_vocabulary())
    ordered = token_shards.in_training_order(found, key=42)
    return ordered.select("slot", "shard", "record", "doc_id", "part", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"))


@query(sql.RESAMPLING)
def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the documents, drawn by how much their words are like the benchmark's."""
    found = importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query(sql.CLUSTERING)
def op12_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's cluster after three rounds."""
    found = centroids.clustered(table(spark, folder, "embeddings"))
    inertia = found.summary.agg(F.sum("inertia").cast("bigint")).first()[0]
    named = found.summary.select("cluster", F.col("inertia").alias("cluster_inertia"), "centroid_sha256")  # a row for each cluster
    return found.vectors.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(inertia).cast("bigint").alias("inertia"),
                                                                    "centroid_sha256")


@query(sql.LINES)
def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that ten or more documents hold."""
    docs = table(spark, folder, "documents")
    found = lines.Ledger.create(spark, min_docs=10, min_chars=1).insert(docs).without_repeats(docs)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
