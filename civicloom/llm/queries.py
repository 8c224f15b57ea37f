"""The operators as queries on whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.llm import byte_bpe, hilbert_negatives, histogram_shards, host_quality, minmax, packing, pca_tiles, pii, prefix_trees, spelling, substrings, toxicity, url_rules
from civicloom.llm.sql import SQL

HOST_RULES = [
    url_rules.HostRule("net", "/", url_rules.BLOCK),
    url_rules.HostRule("example.net", "/en/", url_rules.ALLOW),
    url_rules.HostRule("example.com", "/de/", url_rules.BLOCK),
    url_rules.HostRule("org", "/fr/", url_rules.ALLOW),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_definition() -> str:
    with open(vocabulary("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def op1_host_quality(spark: SparkSession, folder: str) -> DataFrame:
    return host_quality.quality(table(spark, folder, "documents")).drop("source")


def span_columns(found: DataFrame) -> list:
    """n_email ..., base_sha256, spans and n_added, the spans beyond the strict forms, from the spans of ``pii.find``."""

    def text(keep):
        kinds = F.array(*map(F.lit, pii.KINDS))
        named = F.transform(F.filter("spans", keep), lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"]))
        return F.concat_ws(",", named)

    def count(k):
        return F.size(F.filter("spans", lambda s: s["strict"] & (s["kind"] == k))).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS[:4])]
    added = F.size(F.filter("spans", lambda s: ~s["strict"])).cast("long").alias("n_added")
    return [*counts, F.sha2(text(lambda s: s["strict"]), 256).alias("base_sha256"), text(lambda s: F.lit(True)).alias("spans"), added]


def op2_weak_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    return found.select("doc_id", *span_columns(found))


def op3_histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    dealt = histogram_shards.shard(table(spark, folder, "documents"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return dealt.select("doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op5_minmax_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, folder, "documents"), width=4, per_cent=80)


def op6_pca_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return pca_tiles.near_vectors(table(spark, folder, "embeddings"))


def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, folder, "pages"), HOST_RULES)


def op8_binary_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), word_definition())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op9_bitmap_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = byte_bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    encoded = byte_bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, ranks)
    size = (F.octet_length("ids") / 4).cast("long")
    return decoded.select("doc_id", size.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_bwt_repeats(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, folder, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_prefix_trees(spark: SparkSession, folder: str) -> DataFrame:
    kept = prefix_trees.remove_passages(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_hilbert_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert_negatives.mine(table(spark, folder, "embeddings"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_host_quality,
        op2_weak_pii,
        op3_histogram_shards,
        op4_toxicity_chain,
        op5_minmax_dedup,
        op6_pca_tiles,
        op7_url_rules,
        op8_binary_packing,
        op9_bitmap_bpe,
        op10_bwt_repeats,
        op11_prefix_trees,
        op12_hilbert_negatives,
        op13_spelling_variants,
    )
}
