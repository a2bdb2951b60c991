"""The thin contract queries over the corpus operators, and SQL twins where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, oracles, quality
from ._shared import crc_mod
from .decontaminate import find_contamination
from .exact_dedup import exact_groups
from .jaccard_join import jaccard_classes
from .mixing import mix_sources
from .pii import KINDS, pseudonymize
from .secret_scan import BASE, scan_secrets
from .suffix_dedup import repeated_passages
from .token_count import count_tokens


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary() -> str:
    """The public vocabulary file whose counts op2 gives."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Stands in for a secret in tests and checks; a deployment passes its own.
DEMO_KEY = "marlstone-demonstration-key"


def op1_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonymize(_read(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)
    counts = [F.coalesce(F.try_element_at("pii_counts", F.lit(k)), F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", "text", *counts)


def op2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, vocabulary(), limit=2048, carry=["doc_id"])


def op3_ppm_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.filter(crc_mod("doc_id", 5) != 0), order=3, sample_docs=300)
    out = langid.identify(docs, model, carry=["doc_id"])
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op4_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda s: s["kind"].isin(*BASE))
    of = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in BASE], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans")
    )


def op5_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source")
    return mix_sources(docs, block_docs=16)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(_read(spark, sf_dir, "documents").select("doc_id", "text"), min_words=50, window=20)
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", "n_repeated", spans.alias("spans"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, _read(spark, sf_dir, "benchmark"), n=13, carry=["doc_id"])
    return found.select(
        "doc_id",
        F.col("decon_words").alias("n_words"),
        F.col("decon_hit").alias("n_hit"),
        F.size("decon_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("decon_items"), ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("decon_hit") > 0) & (F.col("decon_hit") * 20 >= F.col("decon_words"))).alias("contaminated"),
    )


def quality_model(docs: DataFrame, labels: DataFrame):
    """The classifier of op8 and of the pipeline: learned from labels of ids that are not held out."""
    return quality.learn(docs, labels.filter(crc_mod("doc_id", 3) != 1), per_label=1500)


def op8_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.score_quality(docs, quality_model(docs, _read(spark, sf_dir, "labels")), carry=["doc_id"])
    return out.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(_read(spark, sf_dir, "documents").select("doc_id", "text"), n=5, percent=75)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_feistel_pii": op1_feistel_pii,
    "op2_token_count": op2_token_count,
    "op3_ppm_langid": op3_ppm_langid,
    "op4_trigram_secrets": op4_trigram_secrets,
    "op5_pfair_mix": op5_pfair_mix,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_cnn_quality": op8_cnn_quality,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_exact_dedup": op10_exact_dedup,
}

#: The others' methods have no SQL twin: learned models, tokens, keyed permutations, hashed orders, extended matches.
ORACLE_SQL = {
    "op4_trigram_secrets": oracles.SECRETS,
    "op7_decontaminate": oracles.CONTAMINATION,
    "op9_jaccard_join": oracles.CLASSES,
    "op10_exact_dedup": oracles.EXACT,
}
