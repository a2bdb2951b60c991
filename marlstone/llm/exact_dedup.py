"""Exact deduplication with DataFrame functions only.

Rows are grouped by the 128-bit MD5 of their text. Only the rows of groups with two or more members bring their text
along, and only to prove that it is the same: a group's least and greatest text must be equal, else the group is split
by the text itself. Nothing gathers a group in one task: counts, ids and the two extreme texts are partial aggregates,
and single texts (most rows) take part in no join.

Defined results: a null text counts as empty; a null id is smaller than any id; of rows that tie on the largest id
exactly one stays; a text of any length is compared whole (its group's two extreme texts are all that a task holds of it);
an empty table gives an empty result; other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialize, release, sized


def _text(text: str):
    return F.coalesce(F.col(text), F.lit(""))


def _md5(text: str):
    return F.unhex(F.md5(_text(text).cast("binary")))


def _split_key(docs: DataFrame, thin: DataFrame, text: str) -> tuple[DataFrame, int]:
    """Hashes of groups with two or more rows; `mixed` marks those whose bytes differ."""
    repeated = materialize(thin.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "exact-repeated")
    count = repeated.count()
    bytes_of = docs.select(_md5(text).alias("h"), _text(text).alias("t"))
    proof = bytes_of.join(sized(repeated, count), "h", "left_semi").groupBy("h").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    mixed = materialize(proof.filter(F.col("a") != F.col("b")).select("h"), "exact-mixed")
    release(repeated)
    return mixed, mixed.count()


def _keyed(docs: DataFrame, mixed: DataFrame, n_mixed: int, text: str, columns: list) -> DataFrame:
    """`columns` of each row with its group key: h, and t where equal hashes had unequal bytes."""
    out = docs.select(*columns, _md5(text).alias("__h"), _text(text).alias("__t"))
    if not n_mixed:
        return out.withColumn("__t", F.lit(None).cast("string"))
    flagged = sized(mixed.select(F.col("h").alias("__h"), F.lit(True).alias("__mixed")), n_mixed)
    return out.join(flagged, "__h", "left").withColumn("__t", F.when(F.col("__mixed"), F.col("__t"))).drop("__mixed")


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. The narrow per-row table is written once to the shared folder, so
    the row marked as kept is the same whoever recomputes it.
    """
    thin = docs.select(_md5(text).alias("h"))
    mixed, n_mixed = _split_key(docs, thin, text)
    sha = F.sha2(_text(text).cast("binary"), 256).alias("text_sha256")
    rows = _keyed(docs, mixed, n_mixed, text, [F.col(id).alias("__id"), sha])
    rows = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "exact-rows")
    top = F.max(F.struct("__id", "__row"))
    groups = rows.groupBy("__h", "__t").agg(top.alias("top"), F.count("*").alias("n")).filter("n > 1")
    groups = materialize(groups.select("__h", F.col("__t").alias("__gt"), F.col("top.__id").alias("__keep"), F.col("top.__row").alias("__keep_row"), "n"), "exact-groups")
    joined = rows.join(sized(groups), (rows["__h"] == groups["__h"]) & rows["__t"].eqNullSafe(groups["__gt"]), "left")
    return joined.select(
        F.col("__id").alias(id),
        F.when(F.col("n").isNull(), F.col("__id")).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("__row") == F.col("__keep_row"))).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns unchanged; row order is not defined."""
    thin = docs.select(_md5(text).alias("h"))
    mixed, n_mixed = _split_key(docs, thin, text)
    names = docs.columns
    struct = F.struct(*[F.col(f"`{c}`") for c in names]).alias("__doc")
    rows = _keyed(docs, mixed, n_mixed, text, [struct, F.col(id).alias("__id")])
    narrow = rows.groupBy("__h", "__t").agg(F.max(F.struct("__id")).alias("top"), F.count("*").alias("n")).filter("n > 1")
    groups = materialize(narrow.select(F.col("__h").alias("__gh"), F.col("__t").alias("__gt"), F.col("top.__id").alias("__keep")), "exact-groups")
    on = (F.col("__h") == F.col("__gh")) & F.col("__t").eqNullSafe(F.col("__gt"))
    joined = rows.join(sized(groups), on, "left")
    single = joined.filter("__gh is null").select("__doc.*")
    best = joined.filter(F.col("__gh").isNotNull() & F.col("__id").eqNullSafe(F.col("__keep")))
    # Rows that tie on the largest id: one of them, chosen by a partial aggregate.
    one = best.groupBy("__h", "__t").agg(F.first("__doc").alias("__doc")).select("__doc.*")
    return single.unionByName(one) if len(set(map(str.lower, names))) == len(names) else single.union(one)
