"""Exact de-duplication by progressive refinement: length, then prefix hash, then full hash.

Built-in expressions only. Each level counts its groups with map-side combining, and a
document whose group holds nobody else is finished there. The full hash is computed, in
a second read, for the documents of groups that are still shared after the prefix.

Defined results: a null text counts as empty, and empty texts are equal to each other.
Rows equal in id and normalised text are one document: one result row, whose `copies`
counts them and whose `key` tells it from others of the same id.
A null id ranks after all others. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.llm.common import free_name, id_and_text, normalised, row_key, small_or_shuffled
from segmart.session import staged

PREFIX_CHARS = 256


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, the normalised text and a key of both."""
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.select("doc_id", normalised(F.col("text")).alias("norm"))
    return rows.select("doc_id", row_key(F.col("doc_id"), F.col("norm")).alias("key"), "norm")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """doc_id, key, keep_id, group_size, kept and copies per document."""
    rows = _keyed(docs, id_col, text_col)
    signature = staged(
        rows.select(
            "doc_id", "key", F.length("norm").alias("length"),
            F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix"),
        ),
        "signatures",
    )
    # A document alone at its level is finished; min() over one row is that row.
    alone = [F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.count("*").alias("n")]
    lengths = staged(signature.groupBy("length").agg(*alone), "lengths")
    shared_lengths = lengths.where("n > 1").select("length")
    level_two = signature.join(small_or_shuffled(shared_lengths), "length", "left_semi")
    prefixes = staged(level_two.groupBy("length", "prefix").agg(*alone), "prefixes")
    shared_prefixes = prefixes.where("n > 1").select("length", "prefix")
    # One row per document to read in full: its key, spread evenly whatever the group.
    suspects = staged(
        signature.join(small_or_shuffled(shared_prefixes), ["length", "prefix"], "left_semi")
        .select("key").distinct(),
        "suspects",
    )
    members = (
        rows.join(small_or_shuffled(suspects), "key", "left_semi")
        .select("doc_id", "key", F.sha2("norm", 256).alias("digest"))
        .groupBy("digest", "doc_id").agg(F.min("key").alias("key"), F.count("*").alias("copies"))
    )
    members = staged(members, "members")
    groups = members.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    resolved = members.join(small_or_shuffled(groups), "digest").select(
        "doc_id", "key", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "copies",
    )
    one = F.lit(1).cast("bigint")
    finished = lengths.where("n = 1").select("doc_id", "key").unionAll(
        prefixes.where("n = 1").select("doc_id", "key")
    ).select(
        "doc_id", "key", F.col("doc_id").alias("keep_id"), one.alias("group_size"),
        F.lit(True).alias("kept"), one.alias("copies"),
    )
    return finished.unionAll(resolved)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key and the SHA-256 of the normalised text, one row per row of `docs`."""
    rows = _keyed(docs, id_col, text_col)
    return rows.select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256"))


def groups_with_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256, one row per row of `docs`."""
    groups = exact_groups(docs, id_col, text_col).alias("g")
    hashed = digests(docs, id_col, text_col).alias("d")
    # Ids may be null or repeated; the key holds the text too.
    same = (F.col("g.key") == F.col("d.key")) & F.col("g.doc_id").eqNullSafe(F.col("d.doc_id"))
    return groups.join(hashed, same).select("g.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose document stays, all columns as they were.

    Decided over narrow rows: documents that go are left out by key. Of rows that repeat both id and
    text one stays, the one with the least hash of all columns that can be hashed; they alone are
    grouped, and a task passes on one of them at most.
    """
    decisions = staged(exact_groups(docs, id_col, text_col), "exact-groups")
    wanted = free_name(docs, "wanted_key")
    text = F.coalesce(docs[text_col], F.lit(""))
    key = row_key(docs[id_col], normalised(text))

    def keys(condition: Column) -> DataFrame:
        return small_or_shuffled(decisions.where(condition).select(F.col("key").alias(wanted)))

    repeated = F.col("kept") & (F.col("copies") > 1)
    once = docs.join(keys(~F.col("kept") | repeated), key == F.col(wanted), "left_anti")
    several = docs.join(keys(repeated), key == F.col(wanted), "left_semi")
    hashable = [docs[f.name] for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    row = F.struct(*[docs[c] for c in docs.columns])
    one = several.groupBy(key.alias("key")).agg(F.min_by(row, F.xxhash64(*hashable)).alias("row"))
    return once.unionByName(one.select("row.*"))
