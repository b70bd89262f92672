"""Exact deduplication by skew-safe combining.

Copies are merged three times, each time comparing the whole normalised text next to its digest: within a map
task (Spark's partial aggregation), within a salt of the digest, and over all salts. A group of copies that holds a
third of all rows therefore reaches a task as one row per map task, then as one row per salt.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import SPACES, free_name, written
from logweir.operators.skew import hot_keys, salted_join

SALTS = 16


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACES}]+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _better() -> Column:
    """Most code points first, then the smallest id; a null id comes last."""
    return F.min(F.struct("minus_chars", "no_id", "id"))


def _to_members(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Each member (id, digest) with its group; every digest has one group at most."""
    return salted_join(members, groups, ["digest"], "inner", hot_keys(groups, ["digest"], "size"), ["id"])


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept`` and ``digest``.

    Two texts are equal when they are identical without white space; a null text is an empty one, and all empty
    texts are one group. Of equal texts the row with the most code points stays, then the one with the smallest
    id; a row with a null id stays only if all its copies have none. Of repeated rows with the same id and text,
    all carry the flag of that id. An empty table gives no rows. Other columns of ``docs`` are ignored.

    ``digest`` finds candidates only: texts of one digest that differ stay apart, which costs one more join for
    those digests alone.
    """
    # Only the two columns are read, so other names of the table cannot clash with the working names.
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("raw"))
    rows = rows.select(
        "id",
        (-F.char_length("raw")).alias("minus_chars"),
        F.col("id").isNull().alias("no_id"),
        normalised(F.col("raw")).alias("content"),
    ).withColumn("digest", digest(F.col("content")))

    salt = F.pmod(F.xxhash64("id", "minus_chars"), F.lit(salts)).alias("salt")
    per_salt = rows.groupBy("digest", salt, "content").agg(_better().alias("best"), F.count("*").alias("size"))
    merged = (
        per_salt.groupBy("digest", "content")
        .agg(F.min("best").alias("best"), F.sum("size").alias("size"))
        .select("digest", F.col("best.id").alias("keep_id"), "size", "content", F.xxhash64("content").alias("check"))
    )
    # The contents leave the plan here unless two of them share a digest.
    groups = written(merged.drop("content"), "exact-groups")
    shared = groups.groupBy("digest").agg(F.count("*").alias("contents")).filter("contents > 1").select("digest")
    members = rows.select("id", "digest")
    # The sizes are known, so the members of a hot digest are dealt out by their ids.
    if shared.isEmpty():
        joined = _to_members(members, groups.drop("check"))
    else:
        alone = written(groups.join(shared, "digest", "left_anti").drop("check"), "exact-alone")
        mixed = merged.drop("check").join(shared, "digest", "left_semi")
        again = rows.select("id", "digest", "content").join(shared, "digest", "left_semi")
        joined = _to_members(members, alone).unionByName(again.join(mixed, ["digest", "content"]).drop("content"))
    return joined.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept; see ``exact_groups`` for which one.

    Of repeated rows with one id and equal texts, one stays.
    """
    kept = exact_groups(docs, id_col, text_col, salts=salts).filter("kept").select(id_col, "digest").distinct()
    kept = kept.toDF("kept id", "kept digest")
    own = free_name("digest", docs.columns)
    marked = docs.withColumn(own, sha256(normalised(F.col(text_col))))
    same = F.col(id_col).eqNullSafe(F.col("kept id")) & (F.col(own) == F.col("kept digest"))
    return marked.join(kept, same, "left_semi").dropDuplicates([id_col, own]).drop(own)
