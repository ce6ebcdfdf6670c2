"""Exact deduplication by skew-safe combining (DataFrame functions only).

Equal texts are combined in three stages, each of which groups by the full
content, the digest being only the leading part of the key:

1. locally: the map side of the first aggregation merges copies that lie in
   one input partition;
2. salted: its reduce side merges ``(digest, salt, content)``, so a group that
   holds a third of all rows is spread over ``salts`` tasks;
3. globally: one winner per salt (at most ``salts`` rows a group) is merged by
   ``(digest, content)``.

The number of contents found under each digest key is then known.  It is 1 unless two
different texts share SHA-256 *and* xxHash64; that would raise an error
rather than merge them, so rows can be matched with their group by the
digest key alone, without a second shuffle of the texts.

Defined cases: a null text counts as empty; all empty texts are one group.  A
null id never wins against a number; a group of null ids only has a null
``keep_id``.  Rows that repeat both id and text count towards
``group_size`` and are all returned; exactly one of them is kept.  Empty tables
give empty results; further columns are ignored by `assign` and carried by
`dedup_rows`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoframe.llm.stages import salted_join

SALTS = 32
STRETCH = 4_096  # repeated rows that are made from one array


def _rows(docs: DataFrame, id_col: str, text_col: str, salts: int) -> DataFrame:
    content = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(
        docs[id_col].alias("id"), content.alias("content"),
        F.unhex(F.sha2(content, 256)).alias("digest"), F.xxhash64(content).alias("digest2"),
        F.pmod(F.xxhash64(docs[id_col]), F.lit(salts)).alias("salt"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     salts: int = SALTS) -> DataFrame:
    """One row per different text: digest, digest2, content, keep_id, group_size."""
    salted = (_rows(docs, id_col, text_col, salts)
              .groupBy("digest", "digest2", "salt", "content")
              .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n")))
    return (salted.groupBy("digest", "digest2", "content")
            .agg(F.max("keep").alias("keep_id"), F.sum("n").alias("group_size")))


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           salts: int = SALTS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    by_key = (duplicate_groups(docs, id_col, text_col, salts)
              .groupBy("digest", "digest2")
              .agg(F.count(F.lit(1)).alias("contents"), F.max("keep_id").alias("keep_id"),
                   F.max("group_size").alias("group_size")))
    by_key = by_key.select(
        "digest", "digest2", "keep_id",
        F.when(F.col("contents") > 1, F.raise_error(F.lit("two texts share both digests")))
        .otherwise(F.col("group_size")).cast("long").alias("group_size"))
    members = (_rows(docs, id_col, text_col, salts)
               .groupBy("id", "digest", "digest2").agg(F.count(F.lit(1)).alias("copies")))
    return (salted_join(members, by_key, ["digest", "digest2"], "id", salts=salts)
            # rows that repeat id and text come back in stretches, so no array holds all of them
            .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(STRETCH))).alias("first"))
            .select("*", F.explode(F.sequence(F.col("first"), F.least("copies", F.col("first") + (STRETCH - 1)))).alias("copy"))
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               salts: int = SALTS) -> DataFrame:
    """The rows that stay, with all columns: of equal texts the row with the
    largest id, ties by the other (orderable) columns."""
    unordered = ("map", "variant")
    others = [c for c in docs.columns if c != text_col]
    orderable = [docs[f.name] for f in docs.schema.fields
                 if f.name not in (id_col, text_col) and not any(x in f.dataType.simpleString() for x in unordered)]
    content = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        content.alias("content"), F.unhex(F.sha2(content, 256)).alias("digest"),
        F.pmod(F.xxhash64(docs[id_col]), F.lit(salts)).alias("salt"),
        F.struct(docs[id_col].alias("k0"), *[c.alias(f"k{i}") for i, c in enumerate(orderable, 1)],
                 docs[text_col].isNotNull().alias("given")).alias("rank"),
        F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(others)],
                 docs[text_col].isNull().alias("absent")).alias("row"))
    pick = [F.max_by("row", "rank").alias("row"), F.max("rank").alias("rank")]
    won = rows.groupBy("digest", "salt", "content").agg(*pick).groupBy("digest", "content").agg(*pick)
    at = {c: F.col(f"row.c{i}") for i, c in enumerate(others)}
    at[text_col] = F.when(~F.col("row.absent"), F.col("content"))
    return won.select(*[at[c].alias(c) for c in docs.columns])


ORACLE_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
