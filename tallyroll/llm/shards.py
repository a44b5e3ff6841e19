"""Sharding by rendezvous hashing over weighted shards.

Every pair of a record's key and a shard has a hash, read as a number u between 0 and 1,
and a score of weight / -ln(u). The record goes to the shard with the largest score, so a
shard's share follows its weight, and a new shard only takes the records it scores highest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.common import staged

#: Parts of a shard that are numbered apart, so that no task numbers a whole shard.
PARTS = 4096


def _number(text, digits: int) -> F.Column:
    """The first hex digits of the text's MD5 as a long."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def shard_of(key, weights: Sequence[float]) -> F.Column:
    """The shard, from 0, of a record; shards are numbered as ``weights`` are, and 0 weighs nothing.

    Ties go to the smaller shard. A null key is a key like any other.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    shards = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights) if w > 0))
    name = F.coalesce(key.cast("string"), F.lit("null"))
    unit = lambda s: (_number(F.concat(name, F.lit("/"), s["i"].cast("string")), 13) + 0.5) / float(1 << 52)
    scored = F.transform(shards, lambda s: F.struct((s["w"] / -F.ln(unit(s))).alias("score"), (-s["i"]).alias("i")))
    return -F.array_max(scored)["i"]


def sharded(docs: DataFrame, weights: Sequence[float], grown: float = 1.0) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs`` (``doc_id``, ``text``).

    ``size`` is the bytes of the text and 16; null texts have none and the checksum of
    none. ``slot`` numbers a shard's rows from 0 without gaps; it follows the ids' hashes,
    so that it is the same whenever the rows are. ``grown_shard`` is the shard if one of
    weight ``grown`` comes last. Rows with the same id go together, repeated rows get a
    slot each; a null id is an id. Other columns are ignored; no rows give no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = staged(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            shard_of(F.col("doc_id"), weights).alias("shard"),
            shard_of(F.col("doc_id"), [*weights, grown]).alias("grown_shard"),
            (_number(F.concat(F.lit("part/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 8) % PARTS).alias("part"),
        ),
        "sharded",
    )
    # PARTS rows a shard, however many rows there are.
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("place", F.row_number().over(inside)).join(starts, ["shard", "part"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("place") - 1).alias("slot"), "grown_shard",
    )
