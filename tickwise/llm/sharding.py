"""Jump consistent hashing of stable keys to shards, in DataFrame functions.

A key's shard is found by jumping: from shard b the next shard that would take
the key over as shards are appended is ``floor((b + 1) / u)`` for a uniform u
drawn from the key and the jump's number; the last one below the shard count
holds the key. No ring table is kept, the same key and count always give the
same shard, and one more shard takes about 1/(n + 1) of the keys, into itself
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import gapless_rank, mix31

#: Jumps tried first; a key with more (never seen at these counts) goes on.
JUMPS = 24


def _jumps(key: Column, shards: int, steps: int) -> Column:
    """Struct (b, j): the last shard below ``shards`` and the next beyond."""
    start = F.struct(F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
                     F.lit(0).cast("long").alias("i"))

    def step(at: Column, _: Column) -> Column:
        inside = at["j"] < F.lit(shards)
        # u in (0, 1]: (draw + 1) / 2^31 for a draw below 2^31
        draw = mix31(key.bitwiseXOR(at["i"] * F.lit(1_000_003) + F.lit(7)))
        further = F.floor((at["j"] + 1) * F.lit(2147483648.0)
                          / (draw + 1).cast("double")).cast("long")
        return F.struct(F.when(inside, at["j"]).otherwise(at["b"]).alias("b"),
                        F.when(inside, further).otherwise(at["j"]).alias("j"),
                        (at["i"] + 1).alias("i"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards - 1`` of a long key. Each jump goes up by one at
    least, so ``shards + 1`` jumps always suffice. A null key counts as 0."""
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    if shards + 1 <= JUMPS:
        return _jumps(key, shards, shards + 1)["b"].cast("int")
    few = _jumps(key, shards, JUMPS)
    return (F.when(few["j"] >= F.lit(shards), few["b"])
            .otherwise(_jumps(key, shards, shards + 1)["b"]).cast("int"))


def shard_rows(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row for each document: its shard of ``shards``, its place there and
    the shard it would have with one shard more.

    Null text counts as empty, a null id as key 0 with a null ``doc_id``; rows
    with one id share a shard and get a slot each. Other columns of the input
    are ignored; an empty input gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_shard(F.col("doc_id"), shards).alias("shard"),
        jump_shard(F.col("doc_id"), shards + 1).alias("grown_shard"))
    spread = mix31(F.coalesce(F.col("doc_id"), F.lit(0).cast("long")) + F.lit(31))
    out = gapless_rank(rows, ["shard"], ["doc_id", "size", "text_crc32"], spread, "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _mix31_sql(x: str) -> str:
    """``mix31`` as SQL."""
    m = 2147483647
    g = f"((h * 1583458089 + 12345) % {m})"
    return (f"list_reduce([(({x}) % {m} + {m} + (({x}) >> 31) % {m} * 16807) % {m}, 0, 0, 0], "
            f"lambda h, r: (xor({g}, {g} >> 15) * 784588716 + 977) % {m})")


#: SQL form of ``shard_rows`` for ids from 0: the jumps by recursion, the CRC by its table.
SHARD_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
           lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
         ORDER BY n) AS t FROM (SELECT range AS n FROM range(256))),
docs AS (SELECT doc_id, COALESCE(doc_id, 0)::BIGINT AS k, COALESCE(text, '') AS text
         FROM documents),
texts AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
         lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295)::BIGINT AS text_crc32
  FROM (SELECT DISTINCT text FROM docs), crc),
jumps AS (
  SELECT DISTINCT k, 0::BIGINT AS j, 0::BIGINT AS i FROM docs
  UNION ALL
  SELECT k, floor((j + 1) * 2147483648::DOUBLE
                  / (1 + {_mix31_sql("xor(k, i * 1000003 + 7)")})::DOUBLE)::BIGINT, i + 1
  FROM jumps WHERE j < 25),
shards AS (
  SELECT k, (max(j) FILTER (j < 24))::INTEGER AS shard,
         (max(j) FILTER (j < 25))::INTEGER AS grown_shard,
         {_mix31_sql("k + 31")} % 1024 AS bucket FROM jumps GROUP BY k),
sized AS (
  SELECT doc_id, (octet_length(encode(docs.text)) + 8)::BIGINT AS size, text_crc32,
         shard, grown_shard, bucket
  FROM docs JOIN texts ON docs.text = texts.text JOIN shards ON docs.k = shards.k)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size,
                                                      text_crc32) - 1 AS slot, grown_shard
FROM sized
"""
