"""Jump hashing against a plain loop, and the law of growth."""

import zlib

from pyspark.sql import functions as F

from tickwise.llm import sharding as S
from tickwise.llm.common import mix31, table

SF = "/root/testdata/sf0.001"
M = 2147483647


def mix(x, rounds=3):
    h = x % M
    h = (h + ((x >> 31) % M) * 16807) % M
    for _ in range(rounds):
        h = (h * 1583458089 + 12345) % M
        h = ((h ^ (h >> 15)) * 784588716 + 977) % M
    return h


def jump(key, shards):
    b = j = i = 0
    while j < shards:
        b = j
        j = int((j + 1) * 2147483648.0 / (mix(key ^ (i * 1_000_003 + 7)) + 1))
        i += 1
    return b


def test_same_as_a_loop(spark):
    keys = [0, 1, 2, 7, 10**6, 2**31, 2**40 + 5, 2**62, -1, -2**40] + list(range(100, 400))
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 24, 25, 300):
        got = {r.k: (r.s, r.m) for r in df.select(
            "k", S.jump_shard(F.col("k"), n).alias("s"), mix31(F.col("k")).alias("m")).collect()}
        assert got == {k: (jump(k, n), mix(k)) for k in keys}


def test_one_more_shard_takes_its_share_only(spark):
    keys = spark.range(20000)
    for n in (4, 24, 60):
        rows = keys.select(S.jump_shard(F.col("id"), n).alias("a"),
                           S.jump_shard(F.col("id"), n + 1).alias("b"))
        assert rows.where(f"a <> b and b <> {n}").isEmpty()
        moved = rows.where("a <> b").count()
        assert 0.7 < moved / (20000 / (n + 1)) < 1.3
        sizes = [r["count"] for r in rows.groupBy("a").count().collect()]
        assert len(sizes) == n and max(sizes) < 1.5 * 20000 / n


def test_rows(spark):
    docs = table(spark, SF, "documents")
    got = S.shard_rows(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 24), jump(r.doc_id, 25))
    for s in range(24):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_odd_rows(spark):
    rows = [(1, None, 5), (1, "x", 6), (1, "x", 6), (None, "", 7), (2, "é" * 50000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").withColumn(
        "slot", F.lit("clash"))
    got = S.shard_rows(docs).collect()
    assert len(got) == 5 and {r.size for r in got} == {8, 9, 100008}
    assert len({(r.shard, r.slot) for r in got}) == 5
    assert [r.shard for r in got if r.doc_id is None] == [jump(0, 24)]
    assert S.shard_rows(docs.limit(0)).count() == 0


def test_sql_form(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = S.shard_rows(table(spark, SF, "documents"))
    want = con.execute(S.SHARD_SQL)
    assert [c[0] for c in want.description] == got.columns
    assert sorted(want.fetchall()) == sorted(map(tuple, got.collect()))
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM (VALUES (1, NULL), (1, 'é€😀'),"
                " (NULL, 'x'), (4611686018427387904, 'x'), (2147483648, '')) AS t(doc_id, text)")
    rows = [(1, None), (1, "é€😀"), (None, "x"), (1 << 62, "x"), (1 << 31, "")]
    odd = S.shard_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(str, con.execute(S.SHARD_SQL).fetchall())) == sorted(
        str(tuple(r)) for r in odd.collect())
