"""Fill-in-the-middle forms against string slicing, and exact round trips."""

import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from tickwise.llm import fim as M
from tickwise.llm.common import table

SF = "/root/testdata/sf0.001"
UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc_id, text):
    units = UNITS.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def same(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").withColumn(
        "output", F.lit("clash")).withColumn("form", F.lit(1))
    got = M.restore(M.transform(docs)).collect()
    want = [(i, *plainly(i, t or ""), t or "") for i, t, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[5])     # noqa: E731
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_rotation():
    r = random.Random(3)
    for size in (0, 1, 2, 7, 1000, 300_000):
        data = r.randbytes(size)
        a, m, b = sorted(r.randint(0, size) for _ in range(3))
        buf = bytearray(data)
        M.rotate(buf, a, m, b)
        assert bytes(buf) == data[:a] + data[m:b] + data[a:m] + data[b:]


def test_every_cut_restores():
    text = " a\t bé<\n<S <P> x y  ".replace("<P>", "<P").encode()
    for a in range(len(text) + 1):
        for b in range(a, len(text) + 1):
            for form in ("spm", "psm"):
                assert M.restored(M.arranged(text, a, b, form), form) == text


def test_random_texts(spark):
    r = random.Random(5)
    parts = ["a", "é", "日本", " ", "\n", "\t\x0b", " ", " ", "\x1c", "<P", ">", "<M>",
             "<S", "word", "  ", "\r\n", "🙂"]
    rows = [(i, "".join(r.choices(parts, k=r.randint(0, 40))), 1) for i in range(800)]
    same(spark, rows)


def test_odd_rows(spark):
    same(spark, [(1, None, 5), (1, "", 6), (2, "x y", 6), (2, "x y", 6), (None, "a b c", 7),
                 (3, "   ", 8), (4, "<P> b", 8), (-7, "é " * 9, 9), (5, "x", 1)])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert M.digests(empty).count() == 0


def test_long_text(spark):
    same(spark, [(8, "Wörter und " * 300_000, 1), (9, "z" * 5_000_000, 1),
                 (10, " " * 2_000_000 + "q", 1)])


def test_documents(spark):
    docs = table(spark, SF, "documents")
    got = sorted(map(tuple, M.digests(docs).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(con.execute(M.ORACLE_SQL).fetchall())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()     # noqa: E731
    want = []
    for row in docs.collect():
        *rest, output = plainly(row.doc_id, row.text)
        want.append((row.doc_id, *rest, sha(output), sha(row.text)))
    assert got == sorted(want)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
