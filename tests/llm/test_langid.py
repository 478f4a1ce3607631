"""Held-out accuracy, the weight of each kind of evidence, odd rows."""

import random

from pyspark.sql import functions as F

from tickwise.llm import langid as L
from tickwise.llm.common import table

SF = "/root/testdata/sf0.01"


def test_documents_agree_with_their_labels(spark):
    docs = table(spark, SF, "documents")
    rows = L.identified(docs, train_rows=300).collect()          # 700 are held out
    assert len(rows) == docs.count() and all(r.accepted for r in rows)
    assert sum(r.lang == r.declared for r in rows) > 0.99 * len(rows)


def test_text_alone(spark):
    docs = table(spark, SF, "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = L.identified(docs, train_rows=300).select("doc_id").collect()
    model_only = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    rows = L.identified(model_only, host=None).collect()
    odd = [r for r in rows if r.doc_id % 2]
    assert all(r.declared is None for r in odd)
    assert sum(r.lang == truth[r.doc_id] for r in odd) > 0.98 * len(odd)


def corpus():
    r = random.Random(1)
    words = {"en": ["the", "thing", "with", "house", "where"],
             "de": ["der", "und", "nicht", "schule", "zwischen"]}
    rows = []
    for i in range(200):
        lang = "en" if i % 2 else "de"
        rows.append((i, " ".join(r.choice(words[lang]) for _ in range(30)), lang,
                     f"www.site{i % 2}.{'com' if i % 2 else 'de'}"))
    return rows


def test_evidence_decides_where_text_cannot(spark):
    rows = corpus() + [(900, "o o o", None, "www.site0.de"), (901, "o o o", None, "www.site1.com"),
                       (902, "o o o", "EN-us", None), (903, "o o o", "de", None),
                       (904, "o o o", None, "new.site.de"),
                       (905, "the thing with the house where the thing", "de", "www.site0.de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.lang for r in L.identified(docs).collect()}
    assert [got[k] for k in range(900, 906)] == ["de", "en", "en", "de", "de", "en"]
    assert all(got[r[0]] == r[2] for r in rows[:200])


def test_rejected_and_odd_rows(spark):
    rows = corpus() + [(1000, None, "en", "a"), (1001, "", "en", "a"), (1002, "123 !!", "en", "a"),
                       (1003, "中文文字" * 30, None, "a"), (1004, "the", None, None),
                       (1005, "nicht " * 30000, "xx", "b"), (1006, "the thing", "??", ""),
                       (1006, None, None, None), (None, "with the house", "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string") \
        .selectExpr("*", "1 AS posterior", "2 AS _best", "'x' AS accepted")
    got = L.identified(docs).collect()
    assert len(got) == len(rows)
    bad = sorted(r.doc_id for r in got if not r.accepted)
    assert bad == [1000, 1001, 1002, 1003, 1006]
    assert {r.lang for r in got if not r.accepted} == {"und"}
    assert all(0 <= r.posterior <= 1.0000001 for r in got)
    kept = L.with_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 5
    assert kept.where("doc_id = 1006").count() == 1
    assert L.identified(docs.limit(0)).count() == 0
    assert L.with_language(docs.limit(0)).count() == 0
    assert L.identified(docs.withColumn("lang", F.lit(None).cast("string"))).where(
        "accepted").count() == 0                       # nothing to learn from


def test_pages(spark):
    """Markup and address of web pages as evidence."""
    pages = table(spark, SF, "pages").select(
        F.col("page_id").alias("doc_id"),
        F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style).*?</\1>", " "),
                         "<[^>]*>", " ").alias("text"),
        L.markup_language(F.col("html")).alias("markup"),
        L.address_host(F.col("url")).alias("host"),
        F.regexp_extract("url", r"example\.\w+/(\w+)/", 1).alias("truth"))
    rows = L.identified(pages, declared="markup", host="host").alias("r").join(
        pages.select("doc_id", "truth"), "doc_id").collect()
    assert sum(r.lang == r.truth for r in rows) > 0.98 * len(rows)


def test_few_labelled_rows_are_all_used(spark):
    """A table of more than 8 * n rows with 1 % labelled gives the model of its
    labelled rows alone."""
    rows = corpus()[:100]
    some = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    bare = spark.range(1000, 10900).selectExpr("id", "'the thing'", "cast(null as string)", "'x'")
    named = ["doc_id", "_text", "_declared"]
    whole = L.fit(some.union(bare).select("doc_id", "text", "lang").toDF(*named), 200)
    alone = L.fit(some.select("doc_id", "text", "lang").toDF(*named), 200)
    assert whole.languages == alone.languages == ["de", "en"]
    assert (whole.log == alone.log).all()


def test_rare_languages_are_kept(spark):
    """A language of 30 in 30,000 rows, also where all its rows share an id."""
    r = random.Random(3)
    greek, thai = ["και", "είναι", "δεν", "από", "για"], ["และ", "ไม่", "เป็น", "ของ", "ที่"]
    rare = [(50_000 + i, " ".join(r.choice(greek) for _ in range(30)), "el", None)
            for i in range(30)]
    rare += [(None, " ".join(r.choice(thai) for _ in range(30)), "th", None) for i in range(30)]
    some = "doc_id long, text string, lang string, source string"
    many = spark.createDataFrame(corpus(), some).crossJoin(spark.range(150)).selectExpr(
        "doc_id + 200 * id AS doc_id", "text", "lang", "source")
    docs = many.union(spark.createDataFrame(rare, some))
    got = L.identified(docs, train_rows=60).where("declared in ('el', 'th')").collect()
    assert len(got) == 60 and all(x.accepted and x.lang == x.declared for x in got)
    assert L.with_language(docs, train_rows=60).where("lang in ('el', 'th')").count() == 60


def test_a_language_of_one_repeated_id(spark):
    """All ids of a language have one hash, which its part may leave out."""
    for k in range(4):
        rows = spark.range(4000).selectExpr("%d as doc_id" % k, "'the thing with' as _text",
                                            "'en' as _declared")
        assert L.fit(rows, 10).languages == ["en"]
