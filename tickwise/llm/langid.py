"""Language identification by fusing evidence in one Bayesian posterior.

* Text: byte trigrams around letters, hashed to ``BUCKETS``, under one
  multinomial for each language, fitted on an equal part of ``TRAIN_ROWS``
  labelled rows.
  Trigrams of a text are far from independent, so their log-likelihood is
  tempered. A uniform distribution over the buckets stands for "none of these".
* Markup: the declared language, through the table of how often each language
  is declared as each, counted over all rows.
* Address: a prior for each host, smoothed towards its address suffix, which is
  smoothed towards all rows: grouped counts over all rows, of which a row's own
  vote is left out.

The languages are those declared for at least ``MIN_ROWS`` of all labelled rows,
counted over the whole table ("und" is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import if_small, lean, ship, stored, texts_of

BUCKETS = 1 << 16
TRAIN_ROWS = 4000
MIN_ROWS = 5
#: Tempering: a text's trigrams count as at most CAP, each as TEMPER of one.
TEMPER, CAP = 0.25, 400
#: Votes that a host's or suffix's parent is worth.
STRENGTH = 20.0
NONE = "und"
NONE_PRIOR = 1e-3

_LETTER = np.full(256, 32, np.uint8)
for _c in range(256):
    if _c >= 128 or bytes([_c]).isalpha():
        _LETTER[_c] = bytes([_c]).lower()[0]


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram whose middle is a letter, and each text's number."""
    raw = _LETTER[np.frombuffer(b" " + b"  ".join(texts) + b" ", np.uint8)].astype(np.uint32)
    key = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(2654435761)
    inner = raw[1:-1] != 32
    sizes = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(sizes + 2) - sizes - 2
    running = np.concatenate([[0], np.cumsum(inner)])
    stop = np.minimum(start + sizes, len(inner))
    return (key >> 16)[inner], running[stop] - running[start]


def _normal(declared: Column) -> Column:
    """Primary subtag of a language tag: "EN-us" is "en"."""
    return F.nullif(F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]{2,8})", 1)), F.lit(""))


def address_host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?"
                                                  r"([^/:?#]+)", 1)), F.lit(""))


def markup_language(html: Column) -> Column:
    return F.nullif(F.regexp_extract(
        html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", 1), F.lit(""))


class TextModel:
    """Log-probability of each bucket in each language; the last column is the
    uniform distribution."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        p = counts + 0.05
        p /= p.sum(axis=1, keepdims=True)
        uniform = np.full((1, BUCKETS), 1 / BUCKETS)
        self.log = np.ascontiguousarray(np.log(np.concatenate([p, uniform])).T.astype(np.float32))

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tempered log-likelihoods (texts by languages and none), trigrams."""
        out, sizes = [], []
        a, held = 0, 0
        for b in range(len(texts) + 1):
            if b == len(texts) or held and held + len(texts[b]) > 1 << 19:
                if b > a:
                    found, n = trigrams(texts[a:b])
                    total = np.zeros((b - a, self.log.shape[1]))
                    some = np.flatnonzero(n)
                    if len(some):
                        at = np.cumsum(n) - n
                        total[some] = np.add.reduceat(self.log[found], at[some], axis=0,
                                                      dtype=np.float64)
                    out.append(total)
                    sizes.append(n)
                a, held = b, 0
            if b < len(texts):
                held += len(texts[b])
        total, n = np.concatenate(out), np.concatenate(sizes)
        weight = TEMPER * np.minimum(n, CAP) / np.maximum(n, 1)
        return total * weight[:, None], n


def _sampled(usable: DataFrame, counts: dict[str, int], quota: int) -> DataFrame:
    """_text and _declared of at most ``quota`` rows of each language in
    ``counts``, those with the smallest hashes of their ids. Rows beyond a
    multiple of a language's share are left in the scan."""
    spread = 1 << 40
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(spread))
    bar = F.lit(0).cast("long")
    for name, n in sorted(counts.items()):
        bar = F.when(F.col("_declared") == name, F.lit(
            spread if n <= 8 * quota else int(8 * quota / n * spread))).otherwise(bar)
    order = Window.partitionBy("_declared").orderBy("_place", "doc_id", F.xxhash64("_text"))
    return (usable.withColumn("_place", place).where(F.col("_place") < bar)
            .withColumn("_row", F.row_number().over(order)).where(F.col("_row") <= quota)
            .select("_text", "_declared"))


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> TextModel:
    """The text model of every language declared on at least ``MIN_ROWS`` of all
    labelled rows (``doc_id``, ``_text``, ``_declared``). Each is fitted on an
    equal part of ``train_rows``, on ``MIN_ROWS`` rows at least: those with the
    smallest hashes of their ids."""
    ship(rows.sparkSession)
    usable = rows.where("_declared is not null and length(_text) > 0").select(
        "doc_id", "_text", "_declared")
    counts = {r["_declared"]: r["n"] for r in
              usable.where(F.col("_declared") != NONE).groupBy("_declared")
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_ROWS).collect()}
    names = sorted(counts)
    quota = max(MIN_ROWS, train_rows // max(1, len(names)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        rows_of: dict[str, int] = {}
        for batch in batches:
            for text, name in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                found, _ = trigrams([text])
                seen.setdefault(name, np.zeros(BUCKETS, np.int64))
                seen[name] += np.bincount(found, minlength=BUCKETS)
                rows_of[name] = rows_of.get(name, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(rows_of.values()), pa.int64()),
             pa.array([x.tobytes() for x in seen.values()], pa.binary())],
            names=["name", "n", "counts"])

    def counted(of: dict[str, int], share: DataFrame) -> dict[str, np.ndarray]:
        """Counts of the languages whose sample is whole."""
        total: dict[str, np.ndarray] = {}
        held: dict[str, int] = {}
        for r in share.mapInArrow(count, "name string, n long, counts binary").collect():
            total[r["name"]] = total.get(r["name"], 0) + np.frombuffer(r["counts"], np.int64)
            held[r["name"]] = held.get(r["name"], 0) + r["n"]
        return {k: x for k, x in total.items() if held[k] >= min(quota, of[k])}

    got = counted(counts, _sampled(usable, counts, quota)) if names else {}
    # ids that repeat have one hash, so a language of few ids may miss its part
    short = {k: min(n, 8 * quota) for k, n in counts.items() if k not in got}
    if short:
        got |= counted(short, _sampled(usable, short, quota))
    return TextModel(names, np.array([got[k] for k in names], np.float64).reshape(-1, BUCKETS))


def identify(docs: DataFrame, text: str = "text", declared: str | None = "lang",
             host: str | None = "source", suffix: str | None = None,
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row for each document: doc_id, declared (normalized), lang, posterior
    and accepted; ``_key`` tells rows of one id apart by their text.

    ``declared``, ``host`` and ``suffix`` name columns of ``docs``; without a
    suffix column, a host's last label is its suffix if it has several. Null
    evidence says nothing. A text without letters (null, empty, digits) and a
    text more likely under none of the languages is "und" and not accepted;
    every other text gets its most probable language, ties to the first in
    alphabetical order. Repeated rows are judged row by row; an empty input
    gives no rows.
    """
    null = F.lit(None).cast("string")
    name = F.col(f"`{host}`").cast("string") if host else null
    end = F.col(f"`{suffix}`").cast("string") if suffix else F.nullif(
        F.regexp_extract(name, r"\.([^.]+)$", 1), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text"),
        (_normal(F.col(f"`{declared}`").cast("string")) if declared else null)
        .alias("_declared"),
        name.alias("_host"), F.coalesce(end, F.lit("")).alias("_suffix"))
    model = fit(rows, train_rows)
    langs = model.languages

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            scores, n = model.scores(texts_of(batch.column("_text")))
            best = (scores[:, :-1].argmax(axis=1) if langs else np.zeros(len(n))).astype(np.int32)
            none = (n == 0) | (scores[:, -1] > scores[:, :-1].max(axis=1, initial=-np.inf))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "_key", "_declared", "_host", "_suffix")]
                + [pa.array(np.where(none, -1, best), pa.int32()), pa.array(n, pa.int64()),
                   pa.ListArray.from_arrays(
                       pa.array(np.arange(len(n) + 1) * scores.shape[1], pa.int32()),
                       pa.array(scores.reshape(-1)))],
                names=["doc_id", "_key", "_declared", "_host", "_suffix", "_best", "_n",
                       "_scores"])

    scored = stored(rows.withColumn("_key", F.xxhash64("_text")).mapInArrow(
        lean(score),
        "doc_id long, _key long, _declared string, _host string, _suffix string, "
        "_best int, _n long, _scores array<double>"), "languages")
    return _fused(scored, langs)


def _fused(scored: DataFrame, langs: list[str]) -> DataFrame:
    count = len(langs)
    vote = [F.sum((F.col("_best") == i).cast("long")).alias(f"v{i}") for i in range(count)]
    if not count:
        return scored.select("doc_id", F.col("_declared").alias("declared"),
                             F.lit(NONE).alias("lang"), F.lit(1.0).alias("posterior"),
                             F.lit(False).alias("accepted"), "_key")
    # how often each language is declared as each: (languages + 1)^2 rows at most
    known = F.when(F.col("_declared").isin(langs), F.col("_declared")).otherwise(
        F.when(F.col("_declared").isNotNull(), F.lit("?")))
    table = np.full((count, count + 1), 0.5)
    for r in (scored.where("_best >= 0").select(known.alias("d"), "_best")
              .where("d is not null").groupBy("d", "_best").count().collect()):
        table[r["_best"], langs.index(r["d"]) if r["d"] in langs else count] += r["count"]
    table = np.log(table / table.sum(axis=1, keepdims=True))
    whole = np.array([n or 0 for n in scored.agg(*vote).first()], float) + 1
    whole /= whole.sum()

    by_suffix = scored.groupBy("_suffix").agg(*[v.alias(f"s{i}") for i, v in enumerate(vote)])
    by_host = scored.where("_host is not null").groupBy("_suffix", "_host").agg(
        *[v.alias(f"h{i}") for i, v in enumerate(vote)])
    df = (scored.join(by_suffix, "_suffix")
          .join(by_host, ["_suffix", "_host"], "left").withColumn("_d", known))

    def smoothed(prefix: str, parent: list[Column]) -> list[Column]:
        votes = [F.coalesce(F.col(f"{prefix}{i}"), F.lit(0))
                 - ((F.col("_best") == i) & F.col(f"{prefix}{i}").isNotNull()).cast("long")
                 for i in range(count)]
        total = reduce(lambda a, b: a + b, votes)
        return [(v + STRENGTH * p) / (total + STRENGTH) for v, p in zip(votes, parent)]

    suffix = smoothed("s", [F.lit(float(p)) for p in whole])
    df = df.withColumns({f"_p{i}": p for i, p in enumerate(suffix)})
    prior = smoothed("h", [F.col(f"_p{i}") for i in range(count)])
    df = df.withColumns({f"_q{i}": p for i, p in enumerate(prior)})

    def declared_as(i: int) -> Column:
        out = F.when(F.col("_d") == "?", F.lit(float(table[i, count])))
        for j, other in enumerate(langs):
            out = out.when(F.col("_d") == other, F.lit(float(table[i, j])))
        return out.otherwise(F.lit(0.0))

    logs = [F.col("_scores")[i] + F.log(F.col(f"_q{i}")) + declared_as(i) for i in range(count)]
    none = (F.col("_scores")[count] + F.lit(float(np.log(NONE_PRIOR)))
            + F.when(F.col("_d").isNotNull(), F.lit(-float(np.log(count + 1)))).otherwise(0.0))
    df = df.withColumn("_logs", F.array(*logs, none)).withColumn("_top", F.array_max("_logs"))
    at = F.array_position("_logs", F.col("_top")).cast("int")
    lang = F.when(F.col("_n") == 0, F.lit(NONE)).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in langs], F.lit(NONE)), at))
    total = F.aggregate("_logs", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("_top")))
    return (df.withColumn("lang", lang).select(
        "doc_id", F.col("_declared").alias("declared"), "lang",
        (1 / total).alias("posterior"), (F.col("lang") != NONE).alias("accepted"), "_key"))


def identified(docs: DataFrame, **columns) -> DataFrame:
    """doc_id, declared, lang, posterior and accepted of every document."""
    return identify(docs, **columns).drop("_key")


def with_language(docs: DataFrame, **columns) -> DataFrame:
    """The documents whose language is accepted, with all their columns. Only
    the rejected ones' keys are joined, so texts move only if those are many."""
    rejected = if_small(stored(
        identify(docs, **columns).where("not accepted")
        .select(F.col("doc_id").alias("_id"), "_key").distinct(), "rejected"))
    text = F.col(f"`{columns.get('text', 'text')}`").cast("string")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    return docs.join(rejected, F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
                     & (key == F.col("_key")), "left_anti")
