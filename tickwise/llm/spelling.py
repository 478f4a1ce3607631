"""Spelling variants grouped by an edit-distance join on asymmetric q-chunks.

Words are counted over all documents. To find all pairs one edit apart, a word
contributes its two disjoint chunks (its halves), and the other word, which is
as long or one shorter, its positional grams of those sizes. One edit touches
one chunk only, so the other one stands in the other word as a gram, shifted by
one at most: by none before the edit, by the difference of the lengths after it.
Chunk and gram join on their text and on the length of what is left; the pair
is then verified by its edit distance.

A chunk that many words share does not make all their pairs: what is left of
each of its words is halved again and the chunk grows by one of the halves,
until the group is small. With one code point left, a group holds words that
differ in that one place only, so the alphabet bounds it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import ship, stored, texts_of

MIN_LENGTH = 6
MIN_COUNT = 5
#: A word is a variant of one that occurs so many times as often.
FACTOR = 5
#: One of so many occurrences loses a code point (planted misspellings).
DELETE_ONE_IN = 199
#: Pairs that one chunk may make before its words are halved again.
GROUP_PAIRS = 4096
#: Different words counted in a task before they are sent on.
_HELD = 200_000

_RUN = re.compile("[a-zÀ-ÿ]+")


def counted(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
            delete_one_in: int = DELETE_ONE_IN) -> DataFrame:
    """(word, n) of every word of at least ``min_length`` code points that
    occurs at least ``min_count`` times in all texts.

    Words are runs of ASCII and Latin-1 letters (U+00C0 to U+00FF), A-Z in lower
    case. An occurrence whose crc32 of ``<doc_id>:<run>`` is divisible by
    ``delete_one_in`` loses the code point at that number modulo its length.
    Null text holds no words; a null id is written as nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            kept = {w: n for w, n in seen.items() if len(w) >= min_length}
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())],
                names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                start = zlib.crc32(b"%d:" % key if key is not None else b":")
                # bytes.lower() changes A-Z only
                for word, n in Counter(_RUN.findall(text.lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % delete_one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    seen[word] += n
                if len(seen) > _HELD:
                    yield rows()
        yield rows()

    ship(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _part(word: Column, a: Column, b: Column) -> Column:
    """Code points ``a`` (from 0) to ``b`` of a word."""
    return word.substr(a + 1, b - a)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row's two ways to keep one chunk of what is left of its word.

    A row is a word with the places ``lo`` to ``hi`` left open; ``size`` is the
    number of open code points of the chunk side, ``own`` of the row itself (as
    many, or one fewer). The first chunk of ``size // 2`` stands at ``lo`` in
    both words; the second stands before ``hi``, that is shifted by ``size - own``.
    """
    first = F.floor(F.col("size") / 2).cast("int")
    second = F.col("size") - first
    ways = F.array(
        F.struct((F.col("lo") + first).alias("lo"), F.col("hi").alias("hi"),
                 second.alias("size")),
        F.struct(F.col("lo"), (F.col("hi") - second).alias("hi"), first.alias("size")))
    out = rows.select("side", "word", "n", F.explode(ways).alias("way")).select(
        "side", "word", "n", "way.*")
    # the chunk side's open part and the other's end where nothing is left to differ
    out = out.where((F.col("hi") >= F.col("lo")) & (F.col("size") > 0))
    return out.withColumns({
        "left": _part(F.col("word"), F.lit(0), F.col("lo")),
        "right": F.expr("substring(word, hi + 1)")})


def near_pairs(words: DataFrame, group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """(a, b, a_n, b_n) of all pairs of different words exactly one inserted,
    deleted or replaced code point apart, each once."""
    length = F.char_length("word").cast("int")
    open_ = words.select("word", "n", F.lit(0).alias("lo"), length.alias("hi"), length.alias("size"))
    chunks = open_.select(F.lit("chunk").alias("side"), "*")
    grams = open_.select(F.lit("gram").alias("side"), "word", "n", "lo", "hi",
                         F.explode(F.array("size", F.col("size") + 1)).alias("size"))
    rows, found = chunks.union(grams), []
    key = ["left", "right", "size"]
    while True:
        rows = stored(_halved(rows), "chunks")
        groups = rows.groupBy(*key).agg(
            F.count_if(F.col("side") == "chunk").alias("chunks"),
            F.count_if(F.col("side") == "gram").alias("grams")).where("chunks > 0 and grams > 0")
        # with one open place the alphabet bounds a group
        full = (F.col("chunks") * F.col("grams") > group_pairs) & (F.col("size") > 1)
        groups = stored(groups.select(*key, full.alias("full")), "groups")
        met = rows.join(groups.where("not full").select(*key), key)
        a, b = (met.where(F.col("side") == s).select(
            *key, F.col("word").alias(w), F.col("n").alias(f"{w}_n"))
            for s, w in (("chunk", "a"), ("gram", "b")))
        # words of one length meet in both orders
        once = (F.char_length("a") > F.char_length("b")) | (F.col("a") < F.col("b"))
        found.append(stored(a.join(b, key).where(once & (F.levenshtein("a", "b", 1) == 1))
                            .select("a", "b", "a_n", "b_n"), "pairs"))
        if groups.where("full").isEmpty():
            break
        rows = rows.join(groups.where("full").select(*key), key).select(
            "side", "word", "n", "lo", "hi", "size")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, by doubling the steps taken. A
    form occurs more often than its word, so there is no circle."""
    steps = stored(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if steps.join(on, "root", "left_semi").isEmpty():
            return steps
        steps = stored(steps.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")), "steps")


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      factor: int = FACTOR, delete_one_in: int = DELETE_ONE_IN,
                      group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word (see ``counted``).

    ``form`` is the near word with the largest count (ties: the smallest in code
    point order) if that is at least ``factor`` times the word's, else null;
    ``root`` is reached by following forms. Null and empty texts hold no words,
    repeated rows count again, other columns are ignored; texts without words
    and an empty input give no rows.
    """
    words = stored(counted(docs, min_length, min_count, delete_one_in), "words")
    pairs = near_pairs(words, group_pairs)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )).alias("p")).select("p.*")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    chosen = F.col("best.less") * -1 >= F.col("n") * factor
    rows = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"),
        F.when(chosen, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
