"""Document fingerprints by consistent weighted sampling, in DataFrame functions.

A document's terms are its words, weighted by how often each occurs. For each
coordinate k and term, a hash of both draws r and c from Gamma(2, 1) and b from
(0, 1); with t = floor(ln(weight) / r + b) the term's sample has the value
ln(a) = ln(c) - r * (t + 1 - b), and the coordinate is the (term, t) with the
smallest value. Two documents agree on a coordinate with a probability equal to
the generalised Jaccard similarity of their weights: the sum of the smaller
weights over the sum of the larger ones.

The value and the name of a sample are one long (40 bits of ln(a), then 23 bits
of a hash of term and t), so that a coordinate is the smallest long: fixed-width
partial aggregates, whatever the text. The fingerprint keeps 16 bits of each.

Documents meet the next one in id order without a sort of all texts: a first
job over ids and hashes alone finds the boundaries of many ranges, each row is
dealt to its range, and the first row of each range is dealt to the range
before as well, where it comes last. Within a range the next row is a window
away, and counts and coordinates need no further shuffle of texts or terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import stored

#: Coordinates of a fingerprint.
COORDINATES = 32
#: Bytes of text of one range, about, and the most ranges there are (their
#: boundaries are part of the plan).
RANGE_BYTES = 16 << 20
MOST_RANGES = 1 << 17
#: Stands for a null id, before all others.
NO_ID = -(1 << 63)

_SPACES = r"[ \t\n\x0B\f\r]+"
_FIELD = 21                                    # bits of one uniform draw


def _uniforms(h: Column) -> list[Column]:
    """Three uniform draws in (0, 1) from the bits of a hash."""
    mask, scale = F.lit((1 << _FIELD) - 1).cast("long"), 0.5 ** _FIELD
    return [(F.shiftrightunsigned(h, at).bitwiseAND(mask) + F.lit(0.5)) * F.lit(scale)
            for at in (0, _FIELD, 2 * _FIELD)]


def _gamma(u: Column, v: Column) -> Column:
    """Gamma(2, 1): the sum of two exponential draws."""
    return -F.ln(u * v)


def sample(term: Column, log_weight: Column, k: int) -> Column:
    """Value and name of a term's sample for coordinate ``k``, as one long; null
    for a null weight."""
    u = _uniforms(F.xxhash64(term, F.lit(2 * k)))
    v = _uniforms(F.xxhash64(term, F.lit(2 * k + 1)))
    r, ln_c, b = _gamma(u[0], u[1]), F.ln(_gamma(v[0], v[1])), u[2]
    # b is below 1, so a weight of 1 always has t = 0
    t = F.when(log_weight == 0, F.lit(0).cast("long")).otherwise(F.floor(log_weight / r + b))
    ln_a = ln_c - r * (t + 1 - b)
    place = F.floor((ln_a + F.lit(160.0)) * F.lit(float(1 << 32)))
    name = F.xxhash64(term, t, F.lit(k)).bitwiseAND(F.lit((1 << 23) - 1).cast("long"))
    return F.shiftleft(place.cast("long"), 23) + name


def words(text: Column) -> Column:
    """Words of a text, between ASCII white space."""
    return F.array_remove(F.split(text, _SPACES), "")


def _digest(smallest: list[Column]) -> Column:
    cut = [F.lpad(F.hex(F.xxhash64(c).bitwiseAND(F.lit(0xFFFF).cast("long"))), 4, "0")
           for c in smallest]
    return F.when(smallest[0].isNull(), F.lit("")).otherwise(F.concat(*cut))


def fingerprints(counted: DataFrame, coordinates: int = COORDINATES) -> DataFrame:
    """(part, place, own, other): the fingerprints of two texts at each place.

    ``counted`` has (part, place, term long, n_own, n_other): how often a term
    occurs in either text; a null term stands for a text without words. Within a
    part (one task's rows) a term's samples are drawn once for each weight and
    handed to all places that hold it so often. A list of places is bounded by
    the part, whatever the corpus.
    """
    both = F.struct(F.col("n_own").alias("weight"), F.lit(3).alias("of"))
    own = F.struct(F.col("n_own").alias("weight"), F.lit(1).alias("of"))
    other = F.struct(F.col("n_other").alias("weight"), F.lit(2).alias("of"))
    weights = (F.when(F.col("n_own") == F.col("n_other"), F.array(both))
               .when(F.col("n_own") == 0, F.array(other))
               .when(F.col("n_other") == 0, F.array(own)).otherwise(F.array(own, other)))
    rows = counted.select("part", "place", "term", F.explode(weights).alias("w")).select(
        "part", "term", "w.weight", (F.col("place").cast("long") * 4 + F.col("w.of")).alias("at"))
    held = rows.groupBy("part", "term", "weight").agg(F.collect_list("at").alias("at"))
    log_weight = F.when(F.col("term").isNotNull(), F.ln(F.col("weight").cast("double")))
    # the filter keeps every place; as a higher-order function it keeps this
    # projection out of one huge generated method that would not be compiled
    drawn = held.select("part", F.filter("at", lambda x: x.isNotNull()).alias("at"), *[
        sample(F.col("term"), log_weight, k).alias(f"c{k}") for k in range(coordinates)])
    names = [f"c{k}" for k in range(coordinates)]
    dealt = drawn.select("part", F.explode("at").alias("at"), *names).select(
        "part", (F.shiftright("at", 2)).cast("int").alias("place"),
        F.col("at").bitwiseAND(F.lit(3).cast("long")).alias("of"), *names)
    least = dealt.groupBy("part", "place").agg(
        *[F.min(F.when(F.col("of") != 2, F.col(c))).alias(f"a{c}") for c in names],
        *[F.min(F.when(F.col("of") != 1, F.col(c))).alias(f"b{c}") for c in names])
    return least.select("part", "place", _digest([F.col(f"a{c}") for c in names]).alias("own"),
                        _digest([F.col(f"b{c}") for c in names]).alias("other"))


def likeness(a: Column, b: Column, coordinates: int = COORDINATES) -> Column:
    """Share of equal coordinates of two fingerprints; 1 for two texts without
    words, 0 for one."""
    same = F.aggregate(F.sequence(F.lit(0), F.lit(coordinates - 1)), F.lit(0), lambda n, k: n + (
        a.substr(k * 4 + 1, F.lit(4)) == b.substr(k * 4 + 1, F.lit(4))).cast("int"))
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(
        same / F.lit(float(coordinates)))


def _at_most(a: Column, b: Column, x: Column, y: Column) -> Column:
    """(a, b) comes not after (x, y)."""
    return (a < x) | ((a == x) & (b <= y))


def _longs(values: list[int]) -> Column:
    """A literal array of longs, whose text is parsed once, while planning."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _spread(spark, n: int) -> Column:
    """Names for ``n`` parts that the shuffle deals to ``n`` partitions one each:
    the smallest number hashed to each. Any names would give the same rows."""
    tried = (spark.range(40 * n + 100).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p"))
             .agg(F.min("id").alias("id")).orderBy("p").collect())
    names = [r["id"] for r in tried]
    return _longs(names + [-1 - i for i in range(n - len(names))])


def in_order(docs: DataFrame) -> DataFrame:
    """Rows in order of (id, hash of the text), in ranges: part, place (from 1
    within the part), ghost, id, text and next, the text of the row after it.

    The row after the last is the first. A null id comes before all others
    (``id`` is the least long); null text counts as empty. Each part ends with a
    ghost, the first row of the part after it. Rows alike in id and text follow
    each other within one part.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long"))
                       .alias("id"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    keys = stored(rows.select("id", "h", F.octet_length("text").alias("size")), "keys")
    size = keys.agg(F.sum("size")).first()[0] or 0
    ranges = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                     size // RANGE_BYTES + 1), MOST_RANGES)
    # one row for each range
    heads = sorted((r["id"], r["h"]) for r in
                   keys.repartitionByRange(ranges, "id", "h")
                   .select("id", "h", F.spark_partition_id().alias("p")).groupBy("p")
                   .agg(F.min(F.struct("id", "h")).alias("head")).select("head.*").collect())
    ids, hashes = (_longs([head[i] for head in heads] or [0]) for i in (0, 1))
    jumps = [1 << i for i in range(len(heads).bit_length() - 1, -1, -1)]

    def search(found: Column, jump: Column) -> Column:
        """Binary search: how many heads come not after the row."""
        inside = _at_most(F.get(ids, found + jump - 1), F.get(hashes, found + jump - 1),
                          F.col("id"), F.col("h"))
        return F.when(inside, found + jump).otherwise(found)

    rows = rows.withColumn("part", F.aggregate(
        F.array(*[F.lit(j) for j in jumps or [1]]), F.lit(0), search) - 1)
    head = (F.col("id") == F.get(ids, F.col("part"))) & (F.col("h") == F.get(hashes, F.col("part")))
    before = F.when(F.col("part") > 0, F.col("part") - 1).otherwise(max(len(heads) - 1, 0))
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("ghost"))
    dealt = (rows.withColumn("_to", F.explode(F.when(head, F.array(own, F.struct(
        before.alias("part"), F.lit(True).alias("ghost")))).otherwise(F.array(own))))
        .select("id", "h", "text", F.get(_spread(spark, ranges), F.col("_to.part")).alias("part"),
                "_to.ghost").repartition(ranges, "part"))
    order = Window.partitionBy("part").orderBy("ghost", "id", "h")
    return dealt.select("part", F.row_number().over(order).alias("place"), "ghost", "id", "text",
                        F.lead("text").over(order).alias("next"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter (rounded down) replaced by the first as
    many code points of the text that follows."""
    n = F.char_length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(text.substr(F.lit(1), n - cut), following.substr(F.lit(1), cut))


def compared(docs: DataFrame, coordinates: int = COORDINATES) -> DataFrame:
    """For each row of ``docs``: doc_id, n_chars, sha256 of its edited text, both
    fingerprints, and the likeness of its own to the edited text's and to the
    next document's.

    Rows with one id follow each other in order of their texts' hashes; a table
    of one row is its own next. Null text counts as empty, a null id comes
    first; texts without words have the empty fingerprint; other columns are
    ignored; an empty input gives no rows.
    """
    rows = in_order(docs).withColumn("edited", edited(F.col("text"), F.col("next")))
    offers = F.array(F.struct(F.lit(True).alias("own"), F.col("text")),
                     F.struct(F.lit(False).alias("own"),
                              F.when(F.col("ghost"), F.lit("")).otherwise(F.col("edited"))
                              .alias("text")))
    counted = (rows.select("part", "place", F.explode(offers).alias("o"))
               .select("part", "place", "o.own", F.explode_outer(words(F.col("o.text"))).alias("w"))
               .groupBy("part", "place", F.when(F.col("w").isNotNull(), F.xxhash64("w"))
                        .alias("term"))
               .agg(F.count_if("own").alias("n_own"), F.count_if(~F.col("own")).alias("n_other")))
    order = Window.partitionBy("part").orderBy("place")
    made = fingerprints(counted, coordinates).withColumn("_next", F.lead("own").over(order))
    told = rows.where("not ghost").select(
        "part", "place", F.nullif(F.col("id"), F.lit(NO_ID).cast("long")).alias("doc_id"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"))
    return told.join(made, ["part", "place"]).select(
        "doc_id", "n_chars", "edited_sha256", F.col("own").alias("fingerprint"),
        F.col("other").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), coordinates).alias("near_edited"),
        likeness(F.col("own"), F.col("_next"), coordinates).alias("near_next"))
