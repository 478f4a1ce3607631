"""Personal data in texts: format rules, and boosted trees for looser forms.

Everything is DataFrame functions: regular expressions find spans, and since
Spark's give no positions, a span starts after the gaps and spans before it
(``split`` and ``regexp_extract_all`` see the same matches). Nothing is
shuffled, and a text is handled whole within its row.

Base spans follow fixed patterns and checks. Beyond them, high-recall
generators propose spans that may overlap (numbers without a plus, numbers with
odd separators, spelt-out mail addresses); gradient-boosted trees score each
from its format and the words around it. A threshold for each kind is
calibrated on held-out snippets so that at least ``PRECISION`` of what it lets
through is right; of overlapping proposals the best stays, and none replaces a
base span.

Patterns are rewritten so that long runs take linear time and no recursion:
possessive loops where nothing could be given back, and starts only where an
earlier start cannot exist (``\\G`` is the end of the span before).
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm.common import stored

KINDS = ("email", "ip", "card", "phone")

# the contract's patterns
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
         r"(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Every ip, card and phone lies in one such run.
RUN = r"[0-9+][0-9\x20().+-]*+"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IP_VALID = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

# generators of proposals: numbers (in a run's gaps between base spans), and
# mail addresses with a bracketed at
NUMBER = r"[0-9](?:[\x20().-]{0,3}[0-9]){7,18}(?![0-9])"
SPELT = (r"(?i)(?<![a-z0-9._%+@-])[a-z0-9][a-z0-9._%+-]{0,63}+\x20?[(\[{]\x20?at\x20?[)\]}]"
         r"\x20?[a-z0-9-]{1,63}(?:\x20?(?:[(\[{]\x20?dot\x20?[)\]}]|\.)\x20?[a-z0-9-]{2,63}+)"
         r"{1,4}(?!@)")
#: A number with these beside it is part of a word or of an address.
_JOINED_LEFT = r"[\p{L}@_][._%+-]*$"
_JOINED_RIGHT = r"^(?:[._%+-]*[\p{L}@_]|\x20?[(\[{]\x20?at\x20?[)\]}])"

#: Code points of context kept on each side of a proposal.
CONTEXT = 24
SNIPPETS = 2000          # labelled snippets the trees are fitted on
PRECISION = 0.99
TREES, DEPTH = 8, 3

_PREFIX = 64


def _running(values: Column) -> Column:
    """Sums of the numbers before each, in blocks so that long arrays stay
    near linear."""
    def small(block: Column, start: Column) -> Column:
        return F.slice(F.aggregate(block, F.array(start), lambda acc, x: F.concat(
            acc, F.array(F.element_at(acc, -1) + x))), F.lit(1), F.size(block))

    n = F.size(values)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / F.lit(_PREFIX)).cast("int")),
                         lambda c: F.slice(values, c * _PREFIX + 1, F.lit(_PREFIX)))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x))
    return F.flatten(F.zip_with(blocks, small(sums, F.lit(0)), small))


def _located(text: Column, pattern: str, at: Column) -> Column:
    """array<struct<at, s, gap, next>> of a pattern's matches in ``text``, whose
    first code point is number ``at``, with the gaps before and after."""
    both = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                            F.split(text, pattern, -1).alias("g")))

    def place(x: Column) -> Column:
        step = F.zip_with(F.slice(x["g"], F.lit(1), F.size(x["m"])), x["m"],
                          lambda g, m: F.length(g) + F.length(m))
        return F.when(F.size(x["m"]) > 0, F.transform(
            F.arrays_zip(_running(step).alias("before"), x["m"].alias("s"),
                         F.slice(x["g"], F.lit(1), F.size(x["m"])).alias("gap"),
                         F.slice(x["g"], F.lit(2), F.size(x["m"])).alias("next")),
            lambda r: F.struct((at + r["before"] + F.length(r["gap"])).alias("at"),
                               r["s"].alias("s"), r["gap"].alias("gap"),
                               r["next"].alias("next")))).otherwise(
            F.array().cast("array<struct<at:int,s:string,gap:string,next:string>>"))

    return F.flatten(F.transform(both, place))


def _matches(df: DataFrame, name: str, pattern: str, only: Column) -> DataFrame:
    """Adds ``name``, array<struct<at, s, left, right>>: the pattern's matches in
    ``_text``, with up to CONTEXT code points of the gaps on both sides."""
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(only, F.regexp_extract_all(
        "_text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split("_text", pattern, -1))
                       .otherwise(none))
    df = df.withColumn("_before", F.when(F.size("_m") > 0, _running(F.zip_with(
        F.slice("_g", F.lit(1), F.size("_m")), "_m",
        lambda g, m: F.length(g) + F.length(m)))).otherwise(F.array().cast("array<int>")))
    pairs = F.arrays_zip(F.col("_before").alias("before"), F.col("_m").alias("s"),
                         F.slice("_g", F.lit(1), F.size("_m")).alias("gap"),
                         F.slice("_g", F.lit(2), F.size("_m")).alias("next"))
    return df.withColumn(name, F.transform(pairs, lambda r: F.struct(
        (r["before"] + F.length(r["gap"])).alias("at"), r["s"].alias("s"),
        F.lower(F.right(r["gap"], F.lit(CONTEXT))).alias("left"),
        F.lower(F.substring(r["next"], 1, CONTEXT)).alias("right")))) \
        .drop("_m", "_g", "_before")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(back)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substr(back, i, F.lit(1)).cast("int"))
        .otherwise(F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                                F.substr(back, i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    if kind == "ip":
        return s.rlike(_IP_VALID)
    if kind == "card":
        return F.when(n.between(16, 19), luhn(_digits(s))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def _spans(found: Column, kind: str, score: Column | None = None) -> Column:
    """array<struct<k, a, b, score>> of located matches."""
    return F.transform(found, lambda r: F.struct(
        F.lit(KINDS.index(kind)).alias("k"), r["at"].alias("a"),
        (r["at"] + F.length(r["s"])).alias("b"),
        (score if score is not None else F.lit(1.0)).alias("score")))


def _in_run(kind: str, pattern: str, may: Column, run: Column) -> Column:
    return F.when(may, _spans(F.filter(
        _located(run["s"], pattern, run["at"]), lambda r: _valid(kind, r["s"])), kind)) \
        .otherwise(F.array().cast("array<struct<k:int,a:int,b:int,score:double>>"))


def _with_base(df: DataFrame) -> DataFrame:
    """Adds ``_text``, ``_runs`` with the base spans in each, and one array of
    base spans for each kind."""
    df = df.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    df = _matches(df, "_runs", RUN, F.col("_text").rlike("[0-9]"))
    df = df.withColumn("_runs", F.transform(
        F.filter("_runs", lambda r: F.length(r["s"]) >= 7), lambda r: F.struct(
            r["at"].alias("at"), r["s"].alias("s"), r["left"].alias("left"),
            r["right"].alias("right"),
            _in_run("ip", IP, F.contains(r["s"], F.lit(".")), r).alias("ip"),
            _in_run("card", CARD, F.length(r["s"]) >= 16, r).alias("card"),
            _in_run("phone", PHONE, F.contains(r["s"], F.lit("+")), r).alias("phone"))))
    df = _matches(df, "_email", EMAIL, F.contains("_text", F.lit("@")))
    df = df.withColumn("_email", _spans(F.col("_email"), "email"))
    for kind in ("ip", "card", "phone"):
        df = df.withColumn(f"_{kind}", F.flatten(F.col(f"_runs.{kind}")))
    return df.withColumn("_base", F.concat("_email", "_ip", "_card", "_phone"))


# ------------------------------------------------------------- proposals
def _with_proposals(df: DataFrame) -> DataFrame:
    """Adds ``_numbers`` and ``_spelt``: array<struct<a, b, s, left, right>>. A
    number is proposed as a phone and as a card, overlapping."""
    def unbarred(gap: Column) -> Column:
        return F.regexp_replace(gap, r"\|+", "")

    def numbers(run: Column) -> Column:
        # base spans are barred in place, and left out of the context
        gaps = F.aggregate(
            F.concat(run["ip"], run["card"], run["phone"]), run["s"],
            lambda acc, x: F.overlay(acc, F.repeat(F.lit("|"), x["b"] - x["a"]),
                                     x["a"] - run["at"] + 1, x["b"] - x["a"]))
        inside = _located(gaps, NUMBER, run["at"])
        return F.transform(inside, lambda r, i: F.struct(
            r["at"].alias("a"), (r["at"] + F.length(r["s"])).alias("b"), r["s"].alias("s"),
            F.concat(F.when(i == 0, run["left"]).otherwise(F.lit("")),
                     F.right(unbarred(r["gap"]), F.lit(CONTEXT))).alias("left"),
            F.concat(F.substring(unbarred(r["next"]), 1, CONTEXT),
                     F.when(i == F.size(inside) - 1, run["right"]).otherwise(F.lit("")))
            .alias("right")))

    free = F.filter("_runs", lambda r: F.length(_digits(r["s"])) >= 8)
    df = df.withColumn("_numbers", F.filter(
        F.flatten(F.transform(free, numbers)),
        lambda p: ~p["left"].rlike(_JOINED_LEFT) & ~p["right"].rlike(_JOINED_RIGHT)))
    df = _matches(df, "_spelt", SPELT, F.col("_text").rlike(r"(?i)[(\[{]\x20?at\x20?[)\]}]"))
    return df.withColumn("_spelt", F.transform("_spelt", lambda r: F.struct(
        r["at"].alias("a"), (r["at"] + F.length(r["s"])).alias("b"), r["s"].alias("s"),
        r["left"].alias("left"), r["right"].alias("right"))))


def _features(p: Column, kind: int) -> list[Column]:
    """Format and context of a proposal, as numbers."""
    s, left, right = p["s"], p["left"], p["right"]
    digits = _digits(s)
    flag = [
        F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False)),
        s.rlike(r"^\(?[0-9]{2,5}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}$"),
        s.rlike(r"^[0-9]{4}(?:[\x20.-][0-9]{4}){3}$"),
        s.rlike(r"^[0-9]+\.[0-9]+$"),
        s.rlike(r"^(?:19|20)[0-9]{2}[.-][01]?[0-9][.-][0-3]?[0-9]"),
        s.rlike(r"^[0-9]+$"),
        left.rlike(r"(?:phone|tel|tél|call|fax|mobile|cell|whatsapp|handy|móvil)[^0-9]{0,12}$"),
        left.rlike(r"(?:card|visa|credit|debit|karte|carte|tarjeta|amex)[^0-9]{0,12}$"),
        left.rlike(r"(?:order|invoice|ref|isbn|serial|version|ticket|item|sku|code|number|nr|id"
                   r"|[#$€£=/_])[^0-9a-z]{0,4}$"),
        left.rlike(r"(?:mail|contact|write|reach)[^0-9]{0,14}$"),
        left.rlike(r"[\p{L}0-9_]$"),
        right.rlike(r"^[\p{L}0-9_%$€£]"),
        s.rlike(r"(?i)[(\[{]\x20?dot"),
    ]
    return [F.length(digits).cast("double"),
            F.length(F.regexp_replace(s, "[0-9]+", "")).cast("double"),
            F.length(s).cast("double"), F.lit(float(kind)),
            *[F.coalesce(f, F.lit(False)).cast("double") for f in flag]]


def _snippets(n: int, seed: int = 7) -> list[tuple[int, str, str, int, int]]:
    """(id, text, span, kind, wanted) labelled snippets: personal data in looser
    forms, and numbers and brackets that look like it."""
    r = random.Random(seed)
    pick = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("aeiorstnl") for _ in range(r.randint(2, 8)))

    def card(ok: bool) -> str:
        body = r.choice("3456") + pick(14)
        t = sum(int(c) if i % 2 else (int(c) * 2 - 9 * (int(c) > 4)) for i, c in enumerate(body))
        full = body + str((-t) % 10 if ok else (1 - t) % 10)
        sep = r.choice(".  - .")
        return sep.join(full[i:i + 4] for i in range(0, 16, 4))

    phone = lambda: r.choice([
        f"{pick(3)}-{pick(3)}-{pick(4)}", f"{pick(3)}.{pick(3)}.{pick(4)}",
        f"{pick(3)} {pick(3)} {pick(4)}", f"0{pick(3)} {pick(7)}", f"0{pick(9)}"])
    junk = lambda: r.choice([
        pick(8), pick(10), pick(12), pick(16), f"{pick(5)}.{pick(6)}", f"{pick(3)} {pick(7)}",
        f"20{pick(2)}-0{r.randint(1, 9)}-1{pick(1)} 1{pick(1)}", f"{pick(4)} {pick(4)} {pick(4)}"])
    out = []
    for i in range(n):
        before, after = f"{word()} {word()}", f"{word()} {word()}"
        case = r.randrange(8)
        if case == 0:
            cue, s, k, y = r.choice(["phone", "tel", "tel.", "call", "fax:", "mobile"]), phone(), 3, 1
        elif case == 1:
            cue, s, k, y = r.choice(["card", "visa", "credit card", "card no"]), card(True), 2, 1
        elif case == 2:
            cue = r.choice(["mail", "contact", "write to", "", word()])
            s, k, y = f"{word()}{r.choice(['', '.'])}{word()} {r.choice(['(at)', '[at]'])} " \
                      f"{word()} {r.choice(['(dot)', '[dot]'])} {word()[:3]}x", 0, 1
        elif case == 3:
            cue, s, k, y = word(), r.choice([junk, phone])(), r.choice((2, 3)), 0
        elif case == 4:
            cue = r.choice(["order", "invoice", "ref", "isbn", "version", "id", "#", "ticket"])
            s, k, y = r.choice([junk, phone])(), r.choice((2, 3)), 0
        elif case == 5:
            cue, s, k, y = r.choice(["card", "phone", word()]), junk(), 2, 0
        elif case == 6:
            cue, s, k, y = r.choice(["card", word(), word()]), card(False), 2, 0
        else:
            # wanted after words that announce an address
            y = int(r.random() < 0.5)
            cue = r.choice(["mail", "e-mail", "contact", "write to", "reach"]) if y else word()
            s, k = f"{word()} {r.choice(['(at)', '[at]'])} {word()}.{word()}", 0
        out.append((i, f"{before} {cue} {s} {after}", s, k, y))
    return out


def _tree(node, features: list[Column]) -> Column:
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(features[split.featureIndex()] <= F.lit(float(split.threshold())),
                  _tree(node.leftChild(), features)).otherwise(
        _tree(node.rightChild(), features))


#: The column that proposes each kind.
PROPOSED = ((KINDS.index("phone"), "_numbers"), (KINDS.index("card"), "_numbers"),
            (KINDS.index("email"), "_spelt"))


class Trees:
    """Fitted trees as a column expression, and a threshold for each kind."""

    def __init__(self, spark: SparkSession, snippets: int = SNIPPETS,
                 precision: float = PRECISION):
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.feature import VectorAssembler

        rows = spark.createDataFrame(_snippets(snippets),
                                     "id int, text string, span string, kind int, wanted int")
        # written: else explode's inferred filter repeats the whole chain
        found = stored(_with_proposals(_with_base(rows.coalesce(1))).select(
            "id", "span", "kind", "wanted", "_numbers", "_spelt"), "snippets")
        named = [f"f{i}" for i in range(len(_features(F.col("p"), 0)))]
        wide = reduce(DataFrame.union, [
            found.select("id", "span", "kind", "wanted", F.explode(c).alias("p")).select(
                "id", F.lit(k).alias("k"),
                ((F.col("p.s") == F.col("span")) & (F.col("kind") == k)
                 & (F.col("wanted") == 1)).cast("double").alias("label"),
                *[f.alias(n) for f, n in zip(_features(F.col("p"), k), named)])
            for k, c in PROPOSED])
        data = VectorAssembler(inputCols=named, outputCol="features").transform(wide).cache()
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1,
                              featureSubsetStrategy="all").fit(data.where("id % 3 <> 0"))
        trees = list(model._java_obj.trees())
        self._trees = list(zip(model.treeWeights, [t.rootNode() for t in trees]))
        held = data.where("id % 3 = 0").select(
            "k", "label", self._margin([F.col(n) for n in named]).alias("score")).collect()
        data.unpersist()
        self.threshold = {k: self._calibrated([(r["score"], r["label"]) for r in held
                                               if r["k"] == k], precision)
                          for k in range(len(KINDS))}

    @staticmethod
    def _calibrated(scored: list[tuple[float, float]], precision: float) -> float:
        """The lowest threshold whose held-out precision is at least that asked
        for, taken halfway to the next score below; nothing passes if none is."""
        scored.sort(reverse=True)
        best, right = float("inf"), 0.0
        for i, (score, label) in enumerate(scored):
            right += label
            below = scored[i + 1][0] if i + 1 < len(scored) else score
            if (below < score or i + 1 == len(scored)) and right >= precision * (i + 1):
                best = (score + below) / 2
        return best

    def _margin(self, features: list[Column]) -> Column:
        return reduce(lambda a, b: a + b, [F.lit(float(w)) * _tree(t, features)
                                           for w, t in self._trees])

    def passed(self, proposals: Column, kinds: list[int]) -> Column:
        """array<struct<k, a, b, score>>: each proposal as the kind with the best
        score among those that reach their threshold, if any."""
        def judge(p: Column) -> Column:
            as_kind = F.array(*[F.struct(
                self._margin(_features(p, k)).alias("score"), F.lit(k).alias("k"),
                F.lit(self.threshold[k]).alias("bar")) for k in kinds])
            best = F.array_max(F.filter(as_kind, lambda x: x["score"] >= x["bar"]))
            return F.transform(F.array(best), lambda x: F.struct(
                x["k"].alias("k"), p["a"].alias("a"), p["b"].alias("b"),
                x["score"].alias("score")))

        return F.filter(F.flatten(F.transform(proposals, judge)),
                        lambda x: x["k"].isNotNull())


def find_personal_data(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: arrays of struct (k: number of the
    kind, a, b: code points, end exclusive, score), by kind and start."""
    trees = trees or Trees(docs.sparkSession)
    df = _with_proposals(_with_base(docs))
    phone, card, email = (k for k, _ in PROPOSED)
    return (df.withColumn("_spans", F.array_sort(F.concat(
        "_base", trees.passed(F.col("_numbers"), [phone, card]),
        trees.passed(F.col("_spelt"), [email]))))
        .withColumn("_base", F.array_sort("_base")).drop("_numbers", "_spelt", "_runs"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["k"] + 1), s["a"].cast("string"), s["b"].cast("string"))), ",")


def personal_data(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """One row for each document: counts of base spans by kind, the SHA-256 of
    their list, and the list of all spans.

    Null and empty texts have no spans; repeated rows are judged row by row;
    other columns are ignored; an empty input gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    df = find_personal_data(rows, trees)
    return df.select(
        "doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("_spans")).alias("spans"))


def redacted(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets, and
    ``n_chars`` brought up to date where there is such a column."""
    df = find_personal_data(docs, trees)
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    # overlapping spans of two kinds become one, named by the first
    merged = F.aggregate(
        F.array_sort("_spans", lambda x, y: F.when(x["a"] < y["a"], -1).when(
            x["a"] > y["a"], 1).when(x["b"] > y["b"], -1).when(x["b"] < y["b"], 1)
            .when(x["k"] < y["k"], -1).otherwise(F.when(x["k"] > y["k"], 1).otherwise(0))),
        F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("done")),
        lambda acc, s: F.when(s["a"] >= acc["done"], F.struct(
            F.concat(acc["parts"], F.array(
                F.substring(F.col("_text"), acc["done"] + 1, s["a"] - acc["done"]),
                F.element_at(names, s["k"] + 1))).alias("parts"), s["b"].alias("done")))
        .otherwise(F.struct(acc["parts"].alias("parts"),
                            F.greatest(acc["done"], s["b"]).alias("done"))),
        lambda acc: F.concat(F.array_join(acc["parts"], ""),
                             F.substring(F.col("_text"), acc["done"] + 1, F.length("_text"))))
    new = F.when(F.size("_spans") > 0, merged).otherwise(F.col("text"))
    df = df.withColumn("_new", new)
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("_new").alias("text"))
        elif c == "n_chars":
            out.append(F.when(F.size("_spans") > 0, F.length("_new").cast(
                docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias("n_chars"))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)
