"""Found notices against a scan of every window."""

import random
import re

from tickwise.llm import licenses as C
from tickwise.llm.common import table

SF = "/root/testdata/sf0.01"


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def grams(w):
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def brute(rows, least=0.8):
    known = [(k, set(grams(words(t))), max(1, len(words(t)) - 4)) for k, t in C.TEMPLATES]
    out = {}
    for key, t in rows:
        s = grams(words(t))
        for span in {m for _, _, m in known}:
            for at in range(max(1, len(s) - span + 1)):
                held = set(s[at:at + span])
                score = [(len(g & held) / len(g), k) for k, g, m in known if m == span]
                best = max(x for x, _ in score)
                if best >= least:
                    for x, k in score:
                        if x == best:
                            out[(key, k)] = max(out.get((key, k), 0), x)
    return out


def test_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    got = {(r.doc_id, r.license): r.containment for r in C.find_licenses(docs).collect()}
    assert got == want and len(want) > 20


def test_changed_notices(spark):
    r = random.Random(2)
    rows = []
    for i in range(150):
        w = r.choice(C.TEMPLATES)[1].split()
        for _ in range(r.choice([0, 0, 1, 2])):
            w[r.randrange(len(w))] = "other"
        filler = ["lorem", "the", "license", "Software", "under"]
        body = [r.choice(filler) for _ in range(r.randint(0, 40))]
        at = r.randint(0, len(body))
        rows.append((i, r.choice([" ", "\n"]).join(body[:at] + [x.upper() for x in w] + body[at:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {k for k, x in brute(rows).items() if x == 1}
    near = set(brute(rows))
    got = {(x.doc_id, x.license) for x in C.find_licenses(docs).collect()}
    # windows overlap by seven eighths: a notice that just reaches the
    # containment at one offset may miss it at the windows made
    assert want <= got <= near and len(got) > 0.95 * len(near)


def test_cover_words_are_needed():
    for _, t in C.TEMPLATES:
        cover, w = C.cover_words(t), words(t)
        own = set(grams(w))
        held = {g for g in own if not cover & set(g)}
        assert len(held) < 0.8 * len(own)


def test_odd_rows(spark):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, mit), (3, mit), (None, mit), (4, mit + " x" * 60000),
            (5, "license " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS h", "2 AS span", "'x' AS license", "3 AS own")
    got = sorted((x.doc_id or 0, x.license, x.word) for x in C.find_licenses(docs).collect())
    assert got == [(0, "MIT", 0), (3, "MIT", 0), (4, "MIT", 0)]
    assert C.find_licenses(docs.limit(0)).count() == 0
    assert C.find_licenses(docs, templates=(("X", ""),)).count() == 0
    short = C.find_licenses(docs, templates=(("Y", "MIT License"),))
    assert {x.license for x in short.collect()} <= {"Y"}


def test_every_start_counts(spark):
    """Changed notices after any number of words, as all windows give them."""
    r = random.Random(6)
    rows = []
    for _, t in C.TEMPLATES:
        for before in range(12 if len(t.split()) > 15 else 2):
            w = t.split()
            for _ in range(r.choice([1, 2])):
                w[r.randrange(len(w))] = "other"
            rows.append((len(rows), " ".join(["lorem"] * (before + 3) + w + ["ipsum"] * 9)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x.doc_id, x.license): x.containment for x in C.find_licenses(docs).collect()}
    assert got == brute(rows)


def best_places(text, least=0.8):
    """Licences whose match no better one of another licence overlaps by half or
    more of the shorter, from every window of every template."""
    s = grams(words(text))
    at = {}
    for span in {max(1, len(words(t)) - 4) for _, t in C.TEMPLATES}:
        own = [(k, set(grams(words(t)))) for k, t in C.TEMPLATES
               if max(1, len(words(t)) - 4) == span]
        for i in range(max(1, len(s) - span + 1)):
            held = set(s[i:i + span])
            score = [(len(g & held) / len(g), k) for k, g in own]
            best = max(x for x, _ in score)
            if best >= least:
                at.update({(k, span, i): x for x, k in score if x == best})
    stay = {}
    for (k, n, i), x in at.items():
        if not any(y > x and o != k
                   and 2 * (min(i + n, j + m) - max(i, j)) >= min(n, m)
                   for (o, m, j), y in at.items()):
            stay[k] = max(stay.get(k, 0), x)
    return stay


def test_best_of_a_place(spark):
    r = random.Random(9)
    gpl = {k: t for k, t in C.TEMPLATES if t.startswith("This work is licensed under the GNU")}
    rows = [(1, "Some words stand here. " + gpl["GPL-3.0"] + " And more follows."),
            (2, "lorem ipsum " * 40 + gpl["GPL-2.0"] + " " + gpl["GPL-3.0"] + " dolor " * 100),
            (3, "x y " + gpl["GPL-3.0"]), (3, "x y " + gpl["GPL-2.0"]),
            (None, "a " + gpl["GPL-3.0"]), (None, "a " + gpl["GPL-2.0"])]
    for i in range(120):
        body = []
        for _ in range(r.randint(1, 4)):
            w = r.choice(C.TEMPLATES)[1].split()
            for _ in range(r.choice([0, 0, 1])):
                w[r.randrange(len(w))] = "other"
            body += ["lorem"] * r.randint(0, 70) + w
        rows.append((10 + i, " ".join(body)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x.doc_id, x.license): x.containment
           for x in C.find_licenses(docs, by_place=True).collect()}
    want = {}
    for key, t in rows:
        for k, x in best_places(t).items():
            want[(key, k)] = max(want.get((key, k), 0), x)
    assert got == want
    assert [k for d, k in got if d == 1] == ["GPL-3.0"]
    for d in (2, 3, None):
        assert sorted(k for e, k in got if e == d) == ["GPL-2.0", "GPL-3.0"]
