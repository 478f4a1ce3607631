"""Spelling variants against counting and comparing by hand."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tickwise.llm import spelling as S
from tickwise.llm.common import table

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def words_of(rows, one_in=199, least=5):
    lower = {c: c + 32 for c in range(65, 91)}
    seen = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % one_in == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= least}


def grouped(words):
    """word -> (form, root, n, n_near, form_n), from words without one letter."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault(w[:i] + w[i + 1:], set()).add(w)
            holes.setdefault((w[:i], w[i + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1:]
            near[w] |= holes[(w[:i], w[i + 1:])] | ({cut} & words.keys())
        near[w] |= holes.get(w, set())
        near[w] = {v for v in near[w] if v != w}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        f = form[w]
        out[w] = (f, root, words[w], len(near[w]), None if f is None else words[f])
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_pairs_of_all_kinds(spark):
    r = random.Random(1)
    base = ["".join(r.choices("abé", k=r.randint(6, 9))) for _ in range(250)]
    base += ["aaaaaa" + "b" * i for i in range(9)] + ["x" * 40, "x" * 41, "x" * 20 + "y" + "x" * 20]
    words = sorted(set(base))
    df = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(words)], "word string, n long")
    want = {tuple(sorted((a, b))) for i, a in enumerate(words) for b in words[:i] if one_edit(a, b)}
    for most in (0, 10, 4096):            # hot groups at every level, some, none
        got = [tuple(sorted((p.a, p.b))) for p in S.near_pairs(df, most).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_shared_chunks_stay_small(spark):
    # 676 words share each half: no task may compare all of them
    r = random.Random(2)
    tails = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(3000)]
    words = sorted({"prefix" + t for t in tails} | {t + "suffix" for t in tails})
    df = spark.createDataFrame([(w, 9) for w in words], "word string, n long")
    want = grouped({w: 9 for w in words})
    got = Counter()
    for p in S.near_pairs(df).collect():
        got[p.a] += 1
        got[p.b] += 1
    assert got == Counter({w: v[3] for w, v in want.items() if v[3]})


def test_random_texts(spark):
    r = random.Random(7)
    stems = ["".join(r.choices("abcdeéÀ÷", k=r.randint(5, 8))) for _ in range(60)]
    rows = []
    for i in range(400):
        text = []
        for w in r.choices(stems, weights=[1 / (k + 1) for k in range(60)], k=30):
            at = r.randrange(len(w) + 1)
            w = [w, w.upper(), w[:at] + w[at + 1:], w[:at] + "b" + w[at:]][r.choice((0, 0, 0, 1, 2, 3))]
            text.append(w + r.choice([" ", ",", "\n", "1", "ß ", "Ω"]))
        rows.append((i, "".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = grouped(words_of(rows))
    assert result(S.spelling_variants(docs)) == want
    assert result(S.spelling_variants(docs, group_pairs=20)) == want
    assert any(v[0] for v in want.values())


def test_chains_are_followed(spark):
    counts = {"abcdef": 5, "abcdefg": 25, "abcdefgh": 125, "abcdefghi": 625, "zzzzzz": 7}
    text = " ".join(w for w, n in counts.items() for _ in range(n))
    docs = spark.createDataFrame([(3, text)], "doc_id long, text string")
    words = words_of([(3, text)])
    assert set(words) == set(counts)
    got = result(S.spelling_variants(docs))
    assert got == grouped(words)
    assert {got[w][1] for w in counts if w != "zzzzzz"} == {"abcdefghi"}


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (2, "letters " * 9), (2, "letters " * 9), (None, "lettres " * 5),
            (4, "×÷ÿÀÁÂ " * 5), (5, "y" * 300_000), (6, "1 2 3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"word": F.lit("clash"), "n": F.lit(1)})
    assert result(S.spelling_variants(docs)) == grouped(words_of(rows))
    assert S.spelling_variants(docs.where("doc_id = 6")).count() == 0
    assert S.spelling_variants(docs.limit(0)).count() == 0


def test_long_text(spark):
    rows = [(1, "lengthy wordy wording worden " * 300_000), (2, "q" * 3_000_000 + " "),
            (3, ("w" * 20_000 + " ") * 5 + ("w" * 20_001 + " ") * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(S.spelling_variants(docs))
    assert got["w" * 20_000][0] == "w" * 20_001
    assert {w: v[2] for w, v in got.items()} == words_of(rows)


def test_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = result(S.spelling_variants(docs))
    assert got == grouped(words_of(rows)) and len(got) > 50
