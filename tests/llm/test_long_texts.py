"""One text of some 30 MB in a worker of its own: results, and memory at its peak."""

import os
import subprocess
import sys

import numpy as np

from tickwise.llm import shingles as S

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RUN = """
import random, resource, sys
sys.path.insert(0, {root!r})
from tickwise.llm import decontam as D, shingles as S
r = random.Random(1)
item = " ".join(f"w{{r.randrange(5000)}}" for _ in range(60))
items = D.Items([(1, item)])
part = " ".join(f"w{{r.randrange(5000)}}" for _ in range(50_000))
text = (item + (" " + part) * 110 + " " + item).encode()
assert len(text) > 28 << 20
assert list(items.leaks([text], 0.8)) == [(0, 0, 1.0)]
sets = S.shingle_sets([text, b"a b c d e f"])
assert len(sets[1]) == 2 and 50_000 <= len(sets[0]) < 50_200
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


def test_memory_of_one_long_text():
    done = subprocess.run([sys.executable, "-c", RUN.format(root=ROOT)], capture_output=True,
                          text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-1]) < 1000


def test_words_do_not_depend_on_pieces(monkeypatch):
    texts = [b"one two  three\tfour five", b"", b"x" * 5000 + b" y", b" two x"]
    whole = S.words_of(texts)
    for piece in (1, 7, 100):
        monkeypatch.setattr(S, "PIECE", piece)
        monkeypatch.setattr(S, "_POWERS", {})
        for a, b in zip(whole, S.words_of(texts)):
            assert np.array_equal(a, b)
