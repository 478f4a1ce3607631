"""Fill-in-the-middle forms by in-place block rotation.

A text's UTF-8 bytes are scanned once for unit ends (white space and the word
after it; white space at the end of a text is a unit). Two cuts drawn from the
document's id part it into prefix, middle and suffix. The three sentinels are
put into a bytearray at the cuts, and blocks are exchanged inside it by three
reversals each, a bounded piece at a time; running the same rotation backwards
and taking the sentinels out restores the text exactly.

Text that holds a sentinel stays plain, so a sentinel of an output is always
one that was put in: a sentinel begins with its only ``<`` and ends with its
only ``>``, so none can arise across a cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import arrow_rows, texts_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
#: Percent of the documents to be changed, and of those in suffix-first order.
RATE = 50
SPM = 80

#: Bytes swapped at once within a reversal, and output bytes held by a task.
_SWAP = 1 << 16
_HELD = 8 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def reverse(buf: bytearray, a: int, b: int) -> None:
    """Reverses ``buf[a:b]`` in place, two bounded pieces at a time."""
    while b - a > 1:
        k = min(_SWAP, (b - a) // 2)
        left = buf[a:a + k]
        left.reverse()
        right = buf[b - k:b]
        right.reverse()
        buf[a:a + k], buf[b - k:b] = right, left
        a, b = a + k, b - k


def rotate(buf: bytearray, a: int, m: int, b: int) -> None:
    """Exchanges ``buf[a:m]`` and ``buf[m:b]`` in place."""
    reverse(buf, a, m)
    reverse(buf, m, b)
    reverse(buf, a, b)


def unit_ends(text: bytes) -> np.ndarray:
    """End byte of every unit of a text, in order."""
    gap = _SPACE[np.frombuffer(text, np.uint8)]
    ends = np.flatnonzero(np.diff(gap.view(np.int8), append=1) > 0) + 1
    if len(gap) and gap[-1]:
        ends = np.append(ends, len(text))
    return ends


def arranged(text: bytes, a: int, b: int, form: str) -> bytearray:
    """The text with its blocks ``[:a]``, ``[a:b]``, ``[b:]`` in a form's order."""
    buf = bytearray(text)
    buf[b:b] = SUFFIX
    buf[a:a] = MIDDLE
    buf[0:0] = PREFIX
    a, b = a + 3, b + 6                       # where the middle's and suffix's marks begin
    if form == "psm":
        rotate(buf, a, b, len(buf))
    else:
        rotate(buf, 0, b, len(buf))
    return buf


def restored(output: bytes, form: str) -> bytes:
    """The text that an output was made from."""
    if form == "plain":
        return bytes(output)
    buf, size = bytearray(output), len(output)
    middle = buf.find(MIDDLE)
    if form == "psm":
        a = buf.find(SUFFIX)
        rotate(buf, a, middle, size)
        b = a + size - middle
    else:
        turned = buf.find(PREFIX)
        rotate(buf, 0, turned, size)
        a, b = middle - turned, size - turned
    del buf[b:b + 3], buf[a:a + 3], buf[0:3]
    return bytes(buf)


def _points(text: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((text & 0xC0) != 0x80))


def _form(text: bytes, h: list[int], rate: int, spm: int) -> str:
    if not text or h[2] % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return "plain"
    return "spm" if h[3] % 100 < spm else "psm"


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points, null if
    plain) and output of every row of ``docs``.

    Null text counts as empty; an empty text is plain. Cuts come from the id
    alone, so rows with one id and one text are alike; a null id is drawn from
    the seed without digits. Other columns of the input are ignored; an empty
    input gives no rows.
    """
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
        out: dict[str, list] = {k: [] for k in names}
        size = 0
        for key, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            ends = unit_ends(text)
            n = len(ends)
            drawn = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
            h = np.frombuffer(drawn, ">u4", 4).tolist()
            form, made, before, inside = _form(text, h, rate, spm), text, None, None
            if form != "plain":
                x, y = sorted((h[0] % (n + 1), h[1] % (n + 1)))
                a, b = (int(ends[i - 1]) if i else 0 for i in (x, y))
                made = bytes(arranged(text, a, b, form))
                raw = np.frombuffer(text, np.uint8)
                before, inside = _points(raw[:a]), _points(raw[a:b])
            for name, value in zip(names, (key, n, form, before, inside, made.decode())):
                out[name].append(value)
            size += len(made)
            if size > _HELD:
                yield out
                out, size = {k: [] for k in names}, 0
        yield out

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_rows(rows, run, "doc_id long, n long, form string, prefix_chars long, "
                                 "middle_chars long, output string")


def restore(made: DataFrame) -> DataFrame:
    """Rows of ``transform`` with ``restored``, the text rebuilt from output and
    form alone. All columns are kept; no rows give no rows."""
    fields = [f for f in made.schema.fields if f.name != "restored"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                       + ["restored string"])
    names = [f.name for f in fields]

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        at, size = 0, 0
        forms, back = batch.column(names.index("form")).to_pylist(), []
        for row, output in enumerate(texts_of(batch.column(names.index("output")))):
            back.append(restored(output, forms[row]).decode())
            size += len(output)
            if size > _HELD or row + 1 == batch.num_rows:
                part = batch.slice(at, len(back))
                yield {**{n: part.column(i) for i, n in enumerate(names)}, "restored": back}
                at, size, back = row + 1, 0, []

    return arrow_rows(made.select(*names), run, schema)


def digests(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """The rows of ``transform`` with sha256 of the output and of the text that
    is restored from it, in place of the texts."""
    return restore(transform(docs, seed, rate, spm)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


#: The same rows in DuckDB SQL, without rotations: lists of units are joined.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS text,
         regexp_extract_all(COALESCE(text, ''),
                            '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || COALESCE(doc_id::VARCHAR, '')) AS h
  FROM documents),
e AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
         ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3,
         ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR h3 % 100 >= 50 OR contains(text, '<P>')
                OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (
  SELECT *, COALESCE(array_to_string(list_slice(units, 1, a), ''), '') AS pre,
         COALESCE(array_to_string(list_slice(units, a + 1, b), ''), '') AS mid,
         COALESCE(array_to_string(list_slice(units, b + 1, n), ''), '') AS suf FROM f)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM g
"""
