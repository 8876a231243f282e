"""Fill-in-the-middle transformation with a sparse checkpoint index.

A text is n units: a word with the white space before it, and white space at the end. One pass counts them in segments of
bounded size and records, every `every` units, how many bytes and code points lie before. A cut at any unit is then found by
binary search among these checkpoints and a rescan of the few units behind one, so neither a list of all units nor
a second pass over the text is needed, and a very long text costs memory for its checkpoints only.

The hexadecimal SHA-256 of `<seed>:<doc_id>` gives each row its draws: two cuts among 0..n, whether it is transformed (`rate`
percent), and in which order (`spm` percent suffix first, else prefix first). Forms:

* plain: the text itself. Texts that are null or empty, texts that hold one of the marks, and those not drawn.
* psm: <P>prefix<S>suffix<M>middle
* spm: <S>suffix<P>prefix<M>middle

As no transformed text holds a mark, restored() gets each text back exactly. A null doc_id draws as an empty one. Equal cuts
give an empty middle. Repeated rows, and rows that share a doc_id, are transformed alike and each is returned. An empty table
gives no rows. Other columns, of whatever name, are never read. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernels

SEED, RATE, SPM, EVERY = 42, 50, 80, 64
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]


def _ends(data: np.ndarray, after: int | None) -> np.ndarray:
    """Places behind the words that end within data; `after` is the byte that follows, None at the end of the text."""
    inside = ~kernels.SPACE[data]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    if len(last) and after is not None and not kernels.SPACE[after]:
        last[-1] = False
    return np.flatnonzero(last) + 1


def _points(data: np.ndarray) -> int:
    """Code points that begin in data."""
    return int(((data & 0xC0) != 0x80).sum())


class Checkpoints:
    """How many bytes and code points lie before every `every`-th unit of a text."""

    def __init__(self, text: bytes, every: int = EVERY):
        self.text, self.every = np.frombuffer(text, np.uint8), every
        units, points, at, marks = 0, 0, [0], [0]
        for k in range(0, len(text), kernels.SEGMENT):
            part = self.text[k : k + kernels.SEGMENT]
            ends = _ends(part, text[k + len(part)] if k + len(part) < len(text) else None)
            own = ends[(every - 1 - units) % every :: every]
            if len(own):
                before = np.cumsum((part & 0xC0) != 0x80)
                at += (own + k).tolist()
                marks += (before[own - 1] + points).tolist()
            units += len(ends)
            points += _points(part)
        if len(text) and kernels.SPACE[text[-1]]:
            units += 1  # white space at the end is a unit of its own
        self.n, self.points = units, points
        self.at, self.marks = np.array(at), np.array(marks)

    def locate(self, unit: int) -> tuple[int, int]:
        """(bytes, code points) before the unit of that number, from 0 to n."""
        if unit >= self.n:
            return len(self.text), self.points
        k = int(np.searchsorted(np.arange(len(self.at)) * self.every, unit, "right")) - 1
        at, left, points = int(self.at[k]), unit - k * self.every, int(self.marks[k])
        while left:  # a rescan of fewer than `every` units
            part = self.text[at : at + 4096]
            end = at + len(part)
            ends = _ends(part, int(self.text[end]) if end < len(self.text) else None)
            if len(ends) >= left:
                part = part[: ends[left - 1]]
                left = 0
            else:
                left -= len(ends)
            at, points = at + len(part), points + _points(part)
        return at, points


def draws(doc_id, seed: int = SEED) -> list[int]:
    """Four numbers below 2**32 for a row."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(doc_id, text: bytes, seed: int = SEED, rate: int = RATE, spm: int = SPM, every: int = EVERY) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, code points of prefix and of middle, output) of a text."""
    index = Checkpoints(text, every)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or any(m in text for m in _MARKS):
        return index.n, "plain", None, None, text
    first, last = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
    (a, before), (z, upto) = index.locate(first), index.locate(last)
    p, s, m = _MARKS
    prefix, middle, suffix = text[:a], text[a:z], text[z:]
    if h4 % 100 < spm:
        return index.n, "spm", before, upto - before, b"".join((s, suffix, p, prefix, m, middle))
    return index.n, "psm", before, upto - before, b"".join((p, prefix, s, suffix, m, middle))


OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, every: int = EVERY) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output for every row of docs (doc_id, text)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [transformed(d, t.as_buffer().to_pybytes() if t.is_valid else b"", seed, rate, spm, every) for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
        n, form, before, middle, out = ([r[i] for r in got] for i in range(5))
        made = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([batch.column(0), *made], [c.split()[0] for c in OUT.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.arrow_map(rows, run, OUT, "text")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from."""
    front = lambda mark: F.substring_index(F.substring(output, 4, F.length(output)), mark, 1)
    inner = lambda mark: F.substring_index(F.substring_index(output, mark, -1), MIDDLE, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(front(SUFFIX), middle, inner(SUFFIX))
    spm = F.concat(inner(PREFIX), middle, front(PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(common.table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), d AS (
  SELECT *, len(u)::BIGINT AS n, [('0x' || h[8 * i + 1 : 8 * i + 8])::UBIGINT::BIGINT FOR i IN [0, 1, 2, 3]] AS k FROM t
), c AS (
  SELECT *, least(k[1] % (n + 1), k[2] % (n + 1)) AS a, greatest(k[1] % (n + 1), k[2] % (n + 1)) AS z,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR k[3] % 100 >= 50 THEN 'plain' WHEN k[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT *, array_to_string(u[1 : a], '') AS prefix, array_to_string(u[a + 1 : z], '') AS middle, array_to_string(u[z + 1 : n], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
