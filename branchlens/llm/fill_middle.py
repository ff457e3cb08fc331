"""Operator 13: fill-in-the-middle transformation.

Method: repeated-capture matching. One fullmatch of ``(unit)*`` keeps every repetition of its
group, so ``match.ends(1)`` holds the end of each unit: its length is the number of units,
and the two cuts are read from it without going through the text again. Two hashes of
the document's id choose the cuts, so a retried task gives the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.llm.common import chunks, read, small_batches

LINE = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
SEED, RATE, SPM_RATE = 7, 100, 50  # the rates in percent
PLAIN, PSM, SPM = "plain", "psm", "spm"
PART = 4 << 20
FIELDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string"


class Transform:
    """One text to its units, form and rearranged text, and back."""

    def __init__(self, seed: int, rate: int, spm_rate: int, unit: str, marks: tuple[str, str, str]):
        # A mark whose first character does not come back in any mark is never found across a border.
        if any(m[0] in other[1:] for m in marks for other in marks) or len(set(marks)) < len(marks):
            raise ValueError(f"marks that may overlap: {marks}")
        self.seed, self.rate, self.spm_rate, self.marks = seed, rate, spm_rate, marks
        self.units = regex.compile(f"({unit})*")

    def numbers(self, doc_id: int | None) -> list[int]:
        """Four 32-bit numbers from the document's id; a missing id counts as an empty one."""
        name = "" if doc_id is None else str(doc_id)
        digest = hashlib.sha256(f"{self.seed}:{name}".encode()).digest()
        return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]

    def __call__(self, doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, str]:
        """n units, form, characters of prefix and middle (none if plain), output."""
        match = self.units.fullmatch(text)
        if match is None:
            raise ValueError(f"the units do not cover the text of document {doc_id}")
        ends = match.ends(1)
        n = len(ends)
        h1, h2, h3, h4 = self.numbers(doc_id)
        if not text or any(m in text for m in self.marks) or h3 % 100 >= self.rate:
            return n, PLAIN, None, None, text
        first, second = (ends[i - 1] if i else 0 for i in sorted((h1 % (n + 1), h2 % (n + 1))))
        prefix, middle, suffix = text[:first], text[first:second], text[second:]
        p, s, m = self.marks
        if h4 % 100 < self.spm_rate:
            return n, SPM, first, second - first, f"{s}{suffix}{p}{prefix}{m}{middle}"
        return n, PSM, first, second - first, f"{p}{prefix}{s}{suffix}{m}{middle}"

    def restore(self, output: str, form: str) -> str:
        """The text, from the output and its form alone."""
        if form == PLAIN:
            return output
        p, s, m = self.marks
        outer, inner = (p, s) if form == PSM else (s, p)
        if not output.startswith(outer):
            raise ValueError(f"no {outer} in front of a text of form {form}")
        one, _, rest = output[len(outer) :].partition(inner)
        two, _, middle = rest.partition(m)
        return one + middle + two if form == PSM else two + middle + one


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    unit: str = LINE,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, restored of every whole text.

    A text is cut at two borders of its units (lines with their end), which hashes of the id
    choose; ``rate`` percent of the documents are rearranged, ``spm_rate`` percent of those with
    the suffix first. Texts that are empty or hold a mark stay plain: output is the text, the lengths
    are null. ``restored`` is rebuilt from output and form alone. A null text counts as empty, with no
    units; a null id is hashed as an empty one. Lengths are in code points. One row per input row;
    repeated rows give equal rows; other columns are not looked at; an empty table gives an
    empty table. A unit pattern that leaves text uncovered raises.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transform = Transform(seed, rate, spm_rate, unit, marks)
        for batch in batches:
            for part in chunks(batch, size=PART):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    n, form, before, between, output = transform(doc_id, text or "")
                    rows.append((n, form, before, between, output, transform.restore(output, form)))
                columns = list(zip(*rows, strict=True)) or [()] * 6
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"],
                )

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return texts.mapInArrow(run, FIELDS)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), hashed AS (
  SELECT doc_id, t, u, len(u) AS n, list_transform(range(0, 4),
    lambda i: CAST('0x' || substr(h, CAST(8 * i + 1 AS INTEGER), 8) AS BIGINT)) AS h FROM units
), cuts AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
         WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(list_slice(u, 1, a), '') AS p,
    array_to_string(list_slice(u, a + 1, b), '') AS m, array_to_string(list_slice(u, b + 1, n), '') AS s
  FROM cuts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
