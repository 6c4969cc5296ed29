"""Fill-in-the-middle: documents cut into units and put in prefix-suffix-middle order.

The units of a text come from one ``fullmatch`` of the regex library over
``(unit)*``: the library keeps every repetition of a group, so ``m.ends(1)``
is the list of all unit ends; its length is the number of units, and the two
cut offsets are two of its items.  No loop over the units is written here.
The repetition is possessive: a unit once matched is never given back, so the
library keeps no backtracking state for it.

The default unit is a line with its line feed, or the rest without one.  Cuts,
form and order are drawn from a hash of the document's id and nothing else, so
reruns, other cluster sizes and retried tasks agree.

A text that is empty, or that holds one of the sentinels, stays as it is (form
``plain``): a transformed text can therefore always be taken apart again at
its sentinels, which is what ``restored`` does on the output and form alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: bytes of input text whose results leave a task as one batch
STEP_BYTES = 4 << 20

_TYPES = "n long, form string, prefix_chars long, middle_chars long, output string"


def unit_ends(matcher, text: str) -> list[int]:
    """Where each unit of ``text`` ends, from one match of the whole text."""
    m = matcher.fullmatch(text)
    if m is None:
        raise ValueError("the units do not cover the text")
    return m.ends(1)


def draws(seed: int, key: str) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document: the head of a SHA-256 of seed and id."""
    h = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return int(h[0:8], 16), int(h[8:16], 16), int(h[16:24], 16), int(h[24:32], 16)


def transform(matcher, text: str, key: str, seed: int, fim_percent: int, spm_percent: int) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    ends = unit_ends(matcher, text)
    n = len(ends)
    h1, h2, h3, h4 = draws(seed, key)
    if not text or h3 % 100 >= fim_percent or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (lo, hi))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def fill_in_middle(docs: DataFrame, seed: int = 7, fim_percent: int = 100, spm_percent: int = 50, unit: str = LINE,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    Row by row, without a shuffle; lengths are in code points and null for the
    form ``plain``.  ``unit`` is a regular expression whose repetition covers any
    text (an error otherwise).  A null text is empty (n = 0, form ``plain``,
    output empty); a null id hashes as an empty one; repeated ids and rows give a
    row each, the same for the same text; other columns are ignored whatever their
    names; an empty table gives an empty result."""
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        matcher = regex.compile(f"({unit})*+")
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for b in batches:
            first, size, got = 0, 0, []
            for i, text in enumerate(b.column(2)):
                text = text.as_py()
                got.append(transform(matcher, text, b.column(1)[i].as_py(), seed, fim_percent, spm_percent))
                size += len(text)
                if size >= STEP_BYTES or i == b.num_rows - 1:
                    cols = [pa.array(c, k) for c, k in zip(zip(*got), kinds)]
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(got)), *cols], names)
                    first, size, got = i + 1, 0, []

    return src.mapInArrow(run, f"doc_id {id_type}, {_TYPES}")


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that a row was made of, from its output and form: the sentinels
    split a transformed text into an empty head and its three parts."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(part[1], part[3], part[2])
    spm = F.concat(part[2], part[3], part[1])
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)


def fill_digests(docs: DataFrame, **options) -> DataFrame:
    """Counts, form and the digests of output and restored text for every row of ``docs``."""
    got = fill_in_middle(docs, **options)
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(restored("output", "form").cast("binary"), 256).alias("restored_sha256"))


#: The contract's rows in DuckDB SQL; the text is rebuilt here from its three parts.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
             CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi FROM u),
p AS (SELECT *, array_to_string(u[1:lo], '') AS a, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:n], '') AS z,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
                        ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
       sha256(a || m || z) AS restored_sha256
FROM p
"""
