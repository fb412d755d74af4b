"""Fill-in-middle rearrangement by block rotation in place.

A text is cut at two of its token borders, a sentinel goes in front of each of the three
parts, and two neighbouring blocks change places by three reversals inside one bytearray;
no part is copied out. Restoring finds the sentinels, rotates back and deletes them. Texts
that hold a sentinel themselves are left plain, so the sentinels found are those put in:
a text cut anywhere cannot form another one with them, since each begins with ``<``, ends
with ``>`` and has neither inside.

Whether, how and where a text is cut follows from a digest of its id, so reruns and any
partitioning agree. Null and empty texts stay plain and become the empty text. Rows without
an id share the digest of an empty one. Repeated rows are treated alike, extra columns pass
through, one called like the result column is replaced, and an empty table gives no rows. A
text of any length is taken whole; a task holds one Arrow batch, which is bounded in bytes,
and works on one text at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import map_batches, read_table, text_bytes, with_text_columns

# The sentinels, the names of the forms, and the percentages that choose a form.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
REARRANGED_PERCENT, SPM_PERCENT = 90, 20
#: Bytes exchanged at once by a reversal; its only memory besides the text.
SWAP_BYTES = 1 << 16

CUT = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)
RESTORED = T.StructType([T.StructField("text", T.StringType())])


def reverse(view: np.ndarray, lo: int, hi: int) -> None:
    """Reverse ``view[lo:hi]`` in place, from both ends inwards."""
    while hi - lo > 1:
        k = min(SWAP_BYTES, (hi - lo) // 2)
        head = view[lo : lo + k][::-1].copy()
        view[lo : lo + k] = view[hi - k : hi][::-1]
        view[hi - k : hi] = head
        lo, hi = lo + k, hi - k


def rotate(buffer: bytearray, lo: int, mid: int, hi: int) -> None:
    """Exchange the blocks ``buffer[lo:mid]`` and ``buffer[mid:hi]`` by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view, lo, mid)
    reverse(view, mid, hi)
    reverse(view, lo, hi)


class Units:
    """Borders of the units of a text: runs of ASCII letters, and other characters singly."""

    def __init__(self, text: bytes):
        data = np.frombuffer(text, np.uint8)
        letter = ((data | 0x20) - np.uint8(97)) < 26
        self.first = (data & 0xC0) != 0x80  # of a character
        begins = self.first.copy()
        begins[1:] &= ~(letter[1:] & letter[:-1])
        self.starts = np.flatnonzero(begins)
        self.size = len(text)

    def __len__(self) -> int:
        return len(self.starts)

    def offset(self, unit: int) -> int:
        """Byte at which ``unit`` begins; the end of the text for one past the last."""
        return int(self.starts[unit]) if unit < len(self.starts) else self.size

    def chars(self, lo: int, hi: int) -> int:
        return int(np.count_nonzero(self.first[lo:hi]))


def draws(key: object, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the digest of ``seed:key``."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def rearrange(text: bytes, key: object, seed: int = 1) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, characters of prefix and middle, and the rearranged text."""
    units = Units(text)
    n = len(units)
    h1, h2, h3, h4 = draws(key, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= REARRANGED_PERCENT:
        return n, PLAIN, None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = units.offset(first), units.offset(second)
    buffer = bytearray(text)
    for at, sentinel in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    # now prefix, middle, suffix; the middle begins at a + 3, the suffix at b + 6
    middle, suffix = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)
    form = SPM if h4 % 100 < SPM_PERCENT else PSM
    rotate(buffer, 0 if form == SPM else middle, suffix, len(buffer))
    return n, form, units.chars(0, a), units.chars(a, b), bytes(buffer)


def restore(output: bytes, form: str) -> bytes | None:
    """The text before; null if ``output`` is not of ``form``."""
    if form == PLAIN:
        return output
    second, third = (SUFFIX, MIDDLE) if form == PSM else (PREFIX, MIDDLE)
    if form not in (PSM, SPM) or not output.startswith(PREFIX if form == PSM else SUFFIX):
        return None
    at = output.find(second, 3)
    end = output.find(third, at + 3) if at >= 0 else -1
    if end < 0:
        return None
    buffer = bytearray(output)
    if form == PSM:  # suffix and middle change places
        rotate(buffer, at, end, len(buffer))
        middle, suffix = at, at + len(buffer) - end
    else:  # the suffix goes behind prefix and middle
        rotate(buffer, 0, at, len(buffer))
        middle, suffix = end - at, len(buffer) - at
    for begin in (suffix, middle, 0):
        del buffer[begin : begin + 3]
    return bytes(buffer)


def fill_in_middle(
    docs: DataFrame, text: str = "text", key: str = "doc_id", name: str = "infilling", seed: int = 1
) -> DataFrame:
    """``docs`` without their text, and the struct ``name``: n, form, prefix_chars, middle_chars, output."""
    kept = [c for c in docs.columns if c != name]
    source = docs.select(*[docs[c] for c in kept])
    passed = [c for c in kept if c != text]
    schema = T.StructType([*[source.schema[c] for c in passed], T.StructField(name, CUT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = text_bytes(batch.column(text)), batch.column(key).to_pylist()
            rows = [rearrange(t or b"", k, seed) for t, k in zip(texts, keys, strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * len(CUT)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            arrays[-1] = arrays[-1].cast(pa.string())
            struct = pa.StructArray.from_arrays(arrays, names=CUT.fieldNames())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], struct], names=[*passed, name])

    return map_batches(source, run, schema)


def restore_texts(df: DataFrame, output: str, form: str, name: str = "restored") -> DataFrame:
    """``df`` without ``output``, and the struct ``name`` that holds the text before; null if malformed."""
    packed = "__output_and_form"
    # the form goes in front of the text, as one column carries both
    code = F.when(F.col(form) == PLAIN, "0").when(F.col(form) == PSM, "1").when(F.col(form) == SPM, "2").otherwise("3")
    joined = df.withColumn(packed, F.concat(code, F.coalesce(F.col(output), F.lit("")))).drop(output)
    forms = (PLAIN, PSM, SPM, "")

    def steps():
        def step(texts: pa.Array) -> list[pa.Array]:
            found = [restore(t[1:], forms[t[0] - 48]) for t in text_bytes(texts)]
            return [pa.array(found, pa.binary()).cast(pa.string())]

        return step

    return with_text_columns(joined, packed, name, RESTORED, steps, drop_text=True)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.sha2(F.col("output").cast("binary"), 256)
    flat = fill_in_middle(docs).select("doc_id", "infilling.*").withColumn("output_sha256", digest)
    restored = restore_texts(flat, "output", "form")
    return restored.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        "output_sha256",
        F.sha2(F.col("restored.text").cast("binary"), 256).alias("restored_sha256"),
    )


OP11_SQL = """
WITH hashed AS (
    SELECT doc_id, COALESCE(text, '') AS text, sha256('1:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(COALESCE(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
    FROM documents),
drawn AS (
    SELECT doc_id, text, units, len(units) AS n,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM hashed),
cut AS (
    SELECT doc_id, text, n,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
           array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
           array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') AS suffix
    FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut"""
