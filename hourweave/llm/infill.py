"""Fill-in-middle rearrangement of documents, cut by code points or lines over their UTF-8 bytes.

A text is kept as bytes.  Its index records only the exceptions: the position of every multibyte character and
by how many bytes it exceeds one.  Between exceptions a byte offset is the code-point offset plus a constant,
so one ``searchsorted`` among the exceptions turns either offset into the other, and pure ASCII texts need no
index at all.  Cuts are found on one of both sides (line ends on bytes, characters on code points), reported
in code points and applied to bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows_below, table, texts

MARKERS = ("<P>", "<S>", "<M>")
SALT = "7"
RATE = 100
SPM_RATE = 50
BATCH_CHARS = 1 << 21
SLICE = 1 << 22


class Exceptions:
    """Sparse index of the multibyte characters of UTF-8 bytes: where they start and the excess bytes so far."""

    def __init__(self, data: bytes):
        self.size = len(data)
        self.at = np.empty(0, np.int64)
        if not data.isascii():
            raw = np.frombuffer(data, np.uint8)
            # a slice at a time: a long text needs memory for its exceptions only
            self.at = np.concatenate([a + np.flatnonzero(raw[a:a + SLICE] >= 0xC0) for a in range(0, len(raw), SLICE)])
            lead = raw[self.at]
            #: bytes beyond one per character, of the exceptions up to each
            self.excess = np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64)
            #: code-point positions of the exceptions
            self.char = self.at - np.r_[0, self.excess[:-1]]

    @property
    def chars(self) -> int:
        return self.size - (int(self.excess[-1]) if len(self.at) else 0)

    def char_of(self, byte):
        """Code points before a byte offset that starts a character (or ends the text)."""
        if not len(self.at):
            return byte
        before = np.searchsorted(self.at, byte, "left")
        return byte - np.where(before > 0, self.excess[np.maximum(before, 1) - 1], 0)

    def byte_of(self, char):
        """Byte offset of a code-point offset."""
        if not len(self.at):
            return char
        before = np.searchsorted(self.char, char, "left")
        return char + np.where(before > 0, self.excess[np.maximum(before, 1) - 1], 0)


def line_ends(data: bytes) -> np.ndarray:
    """Byte offsets of the ends of the lines ``[^\\n]*\\n|[^\\n]+``."""
    raw = np.frombuffer(data, np.uint8)
    ends = [a + 1 + np.flatnonzero(raw[a:a + SLICE] == 10) for a in range(0, len(raw), SLICE)]
    if data and not data.endswith(b"\n"):
        ends.append(np.array([len(data)]))
    return np.concatenate(ends) if ends else np.empty(0, np.int64)


def draws(doc_id: int | None, salt: str = SALT) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 from the sha256 of ``salt:doc_id``; an absent id counts as the empty string."""
    name = f"{salt}:{'' if doc_id is None else doc_id}"
    return tuple(int.from_bytes(hashlib.sha256(name.encode()).digest()[4 * i:4 * i + 4], "big") for i in range(4))


def check_markers(markers: tuple[str, str, str]) -> None:
    """Markers must be distinct and must not overlap each other, so that the first one found is the one written."""
    ends = {m[k:] for m in markers for k in range(1, len(m))}
    if len(set(markers)) < 3 or not all(markers) or any(m.startswith(e) for m in markers for e in ends) or any(
            a != b and a in b for a in markers for b in markers):
        raise ValueError(f"markers {markers} may be mistaken for each other")


def arrange(text: str, doc_id: int | None, unit: str = "line", markers: tuple[str, str, str] = MARKERS, salt: str = SALT,
            rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple:
    """(units, form, code points of prefix and middle, output) of one text; see ``fill_in_middle``."""
    data = text.encode()
    index = Exceptions(data)
    ends = line_ends(data) if unit == "line" else None
    n = index.chars if ends is None else len(ends)
    h1, h2, h3, h4 = draws(doc_id, salt)
    if not data or any(m in text for m in markers) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    units = np.sort([h1 % (n + 1), h2 % (n + 1)])
    if ends is None:
        chars, cut = units, index.byte_of(units)
    else:
        cut = np.where(units > 0, ends[np.maximum(units, 1) - 1], 0)
        chars = index.char_of(cut)
    pre, suf, mid = (m.encode() for m in markers)
    prefix, middle, suffix = data[:cut[0]], data[cut[0]:cut[1]], data[cut[1]:]
    form = "spm" if h4 % 100 < spm_rate else "psm"
    out = (suf + suffix + pre + prefix if form == "spm" else pre + prefix + suf + suffix) + mid + middle
    return n, form, int(chars[0]), int(chars[1] - chars[0]), out.decode()


def restore(output: str, form: str, markers: tuple[str, str, str] = MARKERS) -> str:
    """The text that ``arrange`` was given."""
    if form == "plain":
        return output
    pre, suf, mid = markers
    first, second = (suf, pre) if form == "spm" else (pre, suf)
    a = output.index(second)
    b = output.index(mid, a)
    one, two, middle = output[len(first):a], output[a + len(second):b], output[b + len(mid):]
    return two + middle + one if form == "spm" else one + middle + two


def fill_in_middle(docs: DataFrame, unit: str = "line", markers: tuple[str, str, str] = MARKERS, salt: str = SALT,
                   rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document.

    The text's n units (``line`` or ``char``) are cut after two numbers of units drawn from the doc_id, into
    prefix, middle and suffix.  ``rate`` per cent of the documents are rearranged, ``spm_rate`` per cent of
    those with the suffix first; ``markers`` stand before prefix, suffix and middle.  prefix_chars and
    middle_chars count code points and are null in plain form.

    Edge cases: null and empty texts, and texts that hold a marker, stay as they are (plain; a null text gives
    the empty output); rows that repeat an id are cut at the same draws, each within its own units; a null id
    draws from the empty string; an empty table gives an empty result; other columns, also ones named like an
    output, are not read.  A very long text is indexed slice by slice: beside the text, its index takes 24 bytes
    for each multibyte character and 8 for each line.
    """
    check_markers(markers)
    if unit not in ("line", "char"):
        raise ValueError(f"unit is line or char, not {unit}")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_below(frames, "text", BATCH_CHARS):
            ids = [None if pd.isna(i) else int(i) for i in frame["doc_id"]]
            done = [arrange(t, i, unit, markers, salt, rate, spm_rate) for t, i in zip(frame["text"], ids, strict=True)]
            out = pd.DataFrame(done, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            out.insert(0, "doc_id", pd.array(ids, dtype="Int64"))
            yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    named = texts(docs).withColumn("doc_id", F.col("doc_id").cast("string"))  # a null turns longs to doubles in pandas
    return named.mapInPandas(cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The texts rebuilt from outputs and forms."""
    @F.pandas_udf("string")
    def rebuilt(output: pd.Series, form: pd.Series) -> pd.Series:
        return pd.Series([restore(o, f, markers) for o, f in zip(output, form, strict=True)], dtype=object)

    return rebuilt(output, form)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units,
             ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
             t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
             array_to_string(units[b + 1:], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN NOT plain THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE WHEN plain THEN t WHEN h4 % 100 < 50 THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                   ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
