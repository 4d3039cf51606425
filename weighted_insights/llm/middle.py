"""Fill-in-the-middle transformation of whole texts.

A text is cut at two places and its parts are rearranged behind marks, so that a model learns to write the middle from
both sides.  Cuts fall between units (lines or code points), work is done on bytes.  A slice of texts has one sparse
index of exceptions: the positions of its multibyte characters and the bytes that they have beyond one.  A cut is
converted between code points and bytes by one binary search in that index and an addition; ASCII text has no entry and
its positions are already right.  One narrow scan, no shuffle.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import map_texts, slices

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Settings:
    """Salt of the draws, what cuts lie between (``line`` or ``char``), shares in percent, and the three marks.

    Marks start with ``<`` and hold it nowhere else, so the end of a part and a mark cannot run into another mark.
    """

    salt: int = 7
    unit: str = "line"
    fim_percent: int = 100
    spm_percent: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        if self.unit not in ("line", "char"):
            raise ValueError(f"cuts lie between lines or chars, not {self.unit!r}")
        if len(set(self.marks)) < 3 or any(m.rfind("<") != 0 for m in self.marks):
            raise ValueError("three different marks that start with < and hold no other < are needed")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Exceptions:
    """Where code points and bytes part: one entry per multibyte character of ``data``."""

    def __init__(self, data: np.ndarray):
        self.byte_at = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte_at]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(extra)))
        self.char_at = self.byte_at - self.excess[:-1]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before byte positions that lie between characters."""
        return cuts - self.excess[np.searchsorted(self.byte_at, cuts, side="left")]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before code-point positions."""
        return cuts + self.excess[np.searchsorted(self.char_at, cuts, side="left")]


class Units:
    """The lines or code points of texts laid end to end, as global byte positions."""

    def __init__(self, texts: list[bytes], unit: str):
        self.raw = b"".join(texts)
        data = np.frombuffer(self.raw, np.uint8)
        self.ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        self.starts = np.concatenate(([0], self.ends[:-1]))[: len(texts)]
        self.exceptions = Exceptions(data)
        self.unit = unit
        if unit == "char":
            self.counts = self.exceptions.to_chars(self.ends) - self.exceptions.to_chars(self.starts)
        else:
            self.breaks = np.append(np.flatnonzero(data == 0x0A) + 1, 0)
            self.first = np.searchsorted(self.breaks[:-1], self.starts, side="right")
            broken = np.searchsorted(self.breaks[:-1], self.ends, side="right") - self.first
            open_end = (self.ends > self.starts) & (data[np.maximum(self.ends - 1, 0)] != 0x0A) if len(data) else False
            self.counts = broken + open_end

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The byte position behind the first ``units[i]`` units of text ``i``."""
        if self.unit == "char":
            return self.exceptions.to_bytes(self.exceptions.to_chars(self.starts) + units)
        inner = self.breaks[np.minimum(self.first + np.maximum(units, 1) - 1, len(self.breaks) - 1)]
        return np.where(units == 0, self.starts, np.where(units == self.counts, self.ends, inner))


def draws(doc_id: int | None, salt: int) -> list[int]:
    """Four numbers below 2 ** 32 that follow from the id; a null id draws like an empty one."""
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def rearranged(text: bytes, prefix: int, middle: int, form: str, marks: tuple[bytes, ...]) -> bytes:
    """The text in its form; ``prefix`` and ``middle`` are the byte positions where these parts end."""
    head, body, tail = text[:prefix], text[prefix:middle], text[middle:]
    p, s, m = marks
    if form == "psm":
        return b"".join((p, head, s, tail, m, body))
    if form == "spm":
        return b"".join((s, tail, p, head, m, body))
    return text


def fill_in_middle(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id``, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    ``form`` is ``plain`` (the text as it is; no counts), ``psm`` or ``spm``.  A null text counts as empty, and an empty text or one
    that holds a mark stays plain.  Rows that repeat an id are transformed alike, each with its own text; a null id draws
    like an empty one; an empty table gives no row; other columns are not read.  Texts are never cut short: one longer than a slice is
    a slice of its own.
    """
    marks = tuple(m.encode() for m in settings.marks)
    anywhere = re.compile(b"|".join(map(re.escape, marks)))

    def run(batches):
        for batch, texts in slices(batches):
            units = Units(texts, settings.unit)
            ids = batch.column("doc_id").to_pylist()
            drawn = np.array([draws(i, settings.salt) for i in ids], np.int64)
            cuts = np.sort(drawn[:, :2] % (units.counts + 1)[:, None], axis=1)
            first, second = units.cut(cuts[:, 0]), units.cut(cuts[:, 1])
            chars = [units.exceptions.to_chars(at) for at in (units.starts, first, second)]
            plain = drawn[:, 2] % 100 >= settings.fim_percent
            plain |= np.fromiter((not t or anywhere.search(t) is not None for t in texts), bool, len(texts))
            form = np.where(plain, "plain", np.where(drawn[:, 3] % 100 < settings.spm_percent, "spm", "psm")).tolist()
            made = [rearranged(t, a, b, f, marks) for t, a, b, f in zip(texts, (first - units.starts).tolist(), (second - units.starts).tolist(), form)]
            counts = [pa.array(c, pa.int64(), mask=plain) for c in (chars[1] - chars[0], chars[2] - chars[1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(units.counts, pa.int64()), pa.array(form), *counts, pa.array(made, pa.binary()).view(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return map_texts(docs, run, SCHEMA)


def restored(settings: Settings = Settings()):
    """The original text as an expression over ``form`` and ``output``."""
    pattern = "|".join(re.escape(m) for m in settings.marks)
    parts = F.split("output", pattern, -1)
    # Before the first mark there is nothing; behind it two parts in the order of the form, then the middle.
    head = F.when(F.col("form") == "psm", parts[1]).otherwise(parts[2])
    tail = F.when(F.col("form") == "psm", parts[2]).otherwise(parts[1])
    return F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat(head, parts[3], tail))


def round_trip(made: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The digest of each output, and of the text that its parts give back."""
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(settings).cast("binary"), 256).alias("restored_sha256"),
    )


#: The same rows in SQL, with the settings as they are by default.
SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS pieces,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, CAST(len(pieces) - CAST(pieces[-1] = '' AS BIGINT) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM texts),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
ends AS (
  SELECT *, CASE WHEN a = 0 THEN 0 WHEN a = n THEN length(t) ELSE length(array_to_string(pieces[1:a], chr(10))) + 1 END AS pa,
         CASE WHEN b = 0 THEN 0 WHEN b = n THEN length(t) ELSE length(array_to_string(pieces[1:b], chr(10))) + 1 END AS pb
  FROM cuts),
parts AS (SELECT *, substr(t, 1, pa) AS head, substr(t, pa + 1, pb - pa) AS body, substr(t, pb + 1) AS tail FROM ends)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(pa AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(pb - pa AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || body
                        ELSE '<S>' || tail || '<P>' || head || '<M>' || body END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
