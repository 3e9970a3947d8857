"""Fill-in-the-middle by piece tables: documents are descriptors over immutable buffers, never edited strings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chainfold.llm.common import arrow_pass, query, table

# The sentinel buffer, and the places of its three marks: before the prefix, the suffix and the middle.
MARKS = {"P": "<P>", "S": "<S>", "M": "<M>"}
BUFFER = "".join(MARKS.values())
TEXT, MARK = "text", "mark"
# What stands where in the output, by the names of the parts.
ORDERS = {"plain": ("whole",), "psm": ("P", "prefix", "S", "suffix", "M", "middle"), "spm": ("S", "suffix", "P", "prefix", "M", "middle")}
PARTS = ("prefix", "middle", "suffix")
PLAIN_FROM, SPM_BELOW = 90, 20          # of 100: documents left as they are; of the others, those with the suffix first
SLICE = 1 << 20


def piece(buffer: str | Column, start: Column, length: Column) -> Column:
    """A descriptor: ``length`` code points from ``start`` of a buffer."""
    return F.struct((F.lit(buffer) if isinstance(buffer, str) else buffer).alias("buffer"),
                    start.cast("long").alias("start"), length.cast("long").alias("length"))


def split(whole: Column, at: Column) -> tuple[Column, Column]:
    """Cutting splits a descriptor in two; the buffer stays as it is."""
    return piece(whole.buffer, whole.start, at), piece(whole.buffer, whole.start + at, whole.length - at)


def arrange(parts: dict[str, Column], order: tuple[str, ...]) -> Column:
    """The descriptors in the order of the output, marks being descriptors of the sentinel buffer."""
    marks = {name: piece(MARK, F.lit(BUFFER.index(mark)), F.lit(len(mark))) for name, mark in MARKS.items()}
    return F.array(*[(parts | marks)[name] for name in order])


def fim_tables(docs: DataFrame, id: str = "doc_id", text: str = "text", seed: str = "1") -> DataFrame:
    """One row per document: doc_id, text, n, form, prefix_chars, middle_chars, pieces (the piece table of the output).

    The cuts and the form follow from SHA-256 of ``seed``:id only, so a task that runs again cuts alike. A document is
    plain (one descriptor over its whole text) if its text is empty or holds a mark, or by the share of plain ones; then
    prefix_chars and middle_chars are null. A null text counts as empty, a null id as an empty one. Repeated rows
    give equal rows, an empty table none; other columns of the table are not looked at.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    draw = lambda k: F.conv(F.substring("h", 8 * k + 1, 8), 16, 10).cast("long")
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), digest.alias("h")).withColumn(
        "n", F.char_length("text").cast("long"))
    held = F.lit(False)
    for mark in MARKS.values():
        held = held | F.contains("text", F.lit(mark))
    form = F.when((F.col("n") == 0) | held | (draw(2) % 100 >= PLAIN_FROM), "plain").when(draw(3) % 100 < SPM_BELOW, "spm").otherwise("psm")
    one, two = draw(0) % (F.col("n") + 1), draw(1) % (F.col("n") + 1)
    cuts = rows.select("doc_id", "text", "n", form.alias("form"), F.least(one, two).alias("low"), F.greatest(one, two).alias("high"))
    whole = piece(TEXT, F.lit(0), F.col("n"))
    front, suffix = split(whole, F.col("high"))
    prefix, middle = split(front, F.col("low"))
    parts = {"whole": whole, "prefix": prefix, "middle": middle, "suffix": suffix}
    cut = F.col("form") != "plain"
    return cuts.select(
        "doc_id", "text", "n", "form", F.when(cut, F.col("low")).alias("prefix_chars"), F.when(cut, F.col("high") - F.col("low")).alias("middle_chars"),
        F.when(F.col("form") == "psm", arrange(parts, ORDERS["psm"])).when(F.col("form") == "spm", arrange(parts, ORDERS["spm"]))
        .otherwise(arrange(parts, ORDERS["plain"])).alias("pieces"))


def byte_places(data: bytes, points: list[int]) -> dict[int, int]:
    """Where code points begin in UTF-8 bytes, found slice by slice: no list of all places is made."""
    wanted, out, passed, base = sorted(set(points)), {}, 0, 0
    for base in range(0, len(data), SLICE):
        starts = np.flatnonzero((np.frombuffer(data, np.uint8, min(SLICE, len(data) - base), base) & 0xC0) != 0x80)
        while wanted and wanted[0] < passed + len(starts):
            out[wanted[0]] = base + int(starts[wanted[0] - passed])
            del wanted[0]
        passed += len(starts)
    return out | {point: len(data) for point in wanted}


def slices(data: bytes, pieces: list[dict]) -> list[memoryview]:
    """The bytes of each descriptor, as views of the buffers."""
    ends = [p for d in pieces if d["buffer"] == TEXT for p in (d["start"], d["start"] + d["length"])]
    places = byte_places(data, ends)
    text, mark = memoryview(data), memoryview(BUFFER.encode())
    return [text[places[d["start"]]:places[d["start"] + d["length"]]] if d["buffer"] == TEXT
            else mark[d["start"]:d["start"] + d["length"]] for d in pieces]


def restore(output: bytes, form: str) -> list[memoryview]:
    """The text's slices in their first order, found in the output by its form alone.

    The marks' places cut the output into descriptors; the inverse of the form's permutation puts them back. A cut text
    holds no mark, so the first one found after the last is the one that was set.
    """
    view, order = memoryview(output), ORDERS[form]
    if order == ("whole",):
        return [view]
    found, at = {}, 0
    marks = [MARKS[name].encode() for name in order[::2]]
    for i, name in enumerate(order[1::2]):
        start = output.index(marks[i], at) + len(marks[i])
        at = output.index(marks[i + 1], start) if i + 1 < len(marks) else len(output)
        found[name] = view[start:at]
    return [found[name] for name in PARTS]


def streamed(parts: list[memoryview]) -> str:
    """SHA-256 of the descriptors' bytes, one after the other."""
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[dict]]]:
    text, pieces = batch.column("text"), batch.column("pieces")
    return ((text[i].as_py(), pieces[i].as_py()) for i in range(batch.num_rows))


def rendered(tables: DataFrame) -> DataFrame:
    """(doc_id, form, output): the documents as they are trained on, written from their piece tables."""
    def work(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "form": batch.column("form"),
                "output": pa.array([b"".join(slices(*row)) for row in _rows(batch)], pa.binary()).cast(pa.string())}
    return arrow_pass(tables.select("doc_id", "form", F.col("text").cast("binary"), "pieces"),
                      f"doc_id {tables.schema['doc_id'].dataType.simpleString()}, form string, output string", work)


def restored(outputs: DataFrame) -> DataFrame:
    """(doc_id, text) from (doc_id, form, output)."""
    def work(batch: pa.RecordBatch) -> dict:
        whole = [b"".join(restore(o, f)) for o, f in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist(), strict=True)]
        return {"doc_id": batch.column("doc_id"), "text": pa.array(whole, pa.binary()).cast(pa.string())}
    return arrow_pass(outputs.select("doc_id", "form", F.col("output").cast("binary")),
                      f"doc_id {outputs.schema['doc_id'].dataType.simpleString()}, text string", work)


def digests(tables: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256; no output leaves its task.

    The output's hash streams the descriptors; the other one is of the text rebuilt from the output and the form.
    """
    kept = ("doc_id", "n", "form", "prefix_chars", "middle_chars")

    def work(batch: pa.RecordBatch) -> dict:
        out, back = [], []
        for (data, pieces), form in zip(_rows(batch), batch.column("form").to_pylist(), strict=True):
            parts = slices(data, pieces)
            out.append(streamed(parts))
            back.append(streamed(restore(b"".join(parts), form)))
        return {name: batch.column(name) for name in kept} | {"output_sha256": out, "restored_sha256": back}
    kinds = ", ".join(f"{name} {tables.schema[name].dataType.simpleString()}" for name in kept)
    return arrow_pass(tables.select(*kept, F.col("text").cast("binary"), "pieces"),
                      f"{kinds}, output_sha256 string, restored_sha256 string", work)


_MARKED = " OR ".join(f"contains(x, '{mark}')" for mark in MARKS.values())


@query("op12_fill_middle", f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
r AS (SELECT doc_id, x, length(x) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
  CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR {_MARKED} OR h3 % 100 >= {PLAIN_FROM} THEN 'plain' WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM r),
p AS (SELECT *, substr(x, 1, a) AS pre, substr(x, a + 1, b - a) AS mid, substr(x, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(x) AS restored_sha256 FROM p""")
def op12_fill_middle(spark, d):
    return digests(fim_tables(table(spark, d, "documents")))
