"""Benchmark decontamination: questions are found also with other numbers, names and units in them."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chainfold.llm.common import STEP, arrow_pass, mix, query, shingles, stored, table, text_bytes, without

WIDTH = 8           # words of a window
LITERAL = 5         # of which so many are no slots
COVERAGE = 0.5      # part of an item's windows that makes a leak
LONG = 30           # or so many windows of an item, whatever its length
RUN = 13            # consecutive words of an item, or all of a shorter one, that make a leak when copied as they are
LEAST = 5           # words of the shortest item that is looked for
BITS = 24
NUMBER, UNIT, NAME = 1, 2, 3

# Units that count as such behind a number.
UNITS = frozenset("""% percent mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons
lb lbs pound pounds oz ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours
day days week weeks month months year years $ dollar dollars cent cents euro euros usd eur hz khz mhz ghz w kw v volt volts a j kj
degree degrees celsius fahrenheit km/h mph m/s kmh""".split())
EDGE = re.compile(r"^[^\w$%+-]+|[^\w%]+$")


class Forms(dict):
    """Word -> its form as a number: a hash above four marks. Emptied when it has grown large, so its size is bounded."""
    MOST = 300_000

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace")
        if text.isalpha():      # nothing to strip and no digit
            low, marks = text.lower(), text[0].isupper() << 1
        else:
            core = EDGE.sub("", text) or text
            low = core.lower()
            marks = any(map(str.isdigit, core)) | core[:1].isupper() << 1 | (text.rstrip("\"')]}»”")[-1:] in ".!?:") << 2
        value = xxhash.xxh64_intdigest(low.encode("utf-8", "replace")) >> 5 << 4 | marks | (low in UNITS) << 3
        if len(self) >= self.MOST:
            self.clear()
        self[word] = value
        return value


_forms = Forms()


def canonical(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The template of a text, a number a word, and the values in its slots (0 where a word is no slot).

    Words with digits are numbers; a known unit behind a number is a unit; a capital letter that starts no sentence is a
    name. Slots of one type look alike. Other words count by their letters, without case and outer punctuation.
    """
    words = text.split()
    form = np.fromiter(map(_forms.__getitem__, words), np.uint64, len(words))
    if not len(form):
        return form, form
    marks, value = form & np.uint64(15), form >> np.uint64(4)
    before = np.r_[np.uint64(4), marks[:-1]]
    number = (marks & np.uint64(1)) > 0
    unit = ~number & ((marks & np.uint64(8)) > 0) & ((before & np.uint64(1)) > 0)
    name = ~number & ~unit & ((marks & np.uint64(2)) > 0) & ((before & np.uint64(4)) == 0)
    kind = number * NUMBER + unit * UNIT + name * NAME
    return np.where(kind > 0, kind.astype(np.uint64), value + np.uint64(16)), np.where(kind > 0, value, np.uint64(0))


def windows(text: bytes, widths: list[int], runs: list[int]) -> tuple[np.ndarray, ...]:
    """Hash, first word, width and kind of each window, and the slot values of the text.

    Kind 0: templates of ``widths`` words, with enough literal ones. Kind 1: the words themselves, ``runs`` of them,
    without case and outer punctuation, whatever they are.
    """
    template, slots = canonical(text)
    literal = np.r_[0, np.cumsum(slots == 0)]
    out = [[], [], [], []]

    def add(hashes, at, width, kind):
        for column, values in zip(out, (hashes, at, np.full(len(at), width), np.full(len(at), kind)), strict=True):
            column.append(values)
    for width in widths:
        if len(template) >= width:
            at = np.flatnonzero(literal[width:] - literal[:-width] >= LITERAL)
            add(mix(shingles(template, width)[at] + np.uint64(width)), at, width, 0)
    said, rolled = np.where(slots > 0, slots, template - np.uint64(16)), np.zeros(len(template) + 1, np.uint64)
    for width in range(1, min(max(runs, default=0), len(said)) + 1):
        rolled = rolled[:-1] * STEP + said[width - 1:]
        if width in runs:
            add(mix(mix(rolled) + np.uint64(width << 8)), np.arange(len(rolled)), width, 1)
    kinds = (np.uint64, np.int64, np.int64, np.int64)
    return *(np.concatenate(o) if o else np.empty(0, t) for o, t in zip(out, kinds, strict=True)), slots


HIT = "hash bigint, at int, width int, slots array<bigint>"


def _rows(ids, found) -> dict:
    """Columns of the windows found; a verbatim one has no slots."""
    out = {"id": [], "hash": [], "at": [], "width": [], "slots": []}
    for i, (hashes, starts, widths, kinds, slots) in zip(ids, found, strict=True):
        out["id"] += [i] * len(hashes)
        out["hash"] += hashes.view(np.int64).tolist()
        out["at"] += starts.tolist()
        out["width"] += widths.tolist()
        out["slots"] += [slots[:0].view(np.int64) if k else slots[a:a + w].view(np.int64)
                         for a, w, k in zip(starts.tolist(), widths.tolist(), kinds.tolist(), strict=True)]
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, kind, matched, windows, coverage, first_word, last_word.

    Both sides become templates, cut into overlapping windows of WIDTH words (an item of 5 to 7 words is one window;
    shorter ones cannot be told from chance and are not looked for). A bitmap of fixed size of the benchmark's windows is
    all that tasks get ahead; windows that it lets through are joined by hash. Windows at the same offset form a match.
    If every slot value of the item stands for one value of the document throughout the match, all its windows count: it
    is ``verbatim`` if the values are the same, else ``reparameterised``. Otherwise only windows with the same values
    count. A leak is an item of which COVERAGE of the windows, or LONG windows, are matched. Templates need LITERAL words
    that are no slots; so the words themselves are looked for too, slots or not: RUN consecutive words of an item, or all
    words of a shorter one, are a ``verbatim`` leak, and matched, windows and coverage then count such runs.

    Null texts count as empty and give no row, as do empty tables. Rows that repeat a doc_id are looked at one by one; a
    null id stays null. Very long texts are cut whole, one at a time. Other columns are not looked at.
    """
    kind = docs.select(F.col(id).alias("id")).schema["id"].dataType.simpleString()
    item_kind = benchmark.select(F.col(item).alias("id")).schema["id"].dataType.simpleString()

    def cut_items(batch: pa.RecordBatch) -> dict:
        found = []
        for t in batch.column(1).to_pylist():
            n = len(t.split())
            found.append(windows(t, [min(WIDTH, n)], [min(RUN, n)]) if n >= LEAST else windows(b"", [], []))
        return _rows(batch.column(0).to_pylist(), found)
    items = arrow_pass(benchmark.select(F.col(item).alias("id"), text_bytes(item_text)), f"id {item_kind}, {HIT}", cut_items).distinct()
    items = items.persist()
    is_run = F.size("slots") == 0
    lengths = sorted((r.width, r.run) for r in items.select("width", is_run.alias("run")).distinct().collect())
    widths, runs = [w for w, run in lengths if not run], [w for w, run in lengths if run]
    cell = F.shiftrightunsigned("hash", 64 - BITS)
    words = items.groupBy(F.shiftright(cell, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITS}) & 63 as int))")).alias("bits")).collect()
    bitmap = np.zeros(1 << (BITS - 6), np.uint64)
    for r in words:
        bitmap[r.word] = np.uint64(r.bits & 0xFFFFFFFFFFFFFFFF)
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    def search(batch: pa.RecordBatch) -> dict:
        found, bits = [], held.value
        for t in batch.column(1).to_pylist():
            *columns, slots = windows(t, widths, runs)
            at = columns[0] >> np.uint64(64 - BITS)
            hit = (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) > 0
            found.append((*(c[hit] for c in columns), slots))
        out = _rows(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True), found)
        return {**out, "row": [r for _, r in out["id"]], "id": [i for i, _ in out["id"]]}
    hits = stored(arrow_pass(docs.select(F.col(id).alias("id"), text_bytes(text), F.monotonically_increasing_id()),
                             f"id {kind}, {HIT}, row bigint", search))
    asked = items.select(F.col("id").alias("item_id"), F.col("hash").alias("h"), F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    sizes = items.groupBy(F.col("id").alias("i")).agg(
        F.countDistinct(F.when(~is_run, F.col("at"))).alias("windows"), F.countDistinct(F.when(is_run, F.col("at"))).alias("runs"))
    pairs = F.filter(F.arrays_zip("item_slots", "slots"), lambda p: p["item_slots"] != 0)
    met = hits.where(~is_run).join(asked, F.col("hash") == F.col("h")).select(
        "row", "id", "item_id", "at", "item_at", "width", pairs.alias("pairs"))
    same = F.forall("pairs", lambda p: p["item_slots"] == p["slots"])
    matches = met.groupBy("row", "id", "item_id", (F.col("at") - F.col("item_at")).alias("offset")).agg(
        F.collect_set("item_at").alias("every"), F.collect_set(F.when(same, F.col("item_at"))).alias("equal"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"), F.min("at").alias("low"), F.max(F.col("at") + F.col("width")).alias("high"))
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_slots"])))
    counted = matches.withColumn("windows_in", F.when(consistent, F.col("every")).otherwise(F.col("equal"))).withColumn(
        "changed", consistent & ~same)
    by_template = counted.where(F.size("windows_in") > 0).groupBy("row", "id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("windows_in")))).alias("matched"), F.max("changed").alias("changed"),
        F.min("low").alias("first_word"), F.max("high").alias("last_word"))
    share = F.col("matched") / F.col("windows")
    by_template = by_template.join(sizes, F.col("item_id").eqNullSafe(F.col("i"))).where((share >= COVERAGE) | (F.col("matched") >= LONG))
    by_words = hits.where(is_run).join(asked, F.col("hash") == F.col("h")).groupBy("row", "id", "item_id").agg(
        F.countDistinct("item_at").cast("int").alias("matched"), F.lit(False).alias("changed"), F.min("at").alias("first_word"),
        F.max(F.col("at") + F.col("width")).alias("last_word")).join(sizes, F.col("item_id").eqNullSafe(F.col("i"))).withColumn("windows", F.col("runs"))
    told = ["matched", "windows", "changed", "first_word", "last_word"]
    found = by_template.withColumn("first", F.lit(1)).unionByName(by_words.withColumn("first", F.lit(0))).groupBy("row", "id", "item_id").agg(
        F.max(F.struct("first", *told)).alias("best")).select("id", "item_id", "best.*")
    return found.select(
        F.col("id").alias("doc_id"), "item_id", F.when(F.col("changed"), "reparameterised").otherwise("verbatim").alias("kind"),
        "matched", "windows", share.alias("coverage"), "first_word", "last_word")


@query("op6_template_leaks")
def op6_template_leaks(spark, d):
    return leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which no item leaks, all columns kept."""
    mark = F.xxhash64(F.col(id).cast("string"), text_bytes(text))
    gone = leaks(docs.select(mark.alias("mark"), F.col(text).alias("text")), benchmark, id="mark").select("doc_id").distinct()
    return without(docs, mark, gone)
