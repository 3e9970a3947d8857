"""Quality rules as a short-circuit cascade: costs and rejections are estimated on a sample, cheap rejections come first."""

from __future__ import annotations

import io
import time
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chainfold.llm.common import arrow_pass, query, table, text_bytes

SAMPLE = 2_000                  # documents that costs and rejections are estimated on, at most about twice as many
WINDOW = 8                      # words of a repeated window
SLICE = 1 << 20
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


class Facts:
    """The measured facts of one document; each is made when a rule or a report first asks for it."""

    def __init__(self, data: bytes):
        self.data, self.known = data, {}

    def __getitem__(self, name: str) -> int:
        if name not in self.known:
            self.known |= FACTS[name](self.data)
        return self.known[name]


def _characters(data: bytes) -> dict:
    """Counts by kind of character, from one histogram of the bytes."""
    seen = np.zeros(256, np.int64)
    for at in range(0, len(data), SLICE):
        seen += np.bincount(np.frombuffer(data, np.uint8, min(SLICE, len(data) - at), at), minlength=256)
    of = lambda kinds: int(seen[list(kinds)].sum())
    points = int(seen.sum() - seen[0x80:0xC0].sum())
    return {"word_chars": points - of(SPACE), "n_symbols": of(SYMBOLS), "n_upper": of(range(65, 91)), "n_lower": of(range(97, 123)),
            "n_marks": of(b"!?"), "n_digits": of(range(48, 58))}


def _words(data: bytes) -> dict:
    """The number of words, counted by where a word begins."""
    total, gap = 0, True
    for at in range(0, len(data), SLICE):
        part = np.frombuffer(data, np.uint8, min(SLICE, len(data) - at), at)
        gaps = (part == 32) | ((part >= 9) & (part <= 13))
        total += int(np.count_nonzero(~gaps & np.r_[gap, gaps[:-1]]))
        gap = bool(gaps[-1])
    return {"n_words": total}


def _lines(data: bytes) -> dict:
    """Lines that hold a word, and those of them that repeat an earlier line."""
    lines, seen = 0, set()
    for line in io.BytesIO(data):
        if line.strip():
            lines += 1
            seen.add(line.rstrip(b"\n"))
    return {"n_lines": lines, "n_dup_lines": lines - len(seen)}


def _repeats(data: bytes) -> dict:
    """Words inside windows of WINDOW words that occur at least twice.

    Words become numbers, then runs of 2, 4 and 8 words do (equal runs get equal numbers), so the comparison is exact.
    """
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    parts, at = [], 0
    while at < len(data):
        end = at + SLICE
        if end < len(data):
            end = max(data.rfind(s, at, end) for s in (SPACE[i:i + 1] for i in range(len(SPACE))))
            if end <= at:
                end = min((p for s in (SPACE[i:i + 1] for i in range(len(SPACE))) if (p := data.find(s, at + SLICE)) > 0), default=len(data))
        parts.append(np.fromiter(map(numbers.__getitem__, data[at:end].split()), np.int64))
        at = end
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    length, total = 1, len(ids)
    while length < WINDOW and len(ids) > length:
        pair = ids[:-length] * (int(ids.max()) + 1) + ids[length:]
        found, ids = np.unique(pair, return_inverse=True)
        length *= 2
        if len(found) == len(ids):      # no run of this length occurs twice, so no longer one does
            return {"n_repeat_words": 0}
    if length < WINDOW:
        return {"n_repeat_words": 0}
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return {"n_repeat_words": int(np.count_nonzero(np.cumsum(edge)[:total]))}


FACTS: dict[str, Callable[[bytes], dict]] = {
    **dict.fromkeys(("word_chars", "n_symbols", "n_upper", "n_lower", "n_marks", "n_digits"), _characters), "n_words": _words,
    **dict.fromkeys(("n_lines", "n_dup_lines"), _lines), "n_repeat_words": _repeats}


@dataclass(frozen=True)
class Rule:
    """A rule rejects a document by facts about it; all arithmetic is on integers, so its verdict is exact."""
    name: str
    facts: tuple[str, ...]
    rejects: Callable[[Facts], bool]


BASE = (Rule("few_words", ("n_words",), lambda f: f["n_words"] < 20),
        Rule("repeats", ("n_repeat_words", "n_words"), lambda f: 100 * f["n_repeat_words"] > 30 * f["n_words"]))
RULES = BASE + (
    Rule("symbols", ("n_symbols", "n_words"), lambda f: 10 * f["n_symbols"] > f["n_words"]),
    Rule("shouting", ("n_upper", "n_lower"), lambda f: f["n_upper"] > f["n_lower"]),
    Rule("marks", ("n_marks", "n_words"), lambda f: 4 * f["n_marks"] > f["n_words"]),
    Rule("digits", ("n_digits", "word_chars"), lambda f: 2 * f["n_digits"] > f["word_chars"]),
    Rule("same_lines", ("n_dup_lines", "n_lines"), lambda f: 2 * f["n_dup_lines"] > f["n_lines"]),
    Rule("word_length", ("word_chars", "n_words"), lambda f: f["word_chars"] < 2 * f["n_words"] or f["word_chars"] > 20 * f["n_words"]))


def _groups(rule: Rule) -> set[Callable]:
    return {FACTS[name] for name in rule.facts}


def estimate(docs: DataFrame, text: str, rules: tuple[Rule, ...], sample: int = SAMPLE) -> tuple[dict[Callable, float], np.ndarray]:
    """Seconds a document for each kind of measurement, and which rules reject which sampled document (documents x rules).

    The sample is random over the whole table and of bounded size; it decides about the order of the rules only.
    """
    total = docs.count()
    chosen = docs.select(text_bytes(text).alias("t")).sample(min(1.0, sample / max(total, 1)), seed=7).limit(2 * sample)
    kinds = list(dict.fromkeys(FACTS[name] for rule in rules for name in rule.facts))

    def work(batch: pa.RecordBatch) -> dict:
        spent, verdicts = [], []
        for value in batch.column("t"):
            facts, cost = Facts(value.as_py()), []
            for kind in kinds:
                began = time.perf_counter()
                facts.known |= kind(facts.data)
                cost.append(time.perf_counter() - began)
            spent.append(cost)
            verdicts.append([bool(rule.rejects(facts)) for rule in rules])
        return {"spent": spent, "verdicts": verdicts}
    rows = arrow_pass(chosen, "spent array<double>, verdicts array<boolean>", work).collect()
    costs = np.array([r.spent for r in rows]).reshape(len(rows), len(kinds))
    return dict(zip(kinds, costs.mean(0) if len(rows) else np.ones(len(kinds)), strict=True)), np.array(
        [r.verdicts for r in rows], bool).reshape(len(rows), len(rules))


def ordered_rules(rules: tuple[Rule, ...], costs: dict[Callable, float], verdicts: np.ndarray) -> list[int]:
    """The rules by rejections per cost: each next one has the most rejections among what the sample's earlier rules left,
    divided by what it still has to measure. Ties follow the order of ``rules``."""
    left, known, order, rest = np.ones(len(verdicts), bool), set(), [], list(range(len(rules)))
    least = max(min(costs.values(), default=1.0), 1e-9) / 100      # the price of a rule whose facts are there
    while rest:
        def worth(i: int) -> float:
            price = least + sum(costs[kind] for kind in _groups(rules[i]) - known)  # noqa: B023
            return (verdicts[left, i].sum() + 1e-6) / price  # noqa: B023
        best = max(rest, key=lambda i: (worth(i), -i))
        order.append(best)
        rest.remove(best)
        known |= _groups(rules[best])
        left &= ~verdicts[:, best]
    return order


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES,
          report: tuple[str, ...] = (), sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, kept, rejected_by, evaluated (rules run), and the facts named in ``report``.

    The rules run in the order that the sample gave and stop at the first one that rejects; facts are made as they
    are needed. ``kept`` does not depend on the order; ``rejected_by`` (the first rule that rejected) and ``evaluated`` do.
    A fact in the report is made for every document, rejected ones too. A null text has no words. Repeated rows give
    equal rows, an empty table none; other columns are not looked at. Texts are measured in slices, the lines and
    word numbers of one text being held at a time.
    """
    order = [rules[i] for i in ordered_rules(rules, *estimate(docs, text, rules, sample))]

    def work(batch: pa.RecordBatch) -> dict:
        out = defaultdict(list)
        for value in batch.column("t"):
            facts, by, ran = Facts(value.as_py()), None, 0
            for rule in order:
                ran += 1
                if rule.rejects(facts):
                    by = rule.name
                    break
            out["kept"].append(by is None)
            out["rejected_by"].append(by)
            out["evaluated"].append(ran)
            for name in report:
                out[name].append(facts[name])
        return {"doc_id": batch.column("doc_id")} | {name: out[name] for name in ("kept", "rejected_by", "evaluated", *report)}
    rows = docs.select(F.col(id).alias("doc_id"), text_bytes(text).alias("t"))
    return arrow_pass(rows, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, kept boolean, rejected_by string, evaluated int"
                      + "".join(f", {name} bigint" for name in report), work)


BASE_FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_GAP = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"


def _kinds(class_: str) -> str:
    return f"length(regexp_replace(x, '[^{class_}]', '', 'g'))"


@query("op13_quality_cascade", rf"""WITH d AS (SELECT row_number() OVER () AS i, doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT i, doc_id, x, regexp_extract_all(x, '{_WORD}+') AS w, list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS l FROM d),
g AS (SELECT i, p, array_to_string(w[p:p + {WINDOW - 1}], ' ') AS g FROM (SELECT i, w, unnest(range(1, len(w) - {WINDOW - 2})) AS p FROM w)),
c AS (SELECT i, p FROM (SELECT i, p, count(*) OVER (PARTITION BY i, g) AS n FROM g) WHERE n > 1),
r AS (SELECT i, count(DISTINCT q) AS n_repeat_words FROM (SELECT i, unnest(range(p, p + {WINDOW})) AS q FROM c) GROUP BY i),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(x, '{_GAP}+', '', 'g')) AS word_chars, {_kinds('#*$%&|<>')} AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines,
  {_kinds('A-Z')} AS up, {_kinds('a-z')} AS low, {_kinds('!?')} AS marks, {_kinds('0-9')} AS digits FROM w LEFT JOIN r USING (i)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR up > low OR 4 * marks > n_words OR 2 * digits > word_chars OR 2 * n_dup_lines > n_lines
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept FROM b""")
def op13_quality_cascade(spark, d):
    judged = judge(table(spark, d, "documents"), report=BASE_FACTS)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", *BASE_FACTS, failed.alias("base_failed"), "kept")
