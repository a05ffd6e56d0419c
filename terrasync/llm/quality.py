"""Quality rules as a short-circuit cascade.

Rules reject documents. Each rule's cost (time) and selectivity (rejected share) are estimated on a
bounded sample; the cascade then runs the rules by rejection per cost, and a document that one rule
rejects is seen by no later one. A verdict is the conjunction of all rules, so it does not depend on
the order, which only decides how much work is done.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


class Document:
    """A text with its measures, each worked out when a rule first asks for it."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()  # bytes.split() takes the six ASCII spaces only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, _SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, _SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(_SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words covered by five-word windows that the text holds at least twice."""
        n = self.n_words
        if n < 6:
            return 0
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, n)
        code, v = ids, len(seen)
        if v**5 < 1 << 63:
            code = (((ids[:-4] * v + ids[1:-3]) * v + ids[2:-2]) * v + ids[3:-1]) * v + ids[4:]
        else:  # rank pairs of windows, so that codes stay exact
            code = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1]
            code = np.unique(code[:-2] * n + code[2:], return_inverse=True)[1]
            code = code[:-1] * v + ids[4:]
        ranked = np.sort(code)
        twice = ranked[1:][ranked[1:] == ranked[:-1]]
        if not len(twice):
            return 0
        hit = np.zeros(n + 1, np.int64)
        at = np.flatnonzero(np.isin(code, twice))
        np.add.at(hit, at, 1)
        np.add.at(hit, at + 5, -1)
        return int((np.cumsum(hit) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


BASE_RULES = (
    Rule("few_words", lambda d: d.n_words < 10),
    Rule("repetition", lambda d: 100 * d.n_repeat_words > 20 * d.n_words),
)
#: Beyond the base rules: thresholds far from ordinary prose in any script with spaces.
EXTRA_RULES = (
    Rule("symbols", lambda d: d.n_symbols > 0.5 * d.n_words),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 20 * d.n_words),
    Rule("duplicate_lines", lambda d: d.n_dup_lines > 0.5 * len(d.lines)),
)
RULES = BASE_RULES + EXTRA_RULES

#: Rows of the sample on which costs and selectivities are estimated, and tasks that look at them.
SAMPLE_ROWS, SAMPLE_TASKS = 512, 16
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plan_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules in the order in which to run them.

    A sample of about sample_rows rows is drawn over the whole table and dealt over a few tasks, as its texts
    may be very long. Greedily, the next rule is the one with the most rejections per second among the
    sample's rows that are still kept.
    The tasks return a time and a verdict for each sampled row and rule, no text.
    """
    total = docs.count()
    if not total:
        return tuple(rules)
    share = min(1.0, sample_rows / total)
    sample = docs.select(docs[text_col].alias("text")).sample(False, share, 42).repartition(SAMPLE_TASKS)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b["text"]:
                for k, rule in enumerate(rules):
                    d, began = Document(t), time.perf_counter()
                    rejected = bool(rule.rejects(d))
                    rows.append((k, time.perf_counter() - began, rejected))
            yield pd.DataFrame(rows, columns=["rule", "cost", "rejected"])

    seen = sample.mapInPandas(each, "rule int, cost double, rejected boolean").toPandas()
    if seen.empty:
        return tuple(rules)
    cost = np.array([seen.cost[seen.rule == k].sum() for k in range(len(rules))])
    rejected = np.array([seen.rejected[seen.rule == k].to_numpy(bool) for k in range(len(rules))])
    left, alive, order = list(range(len(rules))), np.ones(rejected.shape[1], bool), []
    while left:
        best = max(left, key=lambda k: (rejected[k][alive].sum() / max(cost[k], 1e-9), -cost[k], -k))
        order.append(rules[best])
        left.remove(best)
        alive &= ~rejected[best]
    return tuple(order)


def passes(d: Document, ordered: tuple[Rule, ...]) -> bool:
    return not any(rule.rejects(d) for rule in ordered)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", measures: bool = False) -> DataFrame:
    """A row for each row of docs: its id and kept, the verdict of the cascade.

    With measures the five counts and base_failed (the verdict of the base rules alone) come along, for
    which every document is measured in full. Null text: a text without words, which is rejected.
    Repeated rows are each judged; other columns are ignored; an empty table gives an empty result.
    """
    ordered = plan_cascade(docs, rules, text_col)
    one = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [Document(t) for t in b.column("text").to_pylist()]
            out = {"id": b.column("id"), "kept": pa.array([passes(d, ordered) for d in made], pa.bool_())}
            if measures:
                out |= {m: pa.array([getattr(d, m) for d in made], pa.int64()) for m in MEASURES}
                out["base_failed"] = pa.array([not passes(d, BASE_RULES) for d in made], pa.bool_())
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    kind = one.schema["id"].dataType.simpleString()
    more = "".join(f", {m} bigint" for m in MEASURES) + ", base_failed boolean" if measures else ""
    return one.mapInArrow(each, f"id {kind}, kept boolean{more}").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of docs that the cascade keeps, with all their columns."""
    ordered = plan_cascade(docs, rules, text_col)
    at = docs.columns.index(text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([passes(Document(t), ordered) for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(each, docs.schema)
