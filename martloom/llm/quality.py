"""Quality rules as a short-circuit cascade.

Every rule looks at the same lazily computed facts of a text.  Cost and rejection rate of
each rule are measured on a sample, inside the tasks, and the rules then run in the order
of rejections per second; the first failing rule ends the work on a text.  The verdict is
"no rule fails", so the order changes the time only, never the result.

Null and empty texts have no words and fail the base rule.  Rows are judged one by one:
repeated rows, ties and null ids need no special case, an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.texts import CONTINUATION, SPACE, unused, utf8

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
FACTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"


class TextFacts:
    """Counts over one whole text, each computed when a rule first asks for it."""

    def __init__(self, raw: bytes | None):
        self.raw = raw or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.raw.translate(None, SPACE + CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line.strip(SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(*(w[i:] for i in range(WINDOW))))
        if len(set(windows)) == len(windows):
            return 0
        counts, marked = Counter(windows), bytearray(len(w))
        for at, window in enumerate(windows):
            if counts[window] > 1:
                marked[at:at + WINDOW] = b"\1" * WINDOW
        return sum(marked)

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < 10 or 100 * self.n_repeat_words > 20 * self.n_words

    @cached_property
    def text(self) -> str:
        return self.raw.decode("utf-8", "replace")


@dataclass(frozen=True)
class Rule:
    """``passes`` tells whether a text may stay."""

    name: str
    passes: Callable[[TextFacts], bool]


def _few_symbols(f: TextFacts) -> bool:
    return 10 * f.n_symbols <= f.n_words


def _few_equal_lines(f: TextFacts) -> bool:
    return f.n_dup_lines < 3 or 10 * f.n_dup_lines <= 3 * len(f.lines)


def _few_doubled_words(f: TextFacts) -> bool:
    return 10 * sum(map(bytes.__eq__, f.words, f.words[1:])) <= 3 * f.n_words


def _usual_word_length(f: TextFacts) -> bool:
    return 2 * f.n_words <= f.word_chars <= 15 * f.n_words


def _mostly_lower_case(f: TextFacts) -> bool:
    return 10 * sum(map(str.isupper, f.text)) <= 3 * f.word_chars


def _words_have_letters(f: TextFacts) -> bool:
    return 10 * sum(any(map(str.isalpha, w)) for w in map(bytes.decode, f.words)) >= 5 * f.n_words


RULES = (
    Rule("symbols per word", _few_symbols),
    Rule("equal lines", _few_equal_lines),
    Rule("doubled words", _few_doubled_words),
    Rule("word length", _usual_word_length),
    Rule("capitals", _mostly_lower_case),
    Rule("words with letters", _words_have_letters),
)


def measure_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows_per_task: int = 256) -> dict[str, tuple[int, int, float]]:
    """Per rule: texts tried, texts rejected and seconds, from the first rows of every task.

    Each task reads at most ``rows_per_task`` rows of its first batch and stops; the driver
    receives one summed row per rule.
    """
    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.islice(batches, 1):
            facts = [TextFacts(raw) for raw in utf8(batch.column(0).slice(0, rows_per_task))]
            facts = [f for f in facts if not f.base_failed]  # the cascade only sees these
            rejected, seconds = [], []
            for rule in rules:
                begun = time.perf_counter()
                rejected.append(sum(not rule.passes(f) for f in facts))
                seconds.append(time.perf_counter() - begun)
            yield pa.RecordBatch.from_pydict({
                "rule": [r.name for r in rules], "tried": [len(facts)] * len(rules), "rejected": rejected, "seconds": seconds})

    rows = (docs.select("text").mapInArrow(tried, "rule string, tried bigint, rejected bigint, seconds double")
            .groupBy("rule").agg(F.sum("tried"), F.sum("rejected"), F.sum("seconds")).collect())
    return {r[0]: (r[1], r[2], r[3]) for r in rows}


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows_per_task: int = 256) -> tuple[Rule, ...]:
    """Rules by rejections per second of the sample, best first; rules that reject nothing by cost."""
    measured = measure_rules(docs, rules, rows_per_task)

    def place(rule: Rule) -> tuple[float, float, str]:
        _, rejected, seconds = measured.get(rule.name, (0, 0, 0.0))
        return -rejected / max(seconds, 1e-9), seconds, rule.name
    return tuple(sorted(rules, key=place))


def quality_facts(rules: tuple[Rule, ...] = RULES) -> Callable[[Column], Column]:
    """Column function: the counts of a text and its verdict under ``rules`` in the given order."""
    @F.arrow_udf(FACTS)
    def facts(texts: pa.Array) -> pa.Array:
        out = [TextFacts(raw) for raw in utf8(texts)]
        return pa.StructArray.from_arrays([
            pa.array([f.n_words for f in out], pa.int64()), pa.array([f.word_chars for f in out], pa.int64()),
            pa.array([f.n_symbols for f in out], pa.int64()), pa.array([f.n_dup_lines for f in out], pa.int64()),
            pa.array([f.n_repeat_words for f in out], pa.int64()), pa.array([f.base_failed for f in out], pa.bool_()),
            pa.array([not f.base_failed and all(r.passes(f) for r in rules) for f in out], pa.bool_()),
        ], names=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])
    return facts


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every row."""
    facts = quality_facts(cascade_order(docs, rules))
    return docs.select("doc_id", facts("text").alias("f")).select("doc_id", "f.*")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass the base rule and every further rule, unchanged.

    Only the rules run here: a rejected text costs no more than the rules up to its first failure.
    """
    ordered, flag = cascade_order(docs, rules), unused(docs, "_good")

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        facts = (TextFacts(raw) for raw in utf8(texts))
        return pa.array([not f.base_failed and all(r.passes(f) for r in ordered) for f in facts], pa.bool_())
    return docs.withColumn(flag, good("text")).filter(F.col(flag)).drop(flag)
