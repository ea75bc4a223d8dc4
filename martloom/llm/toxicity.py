"""Toxicity by a learned lexicon, matched with spelling errors and weighed by context.

1. Lexicon: words of labelled training texts whose share of toxic texts is far above their
   share of other texts, each with its log-odds as weight.
2. Matching: the lexicon is a trie; walking it with the Levenshtein automaton of all terms
   at once (a set of trie nodes, each with the edits used, made deterministic step by step)
   finds terms of 4 letters with 1 error and those of 7 with 2; a swap of neighbouring letters
   is one error.  A set of nodes that is empty ends a word after its first letters, which is
   nearly always.  A word with ``!*@$`` inside is matched as a whole and by its parts, and the
   reading with fewer errors counts.  How far misspelled forms of a term can be trusted is
   learned from the words of the training texts that match it with errors; those that clean
   texts use as words of their own are no misspellings.
3. Context: a hit between quotation marks, or in a line quoted with ``>``, within a window of
   characters counts for ``QUOTED`` of its weight, so that quotation is told from abuse.
4. Score: logistic regression over the hits' weights.

Training uses about ``train_rows`` labelled rows, chosen by a hash of their id; texts are scored
whole.  Null and empty texts have no hits and get the score of such texts, as does every text
when nothing can be learned (then 0).  Labels that repeat an id count as toxic if one does.  Rows
without an id are scored, never learned from, and not held out.  Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.texts import in_slices
from martloom.session import cut_lineage

TRAIN_ROWS = 20_000
MOST_TERMS = 5_000
QUOTED = 0.4
WINDOW = 80
_WORD = re.compile(r"\w+")
# a word with the signs that mask letters inside
_TOKEN = re.compile(r"\w+(?:[!*@$]+\w+)*")
_SIGNS = frozenset("!*@$")
# quotation marks that open a quotation and those that close it
_OPEN, _CLOSE = "\"“„«‹", "\"”“»›"


def errors_allowed(term: str) -> int:
    """Errors with which a term is still found: none in words of 3 letters, which have too many neighbours."""
    return 0 if len(term) < 4 else 1 if len(term) < 7 else 2


def words_of(text: str | None) -> list[str]:
    """The distinct words of a text; of those with signs inside also the parts."""
    found = set(_TOKEN.findall((text or "").lower()))
    return sorted(found.union(*(_WORD.findall(word) for word in found if not _SIGNS.isdisjoint(word))))


@dataclass
class FuzzyTrie:
    """Trie of terms, walked with a Levenshtein automaton that is made deterministic on the way.

    With ``swaps``, two neighbouring letters in the other order are one error.
    """

    terms: list[str]
    swaps: bool = False
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: dict[int, int] = field(default_factory=dict)
    allowed: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self):
        for number, term in enumerate(self.terms):
            node, errors = 0, errors_allowed(term)
            self.allowed[0] = max(self.allowed[0], errors)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], errors)
            self.ends[node] = number
        self._reset()

    def _reset(self) -> None:
        # states by number, 0 the empty one; their steps by letter; words seen
        self.states: list[tuple] = [()]
        self.numbers: dict[tuple, int] = {(): 0}
        self.steps: list[dict[str, int]] = [{}]
        self.found: dict[str, tuple[int, int] | None] = {}
        self.start = self._number(self._closed({0: 0}))

    def _number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        return self.numbers[state]

    def _closed(self, nodes: dict[int, int]) -> tuple[tuple[int, int, str], ...]:
        """Nodes with their least errors, and those reached by leaving out letters of a term."""
        waiting = list(nodes)
        while waiting:
            node = waiting.pop()
            for child in self.children[node].values():
                errors = nodes[node] + 1
                if errors <= self.allowed[child] and errors < nodes.get(child, 99):
                    nodes[child] = errors
                    waiting.append(child)
        return tuple((node, errors, "") for node, errors in sorted(nodes.items()))

    def _step(self, state: tuple, letter: str) -> tuple:
        nodes: dict[int, int] = {}
        swapped: dict[tuple[int, str], int] = {}  # nodes reached once the first letter of a swap follows
        for node, errors, awaited in state:
            if awaited:
                if letter == awaited and errors < nodes.get(node, 99):
                    nodes[node] = errors
                continue
            if errors + 1 <= self.allowed[node] and errors + 1 < nodes.get(node, 99):
                nodes[node] = errors + 1  # a letter too many
            for label, child in self.children[node].items():
                cost = errors + (label != letter)
                if cost <= self.allowed[child] and cost < nodes.get(child, 99):
                    nodes[child] = cost
                last = self.children[child].get(letter) if self.swaps and label != letter else None
                if last is not None and errors + 1 <= self.allowed[last]:
                    swapped[last, label] = min(errors + 1, swapped.get((last, label), 99))
        return self._closed(nodes) + tuple((node, errors, label) for (node, label), errors in sorted(swapped.items()))

    def match(self, word: str) -> tuple[int, int] | None:
        """``(term, errors)`` of the nearest term; none if no term is near enough."""
        if word in self.found:
            return self.found[word]
        if len(self.found) > 400_000 or len(self.states) > 100_000:
            self._reset()  # both are caches only
        state = self.start
        for letter in word:
            following = self.steps[state].get(letter)
            if following is None:
                following = self.steps[state][letter] = self._number(self._step(self.states[state], letter))
            state = following
            if not state:
                break
        near = [(errors, self.ends[node]) for node, errors, awaited in self.states[state]
                if not awaited and node in self.ends and errors <= errors_allowed(self.terms[self.ends[node]])]
        best = min(near, default=None)
        self.found[word] = best and (best[1], best[0])
        return self.found[word]


def is_quoted(text: str, start: int, end: int, window: int = WINDOW) -> bool:
    """Whether a hit lies between quotation marks of one line, or in a line that begins with ``>``."""
    line = text.rfind("\n", 0, start) + 1
    stop = text.find("\n", end)
    if text.startswith(">", line):
        return True
    before = text[max(line, start - window):start]
    after = text[end:min(stop if stop >= 0 else len(text), end + window)]
    opened = max((before.rfind(mark) for mark in _OPEN), default=-1)
    if opened < 0 or not any(mark in after for mark in _CLOSE):
        return False
    # an even number of straight marks before the hit means that the last one closed a quotation
    return before[opened] != '"' or before.count('"') % 2 == 1


@dataclass
class Lexicon:
    """Terms with the weight of a hit by its number of errors (0, 1, 2), and ordinary words that are near a term."""

    terms: list[str]
    weights: list[tuple[float, float, float]]
    ordinary: frozenset[str] = frozenset()

    def __post_init__(self):
        self.trie = FuzzyTrie(self.terms, swaps=True)

    def _match(self, word: str) -> tuple[int, int] | None:
        near = self.trie.match(word)
        return None if near and near[1] and word in self.ordinary else near

    def _hits(self, word: str) -> list[tuple[int, int, int, int]]:
        """``(start, end, term, errors)`` of a word as a whole, or of its parts if they have no more errors."""
        whole = self._match(word)
        parts = [] if _SIGNS.isdisjoint(word) else [
            (*part.span(), *near) for part in _WORD.finditer(word) if (near := self._match(part.group()))]
        if whole and all(whole[1] < errors for *_, errors in parts):
            return [(0, len(word), *whole)]
        return parts

    def features(self, text: str | None) -> list[float]:
        """Greatest weight, root of the summed weights, hits and hits per 100 words, all by context."""
        lower = (text or "").lower()
        words = _TOKEN.findall(lower)
        hits = {w: found for w in set(words) if (found := self._hits(w))}
        if not hits:
            return [0.0, 0.0, 0.0, 0.0]
        weights = []
        for found in _TOKEN.finditer(lower):
            for start, end, term, errors in hits.get(found.group(), ()):
                weight = self.weights[term][errors]
                at = found.start()
                weights.append(weight * QUOTED if is_quoted(lower, at + start, at + end) else weight)
        weights = [w for w in weights if w > 0]
        return [max(weights, default=0.0), math.sqrt(sum(weights)), math.log1p(len(weights)), min(10.0, 100 * len(weights) / len(words))]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``text, toxic`` of about ``train_rows`` labelled rows; the chosen labels are so few that they are sent to the texts."""
    known = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = min(1.0, train_rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1_000_000)) < share * 1_000_000)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def learn_lexicon(rows: DataFrame, least_texts: int = 3, least_odds: float = 1.5, most_terms: int = MOST_TERMS) -> Lexicon:
    """Terms whose log-odds stay above ``least_odds`` after taking off 1.64 standard errors."""
    @F.arrow_udf("array<string>")
    def words(texts: pa.Array) -> pa.Array:
        return pa.array([words_of(t) for t in in_slices(texts)], pa.list_(pa.string()))

    toxic, clean = (float(x or 0) for x in rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    counts = (rows.select(F.explode(words("text")).alias("word"), "toxic")
              .groupBy("word").agg(F.sum("toxic").cast("double").alias("t"), F.sum(1 - F.col("toxic")).cast("double").alias("c")))

    def odds(t: Column, c: Column) -> Column:
        return F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    t, c = F.col("t"), F.col("c")
    spread = 1.64 * F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    sure = odds(t, c) - spread
    counted = counts.filter("t > 0 OR c > 0")
    terms = (counted.filter(t >= least_texts).filter(sure >= least_odds).select("word", odds(t, c).alias("weight"))
             .orderBy(F.desc("weight"), "word").limit(most_terms).collect())
    weight = {r.word: r.weight for r in terms}
    names = sorted(weight)
    trie = FuzzyTrie(names, swaps=True)

    @F.arrow_udf("term bigint, errors int")
    def near(values: pa.Array) -> pa.Array:
        found = [trie.match(w) for w in values.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([m and m[0] for m in found], pa.int64()), pa.array([m and m[1] for m in found], pa.int32())],
                                          names=["term", "errors"])

    nearby = cut_lineage(counted.withColumn("m", near("word")).filter("m.errors > 0"))
    common = (c >= least_texts) & (odds(t, c) + spread < least_odds)
    ordinary = frozenset(r.word for r in nearby.filter(common).select("word").collect())
    forms = {(r.term, r.errors): (r.t, r.c) for r in nearby.filter(~common)
             .groupBy(F.col("m.term").alias("term"), F.col("m.errors").alias("errors")).agg(F.sum("t").alias("t"), F.sum("c").alias("c")).collect()}

    def form_weight(number: int, errors: int) -> float:
        t, c = forms.get((number, errors), (0.0, 0.0))
        seen = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        return max(0.0, ((t + c) * seen + 3 * weight[names[number]] / (1 + 0.5 * errors)) / (t + c + 3))
    return Lexicon(names, [(weight[name], form_weight(i, 1), form_weight(i, 2)) for i, name in enumerate(names)], ordinary)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    coefficients: list[float]
    intercept: float

    def score(self, text: str | None) -> float:
        z = self.intercept + float(np.dot(self.coefficients, self.lexicon.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    rows = training_rows(docs, labels, train_rows)
    lexicon = learn_lexicon(rows)

    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array([lexicon.features(t) for t in in_slices(texts)], pa.list_(pa.float64()))
    labelled = rows.select(array_to_vector(features("text")).alias("features"), F.col("toxic").cast("double").alias("label")).persist()
    try:
        classes = labelled.select("label").distinct().count()
        if classes < 2:
            return ToxicityModel(lexicon, [0.0] * 4, -700.0 if labelled.filter("label = 1").isEmpty() else 700.0)
        fitted = LogisticRegression(regParam=1e-3, maxIter=50).fit(labelled)
        return ToxicityModel(lexicon, [float(x) for x in fitted.coefficients], float(fitted.intercept))
    finally:
        labelled.unpersist()


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, predicted`` of every row."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t) for t in in_slices(texts)], pa.float64())
    return docs.select("doc_id", score("text").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
