"""Toxicity by a weighted finite-state grammar over clauses.

The first transducer reads characters and gives insult and threat tokens with weights:
an automaton of threat verbs and of words and word beginnings that are learned from
labelled documents. The second reads the tokens of a clause as insult, threat, target,
negation or reported speech and carries a weight: a threat verb with a target nearby is a
threat, with a weight of its own; a target in the clause raises what is scored, a
negation before it or reported speech around it lowers it. A document's score is a
logistic regression on the weights of its clauses.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .rows import texts_of

# Word classes of the clause grammar, in the languages of the corpus.
THREAT = "kill hurt destroy burn shoot stab töten schlagen tuer brûler frapper matar golpear quemar".split()
TARGET = (
    "you your yours yourself he she they them him her his their du dich dir dein deine ihr euch er sie "
    "tu te toi ton ta vous votre vos il elle ils elles tú usted ustedes vosotros él ella ellos"
).split()
NEGATION = (
    "not no never neither nor without isn't aren't don't doesn't nicht kein keine nie niemals ohne "
    "ne pas jamais sans aucun nunca ni sin tampoco"
).split()
REPORT = (
    "said says say told quoted reported called claimed wrote sagte sagt schrieb nannte dit disait écrit "
    "appelé dijo dice escribió llamó"
).split()

RAISE, LOWER_NEGATED, LOWER_REPORTED = 1.25, 0.5, 0.7  # what a clause state does to a weight
NEAR = 4  # tokens between a negation and what it negates, or a threat verb and its target
VERB, AIMED = 1.0, 4.0  # weights of a threat verb alone, and of one with a target nearby
STEMS = range(4, 8)  # lengths of word beginnings that are learned
PER_LABEL = 3000  # labelled rows of each label that the model is fitted on, at most
CLAUSE_END = re.compile(r"[.!?;\n]")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")
FEATURES = 5


@dataclass
class Grammar:
    """Weights of words (ending in a space) and word beginnings, and of clause features."""

    weights: dict[str, float]
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))
    classes: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        self.classes = {w: "target" for w in TARGET} | {w: "negation" for w in NEGATION} | {w: "report" for w in REPORT}
        self.threats = frozenset(THREAT)
        self.automaton = None

    def __getstate__(self):
        return {"weights": self.weights, "coefficients": self.coefficients}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def _hits(self, text: str) -> list[tuple[int, float, bool]]:
        """(start of the word, weight, whether a threat verb); of several learned entries in a word the heaviest."""
        if self.automaton is None:
            entries: dict[str, list[tuple[bool, float, bool]]] = {}  # a word and a beginning may be one key
            for entry, weight in self.weights.items():
                entries.setdefault(entry.rstrip(" "), []).append((entry.endswith(" "), weight, False))
            for verb in self.threats:
                entries.setdefault(verb, []).append((True, VERB, True))
            self.automaton = ahocorasick.Automaton()
            for key, found in entries.items():
                self.automaton.add_word(key, (len(key), found))
            self.automaton.make_automaton()
        best: dict[int, tuple[float, bool]] = {}
        for end, (size, entries) in self.automaton.iter(text):
            start = end - size + 1
            if start and text[start - 1].isalpha():
                continue
            ends = end + 1 == len(text) or not text[end + 1].isalpha()
            for whole, weight, threat in entries:
                if ends or not whole:
                    before, verb = best.get(start, (0.0, False))
                    best[start] = max(weight, before), threat or verb
        return sorted((start, *found) for start, found in best.items())

    def clause(self, text: str, hits: list[tuple[int, float, bool]]) -> float:
        """Weight of one clause: hits are (offset in the clause, weight, whether a threat verb)."""
        at = {start: (weight, threat) for start, weight, threat in hits}
        state_target = state_report = False
        negated = target = -NEAR - 1
        total = 0.0
        waiting: list[tuple[int, float, float]] = []  # threats without a target yet: place, weight, share
        for place, m in enumerate(WORD.finditer(text)):
            kind = self.classes.get(m.group())
            if kind == "target":
                state_target, target = True, place
                total += sum(max(0.0, AIMED - w) * share for p, w, share in waiting if place - p <= NEAR)
                waiting = []
            elif kind == "negation":
                negated = place
            elif kind == "report":
                state_report = True
            if m.start() in at:
                weight, threat = at.pop(m.start())
                share = LOWER_NEGATED if place - negated <= NEAR else 1.0
                if threat and place - target <= NEAR:
                    weight = max(weight, AIMED)
                elif threat:
                    waiting.append((place, weight, share))
                total += weight * share
        total += sum(weight for weight, _ in at.values())  # a hit that the word pattern cuts elsewhere
        if state_target:
            total *= RAISE
        if state_report:
            total *= LOWER_REPORTED
        return total

    def features(self, text: str) -> list[float]:
        """Largest clause, all clauses, their number, weight by length, distinct words."""
        hits = self._hits(text)
        if not hits:
            return [0.0] * FEATURES
        clauses: list[float] = []
        end, group, start = -1, [], 0
        distinct = set()
        for pos, weight, threat in hits:
            distinct.add(text[pos : pos + 6])
            if pos >= end:
                if group:
                    clauses.append(self.clause(text[start:end], group))
                low = max(end, 0)
                start = max((text.rfind(c, low, pos) for c in ".!?;\n"), default=-1) + 1
                start = max(start, low)
                stop = CLAUSE_END.search(text, pos)
                end, group = (stop.start() if stop else len(text)), []
            group.append((pos - start, weight, threat))
        clauses.append(self.clause(text[start:end], group))
        total = sum(clauses)
        return [
            max(clauses), float(np.log1p(total)), float(np.log1p(len(clauses))),
            float(np.log1p(1000.0 * total / max(50, len(text)))), float(np.log1p(len(distinct))),
        ]

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = features @ self.coefficients[1:] + self.coefficients[0]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def learn_weights(rows: DataFrame) -> dict[str, float]:
    """Log odds of words and word beginnings that mark toxic rows of (text, toxic).

    A token counts once for each different word before it, not once per document: a
    group of near copies then weighs as much as one document.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[tuple[str, int, int], int] = {}
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                doc, last = zlib.crc32(text.encode()), 0
                for word in WORD.findall(text):
                    for token in (word + " ", *(word[:n] for n in STEMS if n <= len(word))):
                        out.setdefault((token, last, int(toxic)), doc)
                    last = zlib.crc32(word.encode())
                if len(out) > 400_000:
                    yield pd.DataFrame([(*k, v) for k, v in out.items()], columns=["w", "last", "toxic", "doc"])
                    out = {}
            yield pd.DataFrame([(*k, v) for k, v in out.items()], columns=["w", "last", "toxic", "doc"])

    counts = (
        rows.mapInPandas(count, "w string, last long, toxic int, doc long")
        .groupBy("w", "last", "toxic")
        .agg(F.min("doc").alias("doc"))
        .groupBy("w")
        .agg(
            F.sum("toxic").alias("t"),
            F.sum(1 - F.col("toxic")).alias("c"),
            F.count_distinct(F.when(F.col("toxic") == 1, F.col("doc"))).alias("docs"),
        )
    )
    counts = cut_lineage(counts.filter("t > 0"))
    size = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    n_toxic, n_clean = size["t"] or 1, size["c"] or 1
    marked = counts.withColumn(
        "weight", F.log(((F.col("t") + 0.5) / n_toxic) / ((F.col("c") + 0.5) / n_clean))
    ).filter((F.col("weight") > 2.5) & (F.col("t") >= max(5, round(2e-5 * n_toxic))) & (F.col("docs") >= 3))
    # no more rows than the fitted sample has frequent tokens; beginnings that a shorter one covers are dropped
    found = {r["w"]: r["weight"] for r in marked.select("w", "weight").collect()}
    kept = {}
    for w, weight in found.items():
        bare = w.rstrip(" ")
        shorter = [found.get(w[:n]) for n in STEMS if n < len(bare) or (n == len(bare) and w != bare)]
        if not any(s is not None and s >= weight - 0.7 for s in shorter):
            kept[w] = float(min(weight, 6.0))
    return kept


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Coefficients (constant first) by Newton steps on a ridge-penalised likelihood."""
    a = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(a.shape[1])
    penalty = ridge * np.eye(a.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ (weight * (y - p)) - penalty @ beta
        curve = (a * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + penalty
        step = np.linalg.solve(curve, gradient)
        beta += step / max(1.0, float(np.abs(step).max()) / 5.0)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Grammar:
    """A grammar learned from at most ``per_label`` rows of each label that are not held out.

    Rows are taken in the order of a hash of their id. Labels other than 0 and 1 and
    null ids are not used; without rows of both labels every text scores below one half.
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        "doc_id IS NOT NULL AND toxic IN (0, 1)"
    )
    usable = usable.filter(~held_out("doc_id"))
    order = F.xxhash64("doc_id")
    taken = [usable.filter(F.col("toxic") == t).orderBy(order, "doc_id").limit(per_label) for t in (0, 1)]
    sample = taken[0].unionByName(taken[1])
    rows = texts_of(docs, "doc_id", lower=True).join(F.broadcast(sample), "doc_id").select("text", "toxic")
    rows = rows.repartition(max(8, docs.sparkSession.sparkContext.defaultParallelism))
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Grammar({}, np.array([-2.0] + [0.0] * FEATURES))
    grammar = Grammar(learn_weights(rows))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [grammar.features(t) for t in batch["text"]], "y": batch["toxic"].to_numpy()})

    found = rows.mapInPandas(measure, "x array<double>, y int").collect()
    x = np.array([r["x"] for r in found]).reshape(len(found), FEATURES)
    y = np.array([r["y"] for r in found], dtype=float)
    even = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    grammar.coefficients = fit_logistic(x, y, even)
    return grammar


def score(docs: DataFrame, grammar: Grammar, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and score (0 to 1) of every row, from its text alone.

    A null text scores like an empty one; repeated rows score alike; an empty table
    gives no rows. A column ``score`` of the input is not kept.
    """
    keep = [c for c in keep if c != "score"]
    kept = docs.select(*keep)
    names = [*kept.columns, "score"]
    model = docs.sparkSession.sparkContext.broadcast(grammar)  # bounded by the fitted sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = model.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            x = np.array([g.features(t) for t in texts]).reshape(len(texts), FEATURES)
            columns = batch.columns[:-1] + [pa.array(g.scores(x), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias(max([*keep, "text"], key=len) + "_")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.select(*keep, text).mapInArrow(run, schema)
