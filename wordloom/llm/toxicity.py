"""Toxicity by a weighted finite-state grammar whose lexicon is learned from labels."""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import grammar
from wordloom.llm.common import schema_of, stored, text_slices

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_PREFIXES = range(3, 9)


def _features(word: str) -> list[str]:
    """A word as a whole and by its beginnings, which stand for its stem."""
    return [word[:size] + "-" for size in _PREFIXES if size < len(word)] + [word]


@dataclass(frozen=True)
class Model:
    """Weights of words and stems (``stem-``), and of a document's clauses.

    ``calibration`` weighs 1, the log of the summed clause weights, the largest clause
    weight and the log of the number of clauses with a hit. ``lone`` is the part of its
    weight that a hit outside of a clause pattern has.
    """

    lexicon: dict[str, float]
    calibration: tuple[float, float, float, float]
    lone: float = 1.0

    def probability(self, facts: tuple[float, float, float]) -> float:
        value = self.calibration[0] + sum(w * x for w, x in zip(self.calibration[1:], facts))
        return 1 / (1 + exp(-value)) if value > -700 else 0.0


class Scanner(dict):
    """Reads texts clause by clause; maps words to symbols, those with a weight to numbers
    from ``HIT``, whose classes are in ``kinds``."""

    def __init__(self, lexicon: dict[str, float], lone: float = 1.0):
        super().__init__()
        self.lexicon = lexicon
        self.lone = lone
        self.weights: list[float] = []
        self.kinds: list[int] = []
        self.machine = grammar.clause_grammar().steps
        self._fixed = (
            dict.fromkeys(grammar.COPULAS, grammar.COPULA)
            | dict.fromkeys(grammar.INTENTS, grammar.INTENT)
            | dict.fromkeys(grammar.SCORNS, grammar.SCORN)
            | dict.fromkeys(grammar.SUFFERS, grammar.SUFFER)
            | dict.fromkeys(grammar.PURSUITS, grammar.PURSUE)
            | dict.fromkeys(".!?;:\n", grammar.BREAK)
            | dict.fromkeys(grammar.TARGETS, grammar.TARGET)
            | dict.fromkeys(grammar.NEGATIONS, grammar.NEGATION)
            | dict.fromkeys(grammar.REPORTS, grammar.REPORT)
        )

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self._forget()
        # The longest entry that fits a word tells.
        weight = next(
            (self.lexicon[f] for f in reversed(_features(word)) if f in self.lexicon), None
        )
        if weight is None and word in grammar.THREATS:
            weight = 1.0
        if weight is not None and weight > 0:
            self.weights.append(weight)
            self.kinds.append(grammar.HARM if word in grammar.THREATS else grammar.HIT)
            symbol = grammar.HIT + len(self.weights) - 1
        else:
            symbol = self._fixed.get(word, grammar.OTHER)
        self[word] = symbol
        return symbol

    def _forget(self) -> None:
        self.clear()
        self.weights.clear()
        self.kinds.clear()

    def clauses(self, text: str) -> list[tuple[int, int, float]]:
        """Begin, end and weight of the clauses with a hit."""
        lower = text.lower()
        if len(self) > 400_000:
            self._forget()
        if max(map(self.__getitem__, _TOKEN.findall(lower)), default=0) < grammar.SCORN:
            return []
        found, state, total, begin, end = [], 0, 0.0, None, 0
        last, counted = 0.0, 0.0  # the last hit and the part of it that is in the total
        for match in _TOKEN.finditer(lower):
            symbol = self[match.group()]
            if symbol == grammar.BREAK:
                if total > 0:
                    found.append((begin, end, total))
                state, total, begin, last, counted = 0, 0.0, None, 0.0, 0.0
                continue
            begin = match.start() if begin is None else begin
            end = match.end()
            weight = grammar.ACCEPTED
            if symbol >= grammar.HIT:
                weight = self.weights[symbol - grammar.HIT]
                symbol = self.kinds[symbol - grammar.HIT]
            state, passed, factor = self.machine[state, symbol]
            if passed == grammar.AFTER:
                total += (factor - counted) * last
                last = 0.0
            elif passed == grammar.HIT or passed == grammar.PATTERN:
                last, counted = factor * weight, self.lone if passed == grammar.HIT else 1.0
                total += counted * last
        if total > 0:
            found.append((begin, end, total))
        return found


def clause_facts(clauses: list[tuple[int, int, float]]) -> tuple[float, float, float]:
    weights = [weight for _, _, weight in clauses]
    return log1p(sum(weights)), max(weights, default=0.0), log1p(len(weights))


def _counted(rows: DataFrame, choose) -> DataFrame:
    """``feature, toxic, clean``: documents with a feature, by label."""

    def count(batches):
        for batch, texts in text_slices(batches):
            totals: dict[str, list[int]] = {}
            for text, label in zip(texts, batch.column("toxic").to_pylist()):
                words = set(_TOKEN.findall(text.lower()))
                for feature in {f for word in words for f in choose(word)}:
                    totals.setdefault(feature, [0, 0])[0 if label else 1] += 1
            toxic, clean = zip(*totals.values()) if totals else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(totals, pa.string()), pa.array(toxic, pa.int64()), pa.array(clean, pa.int64())],
                names=["feature", "toxic", "clean"],
            )

    return (
        rows.mapInArrow(count, "feature string, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(weights))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        slope = x.T @ (y - p) - ridge @ weights
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(weights.tolist())


def train(
    documents: DataFrame,
    labels: DataFrame,
    fit_rows: int = 20_000,
    lone: float = 1.0,
) -> Model:
    """A model from ``labels`` (``doc_id, toxic``) of ``documents`` (``doc_id, text``).

    At most ``fit_rows`` labelled documents are used, those with the smallest hash of
    their ids; ids with null labels are left out, the larger of two labels counts. Spark
    counts in how many toxic and clean documents each word and each beginning of a word
    occurs; those with evidence beyond chance, given how many were tried, and mostly in
    toxic documents are candidates, of which these rows can have so many only. Words are then counted for their
    longest candidate only, and what still stands becomes the lexicon. With ``lone`` 0
    only clause patterns count, hits by themselves do not.
    """
    chosen = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    rows = stored(
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most fit_rows pairs of numbers
        .select("toxic", "text")
    )
    sizes = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sum(n for label, n in sizes.items() if label)
    if not clean or not toxic:
        return Model({}, (-3.0, 1.0, 0.5, 0.0), lone)

    def strongest(counts: DataFrame, tried: int) -> list:
        """The entries worth keeping."""
        rate = (toxic + 1) / (toxic + clean + 2)
        n = F.col("toxic") + F.col("clean")
        share = F.col("toxic") / n
        g = 2 * (
            F.col("toxic") * F.log(share / rate)
            + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / (1 - rate))).otherwise(0.0)
        )
        return (
            counts.filter((F.col("toxic") >= 3) & (share >= 0.8))
            .withColumn("g", g)
            .filter(F.col("g") >= 2 * log(max(tried, 2)))
            .select("feature")
            .collect()
        )

    counts = stored(_counted(rows, _features))
    # Rarer ones could not reach the evidence asked for, so they do not count as tried.
    tried = counts.filter("toxic + clean >= 5").count()
    candidates = {row["feature"] for row in strongest(counts, tried)}

    def longest(word: str) -> list[str]:
        return next(([f] for f in reversed(_features(word)) if f in candidates), [])

    lexicon = {
        row["feature"]: log((row["toxic"] + 0.5) / (toxic + 1)) - log((row["clean"] + 0.5) / (clean + 1))
        for row in _counted(rows, longest).collect()  # no more rows than candidates
        if row["toxic"] >= 3 * row["clean"]
    }

    def measure(batches):
        scanner = Scanner(lexicon, lone)
        for batch, texts in text_slices(batches):
            facts = [clause_facts(scanner.clauses(text)) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), *(pa.array(c, pa.float64()) for c in zip(*facts))],
                names=["toxic", "total", "largest", "number"],
            )

    measured = rows.mapInArrow(
        measure, "toxic int, total double, largest double, number double"
    ).toArrow()
    x = np.column_stack([measured[c].to_numpy() for c in ("total", "largest", "number")])
    return Model(lexicon, _fit(x, (measured["toxic"].to_numpy() > 0).astype(float)), lone)


def score_toxicity(
    documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, score, predicted, clauses`` for every row of ``documents``.

    Words are read as symbols of their classes, those of the lexicon and verbs of harm with
    a weight, and each clause runs through the composed transducers of threats, insults,
    negation, reported speech and targets; ``clauses`` has begin,
    end (in characters) and weight of every clause with a hit. A null or empty text has no
    clauses and scores as such; repeated rows and null ids are kept; other columns are not
    read. No shuffle.
    """

    def score(batches):
        scanner = Scanner(model.lexicon, model.lone)
        for batch, texts in text_slices(batches, text_column):
            found = [scanner.clauses(text) for text in texts]
            scores = [model.probability(clause_facts(clauses)) for clauses in found]
            spans = [[dict(zip(("begin", "end", "weight"), c)) for c in clauses] for clauses in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())]))),
                ],
                names=[id_column, "score", "predicted", "clauses"],
            )

    rows = documents.select(id_column, text_column)
    schema = schema_of(
        rows,
        [id_column],
        score="double",
        predicted="int",
        clauses="array<struct<begin:int,end:int,weight:double>>",
    )
    return rows.mapInArrow(score, schema)


def remove_toxic(documents: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``documents``, whole, whose text is not predicted to be toxic.

    Null and empty texts stay, as do repeated rows. No shuffle.
    """

    def keep(batches):
        scanner = Scanner(model.lexicon, model.lone)
        for batch, texts in text_slices(batches, text_column):
            facts = (clause_facts(scanner.clauses(text)) for text in texts)
            yield batch.filter(pa.array([model.probability(f) < 0.5 for f in facts], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)


def held_out(id_column: str = "doc_id"):
    """Whether the fold of an id, crc32 of its text modulo 5, is kept from training."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))
