"""Language identification with a blended-spectrum string kernel.

Two texts are as similar as the number of distinct character n-grams, of 1 to ``degree`` characters,
that occur in both: the blended-spectrum presence kernel, divided by the square root of the product
of the texts' own numbers. Case is ignored, and each character that is no letter counts as the same
break. Nyström: a few landmark texts span the space, so a text is its kernel row against them times
K_mm^(-1/2). On these features a ridge regression is fitted for each language against the rest.

Fitting uses a bounded sample: at most ``per_language`` distinct texts of each language, drawn by
hash, each of at most ``longest`` characters (longer ones are left out whole); the first
``landmarks`` of them, dealt over the languages, are the landmarks. Prediction reads whole texts:
n-grams are numbered by walking tables of the landmarks' n-grams, presence rows are collected in a
batch, and two matrix products give kernel rows and scores.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tramline.llm.words import text_slices
from tramline.session import stage

BATCH = 256  # texts of one matrix product
UNKNOWN, BREAK = 0, 1  # symbols of other letters and of all characters that are no letters


@functools.cache
def _letters() -> np.ndarray:
    """True for the code points of letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


@dataclass
class Model:
    languages: list[str]
    alphabet: np.ndarray  # sorted code points; symbol 2 is the first
    tables: list[np.ndarray]  # tables[n][gram of n symbols, next symbol] -> gram of n + 1 symbols, 0: none
    first_feature: list[int]  # of each n-gram length
    features: int
    landmarks: np.ndarray  # landmark rows, each of length 1, one column a landmark
    weights: np.ndarray  # of the languages, for kernel rows; the last row is the constant
    least_known: float = 0.0  # share of known n-grams below which no language is meant

    def symbols(self, text: str) -> np.ndarray:
        return self._lookup()[code_points(text)]

    def _lookup(self) -> np.ndarray:
        table = self.__dict__.get("_table")
        if table is None:
            table = np.where(_letters(), UNKNOWN, BREAK).astype(np.int32)
            table[self.alphabet] = np.arange(len(self.alphabet)) + 2
            self.__dict__["_table"] = table
        return table

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def mark(self, symbols: np.ndarray, row: np.ndarray) -> None:
        """Set the features of the n-grams that occur."""
        gram = np.where(symbols >= 1, symbols, 0)
        row[gram] = 1
        for n, table in enumerate(self.tables, 1):
            gram = table[gram[:-1], symbols[n:]]
            row[self.first_feature[n] + gram] = 1
        row[self.blank()] = 0

    def blank(self) -> list[int]:
        """The places of "none" of each length, and of the break alone."""
        return [*self.first_feature, BREAK]

    def known(self, text: str | None) -> float:
        """Share of the runs of ``degree`` characters, breaks joined, that some landmark has; those of breaks alone do not count.

        Letters outside the alphabet are in no landmark. A text without letters has the share 0.
        """
        s = self.symbols(text or "")
        s = s[np.append(True, (s[1:] != BREAK) | (s[:-1] != BREAK))] if len(s) else s
        s = np.concatenate([[BREAK], s[int(s[0] == BREAK) :], [BREAK] * int(s[-1] != BREAK)]).astype(np.int64) if len(s) else s
        size = min(len(self.tables) + 1, len(s))
        if size == 0 or not (s != BREAK).any():
            return 0.0
        gram = np.where(s >= 1, s, 0)
        for n, table in enumerate(self.tables[: size - 1], 1):
            gram = np.where(gram[:-1] > 0, table[gram[:-1], s[n:]], 0)
        return float((gram > 0).mean())

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        found, scores = [], np.zeros(len(texts))
        for at in range(0, len(texts), BATCH):
            symbols = [self.symbols(t or "") for t in texts[at : at + BATCH]]
            lettered = np.array([bool((s != BREAK).any()) for s in symbols], bool)
            if not self.languages or not lettered.any():
                found += ["und"] * len(symbols)
                continue
            presence = np.zeros((len(symbols), self.features), np.float32)
            for s, row in zip(symbols, presence, strict=True):
                self.mark(s, row)
            kernel = presence @ self.landmarks
            kernel /= np.sqrt(np.maximum(presence.sum(axis=1, keepdims=True), 1))
            score = kernel.astype(np.float64) @ self.weights[:-1] + self.weights[-1]
            best = score.argmax(axis=1)
            value = np.clip((score[np.arange(len(best)), best] + 1) / 2, 0, 1)
            found += [self.languages[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
            scores[at : at + BATCH] = np.where(lettered, value, 0)
        return found, scores


def fit(texts: list[str], labels: list[str], degree: int, landmarks: int, ridge: float) -> Model:
    """The model of a sample; its texts come in the order in which landmarks are taken."""
    languages = sorted(set(labels))
    turn = {}
    order = []
    for i, label in enumerate(labels):
        order.append((turn.setdefault(label, 0), label, i))
        turn[label] += 1
    chosen = [i for *_, i in sorted(order)[:landmarks]]
    letters = _letters()
    points = [code_points(texts[i]) for i in chosen]
    alphabet = np.unique(np.concatenate([p[letters[p]] for p in points])) if points else np.zeros(0, np.int64)
    model = Model(languages, alphabet, [], [0], len(alphabet) + 2, np.zeros((0, 0)), np.zeros((0, 0)))
    width = len(alphabet) + 2
    symbols = [model.symbols(texts[i]) for i in chosen]
    grams = [s.astype(np.int64) for s in symbols]
    count = width
    for n in range(1, degree):
        pairs = [g[:-1] * width + s[n:] for g, s in zip(grams, symbols, strict=True)]
        valid = [(g[:-1] > 0) & (s[n:] > 0) for g, s in zip(grams, symbols, strict=True)]
        known = np.unique(np.concatenate([p[v] for p, v in zip(pairs, valid, strict=True)]) if pairs else [])
        table = np.zeros(count * width, np.int32)
        table[known.astype(np.int64)] = np.arange(len(known)) + 1
        model.tables.append(table.reshape(count, width))
        model.first_feature.append(model.features)
        model.features += len(known) + 1
        grams = [table[p] for p in pairs]
        count = len(known) + 1
    if not languages:
        return model

    def rows(which: list[int]) -> np.ndarray:
        out = np.zeros((len(which), model.features), np.float32)
        for i, row in zip(which, out, strict=True):
            model.mark(model.symbols(texts[i]), row)
        return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))

    marks = rows(chosen)
    value, vector = np.linalg.eigh((marks @ marks.T).astype(float))
    half = vector[:, value > 1e-8] / np.sqrt(value[value > 1e-8])  # K_mm^(-1/2), without its null space
    kernel = np.concatenate([rows(list(range(i, min(i + BATCH, len(texts))))) @ marks.T for i in range(0, len(texts), BATCH)])
    phi = np.hstack([kernel.astype(float) @ half, np.ones((len(texts), 1))])
    target = np.where(np.array(labels)[:, None] == np.array(languages), 1.0, -1.0)
    share = np.array([1 / (len(languages) * labels.count(label)) for label in labels])  # languages count alike
    penalty = ridge * np.eye(phi.shape[1])
    penalty[-1, -1] = 1e-9
    solved = np.linalg.solve(phi.T @ (phi * share[:, None]) + penalty, phi.T @ (target * share[:, None]))
    model.landmarks = np.ascontiguousarray(marks.T)
    rest = set(range(len(texts))) - set(chosen)
    if rest:  # three quarters of what nearly all labelled texts have that gave no n-grams
        model.least_known = 0.75 * float(np.quantile([model.known(texts[i]) for i in rest], 0.01))
    model.weights = np.vstack([half @ solved[:-1], solved[-1:]])
    return model


def train(
    docs: DataFrame, text_col: str = "text", label_col: str = "lang", per_language: int = 500, landmarks: int = 128,
    degree: int = 3, longest: int = 20_000, ridge: float = 1e-4,
) -> Model:
    """The model of the rows of ``docs`` with a label. Rows without letters, or without a text, are
    left out; no rows give a model without languages, which finds "und" everywhere."""
    rows = docs.select(F.col(text_col).cast("string").alias("t"), F.col(label_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("t").rlike(r"\p{L}") & (F.length("t") <= longest))
    rows = rows.withColumn("h", F.xxhash64("t"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    # About four times as many as needed by hash, then the first of them, so no language is one task's work.
    drawn = rows.join(F.broadcast(stage(sizes, "languages")), "lang")
    drawn = drawn.where((F.col("h") / 2.0**64 + 0.5) * F.col("n") <= 4.0 * per_language)
    drawn = drawn.groupBy("lang", "h").agg(F.min("t").alias("t"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = drawn.withColumn("i", first).where(F.col("i") <= per_language).orderBy("i", "lang").collect()
    return fit([r.t for r in sample], [r.lang for r in sample], degree, max(landmarks, 8 * len({r.lang for r in sample})), ridge)


def classify(
    docs: DataFrame, model: Model, text_col: str = "text", language_col: str = "lang_pred", score_col: str = "score", known_col: str | None = None
) -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1) in two more columns.

    ``known_col`` adds the share of known n-grams (``Model.known``). Only ``text_col`` is read for it. A text that is null, empty or without letters is "und" with
    score 0. All rows and columns stay; the added names must be new.
    """
    names = [*docs.columns, language_col, score_col, *([known_col] if known_col else [])]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    position = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            columns = pa.RecordBatch.from_arrays(batch.columns, [f"c{i}" for i in range(batch.num_columns)])
            for part in text_slices([columns], f"c{position}"):
                texts = part.column(position).to_pylist()
                found, scores = model.predict(texts)
                known = [pa.array([model.known(t) for t in texts], pa.float64())] if known_col else []
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string()), pa.array(scores), *known], names)

    added = [T.StructField(language_col, T.StringType()), T.StructField(score_col, T.DoubleType())]
    added += [T.StructField(known_col, T.DoubleType())] if known_col else []
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))
