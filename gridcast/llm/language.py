"""Language identification in two levels with linear support vector machines.

A text is the profile of its hashed byte n-grams (3 and 4 bytes, letters only,
A-Z lowered). First the language family is chosen, then a language within it; at
both levels every pair of classes has a linear SVM of its own and the class that
wins most of them is taken. The machines are fitted on a bounded sample of
labelled rows, the same rows in every run; prediction is a map over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import Sent, fold
from gridcast.llm.tokens import text_bytes

# fixed values: families of language codes; a code that is not listed is a family of its own
FAMILIES = {
    "romance": "ca es fr gl it pt ro oc",
    "germanic": "af da de en is lb nb nl nn no sv yi",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "indic": "bn gu hi mr ne pa si ur",
    "turkic": "az kk ky tr tt uz",
    "semitic": "ar he mt",
}
UNKNOWN = "und"
PER_LANGUAGE = 1000  # labelled rows of a language that the machines are fitted on, about
BUCKETS = 4096
ROUNDS, COST = 30, 50.0

_LETTERS = np.full(256, 32, np.uint32)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def family(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in FAMILIES.items() if code in codes.split()), f"={lang}")


def profile(data: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """Unit vector of the square roots of the n-gram counts of one text, counted piece by piece."""
    counts = np.zeros(BUCKETS, np.float64)
    shift = np.uint32(20)
    padded = np.concatenate([[32], data, [32]]).astype(np.uint8)
    for start in range(0, max(1, len(data)), piece):
        b = _LETTERS[padded[start:start + piece + 3]]
        three = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
        four = three[:-1] << np.uint32(8) | b[3:]
        # the last two bytes begin no n-gram of this piece but of the next one
        counts += np.bincount(three[:piece] * np.uint32(2654435761) >> shift, minlength=BUCKETS)
        counts += np.bincount(four[:piece] * np.uint32(2246822519) + np.uint32(97) >> shift, minlength=BUCKETS)
    return np.sqrt(counts / max(1.0, counts.sum())).astype(np.float32)


def profiles(texts: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(texts)
    return np.stack([profile(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]) if len(texts) else np.zeros((0, BUCKETS), np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def linear_svm(x: np.ndarray, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (bias last) of the hinge-loss SVM of the given rows of x and their signs y, by dual
    coordinate descent; x is not copied."""
    weights, bias = np.zeros(x.shape[1], np.float32), 0.0
    alpha, square = np.zeros(len(rows)), np.einsum("ij,ij->i", x, x)[rows] + 1.0
    order = np.random.default_rng(5)
    for _ in range(ROUNDS):
        most = 0.0
        for i in order.permutation(len(rows)):
            row = x[rows[i]]
            gradient = y[i] * (float(row @ weights) + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), COST)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                weights += np.float32(step) * row
                bias += step
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return np.append(weights, np.float32(bias))


class Voters:
    """The machines of all pairs of some classes."""

    def __init__(self, names: list[str], machines: dict[tuple[str, str], np.ndarray]):
        self.names = sorted(names)
        at = {name: i for i, name in enumerate(self.names)}
        self.machines = {(at[a], at[b]): w for (a, b), w in machines.items()}

    def vote(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the winner of each row, by wins and then by margins, and its confidence from 0 to 1."""
        wins = np.zeros((len(x), len(self.names)))
        tightest = np.full((len(x), len(self.names)), np.inf)
        for (a, b), w in self.machines.items():
            margin = x @ w[:-1] + w[-1]
            wins[:, a] += (margin > 0) + 1e-3 * np.tanh(margin)
            wins[:, b] += (margin <= 0) - 1e-3 * np.tanh(margin)
            tightest[:, a] = np.minimum(tightest[:, a], margin)
            tightest[:, b] = np.minimum(tightest[:, b], -margin)
        best = wins.argmax(1) if len(x) else np.zeros(0, int)
        return best, 1 / (1 + np.exp(-2 * np.minimum(tightest[np.arange(len(x)), best], 30)))


def pairs(langs: list[str]) -> list[tuple[str | None, str, str]]:
    """The pairs of classes that have a machine: (None, family, family) and (family, language, language)."""
    members = by_family(langs)
    found = [(None, a, b) for a, b in combinations(sorted(members), 2)]
    return found + [(name, a, b) for name, own in sorted(members.items()) for a, b in combinations(sorted(own), 2)]


def by_family(langs: list[str]) -> dict[str, list[str]]:
    members: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        members.setdefault(family(lang), []).append(lang)
    return members


class LanguageModel:
    def __init__(self, langs: list[str], machines: dict[tuple[str | None, str, str], np.ndarray]):
        members = by_family(langs)
        of = lambda level: {(a, b): w for (name, a, b), w in machines.items() if name == level}
        self.families = Voters(list(members), of(None))
        self.within = {name: Voters(own, of(name)) for name, own in members.items()}

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; UNKNOWN and 0 without a letter or without any learned language."""
        sure = np.array([has_letter(t) for t in texts.to_pylist()], bool)
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.families.names or not sure.any():
            return langs, scores
        x = profiles(texts)
        chosen, first = self.families.vote(x)
        for number, name in enumerate(self.families.names):
            voters = self.within[name]
            mine = np.flatnonzero(sure & (chosen == number))
            best, second = voters.vote(x[mine])
            for i, k, score in zip(mine, best, first[mine] * second):
                langs[i], scores[i] = voters.names[k], score
        return langs, scores


def train(docs: DataFrame, lang: str = "lang", per_language: int = PER_LANGUAGE, seed: int = 1) -> LanguageModel:
    """Fit on rows of `docs(doc_id, text, lang)` that have a language and a text.

    At most about `per_language` distinct rows of each language are taken, those of the
    smallest hash of doc_id and text; their number is estimated within a few percent. That sample meets in one task, as profiles of a
    fixed size, and only the machines come to the driver. The number of languages is
    taken to be small.
    """
    share = 1 << 30
    rows = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull()).select(F.col(lang).alias("lang"), "doc_id", "text")
    # rows that repeat an id and a text count once, and are drawn once
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}
    if not counts:
        return LanguageModel([], {})
    limit = F.create_map(*[
        c for name, n in sorted(counts.items()) for c in (F.lit(name), F.lit(min(share, int(share * per_language / max(1, n)) + 1)))
    ])
    drawn = rows.where(F.pmod("h", F.lit(share)) < F.element_at(limit, F.col("lang"))).groupBy("lang", "h").agg(F.min("text").alias("text"))
    wanted = pairs(list(counts))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [v.astype("<f2").tobytes() for v in profiles(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary())], ["lang", "profile"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sorted((lang, v) for batch in batches for lang, v in zip(*(batch.column(i).to_pylist() for i in range(2))))
        names, x = np.array([lang for lang, _ in known]), np.empty((len(known), BUCKETS), np.float32)
        for i, (_, vector) in enumerate(known):
            x[i] = np.frombuffer(vector, "<f2")
        del known
        families = np.array([family(lang) for lang in names])
        for level, a, b in wanted:
            classes = families if level is None else names
            left, right = np.flatnonzero(classes == a), np.flatnonzero(classes == b)
            signs = np.concatenate([np.ones(len(left)), -np.ones(len(right))])
            w = linear_svm(x, np.concatenate([left, right]), signs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([level], pa.string()), pa.array([a]), pa.array([b]), pa.array([w.tobytes()], pa.binary())], ["level", "a", "b", "w"])

    gathered = drawn.select("lang", "text").mapInArrow(sample, "lang string, profile binary").repartition(1)
    fitted = gathered.mapInArrow(fit, "level string, a string, b string, w binary").collect() if wanted else []
    return LanguageModel(list(counts), {(r["level"], r["a"], r["b"]): np.frombuffer(r["w"], np.float32) for r in fitted})


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", rows: int = 512, names: tuple[str, str] = ("_lang_pred", "_lang_score")
) -> DataFrame:
    """`docs` with two columns `names` added, the language and its score; nothing but the text is looked at.

    A null text and one without a letter are `und` with score 0. An empty table
    stays empty. All other columns are kept as they are.
    """
    schema = T.StructType([*docs.schema.fields]).add(names[0], "string").add(names[1], "double")
    at = docs.columns.index(text)
    shared = Sent(docs.sparkSession, model)  # of a size set by the languages and BUCKETS

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                langs, scores = fitted.predict(batch.column(at))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(langs, pa.string()), pa.array(scores)], [f.name for f in schema]
                )

    return docs.mapInArrow(predict, schema)


def in_training(doc_id: Column) -> Column:
    return fold(doc_id, 3) != 1


def language_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; rows of fold 1 of 3 are never learned from."""
    columns = docs.select("doc_id", "text", "lang")
    model = train(columns.where(in_training(F.col("doc_id"))))
    found = identify(columns.select("doc_id", "text", (~in_training(F.col("doc_id"))).alias("held_out")), model)
    return found.select("doc_id", "held_out", F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score"))
