"""Language identification by hierarchical discrimination.

A text is first assigned to a language family, then to a language of that family, by linear
support vector machines over hashed character n-grams.  Families have a machine each, against
all others; languages have one for each two of a family, so closely related languages are told
apart by machines that saw only them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.support import release_encoders, rows_map, texts_of

UNDETERMINED = "und"
FEATURES = 2048
# Bounds of the labelled sample that the machines are fitted on.
SAMPLE_PER_LANGUAGE = 400
SAMPLE_ROWS = 2000
SLICES = 32  # of a language, when its sample is chosen
# Share of a text's letters that the learned rows of its language must hold, to be kept.
LEAST_KNOWN = 0.5
# Characters counted at once.
BLOCK_CHARS = 1 << 18

# Families of languages by ISO 639 code; any other code is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
}


def family_of(language: str) -> str:
    for family, members in FAMILIES.items():
        if language.lower().split("-")[0] in members.split():
            return family
    return language


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from; a null id is learned from neither, but not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


# Features ------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(0x110000)])


def features(text: str | None) -> np.ndarray | None:
    """Hashed counts of one to three characters of the whole text; None without a letter."""
    counts = np.zeros(FEATURES)
    if not text:
        return None
    letters = _letters()
    for at in range(0, len(text), BLOCK_CHARS):
        codes = np.frombuffer(text[at : at + BLOCK_CHARS].lower().encode("utf-32-le"), np.uint32)
        is_letter = letters[codes]
        if not is_letter.any():
            continue
        codes = np.where(is_letter, codes, 32).astype(np.uint32)
        blank = codes == 32
        codes = np.concatenate([[32], codes[~(blank & np.roll(blank, 1))], [32]]).astype(np.uint32)
        hashed = codes * np.uint32(2654435761)
        for n in range(3):
            if n:
                hashed = (hashed[:-1] ^ codes[n:]) * np.uint32(2246822519)
            counts += np.bincount(hashed >> np.uint32(21), minlength=FEATURES)
    if not counts.any():
        return None
    weights = np.sqrt(counts)
    return weights / np.linalg.norm(weights)


# Machines ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Machines:
    """One-versus-one linear machines between classes."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # a row per pair, the bias last

    @classmethod
    def fit(cls, rows: np.ndarray, labels: list[str]) -> Machines:
        classes = sorted(set(labels))
        number = np.array([classes.index(label) for label in labels])
        pairs = list(combinations(range(len(classes)), 2))
        fitted = [
            fit_machine(rows[(number == a) | (number == b)], np.where(number[(number == a) | (number == b)] == a, 1.0, -1.0))
            for a, b in pairs
        ]
        return cls(classes, pairs, np.array(fitted).reshape(len(pairs), rows.shape[1] + 1))

    def decide(self, row: np.ndarray) -> tuple[str, float]:
        """The class with most votes, and the mean certainty of its votes."""
        margins = self.weights[:, :-1] @ row + self.weights[:, -1]
        votes, sums, certainty = (np.zeros(len(self.classes)) for _ in range(3))
        for (a, b), margin in zip(self.pairs, margins.tolist(), strict=True):
            votes[a if margin > 0 else b] += 1
            for one, toward in ((a, margin), (b, -margin)):
                sums[one] += toward
                certainty[one] += 1 / (1 + np.exp(-4 * toward))
        best = max(range(len(self.classes)), key=lambda one: (votes[one], sums[one], -one))
        return self.classes[best], float(certainty[best] / (len(self.classes) - 1)) if self.pairs else 1.0


@dataclass(frozen=True)
class FamilyMachines:
    """One linear machine for each class, against all others."""

    classes: list[str]
    weights: np.ndarray  # a row per class, the bias last

    @classmethod
    def fit(cls, rows: np.ndarray, labels: list[str]) -> FamilyMachines:
        classes = sorted(set(labels))
        number = np.array([classes.index(label) for label in labels])
        signs = np.where(number[:, None] == np.arange(len(classes)), 1.0, -1.0)
        return cls(classes, _descend(rows, signs) if len(classes) > 1 else np.zeros((0, 0)))

    def decide(self, row: np.ndarray) -> tuple[str, float]:
        """The class with the largest margin, and the certainty of its machine."""
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        margins = self.weights[:, :-1] @ row + self.weights[:, -1]
        best = int(np.argmax(margins))
        return self.classes[best], float(1 / (1 + np.exp(-4 * margins[best])))


def fit_machine(rows: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Linear machine with squared hinge loss."""
    return _descend(rows, signs[:, None])[0]


def _descend(rows: np.ndarray, signs: np.ndarray, cost: float = 10.0, rounds: int = 40) -> np.ndarray:
    """Dual coordinate descent for each column of ``signs``; a machine a row."""
    rows = np.hstack([rows, np.ones((len(rows), 1))])
    diagonal = (rows**2).sum(axis=1) + 0.5 / cost
    duals, weights = np.zeros(signs.shape), np.zeros((signs.shape[1], rows.shape[1]))
    order = np.random.default_rng(0)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            slope = signs[i] * (weights @ rows[i]) - 1 + 0.5 / cost * duals[i]
            new = np.maximum(duals[i] - slope / diagonal[i], 0.0)
            moved = np.flatnonzero(new != duals[i])
            weights[moved] += np.outer(((new - duals[i]) * signs[i])[moved], rows[i])
            duals[i] = new
    return weights


@dataclass(frozen=True)
class LanguageModel:
    families: FamilyMachines
    languages: dict[str, Machines]
    alphabets: dict[str, frozenset] = field(default_factory=dict)

    @property
    def learned(self) -> bool:
        return bool(self.families.classes)

    def known(self, text: str, language: str) -> float:
        """Share of a text's letters that the learned rows of a language hold."""
        lowered = text.lower()
        strange = {c for c in set(lowered) - self.alphabets[language] if c.isalpha()}
        if not strange:
            return 1.0
        letters = {c: n for c, n in Counter(lowered).items() if c.isalpha()}
        own = sum(n for c, n in letters.items() if c in self.alphabets[language])
        return own / max(1, sum(letters.values()))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score from 0 to 1); undetermined with score 0 without a letter."""
        row = features(text)
        if row is None or not self.learned:
            return UNDETERMINED, 0.0
        family, sure = self.families.decide(row)
        language, surer = self.languages[family].decide(row)
        return language, sure * surer


def learn_languages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    sample_rows: int = SAMPLE_ROWS,
) -> LanguageModel:
    """Fit the machines on a bounded sample of labelled rows.

    Of each language at most ``per_language`` rows, and ``sample_rows`` altogether, are taken,
    those with the smallest hash of their id, whole texts each.  Of more than ``sample_rows``
    languages those with most rows are learned.  Rows without id, text or language and held-out
    rows are not learned from; without any other the model has learned nothing.
    """
    labelled = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    ).dropna()
    labelled = labelled.filter(~held_out(F.col("doc_id"))).withColumn("version", F.xxhash64("text"))
    languages = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    languages = [row[0] for row in languages.orderBy(F.col("n").desc(), "lang").limit(sample_rows).collect()]
    most = min(per_language, sample_rows // max(1, len(languages)))
    labelled = labelled.filter(F.col("lang").isin(languages))
    # Only the best of each task are moved, without their texts, and first within slices of a
    # language, so that what one task ranks does not grow with the number of tasks.
    chosen = labelled.select("lang", "doc_id", "version").withColumn(
        "slice", F.pmod(F.xxhash64("version", "doc_id"), F.lit(SLICES))
    )
    for group in (["lang", "slice"], ["lang"]):
        order = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id", "version")
        chosen = chosen.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    # At most ``sample_rows`` keys: small enough to send to every task.
    keys = F.broadcast(chosen.select("lang", "doc_id", "version").distinct())
    sample = labelled.join(keys, ["lang", "doc_id", "version"]).dropDuplicates(["lang", "doc_id", "version"])
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("row", pa.list_(pa.float32())), ("letters", pa.string())])

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        release_encoders()
        for doc_id, lang, text in rows:
            row = features(text)
            if row is not None:
                letters = "".join(sorted(c for c in set(text.lower()) if c.isalpha()))
                yield doc_id, lang, row.astype(np.float32).tolist(), letters

    gathered = rows_map(sample.select("doc_id", "lang", "text"), schema, make).toArrow()
    names = gathered["lang"].to_pylist()
    table = np.array(gathered["row"].combine_chunks().flatten(), dtype=float).reshape(-1, FEATURES)
    alphabets: dict[str, set] = {}
    for name, letters in zip(names, gathered["letters"].to_pylist(), strict=True):
        alphabets.setdefault(name, set()).update(letters)
    order_ids = np.lexsort([gathered["doc_id"].to_numpy(), names]) if names else []
    names, table = [names[i] for i in order_ids], table[order_ids] if names else table
    families = [family_of(name) for name in names]
    within = {}
    for family in set(families):
        own = [i for i, name in enumerate(families) if name == family]
        within[family] = Machines.fit(table[own], [names[i] for i in own])
    alphabets = {name: frozenset(letters) for name, letters in alphabets.items()}
    return LanguageModel(FamilyMachines.fit(table, families), within, alphabets)


def identify_languages(
    docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text.

    Texts that are null or have no letter, and all texts if nothing could be learned, are
    undetermined.  Repeated rows are returned as often as they occur; an empty table gives none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield doc_id, *model.predict(text)

    return rows_map(texts_of(docs, id_column, text_column), schema, make)


def keep_determined(
    docs: DataFrame, model: LanguageModel, text_column: str = "text", least_known: float = LEAST_KNOWN
) -> DataFrame:
    """The rows whose language can be told, unchanged.

    A text goes if it is null or has no letter, or if the learned rows of the language it would be
    assigned to hold less than ``least_known`` of its letters, as for an alphabet that no learned
    language uses; this means the same for any number of languages.  If nothing could be learned,
    every row stays.  Repeated rows are treated alike; an empty table stays empty.
    """
    if not model.learned:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for batch in batches:
            keep = []
            for text in batch.column(batch.schema.get_field_index(text_column)).to_pylist():
                lang, _ = model.predict(text)
                keep.append(lang != UNDETERMINED and model.known(text, lang) >= least_known)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
