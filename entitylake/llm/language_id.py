"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram is the elementwise product (binding) of its
letters' vectors, the first rotated twice, the second once; a text is the sum (bundle) of its
trigrams' vectors.  A language's prototype is the sum of its training documents' vectors, each of
unit length.  The mean over all languages is taken out of documents and prototypes alike, since the
letters and word gaps that all languages share say nothing; then the largest cosine wins.

Defined results: a text that is NULL or has no letter gives ``und`` with score 0.  Case, digits and
punctuation make no difference; a run of non-letters is one gap, and texts begin and end with one.
Ties go to the first language by name.  Repeated rows get equal results; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.llm.common import as_text, resident, sampled

UNDETERMINED = "und"
DIMENSIONS = 1024
SEED = 20_240
TRAINING_ROWS = 20_000
MAX_LANGUAGES = 1_000

_CODES = 0x110000
_DENSE = 1 << 22  # up to so many possible trigrams are counted by position instead of by sorting
_PIECE = 1 << 18  # characters of a long text that are read at a time
_RUN = 4_096  # trigrams whose vectors are made at a time
_SYMBOLS, _TEXTS = 1 << 18, 128  # in one bundling
_ROWS = 512  # texts whose vectors are held at a time: each is 8 kB, in several versions
_UNIT = 1 << 30  # unit vectors are summed as integers: the sum does not depend on the order


class Hyperspace:
    """Random letter vectors and the bundles of texts; deterministic in its two parameters."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(_CODES)), bool, _CODES)
        self.index = np.zeros(_CODES, np.int32)  # 0: gap
        self.vectors = np.empty((0, dimensions), np.int8)
        self._known([0])

    def _known(self, codes) -> None:
        rows = [
            np.random.default_rng([self.seed, int(c)]).integers(0, 2, self.dimensions, np.int8)
            for c in codes
        ]
        self.index[np.asarray(codes, np.int64)] = len(self.vectors) + np.arange(len(rows))
        self.vectors = np.concatenate([self.vectors, np.asarray(rows, np.int8) * 2 - 1])

    def _sequences(self, text: str) -> Iterator[np.ndarray]:
        """The symbols of a text, with a gap at both ends, in pieces: each begins with the last two symbols
        of the one before, so that every trigram is in one piece."""
        text, carried = text.lower(), np.zeros(1, "<u4")
        for at in range(0, max(len(text), 1), _PIECE):
            codes = np.frombuffer(text[at : at + _PIECE].encode("utf-32-le", "surrogatepass"), "<u4")
            codes = np.where(self.is_letter[codes], codes, 0)
            end = [0] if at + _PIECE >= len(text) else []
            codes = np.concatenate([carried, codes, end]).astype("<u4")
            codes = codes[(codes != 0) | np.concatenate([[True], codes[:-1] != 0])]
            fresh = codes[(self.index[codes] == 0) & (codes != 0)]
            if len(fresh):
                self._known(np.unique(fresh))
            yield self.index[codes]
            carried = codes[-2:]

    def bundle(self, texts: Sequence[str]) -> np.ndarray:
        """One row per text: the sum of its trigrams' vectors; zeros where there is no letter."""
        out = np.zeros((len(texts), self.dimensions), np.float32)
        held, size = [], 0
        for i, text in enumerate(texts):
            for sequence in self._sequences(text):
                held.append((i, sequence))
                size += len(sequence)
                if size >= _SYMBOLS or len(held) >= _TEXTS:
                    self._add(held, out)
                    held, size = [], 0
        if held:
            self._add(held, out)
        return out

    def _add(self, held: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
        symbols = np.concatenate([s for _, s in held]).astype(np.int64)
        piece = np.repeat(np.arange(len(held)), [len(s) for _, s in held])
        same = piece[:-2] == piece[2:]
        if not same.any():
            return
        base = len(self.vectors)
        grams = ((symbols[:-2] * base + symbols[1:-1]) * base + symbols[2:])[same]
        piece = piece[2:][same]
        if base**3 <= _DENSE:
            place = np.zeros(base**3, np.int64)
            place[grams] = 1
            present = np.flatnonzero(place)
            place[present] = np.arange(len(present))
            at = place[grams]
        else:
            present, at = np.unique(grams, return_inverse=True)
        sums = np.zeros((len(held), self.dimensions), np.float32)
        if len(present) > _RUN:
            order = np.argsort(at, kind="stable")
            at, piece = at[order], piece[order]
        for low in range(0, len(present), _RUN):
            run = present[low : low + _RUN]
            here = slice(*np.searchsorted(at, [low, low + _RUN])) if len(present) > _RUN else slice(None)
            cells = piece[here] * len(run) + (at[here] - low)
            counts = np.bincount(cells, minlength=len(held) * len(run)).reshape(len(held), len(run))
            first, second, third = run // base**2, run // base % base, run % base
            bound = np.roll(self.vectors, 2, 1)[first]
            bound = bound * np.roll(self.vectors, 1, 1)[second] * self.vectors[third]
            sums += counts.astype(np.float32) @ bound.astype(np.float32)
        np.add.at(out, [i for i, _ in held], sums)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(1, keepdims=True))
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


@dataclass(frozen=True)
class LanguageModel:
    """``prototypes`` has a row per language; ``mean`` is what all languages share."""

    languages: tuple[str, ...]
    prototypes: np.ndarray
    mean: np.ndarray
    dimensions: int
    seed: int


def train(
    documents: DataFrame,
    text: str,
    label: str,
    key: str,
    max_rows: int = TRAINING_ROWS,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> LanguageModel:
    """Prototypes from about ``max_rows`` labelled documents at most, chosen by the hash of ``key`` and text.

    Starts jobs.  Rows without text or label are left out, and equal ones count once.  The vectors are summed on the executors;
    the driver gets one prototype per language.
    """
    labelled = documents.select(
        F.col(text).alias("text"), F.col(label).cast("string").alias("label"), F.col(key).alias("key")
    ).where(F.col("text").isNotNull() & F.col("label").isNotNull())
    labelled = sampled(labelled, ["key", "text", "label"], labelled.count(), max_rows)

    def sums(batches):
        space, total = _spaces(dimensions, seed), {}
        for batch in batches:
            texts, labels = as_text(batch["text"]), batch["label"].to_numpy()
            for low in range(0, len(texts), _ROWS):
                units = _unit(space.bundle(texts[low : low + _ROWS]).astype(np.float64))
                units = np.rint(units * _UNIT).astype(np.int64)
                here = labels[low : low + _ROWS]
                for name in set(here):
                    total[name] = total.get(name, 0) + units[here == name].sum(0)
        if total:
            vectors = [v.tolist() for v in total.values()]
            yield pd.DataFrame({"label": list(total), "vector": vectors})

    partial = labelled.select("text", "label").mapInPandas(sums, "label string, vector array<long>")
    by_place = partial.select("label", F.posexplode("vector").alias("place", "value"))
    summed = by_place.groupBy("label", "place").agg(F.sum("value").alias("value"))
    languages = summed.groupBy("label").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]
        ).alias("vector")
    )
    found = sorted(languages.limit(MAX_LANGUAGES + 1).collect(), key=lambda r: r["label"])
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    raw = _unit(np.array([r["vector"] for r in found], float).reshape(len(found), dimensions))
    mean = _unit(raw.mean(0, keepdims=True))[0] if len(found) > 1 else np.zeros(dimensions)
    centred = _unit(raw - np.outer(raw @ mean, mean))
    names = tuple(r["label"] for r in found)
    return LanguageModel(names, centred, mean, dimensions, seed)


def predict(model: LanguageModel, text: Column) -> Column:
    """A struct ``lang_pred``, ``score``: the best language and its cosine (0 where negative)."""

    @F.pandas_udf("lang_pred string, score double")
    def languages(column: pd.Series) -> pd.DataFrame:
        space, texts = _spaces(model.dimensions, model.seed), as_text(column)
        found = [_closest(model, space.bundle(texts[at : at + _ROWS])) for at in range(0, len(texts), _ROWS)]
        names = [n for some, _ in found for n in some]
        return pd.DataFrame({"lang_pred": names, "score": np.concatenate([*(s for _, s in found), []])})

    return languages(text)


def _closest(model: LanguageModel, vectors: np.ndarray) -> tuple[list[str], np.ndarray]:
    vectors = vectors.astype(np.float64)
    lettered = vectors.any(1)
    units = _unit(vectors)
    units = _unit(units - np.outer(units @ model.mean, model.mean))
    if not model.languages:
        lettered[:] = False
        cosines = np.zeros((len(units), 1))
    else:
        cosines = units @ model.prototypes.T
    best = cosines.argmax(1)
    names = np.array([*model.languages, UNDETERMINED], dtype=object)
    score = np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0)
    return np.where(lettered, names[best], UNDETERMINED).tolist(), np.where(lettered, score, 0.0)


def _spaces(dimensions: int, seed: int) -> Hyperspace:
    """The letter vectors of a worker."""
    return resident(("letters", dimensions, seed), lambda: Hyperspace(dimensions, seed))


def with_language(documents: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All columns of ``documents`` and a struct column ``language`` in place of any of that name."""
    return documents.withColumn("language", predict(model, F.col(text)))
