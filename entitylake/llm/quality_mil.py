"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Each passage becomes a vector of measured
properties, a layer encodes it, gated attention (a tanh times a sigmoid) weighs the passages of a
document against each other, and the weighted mean of their encodings is scored. Only labels of whole
documents are needed to learn all of it.

Training takes a bounded sample of labelled documents to the driver, as passage vectors; every
passage of every document is scored, on the executors.

Defined results: a NULL or empty text is a bag of one empty passage. Repeated rows get equal scores.
Without labels of both classes every score is the share of label 1 (0.5 without any label). Only the
text takes part in a score; other columns are untouched.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.llm.common import as_text, sample_bound, sampled, slices

PASSAGE_WORDS = 100
TRAINING_ROWS = 8_000
TRAINING_PASSAGES = 64  # of a longer document, evenly spread ones are learned from; scores use all
HIDDEN, ATTENTION = 24, 12
EPOCHS, BATCH, RATE, DECAY = 40, 256, 0.01, 1e-4
SEED = 77

# Characters counted apart, and frequent words of four languages.
MARKS = b"!?.,;:|#*$%&<>=/\\_-()[]{}\"'@+"
COMMON = frozenset(
    b"the of and to in is that was for on with as der die das und ist nicht ein eine zu den le la les et "
    b"est un une du que qui de el los las en y por se con su".split()
)
_CLASS = np.zeros(256, np.int64)  # lower, upper, digit, mark, beyond ASCII, other
_CLASS[:] = 5
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[list(MARKS)] = 3
_CLASS[128:] = 4
FEATURES = 20 + len(MARKS)


def _passage(words: list[bytes]) -> list[float]:
    n = len(words)
    joined = b"".join(words)
    size = max(1, len(joined))
    lower = [w.lower() for w in words]
    counts = Counter(lower)
    top = counts.most_common(1)[0][1]
    pairs = len(set(zip(lower, lower[1:])))
    lengths = np.fromiter(map(len, words), np.float64, n)
    classes = np.bincount(_CLASS[np.frombuffer(joined, np.uint8)], minlength=6) / size
    same = sum(map(bytes.__eq__, lower, lower[1:]))
    return [
        1.0,
        n / PASSAGE_WORDS,
        lengths.mean() / 8,
        lengths.std() / 8,
        lengths.max() / 32,
        len(counts) / n,
        top / n,
        pairs / max(1, n - 1),
        same / n,
        sum(counts[w] for w in COMMON.intersection(counts)) / n,
        *classes[:5],
        sum(1 for w in words if w.isupper()) / n,
        sum(1 for w in words if w[:1].isupper()) / n,
        sum(1 for w in words if w[-1] in b".!?") / n,
        sum(1 for w in words if not w.strip(MARKS)) / n,
        float((lengths > 24).mean()),
        *[joined.count(m) / n for m in _MARK_BYTES],
    ]


_MARK_BYTES = [bytes([m]) for m in MARKS]


def passages(text: str) -> np.ndarray:
    """A row of properties per passage; zeros for an empty text."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    rows = [_passage(words[i : i + PASSAGE_WORDS]) for i in range(0, len(words), PASSAGE_WORDS)]
    return np.array(rows, np.float32)


@dataclass(frozen=True)
class MilModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(x: np.ndarray, starts: np.ndarray, w: dict[str, np.ndarray]):
    """Scores of bags; ``starts`` are the first rows of the bags in ``x``."""
    sizes = np.diff(np.append(starts, len(x)))
    code = np.tanh(x @ w["encode"] + w["encode_0"])
    tanh, gate = np.tanh(code @ w["v"]), _sigmoid(code @ w["u"])
    energy = (tanh * gate) @ w["a"]
    energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, starts), sizes))
    weight = energy / np.repeat(np.add.reduceat(energy, starts), sizes)
    bag = np.add.reduceat(code * weight[:, None], starts)
    return sizes, code, tanh, gate, weight, bag, bag @ w["out"] + w["out_0"]


def _gradients(x, starts, y, w):
    sizes, code, tanh, gate, weight, bag, logit = _forward(x, starts, w)
    error = (_sigmoid(logit) - y) / len(y)
    d_bag = np.repeat(np.outer(error, w["out"]), sizes, 0)
    of_weight = (d_bag * code).sum(1)
    spread = np.repeat(np.add.reduceat(of_weight * weight, starts), sizes)
    d_energy = weight * (of_weight - spread)
    d_tanh = np.outer(d_energy, w["a"]) * gate * (1 - tanh * tanh)
    d_gate = np.outer(d_energy, w["a"]) * tanh * gate * (1 - gate)
    d_code = d_bag * weight[:, None] + d_tanh @ w["v"].T + d_gate @ w["u"].T
    d_code *= 1 - code * code
    return {
        "encode": x.T @ d_code, "encode_0": d_code.sum(0), "v": code.T @ d_tanh,
        "u": code.T @ d_gate, "a": (tanh * gate).T @ d_energy, "out": bag.T @ error,
        "out_0": error.sum(keepdims=True),
    }


def fit(bags: list[np.ndarray], labels: np.ndarray) -> MilModel:
    """Learn from bags of passage rows and labels 0 or 1, by Adam; deterministic."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return MilModel(np.zeros(FEATURES), np.ones(FEATURES), {}, share)
    rows = np.concatenate(bags).astype(np.float64)
    mean, scale = rows.mean(0), rows.std(0) + 1e-3
    random = np.random.default_rng(SEED)
    shapes = {
        "encode": (FEATURES, HIDDEN), "encode_0": (HIDDEN,), "v": (HIDDEN, ATTENTION),
        "u": (HIDDEN, ATTENTION), "a": (ATTENTION,), "out": (HIDDEN,), "out_0": (1,),
    }
    w = {k: random.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
    w["encode_0"][:] = w["out_0"][:] = 0
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    scaled = [np.clip((b - mean) / scale, -6, 6) for b in bags]
    for epoch in range(EPOCHS):
        order = random.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            sizes = [len(scaled[i]) for i in chosen]
            x = np.concatenate([scaled[i] for i in chosen])
            starts = np.cumsum([0, *sizes[:-1]])
            found = _gradients(x, starts, labels[chosen].astype(float), w)
            step += 1
            rate = RATE * (1 - 0.9 * epoch / EPOCHS)
            for k, g in found.items():
                g = g + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] -= rate * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                )
    return MilModel(mean, scale, w)


def score(model: MilModel, bags: list[np.ndarray]) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(bags), model.constant)
    x = np.clip((np.concatenate(bags).astype(np.float64) - model.mean) / model.scale, -6, 6)
    starts = np.cumsum([0, *[len(b) for b in bags[:-1]]])
    return _sigmoid(_forward(x, starts, model.weights)[-1])


def _eligible(texts: DataFrame, total: int, wanted: int) -> DataFrame:
    """Rows that the sample takes with one label or the other: the rest need not be shuffled to their labels."""
    below = sample_bound(total, wanted)
    if below is None:
        return texts
    taken = [F.xxhash64("id", "text", F.lit(n).cast("int")) < F.lit(below).cast("long") for n in (0, 1)]
    return texts.where(taken[0] | taken[1])


def train(
    documents: DataFrame, labels: DataFrame, key: str, text: str, label: str,
    max_rows: int = TRAINING_ROWS,
) -> MilModel:
    """Fit on about ``max_rows`` labelled documents at most, chosen by the hash of ``key``, text and label.

    Starts jobs. Rows without label are left out, and equal ones count once. What reaches the driver is bounded by ``max_rows``
    times ``TRAINING_PASSAGES`` passage vectors.
    """
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1)
    )
    texts = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    total = texts.join(known, "id").count()
    joined = sampled(_eligible(texts, total, max_rows).join(known, "id"), ["id", "text", "label"], total, max_rows)

    def vectors(batches):
        for batch in batches:
            rows = []
            for text_ in as_text(batch["text"]):
                bag = passages(text_)
                chosen = np.linspace(0, len(bag) - 1, min(len(bag), TRAINING_PASSAGES)).astype(int)
                rows.append(bag[chosen].tobytes())
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "bag": rows})

    schema = f"id {known.schema['id'].dataType.simpleString()}, label int, bag binary"
    found = joined.mapInPandas(vectors, schema).toPandas().sort_values(["id", "label"])
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in found["bag"]]
    return fit(bags, found["label"].to_numpy(float))


def quality(model: MilModel, text: Column) -> Column:
    """The score of each text, between 0 and 1."""

    @F.pandas_udf("double")
    def scores(column: pd.Series) -> pd.Series:
        texts, out = as_text(column), []
        for low, high in slices(texts, 1 << 20, 1_000):
            out.append(score(model, [passages(t) for t in texts[low:high]]))
        return pd.Series(np.concatenate([*out, np.empty(0)]))

    return scores(text)
