"""Quality classification by logistic regression on hashed word n-grams, trained with FTRL-proximal.

Text is cut into runs of letters and digits (words) and runs of other signs. Features are hashed: words
and pairs of words, lower case, and triples of word shapes (case, length, sign, number, whether the word
repeats one of the last two or an earlier one). The counts of words and of shapes are each scaled to
length one, and a score is the logistic function of the sparse dot product with the weights.

Scale: training takes at most ``max_train`` labelled rows, those with the least hash of their id, dealt to
``shards`` tasks; each runs the updates over its rows ``epochs`` times and the weights are averaged. So
training costs the same on any corpus, and the model, 2^18 weights, is what is broadcast. All rows are
scored, in one pass without shuffle.

Defined results: null text is empty; a text without words is scored by the intercept; rows without a label
(or a null one) are not trained on; a document labelled twice is trained on twice; repeated rows get equal
scores; a null id stays null; an empty table gives an empty result; without labels all scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import blank_table, hash_runs, mix64, text_slices

BITS = 18
MAX_TRAIN = 20_000
SHARDS, EPOCHS = 6, 4
#: Of the update: learning rate, smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.0005, 0.0001

_WORD, _SIGN = 1, 2


def _kinds() -> np.ndarray:
    kinds = np.full(256, _SIGN, np.uint8)
    kinds[[b for b in range(256) if b >= 128 or chr(b).isalnum()]] = _WORD
    kinds[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    return kinds


def features(texts: pa.Array, bits: int = BITS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The row, the indexes of its features (each once) and their values."""
    table, kinds = blank_table(), _kinds()
    upper = np.zeros(256, np.int64)
    upper[ord("A") : ord("Z") + 1] = 1
    digit = np.zeros(256, np.int64)
    digit[ord("0") : ord("9") + 1] = 1
    shift = np.uint64(64 - bits)
    for at, part in text_slices(texts):
        raw, words, starts, first, last = hash_runs(part, table, kinds)
        if len(raw):
            size = last - first
            ups = np.r_[0, np.cumsum(upper[raw])]
            nums = np.r_[0, np.cumsum(digit[raw])]
            large, numeric = ups[last] - ups[first], nums[last] - nums[first]
            shape = np.where(kinds[raw[first]] == _SIGN, 1, np.where(numeric > 0, 2, np.where(large == 0, 3, np.where(large > 1, 4, 5))))
            shape = shape * 4 + np.minimum(3, size // 4)
        for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            if a == b:
                yield at + i, np.empty(0, np.int64), np.empty(0)
                continue
            own = words[a:b]
            repeat = np.zeros(b - a, np.int64)
            _, where = np.unique(own, return_index=True)
            seen = np.ones(b - a, bool)
            seen[where] = False
            repeat[seen & (size[a:b] > 4)] = 1
            repeat[2:][own[2:] == own[:-2]] = 2
            repeat[1:][own[1:] == own[:-1]] = 3
            form = (shape[a:b] * 4 + repeat).astype(np.uint64)
            pairs = mix64(own[:-1] * np.uint64(3) + own[1:])
            lexical = np.concatenate((mix64(own + np.uint64(1)), pairs)) >> shift
            forms = np.concatenate((form, [np.uint64(0), np.uint64(0)]))
            triples = mix64((forms[:-2] << np.uint64(20)) | (forms[1:-1] << np.uint64(10)) | forms[2:] | np.uint64(1 << 40))
            index, value = [], []
            for group in (lexical, triples >> shift):
                unique, count = np.unique(group, return_counts=True)
                index.append(unique.astype(np.int64))
                value.append(count / np.sqrt((count * count).sum()))
            yield at + i, np.concatenate(index), np.concatenate(value)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    bits: int = BITS,
    epochs: int = EPOCHS,
    alpha: float = ALPHA,
    beta: float = BETA,
    l1: float = L1,
    l2: float = L2,
) -> np.ndarray:
    """Weights after following the regularised leader through ``rows``; the last is the intercept."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(0, np.abs(z[at]) - l1)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            index, value = rows[i]
            at = np.append(index, 1 << bits)
            x = np.append(value, 1.0)
            w = weights(at)
            wrong = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - labels[i]
            g = wrong * x
            square = g * g
            sigma = (np.sqrt(n[at] + square) - np.sqrt(n[at])) / alpha
            # An index that hashing repeats within a row (words and shapes) is updated for both.
            np.add.at(z, at, g - sigma * w)
            np.add.at(n, at, square)
    return weights(slice(None))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    where: Column | None = None,
    max_train: int = MAX_TRAIN,
    shards: int = SHARDS,
    **options,
) -> np.ndarray:
    """The averaged weights. ``where`` selects the rows of ``labels`` that may be learnt from."""
    usable = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    usable = usable.filter(where) if where is not None else usable
    picked = usable.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    picked = picked.orderBy(F.xxhash64("id"), "id", "label").limit(max_train)  # bounds what is broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(picked), "id").select(
        F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), "id", "label", "text"
    )

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "label", "text"], kind="stable")
        found = [(index, value) for _, index, value in features(pa.array(part["text"], pa.large_string()))]
        weights = ftrl(found, part["label"].to_numpy(), **options).astype(np.float32)
        return pd.DataFrame({"rows": [len(part)], "weights": [weights.tobytes()]})

    total, out = 0, np.zeros((1 << BITS) + 1)
    for row in rows.groupBy("shard").applyInPandas(learn, "rows long, weights binary").collect():
        out += row["rows"] * np.frombuffer(row["weights"], np.float32)
        total += row["rows"]
    return out / max(total, 1)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the chance of label 1, for every row."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            sums = [w[index] @ value + w[-1] for _, index, value in features(batch.column(1))]
            scores = 1 / (1 + np.exp(-np.clip(np.array(sums, float), -35, 35)))
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, score double")
