"""Quality classifier: supervised subword embeddings.

Hashed words and character n-grams have learned vectors; a document is the average of its
vectors, and a softmax layer turns it into class probabilities. Trained by stochastic gradient
descent in numpy on a bounded sample of labelled documents, applied to whole texts on Spark.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.byte_text import Piece, is_space, pieces, word_hashes, words

#: Hashed buckets of n-grams of code points within words, and of words. Two more are for word pairs
#: that are one word twice, next to each other or close by: an average of what a text holds cannot
#: tell how it repeats itself (README has the figures without them).
SIZES = (3, 4)
GRAMS, WORDS = 1 << 18, 1 << 16
AGAIN = GRAMS + WORDS
NEAR = AGAIN + 1
BUCKETS = NEAR + 1
CLOSE_BY = 6
#: Zero vectors that every document has besides its own, which keeps tiny texts near the bias.
TOGETHER = 32
ZEROS = 20
DIM = 8
EPOCHS = 6
RATE = 0.5
#: The training sample has so many documents of each class.
SAMPLE = 1_200
SEED = 5


class Model(NamedTuple):
    """``scores[g]``: what bucket g adds to the log odds of class 1 where it is the average."""

    scores: np.ndarray
    bias: float


def _grams(piece: Piece) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all n-grams: for each size, in the order of rows. They are runs of code points
    inside one word, whatever number of bytes these have."""
    size = int(piece.bounds[-1])
    rows, starts, ends = words(piece)
    memory = piece.memory[:size]
    first = np.flatnonzero((memory & 0xC0) != 0x80)  # where code points begin
    letter = ~is_space(memory[first])
    at = first[letter]
    word = np.searchsorted(starts, at, side="right") - 1
    stop = np.append(first, size)
    place = np.flatnonzero(letter)
    found = []
    for n in SIZES:
        last = place + n
        fits = last < len(stop)
        fits[fits] = stop[last[fits]] <= ends[word[fits]]
        low, high = at[fits], stop[last[fits]]
        hashes = word_hashes(piece, low, high)
        found.append((rows[word[fits]], (hashes >> np.uint64(46)).astype(np.int64)))
    return found


def _word_buckets(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each word, and of each word that has just been there."""
    rows, starts, ends = words(piece)
    hashes = word_hashes(piece, starts, ends)
    plain = GRAMS + (hashes >> np.uint64(48)).astype(np.int64)
    near = np.zeros(len(rows), bool)
    for back in range(1, CLOSE_BY + 1):
        same = (hashes[back:] == hashes[:-back]) & (rows[back:] == rows[:-back])
        near[back:] |= same
        if back == 1:
            again = np.concatenate((np.zeros(min(1, len(rows)), bool), same))
    echo = np.where(again, AGAIN, NEAR)[near]
    all_rows = np.concatenate((rows, rows[near]))
    order = np.argsort(all_rows, kind="stable")
    return all_rows[order], np.concatenate((plain, echo))[order]


def features(values: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, weights that add up to n / (n + ZEROS)) of each text of n n-grams and words.

    A few texts at a time, as their n-grams take many times a text's bytes until they are counted.
    """
    found = []
    for at in range(0, len(values), TOGETHER):
        found += _features(values.slice(at, TOGETHER))
    return found


def _features(values: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    parts: list[list[np.ndarray]] = [[] for _ in range(len(values))]
    for piece in pieces(values):
        for rows, buckets in (*_grams(piece), _word_buckets(piece)):
            at = np.searchsorted(rows, np.arange(len(piece.bounds)))
            for k in range(len(piece.bounds) - 1):
                parts[piece.first + k].append(buckets[at[k] : at[k + 1]])
    found = []
    for part in parts:
        ids, counts = np.unique(
            np.concatenate(part) if part else np.empty(0, np.int64), return_counts=True
        )
        found.append((ids.astype(np.int32), (counts / (counts.sum() + ZEROS)).astype(np.float32)))
    return found


def train(
    texts: pa.Array,
    labels: list[int],
    dim: int = DIM,
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = SEED,
) -> Model:
    """Gradient descent over one document at a time, in a seeded order, the rate falling to 0.

    NULL counts as empty; texts are read whole, of any length, in pieces of about a megabyte.
    Without both classes among the labels there is nothing to learn: every score is then the
    share of class 1 among them, 0.5 for none.
    """
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 0.01), 0.99)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    docs = features(texts)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    output = np.zeros((dim, 2), np.float32)
    bias = np.zeros(2, np.float32)
    step, steps = 0, epochs * len(docs)
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            now = rate * (1 - step / steps)
            step += 1
            ids, weights = docs[i]
            hidden = weights @ vectors[ids]
            logits = hidden @ output + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[y[i]] -= 1
            back = output @ chance
            output -= now * np.outer(hidden, chance)
            bias -= now * chance
            # Shared by all n-grams of a document, the average's gradient is small: a higher rate.
            vectors[ids] -= (now * 50) * weights[:, None] * back
    return Model(
        (vectors @ (output[:, 1] - output[:, 0])).astype(np.float32), float(bias[1] - bias[0])
    )


def score(values: pa.Array, model: Model) -> np.ndarray:
    """Probability of class 1 for each text, NULL counting as empty; a text without words gets the
    bias's. Texts are read whole, of any length, in pieces of about a megabyte."""
    total, count = np.zeros(len(values)), np.zeros(len(values))
    for piece in pieces(values):
        n = len(piece.bounds) - 1
        span = slice(piece.first, piece.first + n)
        for rows, buckets in (*_grams(piece), _word_buckets(piece)):
            total[span] += np.bincount(rows, model.scores[buckets], n)
            count[span] += np.bincount(rows, minlength=n)
    return 1 / (1 + np.exp(-(total / (count + ZEROS) + model.bias)))


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score"):
    """``docs`` with the probability of class 1 of every whole text; NULL counts as empty.

    The model is of fixed size (a megabyte). A column called ``name`` is replaced.
    """

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        return pa.array(score(texts, model))

    return docs.withColumn(name, probability(docs[text_col]))
