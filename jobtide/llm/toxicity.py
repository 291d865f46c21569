"""Toxicity: a support vector machine over a subsequence string kernel, with Nystroem landmarks.

The gap-weighted kernel counts common subsequences of four letters; every letter a subsequence
spans, gaps included, costs a factor. An insult with letters put in between, or spelled with dots
or spaces, still shares most of its subsequences. Landmarks are word stems that mark sentences of
toxic training documents. Kernel values with the landmarks add up over the words of a passage; a
linear machine in the landmarks' Nystroem space judges passages, and a document is as toxic as its
worst passage.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = 4
DECAY = 0.6
#: Kernel values, as shares of a landmark's own, below which a word counts as unrelated.
RELATED = 0.40
#: A word is read in windows of so many letters that overlap by ``OVERLAP``.
LONGEST, OVERLAP = 24, 12
#: Stands before the first letter of words and landmarks: where a word begins counts as well.
START = "\x02"
STEM_LENGTHS = range(4, 10)
#: In each half of the sample, a landmark marks so many more toxic documents than clean ones, which
#: count ``CLEAN_COST`` times. Landmarks whose weight turns out below ``LEAST_WEIGHT`` are let go.
LEAST_DOCUMENTS, CLEAN_COST, LEAST_WEIGHT = 3, 2, 0.05
#: Words of a passage; values of one landmark add up to ``MOST`` at most.
PASSAGE, MOST = 30, 3.0
SAMPLE = 700
ROUNDS, STEPS, PENALTY = 3, 600, 1e-4
#: Words a Python worker remembers; then it starts afresh.
REMEMBERED = 300_000
SEED = 8

_SPELLED = re.compile(r"(?<!\S)\w(?:[ .\-*_]\w){3,}(?!\w)")
_OTHERS = re.compile(r"[\W\d_]+")


class Model(NamedTuple):
    """Landmarks, weights of their kernel values, and the logistic curve over the machine's sum."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def coded(strings: list[str]) -> np.ndarray:
    """(letter, string) code points, 0 after a string's end."""
    width = max(map(len, strings), default=0)
    joined = "".join(s.ljust(width, "\0") for s in strings)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.ascontiguousarray(codes.reshape(len(strings), width).T)


def kernel(codes: np.ndarray, landmark: str, letters: int = LETTERS, decay: float = DECAY):
    """Gap-weighted subsequence kernel of coded strings with ``landmark``, by dynamic programming
    over all strings at once."""
    target = np.frombuffer(landmark.encode("utf-32-le"), np.uint32)
    n, m = codes.shape[1], len(target)
    decay, square = np.float32(decay), np.float32(decay * decay)
    total = np.zeros(n, np.float32)
    # ends[q, j]: weight of common subsequences of q letters within the string so far and the
    # first j letters of the landmark, each counted to the end of both.
    ends = np.zeros((letters, m + 1, n), np.float32)
    ends[0] = 1
    for letter in codes:
        same = (letter == target[:, None]) * square
        total += (ends[letters - 1, :m] * same).sum(0)
        for q in range(letters - 1, 0, -1):  # from above, as q needs q - 1 before this letter
            run = ends[q - 1, :m] * same
            for j in range(1, m):
                run[j] += decay * run[j - 1]
            ends[q] *= decay
            ends[q, 1:] += run
    return total


def most_kernel(codes: np.ndarray, landmark: str, letters: int = LETTERS, decay: float = DECAY):
    """What the kernel with ``landmark`` is at most, from how often strings have its letters.

    A subsequence is found in a string as often as the product of its letters' counts at most,
    each time at a cost of decay ** letters or more; these are summed over the landmark's places.
    """
    counts = {c: (codes == ord(c)).sum(0, dtype=np.float32) for c in set(landmark)}
    n = codes.shape[1]
    ends = np.zeros((letters, n), np.float32)  # sums over q + 1 places, counted to this place
    total = np.zeros(n, np.float32)
    for c in landmark:
        own = counts[c] * np.float32(decay)
        ends *= np.float32(decay)
        total += ends[letters - 2] * counts[c] if letters > 1 else own
        for q in range(letters - 2, 0, -1):
            ends[q] += ends[q - 1] * counts[c]
        ends[0] += own
    return total * np.float32(decay**letters)


def related(strings: list[str], landmarks: list[str]) -> np.ndarray:
    """(strings, landmarks): kernel as a share of the landmark's own, at most 1; small ones are 0.

    Strings that cannot reach the limit with their letters (``most_kernel``) are not compared.
    """
    found = np.zeros((len(strings), len(landmarks)), np.float32)
    if not strings or not landmarks:
        return found
    codes = coded(strings)
    for k, landmark in enumerate(landmarks):
        own = kernel(coded([landmark]), landmark)[0]
        rows = np.flatnonzero(most_kernel(codes, landmark) >= 0.999 * RELATED * own)
        for at in range(0, len(rows), 2_048):
            some = rows[at : at + 2_048]
            found[some, k] = kernel(codes[:, some], landmark) / own
    found[found < RELATED] = 0
    return np.minimum(found, 1)


def _windows(token: str) -> list[str]:
    """The letters of a token, in windows; too few letters give none."""
    word = _OTHERS.sub("", token)
    if len(word) < LETTERS:
        return []
    word = START + word
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - OVERLAP, LONGEST - OVERLAP)]


class Reader:
    """Kernel values of words with the landmarks, each word read once."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, np.ndarray | None] = {}

    def learn(self, tokens: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh = list(tokens - self.known.keys())
        values = word_values(fresh, self.model.landmarks)
        near = values.any(1)
        self.known.update(dict.fromkeys(fresh))
        self.known.update((fresh[i], values[i].copy()) for i in np.flatnonzero(near))

    def passages(self, tokens: list[str]) -> np.ndarray:
        """Sums of kernel values over the passages that begin at a related word; one empty passage
        if there is none."""
        values = list(map(self.known.__getitem__, tokens))
        at = [i for i, v in enumerate(values) if v is not None]
        if not at:
            return np.zeros((1, len(self.model.landmarks)), np.float32)
        sums = np.cumsum([values[i] for i in at], axis=0)
        ends = np.searchsorted(at, np.array(at) + PASSAGE) - 1
        before = np.vstack((np.zeros((1, sums.shape[1])), sums[:-1]))
        return np.minimum(sums[ends] - before, MOST)


def word_values(tokens: list[str], landmarks: list[str]) -> np.ndarray:
    """(tokens, landmarks): best kernel value over the windows of each token."""
    windows = [_windows(t) for t in tokens]
    strings = list({w for ws in windows for w in ws})
    rows = {w: i for i, w in enumerate(strings)}
    values = related(strings, landmarks)
    found = np.zeros((len(tokens), len(landmarks)), np.float32)
    for k, ws in enumerate(windows):
        if ws:
            found[k] = values[[rows[w] for w in ws]].max(0)
    return found


def normal(text: str) -> str:
    """Lower case, with words spelled in single letters put together."""
    return _SPELLED.sub(lambda m: _OTHERS.sub("", m.group()), text.lower())


def choose_landmarks(texts: list[str], labels: list[int]) -> list[str]:
    """Word stems, behind ``START``, by the toxic documents they mark less ``CLEAN_COST`` times the
    clean ones: by one word that begins with the stem, or by two of a passage if that tells more.

    The documents fall into halves by a hash, and a stem must mark enough in both: what happens to
    fit one half is held against the other. Near copies count once or twice: what is counted is
    different smallest word hashes of the documents. There may be any number of landmarks. Of stems
    that begin alike the better is taken, of equals the longer, then the first.
    """
    counted: list[dict] = [{}, {}]  # for each half, (level, stem) -> kinds of toxic and clean documents
    for text, y in zip(texts, labels):
        kind = min((zlib.crc32(w.encode()) for w in set(text.split())), default=0)
        half = counted[kind >> 7 & 1]
        for level, stems in enumerate(_stems(text)):
            for stem in stems:
                half.setdefault((level, stem), (set(), set()))[0 if y else 1].add(kind)
    gain: dict[str, int] = {}
    for key in counted[0].keys() & counted[1].keys():
        each = [len(half[key][0]) - CLEAN_COST * len(half[key][1]) for half in counted]
        if min(each) >= LEAST_DOCUMENTS:
            gain[key[1]] = max(gain.get(key[1], 0), sum(each))
    chosen: list[str] = []
    for stem in sorted(gain, key=lambda s: (-gain[s], -len(s), s)):
        if not any(stem.startswith(c) or c.startswith(stem) for c in chosen):
            chosen.append(stem)
    return [START + stem for stem in chosen]


def _variants(landmarks: list[str], seed: int) -> list[str]:
    """Each landmark's letters with a strange one at each inner place."""
    rng = np.random.default_rng(seed)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    plain = [s.removeprefix(START) for s in landmarks]
    return [s[:i] + rng.choice(letters) + s[i:] for s in plain for i in range(1, len(s))]


def _stems(text: str) -> tuple[set[str], set[str]]:
    """Beginnings of words, and those that two words of a passage have."""
    once: set[str] = set()
    twice: set[str] = set()
    last: dict[str, int] = {}
    for i, token in enumerate(text.split()):
        word = _OTHERS.sub("", token)
        for n in STEM_LENGTHS:
            if len(word) < n:
                break
            stem = word[:n]
            if i - last.get(stem, -PASSAGE) < PASSAGE:
                twice.add(stem)
            last[stem] = i
    once.update(last)
    return once, twice


def train(texts: pa.Array, labels: list[int], seed: int = SEED) -> Model:
    """Landmarks, then a support vector machine over passages, then a logistic curve.

    Landmarks that get next to no weight are let go, and the rest is fitted again. All passages of
    clean documents are clean. Of each toxic document with a related word, the
    passage the machine finds worst is its witness, chosen again after each round; landmarks with
    a letter put in are toxic too. Without both classes or without landmarks every score is the
    share of toxic ones.
    """
    plain = [normal(t.as_py() or "") for t in texts]
    y = np.array(labels, int)
    landmarks = choose_landmarks(plain, labels) if len(set(labels)) == 2 else []
    if not landmarks:
        share = min(max(float(y.mean()) if len(y) else 0.0, 0.01), 0.99)
        return Model([], np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    tokens = [t.split() for t in plain]
    while True:
        bags = _bags(tokens, landmarks)
        weights, bias = _fitted(bags, y, landmarks, seed)
        useful = weights >= LEAST_WEIGHT
        if useful.all() or not useful.any():
            break
        landmarks = [s for s, u in zip(landmarks, useful) if u]
    slope, shift = _logistic(np.array([(b @ weights).max() + bias for b in bags]), y)
    return Model(landmarks, weights, bias, slope, shift)


def _bags(tokens: list[list[str]], landmarks: list[str]) -> list[np.ndarray]:
    reader = Reader(Model(landmarks, np.ones(len(landmarks)), 0.0, 1.0, 0.0))
    reader.learn({w for ws in tokens for w in ws})
    return [reader.passages(ws) for ws in tokens]


def _fitted(
    bags: list[np.ndarray], y: np.ndarray, landmarks: list[str], seed: int
) -> tuple[np.ndarray, float]:
    """Weights of the landmarks' kernel values, learned in their Nystroem space, and bias."""
    weights, bias = np.ones(len(landmarks)), 0.0
    own = [kernel(coded([a]), a)[0] for a in landmarks]
    gram = np.array([kernel(coded(landmarks), b) for b in landmarks], float)
    gram /= np.sqrt(np.outer(own, own))
    values, vectors = np.linalg.eigh(gram)
    whiten = vectors / np.sqrt(np.maximum(values, 0.1)) @ vectors.T

    clean = np.concatenate([b for b, t in zip(bags, y) if not t])
    quiet = ~clean.any(1)  # many, and all alike
    share = np.concatenate(([max(1, quiet.sum())], np.ones((~quiet).sum())))
    clean = np.concatenate((np.zeros((1, len(landmarks))), clean[~quiet]))
    extra = word_values(_variants(landmarks, seed), landmarks)
    for _ in range(ROUNDS):
        witness = [b[np.argmax(b @ weights)] for b, t in zip(bags, y) if t and b.any()]
        hot = np.concatenate((np.array(witness), extra)) if witness else extra
        sign = np.repeat([-1.0, 1.0], [len(clean), len(hot)])
        worth = np.full(len(hot), 1 / max(1, len(witness)))
        worth[len(witness) :] = 0.25 / len(extra)
        weight = np.concatenate((share / share.sum(), worth / worth.sum())) / 2
        inner, bias = _machine(np.concatenate((clean, hot)) @ whiten, sign, weight)
        weights = whiten @ inner
    return weights, bias


def _machine(x: np.ndarray, sign: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Hinge loss, each class weighing half, by subgradient steps that get smaller."""
    weights, bias = np.zeros(x.shape[1]), 0.0
    for step in range(1, STEPS + 1):
        inside = sign * (x @ weights + bias) < 1
        pull = (share * sign)[inside]
        rate = 3.0 / np.sqrt(step)
        weights += rate * (pull @ x[inside] - PENALTY * weights)
        bias += rate * pull.sum()
    return weights, float(bias)


def _logistic(sums: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log odds, each class weighing half, by gradient descent."""
    slope, shift = 1.0, 0.0
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for _ in range(2_000):
        error = share * (1 / (1 + np.exp(-(slope * sums + shift))) - y)
        slope -= 0.5 * ((error * sums).sum() + 1e-4 * slope)
        shift -= 0.5 * error.sum()
    return float(slope), float(shift)


def _worst(plain: list[str], reader: Reader) -> np.ndarray:
    """The machine's value of the worst passage of each text."""
    tokens = [t.split() for t in plain]
    reader.learn({w for ws in tokens for w in ws})
    model = reader.model
    return np.array([(reader.passages(ws) @ model.weights).max() + model.bias for ws in tokens])


def score(texts: pa.Array, reader: Reader) -> np.ndarray:
    """Probability of each text's label being toxic."""
    found, held, size = [], [], 0
    for text in texts:
        held.append(normal(text.as_py() or ""))
        size += len(held[-1])
        if size >= 1 << 20:
            found.append(_worst(held, reader))
            held, size = [], 0
    sums = np.concatenate([*found, _worst(held, reader) if held else np.zeros(0)])
    return 1 / (1 + np.exp(-(reader.model.slope * sums + reader.model.shift)))


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score"):
    """``docs`` with the probability of every whole text's being toxic; NULL counts as empty.

    Texts without a word near a landmark, empty ones too, get the same low score. Every row is
    scored by itself. A column called ``name`` is replaced.
    """

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        return pa.array(score(texts, _reader(model)))

    return docs.withColumn(name, probability(docs[text_col]))


_LAST: list = []


def _reader(model: Model) -> Reader:
    """The Python worker's reader for this model, kept from batch to batch."""
    if not _LAST or repr(_LAST[0].model) != repr(model):
        _LAST[:] = [Reader(model)]
    return _LAST[0]
