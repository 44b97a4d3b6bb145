"""Toxicity by a gapped-subsequence kernel, Nyström landmarks and a support vector machine.

A text's sentences are judged by their words. The kernel of two words counts the triples of letters
they share in order, gaps allowed: a triple that spans s letters, s at most ``SPAN``, weighs
``DECAY ** s``, and the kernel is normalised. Punctuation inside a word is skipped. Neighbouring
words, short ones in a row and runs of single letters are joined too, whatever blanks and punctuation stand
between, so that inserted characters lower the similarity only a little. A word cut into more than two pieces is
joined whole only if they are single letters, or ``PIECES`` at most of ``SHORT`` letters.

Training: labels hold for whole texts, so which sentence makes a text toxic is found while
learning. The word that stands out most in each toxic text is its witness; a support vector machine
on Nyström features of the witnesses and of clean words is fitted, witnesses are chosen again with
it, and so on; witnesses that serve as landmarks are also examples with a character inserted.
Landmarks are the ``LANDMARKS`` / 2 most frequent witnesses and as many clean words nearest to them. A logistic curve
turns a text's highest decision, the sum of its positive ones and its number of words into a score.

All of that uses a bounded sample of labelled texts: the first ``SAMPLE`` ids of each class in the order of a hash of the
id, as far as their texts add up to ``SAMPLE_BYTES``. Every word of a sampled text counts: words are cut, counted
by text and normalised in Spark, and the driver gets one table of them as class numbers, no texts and no strings. The
fit starts from ``NEGATIVES`` clean words, the nearest and an even spread. A clean word beyond its margin does not change a squared hinge,
so the last fit adds all clean words of the sample that lie within it until there are none, which makes it the fit over all of them.
The fits before it only choose witnesses. Nothing random is involved.

Scoring covers every word of every text. The decision is linear in the triples, so the landmarks fold
into one table of weights by triple, which is what executors get (``CLASSES ** 3`` numbers). The triples of joined neighbours
are those of both plus the ones across the joint, so neighbours are weighed without being spelled out. Their norm follows only where that
sum exceeds what the least possible norm of their length needs for a positive decision; joined words matter only then.

Defined results: a null or empty text, or one without words, gets the lowest score. Labels that are
null, or belong to no text, are not used; a label that is given twice is used once, a text with both labels as both. Without
a label of each class every score is 0. Further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain, combinations, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import Shared, filled, kept_table, releasing

FOLDS = 5
SAMPLE = 1200  # labelled ids of each class
SAMPLE_BYTES = 8 << 20  # of their texts, for each class
SPAN = 6
DECAY = 0.7
CLASSES = 64  # of letters; none has class 0
GAP = SPAN - 1
WINDOW, STEP = 24, 12  # longer words are cut into overlapping windows
LANDMARKS = 256
ROUNDS = 3
NEGATIVES = 12_000  # clean words a fit starts from
KNOWN = 1 << 18  # words, and as many joined ones, whose decisions a task remembers
SLICE = 500  # texts that are weighed together
LOWEST = -3.0  # decision of a text without words

START, END = "\x02", "\x03"  # marks of a word's ends, letters of their own to the kernel

SHORT = 3  # letters of a piece of a word, at most, where more than two pieces are joined
PIECES = 4  # that are joined, unless they are single letters
HALF = WINDOW // 2 - 1  # letters on either side of the joint of two words
JOINTS = re.compile(r"[\W_]+")
OFFSETS = [(j, k) for j, k in combinations(range(1, SPAN), 2)]


def held_out(id_col: Column) -> Column:
    """Rows kept from learning: the checksum of the id as text is divisible by ``FOLDS``."""
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == 0, F.lit(False))


def units(text: str) -> set[str]:
    """The distinct words of a text as the kernel sees them, still with their punctuation, and neighbours joined.

    Joined, without punctuation and blanks, are runs of single letters and, with a blank before, any two neighbours
    (the ``HALF`` letters next to the joint) and up to ``PIECES`` short ones.
    """
    words = text.lower().split()
    found = set(words)
    pieces = [p for p in (JOINTS.sub("", w) for w in words) if p]
    found.update(f" {a[-HALF:]}{b[:HALF]}" for a, b in zip(pieces, pieces[1:], strict=False))
    run: list[str] = []
    for piece in [*pieces, ""]:
        if 0 < len(piece) <= SHORT:
            run.append(piece)
            continue
        found.update(joined(run))
        run = []
    return found


def joined(run: list[str]) -> set[str]:
    """What short neighbours give beyond pairs."""
    found: set[str] = set()
    for n in range(3, min(PIECES, len(run)) + 1):
        found.update(" " + "".join(run[i : i + n]) for i in range(len(run) - n + 1))
    if len(run) > 2:
        singles = (list(g) for single, g in groupby(run, key=lambda p: len(p) == 1) if single)
        found.update("".join(g) for g in singles if len(g) > 2)
    return found


def windows(unit: str) -> list[str]:
    """A word's letters and digits between end marks, cut into overlapping windows if there are many."""
    unit = JOINTS.sub("", unit)
    if not unit:
        return []
    unit = f"{START}{unit}{END}"
    if len(unit) <= WINDOW:
        return [unit]
    return [unit[i : i + WINDOW] for i in range(0, len(unit) - WINDOW + STEP, STEP)]


def _letters(text: str) -> np.ndarray:
    """Class of each character: a-z, digits and marks have their own, others share what is left."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    classes = 39 + points % (CLASSES - 39)
    classes = np.where(points < 4, points + 35, classes)
    classes = np.where((points >= 97) & (points <= 122), points - 96, classes)
    return np.where((points >= 48) & (points <= 57), points - 21, classes)


def encoded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all letters and the words' lengths."""
    return _letters("".join(words)).astype(np.uint8), np.fromiter(map(len, words), dtype=np.int64, count=len(words))


def triples(letters: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(words, triples, weight) for each pair of gaps; unnormalised, a word's triples may repeat."""
    letters, owner = letters.astype(np.int32), np.repeat(np.arange(len(lengths)), lengths)
    for j, k in OFFSETS:
        if len(letters) <= k:
            continue
        inside = np.flatnonzero(owner[k:] == owner[:-k])
        yield owner[inside], (letters[inside] * CLASSES + letters[inside + j]) * CLASSES + letters[inside + k], DECAY ** (k + 1)


def _blocks(lengths: np.ndarray, size: int = 5_000) -> Iterator[tuple[slice, slice]]:
    """Words, and their letters, a block at a time."""
    ends = np.append(0, np.cumsum(lengths))
    for start in range(0, len(lengths), size):
        end = min(start + size, len(lengths))
        yield slice(start, end), slice(int(ends[start]), int(ends[end]))


def padded(letters: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letters with class 0, which none has, ``GAP`` times before each word and behind the last; and where words start."""
    starts = np.cumsum(lengths) - lengths + GAP * np.arange(1, len(lengths) + 1)
    out = np.zeros(len(letters) + GAP * (len(lengths) + 1), dtype=np.int32)
    out[np.arange(len(letters)) + np.repeat(GAP * np.arange(1, len(lengths) + 1), lengths)] = letters
    return out, starts


def _sums(flat: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums over the words of padded letters; no triple reaches over the gaps, as the table is 0 there."""
    if not len(starts):
        return np.empty(0)
    out, n = np.zeros(len(flat)), len(flat)
    for j, k in OFFSETS:
        out[: n - k] += DECAY ** (k + 1) * table[(flat[: n - k] * CLASSES + flat[j : n - k + j]) * CLASSES + flat[k:]]
    return np.add.reduceat(out, starts)


def numerators(letters: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The sum of a table's entries over each word's triples, weighted but not normalised."""
    parts = [_sums(*padded(letters[at], lengths[words]), table) for words, at in _blocks(lengths)]
    return np.concatenate([np.empty(0), *parts])


def least_norm(length: int) -> float:
    """No word of so many letters has a smaller norm: its triples would all have to differ."""
    return math.sqrt(sum(max(0, length - k) * DECAY ** (2 * (k + 1)) for _, k in OFFSETS))


LEAST_NORM = np.array([max(least_norm(n), 1e-9) for n in range(WINDOW + 1)])


@dataclass
class Features:
    """Normalised triple weights of words: one entry for each word and distinct triple."""

    row: np.ndarray
    code: np.ndarray
    weight: np.ndarray
    n: int

    @staticmethod
    def of(words: list[str]) -> Features:
        return Features.of_letters(*encoded(words))

    @staticmethod
    def of_letters(letters: np.ndarray, lengths: np.ndarray) -> Features:
        rows, codes, weights = [np.empty(0, np.int32)], [np.empty(0, np.int32)], [np.empty(0, np.float32)]
        for words, at in _blocks(lengths, 2_000):
            found = list(triples(letters[at], lengths[words]))
            keys = [row * CLASSES**3 + code for row, code, _ in found]
            values = [np.full(len(row), weight) for row, _, weight in found]
            key, place = np.unique(np.concatenate([np.empty(0, np.int64), *keys]), return_inverse=True)
            summed = np.bincount(place, weights=np.concatenate([np.empty(0), *values]), minlength=len(key))
            row = key // CLASSES**3
            norm = np.sqrt(np.bincount(row, weights=summed**2, minlength=1))
            rows.append((row + words.start).astype(np.int32))
            codes.append((key % CLASSES**3).astype(np.int32))
            weights.append((summed / norm[row]).astype(np.float32))
        return Features(np.concatenate(rows), np.concatenate(codes), np.concatenate(weights), len(lengths))

    def dot(self, table: np.ndarray) -> np.ndarray:
        """Sum of a table's entries by triple, weighted, for each word."""
        out = np.zeros(self.n)
        for start in range(0, len(self.row), 1 << 20):
            part = slice(start, start + (1 << 20))
            out += np.bincount(self.row[part], weights=self.weight[part] * table[self.code[part]], minlength=self.n)
        return out

    def kernel(self, landmarks: Features) -> np.ndarray:
        """Similarities of all words to all landmarks."""
        used, compact = np.unique(landmarks.code, return_inverse=True)
        dense = np.zeros((len(used), landmarks.n), dtype=np.float32)
        dense[compact, landmarks.row] = landmarks.weight
        at = np.minimum(np.searchsorted(used, self.code), len(used) - 1)
        keep = np.flatnonzero(used[at] == self.code)
        out = np.zeros((self.n, landmarks.n), dtype=np.float32)
        rows, at, weight = self.row[keep], at[keep], self.weight[keep].astype(np.float32)
        for start in range(0, len(rows), 1 << 12):
            part = slice(start, start + (1 << 12))
            first, begins = np.unique(rows[part], return_index=True)
            out[first] += np.add.reduceat(dense[at[part]] * weight[part, None], begins, axis=0)
        return out


def svm(parts: list[tuple[np.ndarray, float, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps, from (examples, class, weights) of either class."""
    n = parts[0][0].shape[1] + 1
    ridge = np.append(np.ones(n - 1), 1e-3)
    w = np.zeros(n)
    active = [np.ones(len(x), dtype=bool) for x, _, _ in parts]
    for _ in range(30):
        normal, right = np.diag(ridge), np.zeros(n)
        for (x, y, weight), chosen in zip(parts, active, strict=True):
            for start in range(0, len(x), 2048):  # in double precision, a block at a time
                rows = start + np.flatnonzero(chosen[start : start + 2048])
                part = np.hstack([x[rows], np.ones((len(rows), 1))])
                weighted = part * weight[rows, None]
                normal += weighted.T @ part
                right += y * weighted.sum(axis=0)
        w = np.linalg.solve(normal, right)
        now = [y * (x @ w[:-1].astype(x.dtype) + w[-1]) < 1 for x, y, _ in parts]
        if all((a == b).all() for a, b in zip(now, active, strict=True)):
            break
        active = now
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """The decision's weight for each triple, its offset, and the curve from a text's decisions to its score."""

    table: np.ndarray
    bias: float
    curve: np.ndarray

    def decisions(self, words: list[str]) -> np.ndarray:
        """The decision for each word; LOWEST at least."""
        cut = [windows(w) for w in words]
        best = np.full(len(words), LOWEST)
        letters, lengths = encoded([w for found in cut for w in found])
        values = self.judged(letters, lengths, numerators(letters, lengths, self.table))
        np.maximum.at(best, np.repeat(np.arange(len(words)), [len(found) for found in cut]), values)
        return best

    def judged(self, letters: np.ndarray, lengths: np.ndarray, numerator: np.ndarray) -> np.ndarray:
        """Decisions from sums over triples: exact if positive, otherwise by the least norm of the length.

        The norm of a word takes sorting its triples. No norm is below the least one, so a decision that is not positive with
        that is not positive at all.
        """
        values = numerator / LEAST_NORM[lengths] + self.bias
        exact = np.flatnonzero(values > 0) if self.bias <= 0 else np.arange(len(lengths))
        if len(exact):
            starts = np.cumsum(lengths) - lengths
            own = lengths[exact]
            at = np.arange(own.sum()) + np.repeat(starts[exact] - (np.cumsum(own) - own), own)
            values[exact] = Features.of_letters(letters[at], own).dot(self.table) + self.bias
        return values

    def plain(self) -> tuple[np.ndarray, float, np.ndarray]:
        """The parts, for executors."""
        return self.table, self.bias, self.curve

    def score(self, summaries: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summaries @ self.curve, -30, 30)))


def summary(words: list[float], joined: list[float]) -> tuple[float, float, float, float]:
    """What the curve sees of a text: its worst word, how many stand out, how many there are; joined ones if they stand out."""
    positive = [d for d in joined if d > 0]
    total = sum(d for d in words if d > 0) + sum(positive)
    return max([*words, *positive], default=LOWEST), math.log1p(total), math.log1p(len(words)), 1.0


def _curve(x: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Logistic curve towards Platt's softened targets, by Newton steps; share: of toxic texts."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight, w = np.where(toxic, share / n1, (1 - share) / n0), np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + 1e-4 * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 2 / (np.abs(step).max() + 1e-12))
    return w


def _gapped(word: np.ndarray) -> list[np.ndarray]:
    """The letters with a foreign one after each inner letter, as further examples."""
    return [np.insert(word, i, _letters("0")[0]) for i in range(2, len(word) - 1)]


@dataclass
class Words:
    """Words of sampled texts: classes of letters one word behind the other, norms, and how many texts have each."""

    letters: np.ndarray
    lengths: np.ndarray
    norms: np.ndarray
    in_toxic: np.ndarray
    in_clean: np.ndarray
    candidate: np.ndarray  # may be a witness; all others are clean

    def __post_init__(self):
        self.starts = np.cumsum(self.lengths) - self.lengths

    def word(self, i: int) -> np.ndarray:
        return self.letters[self.starts[i] : self.starts[i] + self.lengths[i]]

    def features(self, chosen: np.ndarray, more: list[np.ndarray] | None = None) -> Features:
        words = [self.word(i) for i in chosen] + (more or [])
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        return Features.of_letters(np.concatenate([np.empty(0, np.uint8), *words]), lengths)

    def values(self, table: np.ndarray) -> np.ndarray:
        return numerators(self.letters, self.lengths, table) / self.norms

    def sums(self, weight: np.ndarray) -> np.ndarray:
        """Of the words' normalised triples, each word with its weight."""
        out, weight = np.zeros(CLASSES**3), weight / self.norms
        for words, at in _blocks(self.lengths):
            for row, code, decay in triples(self.letters[at], self.lengths[words]):
                out += np.bincount(code, weights=decay * weight[words][row], minlength=CLASSES**3)
        return out


class _Learner:
    """Fits decisions to chosen witnesses over a fixed set of words."""

    def __init__(self, words: Words):
        self.words, self.against = words, np.flatnonzero(~words.candidate)

    def first_values(self, seen: np.ndarray) -> np.ndarray:
        """Naive Bayes over triples: words of toxic texts, with their counts, against clean words."""
        clean = (~self.words.candidate).astype(float)
        a, b = self.words.sums(seen.astype(float)), self.words.sums(clean)
        table = np.log((a + 0.5) / (seen.sum() + 1)) - np.log((b + 0.5) / (clean.sum() + 1))
        table = table.reshape(CLASSES, CLASSES, CLASSES)
        table[0], table[:, 0], table[:, :, 0] = 0, 0, 0  # no letters
        return self.words.values(table.ravel())

    def _mapped(self, chosen: np.ndarray, landmarks: Features, mapped: np.ndarray) -> list[np.ndarray]:
        """Nyström features of words, in blocks."""
        blocks = (chosen[i : i + 2000] for i in range(0, len(chosen), 2000))
        return [self.words.features(block).kernel(landmarks) @ mapped for block in blocks]

    def fit(self, witness: np.ndarray, value: np.ndarray, whole: bool = False) -> tuple[np.ndarray, float]:
        """Table and bias; ``value`` tells which clean words are near the witnesses. ``whole`` fits all clean words."""
        words, against = self.words, self.against
        chosen, often = np.unique(witness, return_counts=True)
        chosen = chosen[np.argsort(-often, kind="stable")][: LANDMARKS // 2]
        near = against[np.argsort(-value[against], kind="stable")]
        landmarks = words.features(np.concatenate([chosen, near[: LANDMARKS // 2]]))
        # the nearest clean words, and evenly spaced ones of the rest
        rest = near[NEGATIVES // 2 :]
        spaced = np.linspace(0, len(rest), min(len(rest), NEGATIVES // 2), endpoint=False).astype(np.int64)
        negative = np.concatenate([near[: NEGATIVES // 2], rest[spaced]])
        gram = landmarks.kernel(landmarks)
        values, vectors = np.linalg.eigh(gram + 1e-6 * np.eye(len(gram)))
        nystrom = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
        gapped = [v for i in chosen for v in _gapped(words.word(i))]
        mapped = nystrom.astype(np.float32)
        positive = words.features(witness, gapped).kernel(landmarks) @ mapped
        # each text and each clean text with the word counts; all inserted characters together as half the texts
        inserted = np.full(len(gapped), len(witness) / (2 * len(gapped) + 1))
        taught = np.append(np.ones(len(witness)), inserted)
        often = words.in_clean.astype(float)
        x = self._mapped(negative, landmarks, mapped)
        size = len(positive) + len(negative)
        while True:
            # both classes weigh the same; clean words that a whole fit leaves out are beyond their margin
            scale = 5.0 * size / often[negative if not whole else against].sum()
            ends = np.cumsum([len(part) for part in x])
            against_it = [(part, -1.0, w) for part, w in zip(x, np.split(often[negative] * scale, ends[:-1]), strict=True)]
            w, bias = svm([(positive, 1.0, taught * (5.0 * size / taught.sum())), *against_it])
            table = np.bincount(landmarks.code, weights=landmarks.weight * (nystrom @ w)[landmarks.row], minlength=CLASSES**3)
            if not whole:
                return table, bias
            inside = against[words.values(table)[against] + bias > -1]
            added = np.setdiff1d(inside, negative)
            if not len(added):
                return table, bias
            negative = np.concatenate([negative, added])
            x += self._mapped(added, landmarks, mapped)


def learn(words: Words, bags: list[np.ndarray]) -> Model | None:
    """Decisions from words and the candidates in each toxic text; without its curve.

    The toxic texts are learned in two halves: a text's witness is the word that the model of the
    other half finds worst, and a text in which that model finds nothing teaches nothing, so that
    chance words and wrong labels do not confirm themselves.
    """
    bags = [b for b in bags if len(b)]
    if len(bags) < 2 or words.candidate.all():
        return None
    learner, half = _Learner(words), np.arange(len(bags)) % 2

    def texts_with(chosen: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate(chosen), minlength=len(words.lengths))

    values = [learner.first_values(texts_with(bags[1 - h :: 2])) for h in (0, 1)]
    witness = np.array([bag[np.argmax(values[h][bag])] for bag, h in zip(bags, half, strict=True)])
    taught = np.ones(len(bags), dtype=bool)
    for _ in range(ROUNDS):
        for h in (0, 1):
            other = (half != h) & taught
            table, bias = learner.fit(witness[other if other.any() else half != h], values[h])
            values[h] = words.values(table) + bias
        witness = np.array([bag[np.argmax(values[h][bag])] for bag, h in zip(bags, half, strict=True)])
        taught = np.array([values[h][w] > 0 for w, h in zip(witness, half, strict=True)])
    table, bias = learner.fit(witness[taught] if taught.any() else witness, values[0] + values[1], whole=True)
    return Model(table, bias, np.zeros(4))


def _nothing() -> Model:
    return Model(np.zeros(CLASSES**3), LOWEST, np.array([0.0, 0.0, 0.0, -30.0]))


def _is_candidate(in_toxic, in_clean, plain, n_toxic, n_clean):
    """Words of clean texts and joined neighbours are witnesses only if that can hardly be chance."""
    odds = ((in_toxic + 0.5) / (n_toxic + 1)) / ((in_clean + 0.5) / (n_clean + 1))
    return (in_toxic > 0) & (plain & (in_clean == 0) | (odds > 10) & (in_toxic >= 5))


def fit(bags: list[list[str]], toxic: np.ndarray, share: float = 0.5) -> Model:
    """A model from the units of labelled texts in memory; share: of toxic texts where it will be used."""
    plain = {w for bag in bags for unit in bag if unit[:1] != " " for w in windows(unit)}
    cut = [sorted({w for unit in bag for w in windows(unit)}) for bag in bags]
    names = sorted(set().union(*cut))
    number = {w: i for i, w in enumerate(names)}
    numbered = [np.array([number[w] for w in bag], dtype=np.int64) for bag in cut]
    in_toxic, in_clean = (
        np.bincount(np.concatenate([np.empty(0, np.int64), *(b for b, t in zip(numbered, toxic, strict=True) if t == k)]), minlength=len(names))
        for k in (True, False)
    )
    candidate = _is_candidate(in_toxic, in_clean, np.array([w in plain for w in names], dtype=bool), toxic.sum(), (~toxic).sum())
    used = np.flatnonzero(candidate | (in_clean > 0))
    letters, lengths = encoded([names[i] for i in used])
    words = Words(letters, lengths, _norms(letters, lengths), in_toxic[used], in_clean[used], candidate[used])
    place = np.full(len(names), -1)
    place[used] = np.arange(len(used))
    model = learn(words, [place[b[candidate[b]]] for b, t in zip(numbered, toxic, strict=True) if t])
    if model is None:
        return _nothing()
    seen = []
    for bag in bags:
        values = dict(zip(bag, model.decisions(bag).tolist(), strict=True))
        seen.append(summary([values[u] for u in bag if u[:1] != " "], [values[u] for u in bag if u[:1] == " "]))
    model.curve = _curve(np.array(seen), toxic, share)
    return model


def _norms(letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of the triples' summed weights; 1 for a word without triples."""
    out = np.ones(len(lengths))
    for words, at in _blocks(lengths, 2_000):
        found = list(triples(letters[at], lengths[words]))
        if not any(len(row) for row, _, _ in found):
            continue
        key, place = np.unique(np.concatenate([row * CLASSES**3 + code for row, code, _ in found]), return_inverse=True)
        summed = np.bincount(place, weights=np.concatenate([np.full(len(row), weight) for row, _, weight in found]))
        norm = np.sqrt(np.bincount(key // CLASSES**3, weights=summed**2, minlength=words.stop - words.start))
        out[words] = np.where(norm > 0, norm, 1)
    return out


def _words_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic, word, plain) for each distinct word of each text; a word is the classes of its letters."""
    for batch in batches:
        for place, toxic, text in zip(*(batch.column(c).to_pylist() for c in ("place", "toxic", "text")), strict=True):
            plain: dict[str, bool] = {}
            for unit in units(text):
                for w in windows(unit):
                    plain[w] = plain.get(w, False) or unit[:1] != " "
            letters, lengths = encoded(list(plain))
            ends = np.cumsum(lengths).tolist()
            found: dict[bytes, bool] = {}
            for start, end, p in zip([0, *ends], ends, plain.values(), strict=False):
                word = letters[start:end].tobytes()
                found[word] = found.get(word, False) or p
            n = len(found)
            columns = [pa.array([place] * n, pa.int64()), pa.array([toxic] * n, pa.int32()), pa.array(list(found), pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(found.values()), pa.bool_())], names=["place", "toxic", "word", "plain"])


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Classes and lengths of words given as bytes."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    return np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]], np.diff(ends)


def _with_norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        norms = pa.array(_norms(*_flat(batch.column("word"))).astype(np.float32))
        yield pa.RecordBatch.from_arrays([*batch.columns, norms], names=[*batch.schema.names, "norm"])


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, float]:
    """(place, toxic, text) of the texts to learn from, and the share of toxic texts among all that could be."""
    own = F.col(f"`{id_col}`")
    usable = labels.where(F.col(f"`{label_col}`").isin(0, 1) & ~held_out(own)).select(
        own.alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic")
    ).distinct()
    texts = docs.select(own.alias("id"), filled(F.col(f"`{text_col}`")).alias("text"))
    # ids with their texts' bytes; the join may drop labels without text, so it comes before the bound
    sizes = texts.select("id", F.octet_length("text").alias("size")).join(usable, "id")
    sizes = kept_table(sizes.groupBy("id", "toxic").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "toxicity-labels")
    counts = {r["toxic"]: r["n"] for r in sizes.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    parts = [sizes.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for label in (0, 1)]
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("id"), "id")  # over SAMPLE rows
    chosen = parts[0].unionByName(parts[1]).select(
        "id", "toxic", F.row_number().over(order).cast("long").alias("place"), F.sum("size").over(order).alias("total")
    )
    chosen = chosen.where(F.col("total") <= SAMPLE_BYTES).drop("total")
    return kept_table(texts.join(F.broadcast(chosen), "id").select("place", "toxic", "text"), "toxicity-sample"), share


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from a bounded number of labelled texts of each class that are not held out."""
    sample, share = sampled(docs, labels, id_col, text_col, label_col)
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    found = sample.mapInArrow(_words_of_texts, "place bigint, toxic int, word binary, plain boolean")
    found = kept_table(found, "toxicity-words")
    counted = found.groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).cast("int").alias("in_toxic"), F.count_if(F.col("toxic") == 0).cast("int").alias("in_clean"),
        F.max("plain").alias("plain"),
    )
    candidate = _is_candidate(F.col("in_toxic"), F.col("in_clean"), F.col("plain"), n.get(1, 0), n.get(0, 0))
    counted = counted.withColumn("candidate", candidate).where("candidate OR in_clean > 0").drop("plain")
    schema = "word binary, in_toxic int, in_clean int, candidate boolean, norm float"
    counted = kept_table(counted.mapInArrow(_with_norms, schema), "toxicity-counts")
    bags = found.where("toxic = 1").select("place", "word").join(counted.where("candidate").select("word"), "word").toArrow()
    table = counted.orderBy("word").toArrow()
    arrays = [table[c].to_numpy() for c in ("norm", "in_toxic", "in_clean", "candidate")]
    parts = [_flat(part) for part in table["word"].chunks]
    letters = np.concatenate([np.empty(0, np.uint8), *(part[0] for part in parts)])
    words = Words(letters, np.concatenate([np.empty(0, np.int64), *(part[1] for part in parts)]), *arrays)
    at, place = pc.index_in(bags["word"], table["word"]).to_numpy(), bags["place"].to_numpy()
    order = np.lexsort((at, place))
    at, place = at[order].astype(np.int64), place[order]
    del table, bags, parts
    model = learn(words, np.split(at, np.flatnonzero(np.diff(place)) + 1))
    if model is None:
        return _nothing()
    shared = Shared(docs.sparkSession, Model, *model.plain())
    seen = sample.select("toxic", "text").mapInArrow(partial(_summarised, model=shared), "toxic int, s0 double, s1 double, s2 double, s3 double")
    seen = seen.toArrow().sort_by([(c, "ascending") for c in ("toxic", "s0", "s1", "s2")])
    model.curve = _curve(np.stack([seen[f"s{i}"].to_numpy() for i in range(4)], axis=1), seen["toxic"].to_numpy() == 1, share)
    return model


def _summarised(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(model.value)
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            seen = scorer.summaries(part.column("text").to_pylist())
            columns = [part.column("toxic"), *(pa.array(seen[:, i]) for i in range(4))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "s0", "s1", "s2", "s3"])


class Scorer:
    """Summaries of texts by a model; remembers what it found out about words."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.pieces: list[str] = []
        self.runs: dict[str, float] = {}
        self.decision, self.left_sum, self.right_sum = np.empty(0), np.empty(0), np.empty(0)
        self.size = np.empty(0, np.int64)
        self.left, self.right = np.empty((GAP, 0), np.uint8), np.empty((GAP, 0), np.uint8)

    def _meet(self, words: list[str]) -> None:
        """Decisions of new words, and what joining them needs: sums over either side, letters at the joint."""
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words)), strict=True))
        pieces = [w if w.isalnum() else JOINTS.sub("", w) for w in words]
        self.pieces += pieces
        letters, lengths = encoded([f"{START}{p}{END}" for p in pieces])
        flat, starts = padded(letters, lengths)
        ends, table = starts + lengths - 1, self.model.table
        total, first, last = _sums(flat, starts, table), np.zeros(len(words)), np.zeros(len(words))
        for j, k in OFFSETS:  # the triples that have a mark
            first += DECAY ** (k + 1) * table[(flat[starts] * CLASSES + flat[starts + j]) * CLASSES + flat[starts + k]]
            last += DECAY ** (k + 1) * table[(flat[ends - k] * CLASSES + flat[ends - k + j]) * CLASSES + flat[ends]]
        decision = self.model.judged(letters, np.minimum(lengths, WINDOW), total) if (lengths <= WINDOW).all() else np.empty(len(words))
        left_sum, right_sum = total - last, total - first
        if (lengths > HALF + 2).any():
            self._meet_long(pieces, lengths, total, (letters, starts, decision, left_sum, right_sum))
        decision[lengths == 2] = LOWEST  # nothing but punctuation
        self.decision = np.append(self.decision, np.maximum(decision, LOWEST))
        self.left_sum, self.right_sum = np.append(self.left_sum, left_sum), np.append(self.right_sum, right_sum)
        self.size = np.append(self.size, lengths - 2)
        back, ahead = np.arange(-GAP, 0)[:, None], np.arange(1, GAP + 1)[:, None]
        self.left = np.concatenate([self.left, flat[ends + back].astype(np.uint8)], axis=1)
        self.right = np.concatenate([self.right, flat[starts + ahead].astype(np.uint8)], axis=1)

    def _meet_long(self, pieces: list[str], lengths: np.ndarray, total: np.ndarray, found: tuple[np.ndarray, ...]) -> None:
        """Words that are cut: into windows for their own decision, to ``HALF`` letters where they are joined."""
        letters, _, decision, left_sum, right_sum = found
        whole = lengths <= WINDOW
        if not whole.all():
            own = np.repeat(whole, lengths)
            decision[whole] = self.model.judged(letters[own], lengths[whole], total[whole])
            long = np.flatnonzero(~whole)
            decision[long] = self.model.decisions([pieces[i] for i in long.tolist()])
        cut = np.flatnonzero(lengths > HALF + 2)
        left_sum[cut] = numerators(*encoded([START + pieces[i][-HALF:] for i in cut.tolist()]), self.model.table)
        right_sum[cut] = numerators(*encoded([pieces[i][:HALF] + END for i in cut.tolist()]), self.model.table)

    def _across(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The sum over the triples across the joint of each pair of words."""
        table, out = self.model.table, np.zeros(len(a))
        letters = [*(self.left[i][a].astype(np.int32) for i in range(GAP)), *(self.right[i][b].astype(np.int32) for i in range(GAP))]
        for j, k in OFFSETS:
            part = np.zeros(len(a))
            for s in range(GAP - k, GAP):
                part += table[(letters[s] * CLASSES + letters[s + j]) * CLASSES + letters[s + k]]
            out += DECAY ** (k + 1) * part
        return out

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Decisions of joined neighbours where they are positive, else 0."""
        numerator = self.left_sum[a] + self.right_sum[b] + self._across(a, b)
        length = np.minimum(self.size[a], HALF) + np.minimum(self.size[b], HALF) + 2
        out, bias = np.zeros(len(a)), self.model.bias
        # as for words; the sums were added up in another order
        hope = np.flatnonzero(numerator > -bias * LEAST_NORM[length] - 1e-6) if bias <= 0 else np.arange(len(a))
        if len(hope):
            names = [f" {self.pieces[i][-HALF:]}{self.pieces[j][:HALF]}" for i, j in zip(a[hope].tolist(), b[hope].tolist(), strict=True)]
            out[hope] = np.maximum(0, self.model.decisions(names))
        return out

    def _short_runs(self, ids: np.ndarray, doc: np.ndarray) -> tuple[list[int], list[str]]:
        """(text, unit) of what short neighbours give beyond pairs; each text's distinct ones."""
        short = self.size[ids] <= SHORT
        begins = np.flatnonzero(short & ~np.append(False, short[:-1] & (doc[1:] == doc[:-1]))[: len(short)])
        stops = np.flatnonzero(short & ~np.append(short[1:] & (doc[1:] == doc[:-1]), False)[: len(short)]) + 1
        found: set[tuple[int, str]] = set()
        for begin, stop in zip(begins.tolist(), stops.tolist(), strict=True):
            if stop - begin > 2:
                d = int(doc[begin])
                found.update((d, u) for u in joined([self.pieces[i] for i in ids[begin:stop].tolist()]))
        return [d for d, _ in found], [u for _, u in found]

    def summaries(self, texts: list[str]) -> np.ndarray:
        """What the curve sees of each text."""
        if len(self.number) > KNOWN or len(self.runs) > KNOWN:
            self._forget()
        split = [t.lower().split() for t in texts]
        distinct = [set(words) for words in split]
        self._meet(sorted(set().union(*distinct) - self.number.keys()))
        counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        n, doc = len(texts), np.repeat(np.arange(len(split)), counts)
        ids = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(counts.sum()))
        best = np.full(n, LOWEST)
        value = self.decision[ids]
        np.maximum.at(best, doc, value)
        known, stands = max(1, len(self.number)), np.flatnonzero(value > 0)
        found = np.unique(doc[stands] * known + ids[stands])
        of, values = [found // known], [self.decision[found % known]]

        whole = self.size[ids] > 0
        ids, doc = ids[whole], doc[whole]
        beside = np.flatnonzero(doc[1:] == doc[:-1])
        a, b = ids[beside], ids[beside + 1]
        value = self.pairs(a, b)
        stands = np.flatnonzero(value > 0)
        _, first = np.unique(np.stack([doc[beside[stands]], a[stands], b[stands]]), axis=1, return_index=True)
        of.append(doc[beside[stands[first]]])
        values.append(value[stands[first]])
        runs_of, names = self._short_runs(ids, doc)
        new = sorted(set(names) - self.runs.keys())
        self.runs.update(zip(new, self.model.decisions(new).tolist(), strict=True))
        of.append(np.array(runs_of, dtype=np.int64))
        values.append(np.array([max(0.0, self.runs[u]) for u in names]))
        of, value = np.concatenate(of), np.concatenate(values)
        stands = value > 0
        np.maximum.at(best, of[stands], value[stands])
        total = np.bincount(of, weights=value, minlength=n)
        return np.stack([best, np.log1p(total), np.log1p([len(words) for words in distinct]), np.ones(n)], axis=1)


def summaries(texts: Iterable[str], model: Model, known: dict[str, Scorer]) -> np.ndarray:
    """What the curve sees of each text; ``known`` remembers the words between calls."""
    return known.setdefault("scorer", Scorer(model)).summaries(list(texts))


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model = model.value
    scorer = Scorer(model)
    for batch in batches:
        texts = batch.column("text")
        parts = [scorer.summaries(texts.slice(i, SLICE).to_pylist()) for i in range(0, batch.num_rows, SLICE)]
        scores = pa.array(model.score(np.concatenate([np.empty((0, 4)), *parts])))
        kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
        names = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*kept, scores], names=[*names, "score"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row."""
    shared = Shared(docs.sparkSession, Model, *model.plain())  # CLASSES ** 3 numbers and a few
    given = docs.select(
        F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), filled(F.col(text_col)).alias("text")
    )
    kind = given.schema["id"].dataType.simpleString()
    found = given.mapInArrow(releasing(partial(_scored, model=shared)), f"id {kind}, held_out boolean, score double")
    return found.select(
        F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the model does not reject."""
    shared = Shared(docs.sparkSession, Model, *model.plain())  # CLASSES ** 3 numbers and a few
    # a row is carried as one value, so that its columns may have any name
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    whole = docs.select(row, filled(F.col(f"`{text_col}`")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        scorer = Scorer(own)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                stays = pa.array(own.score(scorer.summaries(part.column("text").to_pylist())) < 0.5)
                yield pa.RecordBatch.from_arrays([part.column("row").filter(stays)], names=["row"])

    kept = whole.mapInArrow(releasing(run), whole.select("row").schema)
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
