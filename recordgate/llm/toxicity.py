"""Toxicity: a support vector machine on a gap-weighted subsequence kernel of sentences, with Nyström landmarks.

The kernel compares two sentences by the subsequences of four symbols that words of both hold
within a span of six, each weighted X explicit features are hashed to 2**20 numbers,
which makes every kernel value, and after training the whole decision function, a sum over one
fixed table. A sentence ends at a full stop, question or exclamation mark or line end, or after
``WIDTH`` words.

Training takes a bounded sample of labelled documents, in their true proportion, one of each group
of copies. The label of a toxic document holds for its worst sentences: each round takes those as
witnesses, the worst sentences of clean documents as counterexamples, some of both as landmarks;
their kernel matrix gives the Nyström map, on which a linear SVM learns. Four tasks train at once:
three without a third of the sample each, whose decisions on that third calibrate the score, and
one on all. A document is described by its two greatest sentence margins and the logarithm of its
number of sentences (a greatest value grows with it); a logistic curve on these gives the score.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from recordgate.llm.common import LOWER, give_back, mix, shingle_sets, small_batches, table, text_chunks, tidy, word_hashes, words

CHUNK = 1 << 20
#: Bounds of the training sample: documents, bytes of text, and bytes of one text (longer ones are scored, not learned from).
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_TEXT = 6000, 8 << 20, 256 << 10
#: Landmark sentences of toxic and of clean documents.
LANDMARKS = (192, 96)
#: Training rounds, witnesses of a toxic document, sentences of clean documents that are drawn at random.
ROUNDS, WITNESSES, RANDOM_CLEAN = 4, 3, 3000
FOLDS = 3
DECAY = 0.75
SPAN, LENGTH = 6, 4
#: Pieces of at most so many letters make one word where so many stand in a row; symbols of a word in which a filler is sought.
PIECE, PIECES, FILLED = 2, 3, 7
#: Words of a sentence; bytes of a word that count (longer words are cut into overlapping units of this size).
WIDTH, UNIT = 3, 24
#: Sentences that training multiplies at once, and entries of their words' features: a task's memory is not to grow with these products.
PART, ENTRIES = 1000, 20_000
#: Words that are hashed at once.
WORDS = 100_000
#: Weight of a feature that no document of the sample holds (a rare one weighs 1).
UNSEEN = 0.25
BITS = 20

_EDGE, _DIGIT, _FIRST_OTHER = 31, 30, 32
_GAPS = [(0, *p) for p in itertools.combinations(range(1, SPAN), LENGTH - 1)]
_WEIGHT = np.array([DECAY ** (g[-1] + 1 - LENGTH) for g in _GAPS], np.float32)
_ENDS = np.zeros(256, bool)
_ENDS[[ord("."), ord("!"), ord("?")]] = True


def symbols(buf: np.ndarray) -> np.ndarray:
    """Symbol of each byte; 0 is left out: punctuation put between letters or after a word changes nothing.

    The last byte of a letter outside ASCII names it together with the byte before, so scripts keep
    their letters apart; accented Latin capitals count as small.
    """
    table_ = np.zeros(256, np.uint8)
    table_[ord("0") : ord("9") + 1] = _DIGIT
    table_[ord("a") : ord("z") + 1] = np.arange(1, 27)
    low = LOWER[buf]
    out = table_[low]
    at = np.flatnonzero((buf & 0xC0) == 0x80)
    if len(at):
        before, here = buf[at - 1].astype(np.uint32), buf[at].astype(np.uint32)
        here = here + 32 * ((before == 0xC3) & (here < 0x9F))
        last = np.ones(len(at), bool)
        last[:-1] = at[1:] != at[:-1] + 1
        out[at] = np.where(last, _FIRST_OTHER + (before * 29 + here) % 224, 0)
    return out


def _running(marks: np.ndarray) -> np.ndarray:
    """Marks before each place, and in all: four bytes a place, for a task holds the whole sample."""
    out = np.zeros(len(marks) + 1, np.int32)
    np.cumsum(marks, out=out[1:])
    return out


def _spelled(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, where those that are spelled out in pieces on one line are one."""
    if not len(starts):
        return starts, stops, doc
    letters = _running((buf & 0xC0) != 0x80)
    piece = letters[stops] - letters[starts] <= PIECE
    lines = _running(buf == 0x0A)
    follows = np.zeros(len(starts), bool)
    follows[1:] = piece[1:] & piece[:-1] & (doc[1:] == doc[:-1]) & (lines[starts[1:]] == lines[stops[:-1]])
    first = np.flatnonzero(~follows)
    size = np.diff(np.append(first, len(starts)))
    joined = np.repeat(size >= PIECES, size)
    end = np.where(joined, np.repeat(stops[first + size - 1], size), stops)
    keep = ~follows | ~joined
    return starts[keep], end[keep], doc[keep]


def _plain(who: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of words without what draws them out: repeats of a symbol beyond the second fall with the second, and a filler at every other place falls."""
    if len(s) < 3:
        return who, s
    first = np.flatnonzero(np.append(True, (s[1:] != s[:-1]) | (who[1:] != who[:-1])))
    size = np.diff(np.append(first, len(s)))
    keep = np.repeat(size < 3, size)
    keep[first] = True
    who, s = who[keep], s[keep]
    if len(s) < FILLED:
        return who, s
    count = np.bincount(who)[who]
    three = np.flatnonzero((s[:-4] == s[2:-2]) & (s[:-4] == s[4:]) & (s[1:-3] != s[:-4]) & (s[3:-1] != s[:-4]) & (who[:-4] == who[4:]) & (count[:-4] >= FILLED))
    keep = np.ones(len(s), bool)
    keep[np.concatenate([three, three + 2, three + 4])] = False
    return who[keep], s[keep]


class Corpus:
    """Distinct words of a chunk of documents, and where they stand: sentence and document of each word."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.n_docs = len(offsets) - 1
        starts, stops, doc = _spelled(buf, *words(buf, offsets))
        # sentences
        new = np.ones(len(starts), bool)
        if len(starts):
            lines = _running(buf == 0x0A)
            new[1:] = (doc[1:] != doc[:-1]) | _ENDS[buf[stops[:-1] - 1]] | (lines[starts[1:]] != lines[stops[:-1]])
            del lines
            first = np.flatnonzero(new)
            place = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
            new |= place % WIDTH == 0
        sentence = np.cumsum(new) - 1
        self.doc_of = doc[new]
        # a long word gives overlapping units
        size = stops - starts
        count = np.maximum(1, -(-(size - 8) // (UNIT - 8)))
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        starts = np.repeat(starts, count) + step * (UNIT - 8)
        stops = np.minimum(np.repeat(stops, count), starts + UNIT)
        self.sentence = np.repeat(sentence, count)
        low = LOWER[buf]
        hashed = [word_hashes(low, starts[lo : lo + WORDS], stops[lo : lo + WORDS]) for lo in range(0, max(1, len(starts)), WORDS)]
        del low, doc, new, size, count, step
        _, one, self.word = np.unique(np.concatenate(hashed), return_index=True, return_inverse=True)
        self.word = self.word.astype(np.int32)
        del hashed
        self.flat, self.begin = _flat(symbols(buf), starts[one], stops[one])
        self.first = np.flatnonzero(np.diff(self.sentence, prepend=-1))

    def per_sentence(self, of_word: np.ndarray) -> np.ndarray:
        """Sums of a number of each distinct word."""
        return np.add.reduceat(of_word[self.word], self.first) if len(self.first) else np.zeros(0, np.float32)


def _flat(symbol: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words one after another: edge, symbols, edge, zeros as many as no span can cross; start of each."""
    size = stops - starts
    at = np.arange(size.sum()) + np.repeat(starts - (np.cumsum(size) - size), size)
    who, s = np.repeat(np.arange(len(starts)), size), symbol[at]
    who, s = _plain(who[s > 0], s[s > 0])
    count = np.bincount(who, minlength=len(starts))
    wide = count + 2 + SPAN - 1
    begin = np.cumsum(wide) - wide
    flat = np.zeros(int(wide.sum()) + SPAN, np.uint8)
    flat[begin] = _EDGE
    flat[begin + count + 1] = _EDGE
    flat[begin[who] + 1 + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)] = s
    return flat, begin


def features(flat: np.ndarray):
    """(feature number, whether there is one) of each place, for each gap pattern in turn."""
    n = len(flat) - SPAN
    wide = flat.astype(np.uint32)
    for gap in _GAPS:
        code = (wide[:n] << 24) | (wide[gap[1] : gap[1] + n] << 16) | (wide[gap[2] : gap[2] + n] << 8) | wide[gap[3] : gap[3] + n]
        code = (code ^ (code >> 15)) * np.uint32(0x2C1B3C6D)
        code = (code ^ (code >> 12)) * np.uint32(0x297A2D39)
        yield (code ^ (code >> 15)) & np.uint32((1 << BITS) - 1), (wide[:n] > 0) & (wide[gap[3] : gap[3] + n] > 0)


def word_sums(corpus: Corpus, decision: np.ndarray, commonness: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct word: the sum of ``decision`` over its features, and its squared length."""
    both = np.stack([decision, commonness**2], 1).astype(np.float32)
    if not len(corpus.begin):
        return np.zeros(0, np.float32), np.zeros(0, np.float32)
    total = np.zeros((len(corpus.flat) - SPAN, 2), np.float32)
    for (index, live), w in zip(features(corpus.flat), _WEIGHT, strict=True):
        at = np.flatnonzero(live)
        total[at] += both[index[at]] * np.array([w, w * w], np.float32)
    out = np.add.reduceat(total, corpus.begin, axis=0)
    return out[:, 0], out[:, 1]


@dataclass
class Model:
    decision: np.ndarray
    commonness: np.ndarray
    bias: float
    curve: np.ndarray | None = None

    @property
    def learned(self) -> bool:
        """Whether there were labels of both kinds to learn from."""
        return bool(self.decision.any())

    def margins(self, corpus: Corpus) -> np.ndarray:
        """Decision of each sentence."""
        value, length = word_sums(corpus, self.decision, self.commonness)
        return corpus.per_sentence(value) / np.sqrt(corpus.per_sentence(length) + 1e-3) + self.bias

    def describe(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        corpus = Corpus(buf, offsets)
        return describe(corpus.doc_of, self.margins(corpus), corpus.n_docs)

    def scores(self, described: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(described @ self.curve, -30, 30)))


def describe(doc: np.ndarray, margin: np.ndarray, n: int) -> np.ndarray:
    """Greatest and second greatest sentence margin, logarithm of the number of sentences, and 1; -2 stands for no sentence."""
    out = np.full((n, 4), -2.0)
    out[:, 2], out[:, 3] = 0, 1
    if len(doc):
        order = np.lexsort((margin, doc))
        d, m = doc[order], margin[order]
        last = np.flatnonzero(np.append(d[1:] != d[:-1], True))
        out[d[last], 0] = m[last]
        count = np.bincount(d, minlength=n)
        more = last[count[d[last]] > 1]
        out[d[more], 1] = m[more - 1]
        out[:, 2] = np.log1p(count)
    return out


# --- training -----------------------------------------------------------------------------------


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, passes: int = 12) -> np.ndarray:
    """Linear SVM (hinge loss) by dual coordinate descent; the last column of ``x`` is constant."""
    q = np.concatenate([(x[lo : lo + PART] ** 2).sum(1) for lo in range(0, len(x), PART)]) + 1e-9
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.Generator(np.random.PCG64(7))
    for _ in range(passes):
        for i in rng.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (x[i] @ w) - 1) / q[i], 0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def _document_frequencies(corpus: Corpus, y: np.ndarray) -> np.ndarray:
    """Documents of label 0 and of label 1 that hold each feature."""
    n = len(corpus.flat) - SPAN
    none = 1 << BITS
    index = np.empty((n, len(_GAPS)), np.int32)
    for k, (i, live) in enumerate(features(corpus.flat)):
        index[:, k] = np.where(live, i, none)
    size = np.diff(np.append(corpus.begin, n)) - (SPAN - 1)
    out = np.zeros((2, none + 1), np.float32)
    doc = corpus.doc_of[corpus.sentence]
    bounds = np.searchsorted(doc, np.arange(corpus.n_docs + 1))
    for d in range(corpus.n_docs):
        mine = np.unique(corpus.word[bounds[d] : bounds[d + 1]])
        at = np.arange(size[mine].sum()) + np.repeat(corpus.begin[mine] - (np.cumsum(size[mine]) - size[mine]), size[mine])
        out[y[d], np.unique(index[at])] += 1
    return out[:, :none]


class _Sentences:
    """Feature rows of chosen sentences, as (sentence, feature, weight) over their distinct words."""

    def __init__(self, corpus: Corpus, which: np.ndarray, commonness: np.ndarray, length: np.ndarray):
        self.which = which
        stop = np.append(corpus.first[1:], len(corpus.word))
        count = (stop - corpus.first)[which]
        at = np.arange(count.sum()) + np.repeat(corpus.first[which] - (np.cumsum(count) - count), count)
        self.word, self.back = np.unique(corpus.word[at], return_inverse=True)
        self.begin = np.cumsum(count) - count
        self.norm = np.sqrt(np.add.reduceat(length[corpus.word[at]], self.begin) + 1e-3)
        size = np.diff(np.append(corpus.begin, len(corpus.flat) - SPAN))[self.word]
        places = np.arange(size.sum()) + np.repeat(corpus.begin[self.word] - (np.cumsum(size) - size), size)
        flat = np.append(corpus.flat[places], np.zeros(SPAN, np.uint8))
        of = np.repeat(np.arange(len(self.word)), size)
        who, index, weight = [], [], []
        for (i, live), w in zip(features(flat), _WEIGHT, strict=True):
            who.append(of[live])
            index.append(i[live])
            weight.append(w * commonness[i[live]])
        who, self.index, self.weight = (np.concatenate(x) for x in (who, index, weight))
        order = np.argsort(who, kind="stable")
        self.index, self.weight = self.index[order], self.weight[order]
        self.first = np.searchsorted(who[order], np.arange(len(self.word) + 1))

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """(features that occur, dense rows of the sentences over them), for few sentences."""
        occurs, number = np.unique(self.index, return_inverse=True)
        out = np.zeros((len(self.which), len(occurs)), np.float32)
        count = np.diff(np.append(self.begin, len(self.back)))
        for s in range(len(self.which)):
            for w in self.back[self.begin[s] : self.begin[s] + count[s]]:
                lo, hi = self.first[w], self.first[w + 1]
                np.add.at(out[s], number[lo:hi], self.weight[lo:hi] / self.norm[s])
        return occurs, out

    def kernel(self, occurs: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Kernel of each sentence with each of the ``rows``."""
        place = np.minimum(np.searchsorted(occurs, self.index), len(occurs) - 1)
        known = np.flatnonzero(occurs[place] == self.index)
        place, weight = place[known], self.weight[known]
        first = np.searchsorted(known, self.first)
        across = np.ascontiguousarray(rows.T)
        of_word = np.zeros((len(self.word), len(rows)), np.float32)
        step, lo = 500, 0
        while lo < len(self.word):
            hi = max(lo + 1, int(np.searchsorted(first, first[lo] + ENTRIES, "right")) - 1)
            a, b = first[lo], first[hi]
            if a < b:
                part = across[place[a:b]]
                part *= weight[a:b, None]
                size = np.diff(first[lo : hi + 1])
                held = np.flatnonzero(size)
                of_word[lo + held] = np.add.reduceat(part, (first[lo:hi] - a)[held], axis=0)
            lo = hi
        out = np.empty((len(self.which), len(rows)), np.float32)
        stop = np.append(self.begin[1:], len(self.back))
        for lo in range(0, len(self.which), step):
            hi = min(lo + step, len(self.which))
            a = self.begin[lo]
            out[lo:hi] = np.add.reduceat(of_word[self.back[a : stop[hi - 1]]], self.begin[lo:hi] - a, axis=0)
        return out / self.norm[:, None]


def _greatest(doc: np.ndarray, margin: np.ndarray, chosen: np.ndarray, each: int) -> np.ndarray:
    """The ``each`` sentences of greatest margin of each document whose mark in ``chosen`` is set, greatest first."""
    order = np.lexsort((-margin, doc))
    order = order[chosen[doc[order]]]
    d = doc[order]
    first = np.flatnonzero(np.append(True, d[1:] != d[:-1])) if len(d) else np.zeros(0, np.int64)
    rank = np.arange(len(d)) - np.repeat(first, np.diff(np.append(first, len(d))))
    return order[rank < each]


def _join(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def learn(texts: list[str], labels: list[int]) -> Model:
    """The decision function (no curve yet) from documents in memory, the bounded sample."""
    y = np.array(labels, np.int64)
    corpus = Corpus(*_join(texts))
    give_back()
    nothing = Model(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), -1.0)
    if not len(corpus.begin) or len(np.unique(y)) < 2:
        return nothing
    held = _document_frequencies(corpus, y)
    n = len(y)
    often = held.sum(0)
    commonness = np.where(often > 0, np.log((n + 1) / (often + 1)) / np.log(n + 1), UNSEEN).astype(np.float32)
    toxic, clean = y == 1, y == 0
    odds = np.log((held[1] + 0.5) / (toxic.sum() + 1)) - np.log((held[0] + 0.5) / (clean.sum() + 1))
    # a first guess: log odds of what at least two toxic documents hold
    guess = np.where(held[1] >= 2, np.maximum(odds, 0), 0).astype(np.float32)
    model = Model(guess * commonness, commonness, 0.0)
    length = word_sums(corpus, model.decision, commonness)[1]
    rng = np.random.Generator(np.random.PCG64(11))
    doc = corpus.doc_of
    negative = rng.permutation(np.flatnonzero(clean[doc]))[:RANDOM_CLEAN]
    for turn in range(ROUNDS):
        margin = model.margins(corpus)
        worst = _greatest(doc, margin, toxic, WITNESSES)
        lead = np.append(True, doc[worst[1:]] != doc[worst[:-1]]) if len(worst) else np.zeros(0, bool)
        positive = worst[lead | ((margin[worst] > 0) & (turn > 0))]
        hard = _greatest(doc, margin, clean, 1)
        negative = np.union1d(negative, hard)
        if not len(positive) or not len(negative):
            return nothing
        marks = np.concatenate([rng.permutation(positive)[: LANDMARKS[0]], rng.permutation(hard)[: LANDMARKS[1]]])
        occurs, rows = _Sentences(corpus, marks, commonness, length).rows()
        values, vectors = np.linalg.eigh((rows @ rows.T).astype(np.float64))
        good = values > 1e-4
        half = vectors[:, good] / np.sqrt(values[good])  # Nyström: k(x, L) K_LL^(-1/2)
        which = np.concatenate([positive, negative])
        kernel = _Sentences(corpus, which, commonness, length).kernel(occurs, rows)
        x = np.full((len(which), half.shape[1] + 1), 0.5)
        for lo in range(0, len(which), PART):
            x[lo : lo + PART, :-1] = kernel[lo : lo + PART] @ half
        del kernel
        sign = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        w = _svm(x, sign, np.where(sign > 0, 4.0, 1.0))
        del x
        decision = np.zeros(1 << BITS, np.float32)
        decision[occurs] = (half @ w[:-1]).astype(np.float32) @ rows
        model = Model(decision * commonness, commonness, float(0.5 * w[-1]))
    return model


def calibrate(described: np.ndarray, y: np.ndarray, lift: float = 0.5) -> np.ndarray:
    """Logistic curve of described documents.

    The rarer label weighs more, by the power ``lift`` of how much rarer it is: at 0 a score of 0.5
    means evens at the sample's share of toxic documents, at 1 evens at equal shares.
    """
    if len(np.unique(y)) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return np.array([0, 0, 0, np.log((share + 1e-3) / (1 - share + 1e-3))])
    share = y.mean()
    return _logistic(described, y, np.where(y == 1, max(1.0, (1 - share) / share), max(1.0, share / (1 - share))) ** lift)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps on the weighted logistic loss with a little shrinkage."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p) + 1e-6)[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (p - y)) + 0.1 * w)
        w -= step
        if abs(step).max() < 1e-8:
            break
    return w


def without_copies(texts: list[str]) -> np.ndarray:
    """Indices of one document of each group whose four least shingle hashes agree: exact copies and most near ones."""
    seen: dict[bytes, int] = {}
    lo, stop = 0, np.cumsum([0, *map(len, texts)])
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(stop, stop[lo] + CHUNK, "right")) - 1)
        owner, value = shingle_sets(*_join(texts[lo:hi]))
        value = mix(value)
        order = np.lexsort((value, owner))
        value = value[order]
        first = np.searchsorted(owner[order], np.arange(hi - lo + 1))
        for i in range(hi - lo):
            seen.setdefault(value[first[i] : min(first[i] + 4, first[i + 1])].tobytes(), lo + i)
        lo = hi
    return np.array(sorted(seen.values()), np.int64)


def train(texts: list[str], labels: list[int]) -> Model:
    """Fit on documents in memory: as ``fit`` does in tasks."""
    y, fold = np.array(labels, np.int64), np.arange(len(labels)) % FOLDS
    described = np.zeros((len(y), 4))
    for k in range(FOLDS):
        rest, mine = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        described[mine] = learn([texts[i] for i in rest], y[rest].tolist()).describe(*_join([texts[i] for i in mine]))
    model = learn(texts, labels)
    model.curve = calibrate(described, y)
    return model


LEARNED = "toxic int, described array<double>, decision binary, common binary, bias double"


def _learn_fold(t: pa.Table) -> pa.Table:
    """Part ``FOLDS``: the model of the whole sample. Other parts: descriptions of the part by a model of the rest."""
    part, order = t.column("part")[0].as_py(), np.argsort(t.column("place").to_numpy())
    texts, y = t.column("text").take(order).to_pylist(), t.column("toxic").to_numpy()[order].astype(np.int64)
    fold = np.abs(t.column("place").to_numpy()[order]) % FOLDS
    one = without_copies(texts)
    give_back()
    rest = one[fold[one] != part]
    model = learn([texts[i] for i in rest], y[rest].tolist())
    kinds = [pa.int32(), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.float64()]
    names = ["toxic", "described", "decision", "common", "bias"]
    if part == FOLDS:
        data = [[None], [None], [model.decision.astype(np.float32).tobytes()], [model.commonness.astype(np.float32).tobytes()], [model.bias]]
    else:
        mine = one[fold[one] == part]
        described = model.describe(*_join([texts[i] for i in mine])) if len(mine) else np.zeros((0, 4))
        none = [None] * len(mine)
        data = [y[mine].tolist(), described.tolist(), none, none, none]
    give_back()
    return pa.table([pa.array(x, k) for x, k in zip(data, kinds, strict=True)], names)


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, n_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """place, toxic, text: distinct texts of labelled documents, as many as the bounds allow, chosen by a hash of the text.

    Held-out rows take no part. Both labels keep their proportion. A text with both labels has the
    more frequent one (toxic in a tie).
    """
    marked = labels.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id"))).select("doc_id", "toxic").distinct()
    known = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).filter(F.col("doc_id").isNotNull() & (F.octet_length("text") <= SAMPLE_TEXT))
    short = known.select("doc_id", F.octet_length("text").alias("n"), F.xxhash64("text").alias("place"))
    each = short.join(marked, "doc_id").groupBy("place").agg(F.first("n").alias("n"), F.avg("toxic").alias("share"))
    n, size = each.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    share = min(1.0, rows / max(n, 1), n_bytes / max(size, 1))
    # unbiased: another hash than the one that names the text, so folds and choice are independent
    chosen = each.filter(F.pmod(F.xxhash64("place", F.lit(17)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))).select("place", (F.col("share") >= 0.5).cast("int").alias("toxic"))
    texts = known.withColumn("place", F.xxhash64("text"))
    # twice the bound at most, whatever the hash does
    return texts.join(F.broadcast(chosen.limit(2 * rows)), "place").groupBy("place").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, n_bytes: int = SAMPLE_BYTES) -> Model:
    """Train on at most about ``rows`` labelled documents of ``n_bytes`` in all, never on held-out ones.

    Without labelled documents, or with one label only, every document gets the share of toxic ones
    as its score. Repeated rows and copies count once. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    sample = training_sample(docs, labels, rows, n_bytes)
    parts = sample.withColumn("part", F.explode(F.array(*[F.lit(k) for k in range(FOLDS + 1)])))
    model, described, y = Model(np.zeros(1 << BITS, np.float32), np.ones(1 << BITS, np.float32), -1.0), [], []
    for r in parts.groupBy("part").applyInArrow(_learn_fold, LEARNED).collect():
        if r["decision"] is None:
            described.append(r["described"])
            y.append(r["toxic"])
        else:
            model = Model(np.frombuffer(r["decision"], np.float32), np.frombuffer(r["common"], np.float32), r["bias"])
    model.curve = calibrate(np.array(described, float).reshape(-1, 4), np.array(y, np.int64))
    return model


def _score(shared):
    def run(batches):
        model = Model(*shared.value)
        for b in batches:
            text, scores = b.select([b.num_columns - 1]).rename_columns(["text"]), []
            text = text.append_column("row", pa.nulls(b.num_rows, pa.int64()).fill_null(0))
            for _, buf, offsets in text_chunks([text], "row", "text", CHUNK):
                scores.append(model.scores(model.describe(buf, offsets)))
            last = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], last], names=[*b.schema.names[:-1], "_score"])

    return run


def with_score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``score_col`` (which must not be among them), one row per row; only the text enters the score.

    Null text: empty; a text without words has the score of no sentence. Repeated rows are scored
    alike. An empty table gives an empty result.
    """
    if score_col.lower() in [c.lower() for c in docs.columns]:
        raise ValueError(f"{score_col} is a column already")
    shared = docs.sparkSession.sparkContext.broadcast((model.decision, model.commonness, model.bias, model.curve))
    names = [f"c{i}" for i in range(len(docs.columns))]
    source = docs.toDF(*names).withColumn("_text", F.col(names[docs.columns.index(text_col)]).cast("string"))
    schema = StructType([*source.schema.fields[:-1], StructField("_score", DoubleType())])
    return source.mapInArrow(tidy(_score(shared)), schema).toDF(*docs.columns, score_col)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, one row per row of ``docs``. A null id stays null; other columns are not read."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_score(source, model).select("doc_id", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
