"""Toxicity scores by a support vector machine on a subsequence string kernel.

The kernel of two words counts common subsequences of three letters within five places,
each weighted down by its gaps, so insults with inserted or left-out characters stay
close to the plain ones; ends of words count as letters. It is approximated from landmarks
(Nystroem): words that mark toxic sentences, and clean words that resemble them. A linear
support vector machine on the landmark features gives a word's margin, a sentence has
that of its most toxic word, a document that of its most toxic sentence, and a logistic
curve turns the margin into a score.

Sentences are not instances of their own: phrases toxic only by ordinary words together are missed.

Training is by witnesses, as a toxic document need only have some toxic sentence: words whose
forms (by the kernel) occur in several toxic and next to no clean documents are landmarks,
their forms in toxic documents are positives, words of clean documents negatives. The machine
is fitted several times, each time with the clean words that look most toxic so far. It runs on the
driver over at most ``max_toxic`` + ``max_clean`` labelled documents of up to ``max_chars``
characters, chosen by a hash of the id. Kernel, landmarks and machine then fold into one table of
a weight for each subsequence, of fixed size, which is broadcast; whole texts are scored in one scan.
Tokens are split at white space and, besides, at all that is no letter; runs of more than ``MAX_WORD`` letters, as in
scripts without spaces, are read by overlapping windows, of which the most toxic counts.

Defined cases: a null or empty text, or one without letters, has the margin of a text without
toxic words; a null id is scored and never trained on; rows that repeat are scored each;
labels that are null or contradict each other (for one id) are left out; without labels of both
kinds every score is 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import find_package, staged, text_or_empty, text_slices

#: a to z are 1 to 26, 0 stands for the ends of a word; other letters are their code points, whose
#: subsequences are hashed to as many places behind those of a to z.
LETTERS, DECAY = 32, 0.6
PLACES = 2 * LETTERS ** 3
#: Offsets of the second and third letter, and the weight of the gaps they leave.
OFFSETS = [(a, b, DECAY ** (b - 2)) for b in range(2, 5) for a in range(1, b)]
#: The margin of a document without words, and the least of any.
NO_WORDS = -2.0
#: Longer runs of letters are read by windows, of these lengths and steps.
MAX_WORD, WINDOWS = 40, ((40, 20), (12, 2))

_SENTENCE = re.compile(r"[.!?\n]+")
_SPELLED = re.compile(r"(?<!\S)(?:\w[\s.*_-]){2,}\w(?!\w)")
_RUN = re.compile(r"[^\W\d_]+")
_LOOKS = str.maketrans("013457@", "oieasta")
_CACHED = 300_000


def normal_words(text: str) -> list[str]:
    """Lower-case words; digits that look like letters count as such, spelled-out words are joined too.

    A token with other characters between letters stands for itself, joined, and for each of its runs of
    letters; more than ``MAX_WORD`` letters are replaced by all their windows.
    """
    low = text.lower()
    words = low.split()
    if m := _SPELLED.findall(low):
        words += ["".join(ch for ch in x if ch.isalnum()) for x in m]
    out = []
    for w in set(words):
        if w.isalpha() and len(w) <= MAX_WORD:
            out.append(w)
            continue
        runs = _RUN.findall(w.translate(_LOOKS))
        letters = "".join(runs)
        out += _windows(letters) if len(letters) > MAX_WORD else [w]
        if len(runs) > 1:
            for r in set(runs):
                if len(r) > 1:
                    out += _windows(r)
    return out


def _windows(letters: str) -> list[str]:
    """A run of letters, or overlapping windows that together hold all of it."""
    if len(letters) <= MAX_WORD:
        return [letters]
    return [letters[i:i + n] for n, step in WINDOWS for i in [*range(0, len(letters) - n, step), len(letters) - n]]


def _codes(word: str) -> list[int]:
    letters = word if word.isalpha() else "".join(ch for ch in word.translate(_LOOKS) if ch.isalpha())
    return [ord(ch) - 96 if "a" <= ch <= "z" else ord(ch) for ch in letters]


def _places(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The place of each three letters in tables of weights."""
    out = (x * LETTERS + y) * LETTERS + z
    wide = np.flatnonzero((x > 26) | (y > 26) | (z > 26))
    if len(wide):
        h = ((x[wide] * 2_097_169 + y[wide]) * 2_097_169 + z[wide]) * 0x9E3779B97F4A7C1  # wraps around
        out[wide] = LETTERS ** 3 + ((h >> 32) & (LETTERS ** 3 - 1))
    return out


def _subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code, weight, word index) of every subsequence, and the norm of each word."""
    coded = [[0, *c, 0] if (c := _codes(w)) else [] for w in words]
    length = np.array([len(c) for c in coded])
    flat = np.array([x for c in coded for x in c], np.int64)
    word = np.repeat(np.arange(len(words)), length)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(flat))  # letters from here to the word's end
    code, weight, owner = [], [], []
    for a, b, w in OFFSETS:
        at = np.flatnonzero(left > b)
        code.append(_places(flat[at], flat[at + a], flat[at + b]))
        weight.append(np.full(len(at), w))
        owner.append(word[at])
    norm2 = sum(np.maximum(length - b, 0) * w * w for _, b, w in OFFSETS)
    return np.concatenate(code), np.concatenate(weight), np.concatenate(owner), np.sqrt(np.maximum(norm2, 1e-12))


def _table_of(landmarks: list[str]) -> np.ndarray:
    """The normalised feature vectors of landmarks, as columns."""
    code, weight, word, norm = _subsequences(landmarks)
    t = np.zeros((PLACES, len(landmarks)), np.float32)
    np.add.at(t, (code, word), weight / norm[word])
    return t


def kernel(words: list[str], table: np.ndarray, step: int = 2_000) -> np.ndarray:
    """Normalised kernel of words (rows) with the landmarks of a table (columns); zero for words too short."""
    out = np.zeros((len(words), table.shape[1]), np.float32)
    for i in range(0, len(words), step):
        code, weight, word, norm = _subsequences(words[i:i + step])
        order = np.argsort(word, kind="stable")
        code, weight, word = code[order], weight[order], word[order]
        if len(word):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sums = np.add.reduceat(table[code] * weight[:, None].astype(np.float32), first, axis=0)
            out[i + word[first]] = sums / norm[word[first]][:, None]
    return out


@dataclass
class Model:
    """A weight per subsequence, the machine's bias, and the logistic curve of the margin."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, words: list[str]) -> np.ndarray:
        code, weight, word, norm = _subsequences(words)
        total = np.bincount(word, self.weights[code] * weight, len(words)) if len(words) else np.zeros(0)
        return total / norm + self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(margin) + self.shift, -30, 30)))


def _hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 500, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """A linear support vector machine by averaged subgradient steps over all rows."""
    x = x.astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    mean_w, mean_b = np.zeros_like(w), 0.0
    y, weight = y.astype(np.float32), (weight / weight.sum()).astype(np.float32)
    for t in range(1, rounds + 1):
        bad = y * (x @ w + b) < 1
        pull = (weight * y)[bad]
        rate = np.float32(20 / np.sqrt(t))
        w += rate * (pull @ x[bad] - decay * w)
        b += rate * 0.1 * pull.sum()
        if t > rounds // 2:
            mean_w += w
            mean_b += b
    return mean_w / (rounds - rounds // 2), mean_b / (rounds - rounds // 2)


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a small ridge."""
    m = np.clip(margin, -5, 5)
    x = np.c_[m, np.ones(len(m))]
    weight = 1 / len(m)
    c = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        g = x.T @ (weight * (p - (y > 0))) + 1e-3 * c
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        c -= np.linalg.solve(h, g)
    return float(c[0]), float(c[1])


def _log_ratio(n: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Log ratio of document frequencies in toxic (first row) and clean (second); what was never seen has 0."""
    return np.log((n[0] + 1) / (toxic + 2)) - np.log((n[1] + clean / toxic) / (clean + 2 * clean / toxic))


def _contrast(words: list[set[str]], toxic: list[int]) -> np.ndarray:
    """Log ratio of the share of toxic and of clean documents that hold each subsequence."""
    n = np.zeros((2, PLACES))
    for s, k in zip(words, toxic, strict=True):
        held = np.zeros(PLACES, bool)
        held[_subsequences(list(s))[0]] = True
        n[1 - k] += held
    return _log_ratio(n, sum(toxic), len(toxic) - sum(toxic))


def _means(vocabulary: list[str], weights: np.ndarray, step: int = 20_000) -> np.ndarray:
    """Each word's mean of a weight per subsequence."""
    out = np.zeros(len(vocabulary))
    for i in range(0, len(vocabulary), step):
        code, weight, word, _ = _subsequences(vocabulary[i:i + step])
        n = len(vocabulary[i:i + step])
        out[i:i + step] = np.bincount(word, weights[code] * weight, n) / np.maximum(1e-9, np.bincount(word, weight, n))
    return out


def _apart(words: list[str], most: int, alike: float = 0.7) -> list[str]:
    """The first words of a list that are less than so alike to those taken before, up to a number."""
    words = words[:6 * most]
    near = kernel(words, _table_of(words)) if words else np.zeros((0, 0))
    taken: list[int] = []
    for i in range(len(words)):
        if len(taken) < most and (not taken or near[i, taken].max() < alike):
            taken.append(i)
    return [words[i] for i in taken]


#: Words at least so alike (kernel) count as forms of one word; the loosest level at which a word tells documents apart holds.
FORMS = (0.45, 0.65, 0.95)


def _supported(pool: list[str], vocabulary: list[str], docs: list[np.ndarray], toxic: np.ndarray, least: float = 9.0) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Pool words whose forms occur in far more toxic than clean documents; for each vocabulary word whether
    it is a form of one of them, and how much it is like the most alike."""
    near = kernel(vocabulary, _table_of(pool))
    level = np.full(len(pool), np.inf)
    for least_alike in FORMS:
        form = near >= least_alike
        held = np.array([form[d].any(0) if len(d) else np.zeros(len(pool), bool) for d in docs])
        n1, n0 = held[toxic].sum(0), held[~toxic].sum(0)
        # Far more toxic than by chance (a log likelihood ratio, as many words are tried), and rare in clean ones.
        share = toxic.mean()
        n = np.maximum(n1 + n0, 1)
        proof = n1 * np.log(np.maximum(n1, 1e-9) / (n * share)) + n0 * np.log(np.maximum(n0, 1e-9) / (n * (1 - share)))
        good = (proof >= least) & (n1 / toxic.sum() >= 8 * (n0 + 0.5) / (~toxic).sum())
        level[good & np.isinf(level)] = least_alike
    good = ~np.isinf(level)
    if not good.any():
        return [], np.zeros(len(vocabulary), bool), np.zeros(len(vocabulary))
    return [w for w, g in zip(pool, good, strict=True) if g], (near >= level).any(1), near[:, good].max(1)


def train(texts: list[str], toxic: list[int], landmarks: int = 96, rounds: int = 3, hardest: int = 6_000) -> Model | None:
    """A model from labelled texts; None without texts of both kinds or without words that tell them apart."""
    y = np.array(toxic) > 0
    if not len(y) or y.all() or not y.any():
        return None
    # A sentence's words stand for it, and a document's sentences for it; so a document is the set of its words.
    words = [set().union(*(normal_words(s) for s in _SENTENCE.split(t))) for t in texts]
    df = [Counter(), Counter()]
    for s, k in zip(words, toxic, strict=True):
        df[k].update(s)
    vocabulary = sorted(w for w in df[0].keys() | df[1].keys() if len(_codes(w)) >= 2)
    place = {w: i for i, w in enumerate(vocabulary)}
    docs = [np.array(sorted(place[w] for w in s if w in place), int) for s in words]
    in_toxic, in_clean = (np.array([df[k].get(w, 0) for w in vocabulary], float) for k in (1, 0))
    exact = _log_ratio(np.array([in_toxic, in_clean]), int(y.sum()), int((~y).sum()))
    belief = _means(vocabulary, _contrast(words, toxic)) + exact
    maybe, negative = np.flatnonzero(in_clean == 0), np.flatnonzero(in_clean > 0)
    if not len(maybe) or not len(negative):
        return None
    by = lambda at, score: [vocabulary[i] for i in at[np.lexsort((at, -score[at]))]]
    # Candidates of toxic words: those that most toxic and no clean documents hold, and the most toxic-looking.
    pool = list(dict.fromkeys(_apart(by(maybe, in_toxic), landmarks // 2) + _apart(by(maybe, belief), landmarks)))
    marks, form, alike = _supported(pool, vocabulary, docs, y)
    if not marks:
        return None
    witness = np.flatnonzero((in_clean == 0) & form)
    # Landmarks: the toxic words, and clean words that resemble them most or are the most frequent.
    marks = list(dict.fromkeys(marks + _apart(by(negative, alike), landmarks) + _apart(by(negative, in_clean), landmarks // 2)))
    table = _table_of(marks)
    # Nystroem: features whose inner products give back the kernel on the landmarks.
    value, vector = np.linalg.eigh(table.T.astype(np.float64) @ table)
    keep = value > 1e-3 * value.max()
    back = vector[:, keep] / np.sqrt(value[keep])
    often = negative[np.lexsort((negative, -in_clean[negative]))][:hardest]
    looks, margin = alike, None
    for _ in range(rounds):
        hard = negative[np.lexsort((negative, -looks[negative]))][:hardest]
        some = np.unique(np.r_[hard, often])
        x = np.r_[kernel([vocabulary[i] for i in witness], table), kernel([vocabulary[i] for i in some], table)] @ back
        # Clean words weigh by how many documents hold them and by how toxic they still look.
        heavy = np.log1p(in_clean[some]) * (1 if margin is None else 1 + 20 * (margin[some] > -1))
        share = np.sqrt(in_toxic[witness])
        w, bias = _hinge(x, np.r_[np.ones(len(witness)), -np.ones(len(some))], np.r_[share / share.sum(), 2 * heavy / heavy.sum()])
        model = Model((table @ (back @ w)).astype(np.float64), float(bias), 1.0, 0.0)
        looks = margin = np.concatenate([model.margins(vocabulary[i:i + 20_000]) for i in range(0, len(vocabulary), 20_000)])
    best = np.array([max(NO_WORDS, margin[d].max()) if len(d) else NO_WORDS for d in docs])
    model.slope, model.shift = _logistic(best, np.where(y, 1, -1))
    return model


def held_out(id_col: Column) -> Column:
    """Whether a document's label is kept from training: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label_col: str = "toxic",
        max_toxic: int = 1_000, max_clean: int = 2_000, max_chars: int = 8_000) -> Model | None:
    """A model from a bounded sample of the labelled documents that are not held out."""
    known = (labels.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(id_col)
             .agg(F.min(label_col).alias("lo"), F.max(label_col).alias("hi")).where("lo = hi AND lo IN (0, 1)")
             .select(id_col, F.col("lo").cast("int").alias("_tox")))
    # Ids are chosen first, without their texts; those of the few chosen are then broadcast to the scan.
    short = docs.where(F.length(text) <= max_chars)
    able = staged(short.select(id_col).distinct().join(known, id_col), "toxic-able")
    chosen = [able.where(F.col("_tox") == kind).orderBy(F.xxhash64(id_col), id_col).limit(limit)
              for kind, limit in ((1, max_toxic), (0, max_clean))]
    chosen = staged(chosen[0].unionByName(chosen[1]), "toxic-chosen")  # at most max_toxic + max_clean rows
    rows = (short.join(F.broadcast(chosen), id_col).groupBy(id_col, "_tox").agg(F.min(text).alias("t"))
            .select("t", "_tox", id_col).collect())
    rows = sorted(rows, key=lambda r: (r[1], r[2]))
    return train([r[0] for r in rows], [r[1] for r in rows])


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted)`` of every document's whole text."""
    find_package(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        known: dict[str, float] = {}
        for b in batches:
            texts, out = b.column(1).to_pylist(), []
            for i, j in text_slices(texts, 1_000_000):
                if m is None:
                    out += [0.0] * (j - i)
                    continue
                words = [set(normal_words(t)) for t in texts[i:j]]
                if len(known) > _CACHED:
                    known = {}
                new = list(set().union(*words).difference(known))
                for k in range(0, len(new), 20_000):
                    known.update(zip(new[k:k + 20_000], m.margins(new[k:k + 20_000]).tolist(), strict=True))
                get = known.__getitem__
                out += m.score([max(NO_WORDS, max(map(get, w), default=NO_WORDS)) for w in words]).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], names=["id", "score"])

    got = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("t"))
    kind = got.schema["id"].dataType.simpleString()
    return got.mapInArrow(run, f"id {kind}, score double").select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
