"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the embeddings of itself and of its character n-grams (hashed to a fixed number of rows), so a
misspelling that was never seen shares most of its vectors with the word. A window of words is the mean of its words; the
linear layer gives the log odds of its two classes, and a document's log odds are the soft maximum over its windows, so
one insult isn't diluted by a long text. Embeddings and layer are trained jointly in numpy on a bounded sample of
labelled rows; scoring goes over whole texts in the tasks, where each word is a single number, as the layer is linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: Words of a window; sharpness of the soft maximum; gain between a window's mean and the layer; start of Adagrad's sums.
#: Windows are narrow, so that one insult isn't averaged away by the words beside it.
WINDOW, SHARP, GAIN, EPS = 2, 1.0, 6.0, 1e-6
MARKS = ".,;:!?\"'()[]{}<>«»¿¡…*-_"


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def features(words: list[str], rows: int, low: int = 3, high: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each word's n-grams (of UTF-8 bytes, with < and > at its ends) and of the word, and where each begins."""
    coded = [b"<" + (w.strip(MARKS) or w).encode("utf-8", "surrogatepass") + b">" for w in words]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    data = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    room = np.repeat(ends, sizes) - np.arange(len(data))  # bytes left in the word
    owner = np.repeat(np.arange(len(words)), sizes)
    mix = lambda h: ((h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(rows)
    with np.errstate(over="ignore"):
        h, out = data.copy(), []
        for n in range(2, high + 1):
            h = h[: len(data) - n + 1] * np.uint64(0x100000001B3) + data[n - 1 :] + np.uint64(n)
            if n >= low:
                ok = np.flatnonzero(room[: len(h)] >= n)
                out.append((owner[ok], mix(h[ok])))
        power = np.uint64(0x100000001B3) ** (np.repeat(sizes, sizes) - (np.arange(len(data)) - np.repeat(starts, sizes))).astype(np.uint64)
        whole = np.add.reduceat(data * power, starts) if len(words) else np.zeros(0, np.uint64)
    out.append((np.arange(len(words)), mix(whole + np.uint64(77))))
    owners, found = np.concatenate([o for o, _ in out]), np.concatenate([f for _, f in out]).astype(np.int64)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(words))
    return found[order], np.cumsum(counts) - counts


def _windows(n: int) -> np.ndarray:
    """First word of each window of a text of n words; a text without words has one empty window."""
    return np.arange(0, max(n, 1), WINDOW)


def soft_maximum(z: np.ndarray) -> float:
    top = z.max()
    return float(top + np.log(np.exp(SHARP * (z - top)).sum()) / SHARP)


class Model:
    """Embeddings (rows, size), layer (2, size) and the two classes' offsets."""

    def __init__(self, rows: int = 1 << 18, size: int = 8, seed: int = 3):
        draw = np.random.default_rng(seed)
        self.rows = rows
        self.table = draw.normal(0, 0.01, (rows, size))
        self.layer = draw.normal(0, 0.5, (2, size))
        self.offset = np.zeros(2)
        self.blank = -50.0  # log odds of a text without words

    def _features(self, words: list[str], part: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each word and their number, found for a part of the words at a time to bound memory."""
        found, count = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(words), part):
            rows, first = features(words[lo : lo + part], self.rows)
            count.append(np.diff(np.append(first, len(rows))))
            found.append(rows.astype(np.int32))
        return np.concatenate(found), np.concatenate(count)

    def fit(self, texts: list[str], labels: list[int], steps: int = 700, batch: int = 32, rate: float = 0.1, seed: int = 5) -> Model:
        """Adagrad over embeddings and layer together, for about ``steps`` batches and at least four rounds. Rows that fewer than one in
        200 documents have stay at zero: what is that rare in the sample can only be learned by heart."""
        rounds = max(4, steps * batch // max(1, len(texts)))
        number: dict[str, int] = {}
        docs = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int32) for t in texts]
        found, count = self._features(list(number))
        first = np.cumsum(count) - count
        held = np.zeros(self.rows, np.int64)
        for d in docs:
            own = np.unique(d)
            if len(own):
                spot = np.repeat(first[own] - (np.cumsum(count[own]) - count[own]), count[own]) + np.arange(count[own].sum())
                held[np.unique(found[spot])] += 1
        rare = held < max(2, len(docs) // 200)
        self.table[rare] = 0
        y = np.array(labels, float)
        seen = [np.full(self.table.shape, EPS), np.full(self.layer.shape, EPS), np.full(2, EPS)]
        draw = np.random.default_rng(seed)
        for _ in range(rounds):
            order = draw.permutation(len(docs))
            for lo in range(0, len(order), batch):
                part = order[lo : lo + batch]
                tokens = np.concatenate([docs[i] for i in part])
                if not len(tokens):
                    continue
                own, place = np.unique(tokens, return_inverse=True)
                n = count[own]
                spot = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                rows = found[spot]
                vectors = np.add.reduceat(self.table[rows], np.cumsum(n) - n, axis=0) / n[:, None]
                sizes = [len(docs[i]) for i in part]
                begin = np.concatenate([b + _windows(s) for b, s in zip(np.cumsum(sizes) - sizes, sizes, strict=True) if s])
                doc = np.concatenate([np.full(len(_windows(s)), k) for k, s in enumerate(sizes) if s])
                width = np.diff(np.append(begin, len(tokens)))
                mean = np.add.reduceat(vectors[place], begin, axis=0) / width[:, None]
                z = GAIN * (mean @ (self.layer[1] - self.layer[0])) + self.offset[1] - self.offset[0]
                top = np.full(len(part), -1e300)
                np.maximum.at(top, doc, z)
                e = np.exp(SHARP * (z - top[doc]))
                total = np.bincount(doc, e, len(part))
                live = total > 0
                odds = np.where(live, top + np.log(np.where(live, total, 1)) / SHARP, 0)
                wrong = np.where(live, 1 / (1 + np.exp(-np.clip(odds, -50, 50))) - y[part], 0) / len(part)
                g = wrong[doc] * e / total[doc]
                up = GAIN * (g @ mean)
                to_mean = GAIN * g[:, None] * (self.layer[1] - self.layer[0])
                to_token = np.repeat(to_mean / width[:, None], width, axis=0)
                to_word = np.stack([np.bincount(place, to_token[:, k], len(own)) for k in range(to_token.shape[1])], axis=1)
                to_row = np.repeat(to_word / n[:, None], n, axis=0)
                used, at = np.unique(rows, return_inverse=True)
                down = np.stack([np.bincount(at, to_row[:, k], len(used)) for k in range(to_row.shape[1])], axis=1)
                seen[0][used] += down**2
                self.table[used] -= rate * down / np.sqrt(seen[0][used])
                for name, grad, past in (("layer", np.stack([-up, up]), seen[1]), ("offset", np.array([-g.sum(), g.sum()]), seen[2])):
                    past += grad**2
                    setattr(self, name, getattr(self, name) - rate * grad / np.sqrt(past))
        self.table[rare] = 0
        return self

    def scalars(self) -> tuple[np.ndarray, float, float]:
        """The log odds that each embedding row adds to the mean, the offset, and the log odds of a text without words."""
        return GAIN * (self.table @ (self.layer[1] - self.layer[0])), float(self.offset[1] - self.offset[0]), self.blank


class Scorer:
    """Scores whole texts, keeping up to ``cache`` words' numbers."""

    def __init__(self, weights: np.ndarray, offset: float, blank: float, cache: int = 300_000):
        self.weights, self.offset, self.blank, self.cache, self.known = weights, offset, blank, cache, {}

    def score(self, texts: list[str | None]) -> list[float]:
        if len(self.known) > self.cache:
            self.known.clear()
        known = self.known
        split = [words_of(t) for t in texts]
        fresh = list(set().union(*split).difference(known)) if split else []
        for lo in range(0, len(fresh), 50_000):
            part = fresh[lo : lo + 50_000]
            found, first = features(part, len(self.weights))
            n = np.diff(np.append(first, len(found)))
            known.update(zip(part, (np.add.reduceat(self.weights[found], first) / n).tolist(), strict=True))
        out = []
        for words in split:
            if not words:
                z = np.array([self.blank])
            else:
                values = np.fromiter(map(known.__getitem__, words), float, len(words))
                begin = _windows(len(words))
                z = np.add.reduceat(values, begin) / np.diff(np.append(begin, len(words))) + self.offset
            out.append(1 / (1 + np.exp(-np.clip(soft_maximum(z), -50, 50))))
        return out


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = (3000, 2000), longest: int = 20_000, key: str = "doc_id", text: str = "text") -> Model:
    """Fit on about ``per_class`` labelled rows of class 0 and 1, chosen by hash among those that aren't held out, null in
    key or label, or longer than ``longest`` characters. These are the documented bounds: the sample's size doesn't grow
    with the corpus. Without rows of both classes the model's score is 0 throughout."""
    usable = labels.filter(F.col(key).isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(key)).select(F.col(key).alias("k"), "toxic").distinct()
    there = dict(usable.groupBy("toxic").count().collect())
    share = [min(1.0, per_class[c] / max(1, there.get(c, 0))) for c in (0, 1)]
    spot = F.pmod(F.xxhash64("k", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    chosen = usable.filter(spot < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    body = docs.select(F.col(key).alias("k"), F.col(text).alias("body")).filter(F.length("body") <= longest)
    # A key that repeats counts once, with the first of its texts, so the keys bound the rows that come to the driver.
    rows = sorted(body.join(F.broadcast(chosen), "k").groupBy("k", "toxic").agg(F.min("body").alias("body")).collect(), key=lambda r: (r.k, r.body))
    model = Model()
    if len({r.toxic for r in rows}) < 2:
        model.table[:], model.offset = 0, np.array([0.0, -50.0])
        return model
    # The sample's classes are drawn alike; a text without words has the share of toxic ones among all usable labels.
    model.blank = float(np.log(there[1] / there[0]))
    return model.fit([r.body for r in rows], [r.toxic for r in rows])


def toxicity_scores(docs: DataFrame, model: Model, keep: tuple[str, ...], text: str = "text", name: str = "score") -> DataFrame:
    """``keep`` and ``name`` (double in 0..1) for every row, from its whole text. A text without words, null and empty ones
    among them, has the share of toxic rows among the labels as its score; repeated rows are scored each; further columns are ignored; an empty table gives an empty table."""
    weights = docs.sparkSession.sparkContext.broadcast(model.scalars())

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(*weights.value)
        for texts in parts:
            yield pd.Series([s for lo in range(0, len(texts), 500) for s in scorer.score(texts.iloc[lo : lo + 500].tolist())], dtype=float)

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.select(*keep, F.pandas_udf(run, "double")(F.col(text)).alias(name))


#: A text is taken for toxic from this score on.
TOXIC = 0.3


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = TOXIC) -> DataFrame:
    """The documents that score below the threshold, each row as it is. A null or empty text has the score of a text without
    words; repeated rows stay or go together; an empty table, or labels of one class only, reject nothing."""
    name = fresh(docs, "__toxicity")
    return toxicity_scores(docs, fit_toxicity(docs, labels), tuple(docs.columns), name=name).filter(F.col(name) < threshold).select(docs.columns)
