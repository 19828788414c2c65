"""What a task holds of a registry, as arrays: names with their tokens, and words with the places where they stand.

Both are bounded in characters, so that a worker takes some hundred MB at most; what is beyond goes by joins (``records``).
A word is looked for by its anchor (see ``contains``), then by a hash of all its characters: a place of an anchor is held
against one hash for each length and offset that the anchor's words have, however many of them there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contains import BLOCK, GRAM, SET_BITS, _top, anchors_in, blocks, codes_of

#: Characters of all words, and of all names with their tokens, that a task holds, and of one of them.
CHARACTERS, LONGEST = 24_000_000, 1_000
BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64, as many as a block and a word may need; kept for the next block."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 2 * BLOCK), base, np.uint64)
        factors[0] = 1
        known = _POWERS[base] = np.cumprod(factors)
    return known


_POWERS: dict[int, np.ndarray] = {}


def _numbers(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return column.to_numpy().astype(kind, copy=False)


def _text(column: pa.ChunkedArray) -> pa.Array:
    """One array that may hold more than 2 GB."""
    return column.cast(pa.large_string()).combine_chunks() if column.num_chunks else pa.array([], pa.large_string())


class Words:
    """Words (word, gram, off, token) in lower case, looked for in texts."""

    def __init__(self, table: pa.Table):
        words = _text(table["word"])
        self.tokens = _text(table["token"])
        self.size = pc.utf8_length(words).to_numpy().astype(np.int32)
        self.off = _numbers(table["off"], np.int32)
        gram = _numbers(table["gram"], np.int64).view(np.uint64)
        codes = codes_of("".join(words.to_pylist()))
        self.codes = codes.astype(np.uint8) if codes.max(initial=0) < 256 else codes
        self.first = np.cumsum(self.size, dtype=np.int64) - self.size
        order = np.lexsort((self.size, self.off, gram))
        sorted_by = gram[order], self.off[order].astype(np.int64), self.size[order].astype(np.int64)
        new = np.ones(len(order), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in sorted_by], axis=0)
        gram, self.group_off, self.group_size = (c[new] for c in sorted_by)
        self.grams, self.low, self.many = np.unique(gram, return_index=True, return_counts=True)
        self.bits = np.zeros(1 << SET_BITS, bool)
        self.bits[_top(self.grams, SET_BITS)] = True
        hashes = self._hashes()
        self.order = np.argsort(hashes, kind="stable").astype(np.int32)
        self.hashes = hashes[self.order]
        self.most = int(np.unique(self.hashes, return_counts=True)[1].max(initial=0))

    def _hashes(self) -> np.ndarray:
        out, left, n = np.zeros(len(self.size), np.uint64), np.arange(len(self.size)), 0
        powers = _powers(BASE, int(self.size.max(initial=0)) + 1)
        while len(left := left[self.size[left] > n]):
            out[left] += (self.codes[self.first[left] + n].astype(np.uint64) + np.uint64(1)) * powers[n]
            n += 1
        return out

    def places(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(number of the text, place in it from 0, number of the word) of all places in texts in lower case, by block."""
        if not len(self.grams):
            return
        for pieces, block in blocks(texts):
            codes = codes_of(block)
            at, which = anchors_in(block, self.bits, self.grams)
            first, number, base = np.array(pieces, np.int64).T
            piece = np.searchsorted(first, at, "right") - 1
            low, high = first[piece], np.append(first[1:], len(block))[piece]
            real = (at + GRAM <= high) & (at - low < BLOCK)  # neither across two texts nor in the next piece as well
            at, which, piece, low, high = (x[real] for x in (at, which, piece, low, high))
            many = self.many[which]
            group = np.repeat(self.low[which] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            piece, low, high = (np.repeat(x, many) for x in (piece, low, high))
            off, size = self.group_off[group], self.group_size[group]
            start = np.repeat(at, many) - off
            inside = (start >= low) & (start + size <= high)
            part, word = self._known(codes, start[inside], size[inside], off[inside])
            part = np.flatnonzero(inside)[part]
            yield number[piece[part]], base[piece[part]] + start[part] - low[part], word
            if base.any() or len(block) > BLOCK:  # a long text's words may go on in the next piece
                out = np.flatnonzero(~inside)
                place, n = base[piece[out]] + start[out] - low[out], number[piece[out]]
                end = place + size[out]
                real = np.array([0 <= p and e <= len(texts[k]) for p, e, k in zip(place.tolist(), end.tolist(), n.tolist(), strict=True)], bool)
                out, place, end, n = out[real], place[real], end[real], n[real]
                if len(out):
                    cut = [texts[k][p:e] for p, e, k in zip(place.tolist(), end.tolist(), n.tolist(), strict=True)]
                    starts = np.cumsum(size[out]) - size[out]
                    part, word = self._known(codes_of("".join(cut)), starts, size[out], off[out])
                    yield n[part], place[part], word

    def _known(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the candidate, number of the word) of candidates, characters from ``start``, that are words whose
        anchor stands at ``off``."""
        ahead = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(codes))[: len(codes)], out=ahead[1:])
        hashes = (ahead[start + size] - ahead[start]) * _powers(_UNBASE, len(codes) + 1)[start]
        near = np.searchsorted(self.hashes, hashes)
        parts, words = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for turn in range(self.most):
            mine = np.flatnonzero(near + turn < len(self.hashes))
            mine = mine[self.hashes[near[mine] + turn] == hashes[mine]]
            word = self.order[near[mine] + turn].astype(np.int64)
            same = (self.size[word] == size[mine]) & (self.off[word] == off[mine])
            mine, word = mine[same], word[same]
            equal = self._equal(codes, start[mine], word)
            parts.append(mine[equal])
            words.append(word[equal])
        return np.concatenate(parts), np.concatenate(words)

    def _equal(self, codes: np.ndarray, start: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of candidates as long as their words those that agree in every character."""
        done, left, n = [np.empty(0, np.int64)], np.arange(len(word)), 0
        while len(left):
            whole = self.size[word[left]] == n
            done.append(left[whole])
            left = left[~whole]
            left = left[codes[start[left] + n] == self.codes[self.first[word[left]] + n]]
            n += 1
        return np.concatenate(done)


def hashes_of(texts: pa.Array) -> np.ndarray:
    """A hash of each text, by all its bytes."""
    out, texts = np.zeros(len(texts), np.uint64), texts.cast(pa.large_binary())
    for at in range(0, len(texts), 100_000):
        some = pa.concat_arrays([texts.slice(at, 100_000)])
        ends = np.frombuffer(some.buffers()[1], np.int64, len(some) + 1, some.offset * 8)
        codes = np.frombuffer(some.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ahead = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(codes))[: len(codes)], out=ahead[1:])
        ends = ends - ends[0]
        out[at : at + len(some)] = (ahead[ends[1:]] - ahead[ends[:-1]]) * _powers(_UNBASE, len(codes) + 1)[ends[:-1]]
    return out


class Names:
    """Names (name, token) and their tokens."""

    def __init__(self, table: pa.Table):
        names = _text(table["name"])
        keys = hashes_of(names)
        order = np.argsort(keys, kind="stable")
        self.keys, self.names, self.tokens = keys[order], names.take(pa.array(order)), _text(table["token"]).take(pa.array(order))
        self.most = int(np.unique(self.keys, return_counts=True)[1].max(initial=0))

    def find(self, names: pa.Array) -> np.ndarray:
        """The number of each name, -1 where it isn't held."""
        names = names.cast(pa.large_string())
        keys, found = hashes_of(names), np.full(len(names), -1, np.int64)
        near = np.searchsorted(self.keys, keys)
        for turn in range(self.most):
            mine = np.flatnonzero(near + turn < len(self.keys))
            at = near[mine] + turn
            hit = self.keys[at] == keys[mine]
            mine, at = mine[hit], at[hit]
            equal = pc.equal(self.names.take(pa.array(at)), names.take(pa.array(mine))).to_numpy(zero_copy_only=False).astype(bool)
            found[mine[equal]] = at[equal]
        return found


def name_of(category: Column, norm: Column) -> Column:
    return F.concat(category, F.lit("\0"), norm)


def parted_words(entries: DataFrame) -> tuple[Words, DataFrame | None]:
    """What every task holds of the words (word, gram, off, rest, seen, token), and the others: none, if all have
    ``CHARACTERS`` in all and none is too long; else those whose anchors the texts hold least often travel."""
    size = F.length("word")
    all_of, longest = entries.agg(F.sum(size), F.max(size)).first()
    held, others = _most_seen(entries) if (all_of or 0) > CHARACTERS or (longest or 0) > LONGEST else (entries, None)
    return Words(held.select("word", "gram", "off", "token").toArrow()), others


def _most_seen(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries with the most frequent anchors, within ``CHARACTERS``, and the others: counted by anchor frequency on a scale
    of powers of two, entries of one step of the scale by a hash."""
    size = F.length("word")
    step = F.floor(F.log2(F.col("seen") + 1)).cast("int")
    steps = entries.filter(size <= LONGEST).groupBy(step.alias("step")).agg(F.sum(size).alias("n")).orderBy(F.desc("step")).collect()
    left, last, share = CHARACTERS, 99, 0.0
    for row in steps:
        last, share = row.step, min(1.0, left / row.n)
        left -= row.n
        if left <= 0:
            break
    some = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))
    near = (size <= LONGEST) & ((step > last) | ((step == last) & some))
    return entries.filter(near), entries.filter(~near)


def parted_names(registry: DataFrame) -> tuple[Names, DataFrame | None]:
    """What every task holds of the registry's names and tokens, and the entries that meet their places in a join: none, or
    those that a hash leaves over."""
    rows = registry.withColumn("name", name_of(F.col("category"), F.col("norm")))
    size = F.length("name") + F.length("sanitized")
    held, others = rows, None
    all_of, longest = rows.agg(F.sum(size), F.max(size)).first()
    if (all_of or 0) > CHARACTERS or (longest or 0) > LONGEST:
        share = min(1 << 20, int((1 << 20) * CHARACTERS / all_of))
        near = (size <= LONGEST) & (F.pmod(F.xxhash64("name"), F.lit(1 << 20)) < share)
        held, others = rows.filter(near), rows.filter(~near)
    return Names(held.select("name", F.col("sanitized").alias("token")).toArrow()), others
