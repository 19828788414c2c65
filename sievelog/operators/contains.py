"""Where the entries of a large dictionary stand in texts, without case.

Every entry is looked for by its anchor: of its grams of four characters the one that the texts hold least often. A text's
grams are hashed in one pass and tested against a bit set of the anchors before anything leaves the text. Entries whose
anchors the texts hold most often (common words) are held by every task and compared where they stand, so none of their
places travels before it is one. For the others, a window just as wide as the anchor's entries need goes on, meets the
entries in an equi-join on the anchor, and is compared with them in full: there may be many of them, and their places are few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from ..sources.scratch import saved

GRAM = 4
#: Bits of the set of anchors, of the counters of grams, and anchors that one pass over the texts looks for (16 bytes each).
SET_BITS, COUNT_BITS, ANCHORS = 22, 18, 1_000_000
BLOCK = 1 << 20
#: Entries that every task holds, and the characters that each of them has at most (4 bytes a character).
NEAR, NEAR_LENGTH = 50_000, 64


def lowered(text: str) -> str:
    """Lower case, one character for each, so that places are those of the text."""
    if text.isascii() or not ("İ" in text or "Σ" in text):
        return text.lower()
    return "İ".join(piece.lower() for piece in text.replace("Σ", "σ").split("İ"))


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every four consecutive characters."""
    codes = codes_of(text).astype(np.uint64)
    if len(codes) < GRAM:
        return np.empty(0, np.uint64)
    mixed = codes[:-3].copy()
    for i in (1, 2, 3):
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed += codes[i : len(codes) - 3 + i]
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x94D049BB133111EB)
    return mixed


def _top(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def blocks(texts: list[str]) -> Iterator[tuple[list[tuple[int, int, int]], str]]:
    """Texts joined to blocks of about a million characters; a longer one comes in pieces that overlap by a gram less one.

    Each block comes with (place in the block, number of the text, place in the text) of its pieces.
    """
    pieces, parts, size = [], [], 0
    for n, text in enumerate(texts):
        for base in range(0, max(1, len(text) - GRAM + 1), BLOCK):
            part = text[base : base + BLOCK + GRAM - 1]
            pieces.append((size, n, base))
            parts.append(part)
            size += len(part)
            if size >= BLOCK:
                yield pieces, "".join(parts)
                pieces, parts, size = [], [], 0
    if size:
        yield pieces, "".join(parts)


def gram_counts(df: DataFrame, text: str) -> np.ndarray:
    """How often grams stand in all texts, by the top bits of their hash. A task sends its counters once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for _, block in blocks([lowered(t) for t in batch["text"] if t]):
                counts += np.bincount(_top(gram_hashes(block), COUNT_BITS), minlength=1 << COUNT_BITS)
        used = np.flatnonzero(counts)
        yield pd.DataFrame({"slot": used.astype(np.int32), "n": counts[used]})

    found = df.select(F.col(text).cast("string").alias("text")).mapInPandas(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    counts[found["slot"]] = found["n"]
    return counts


def anchored(words: DataFrame, word: str, counts: np.ndarray) -> DataFrame:
    """(word, gram, off, rest, seen): each entry in lower case once, its anchor's hash, the characters before the anchor and
    those from it on, and how often the texts hold the anchor at most. Of equally rare grams the first is the anchor.
    Entries shorter than a gram are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list({lowered(w) for w in batch["word"] if w and len(w) >= GRAM})
            size = np.array([len(w) for w in found], np.int64)
            first, number = np.cumsum(size) - size, np.repeat(np.arange(len(found)), size)
            hashes = gram_hashes("".join(found))
            number, off = number[: len(hashes)], np.arange(len(hashes)) - first[number[: len(hashes)]]
            held = np.where(off <= size[number] - GRAM, counts[_top(hashes, COUNT_BITS)], np.iinfo(np.int64).max)
            least = np.minimum.reduceat(held, first) if found else held
            rare = np.flatnonzero(held == least[number])
            at = rare[np.unique(number[rare], return_index=True)[1]]
            yield pd.DataFrame({"word": found, "gram": hashes[at].astype(np.int64), "off": off[at], "rest": size - off[at], "seen": least})

    return words.select(F.col(word).cast("string").alias("word")).mapInPandas(run, "word string, gram long, off int, rest int, seen long").distinct()


class Entries:
    """Entries (word, gram, off) that a task holds, by their anchors."""

    def __init__(self, rows: pd.DataFrame):
        order = np.argsort(rows["gram"].to_numpy(np.int64).view(np.uint64), kind="stable")
        self.rows = rows.iloc[order].reset_index(drop=True)
        self.words, self.off = self.rows["word"].tolist(), self.rows["off"].to_numpy(np.int64)
        self.grams, self.low, self.many = np.unique(self.rows["gram"].to_numpy(np.int64).view(np.uint64), return_index=True, return_counts=True)
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.codes = codes_of("".join(self.words))
        self.held = np.zeros(1 << SET_BITS, bool)
        self.held[_top(self.grams, SET_BITS)] = True

    def places(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(number of the text, place in it from 0, number of the entry) of all places in texts in lower case, by block."""
        if not len(self.grams):
            return
        for pieces, block in blocks(texts):
            at, which = anchors_in(block, self.held, self.grams)
            first, number, base = np.array(pieces, np.int64).T
            piece = np.searchsorted(first, at, "right") - 1
            low, high = first[piece], np.append(first[1:], len(block))[piece]
            real = (at + GRAM <= high) & (at - low < BLOCK)  # neither across two texts nor in the next piece as well
            at, which, piece, low, high = (x[real] for x in (at, which, piece, low, high))
            many = self.many[which]
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            entry = np.repeat(self.low[which], many) + nth
            piece, low, high = (np.repeat(x, many) for x in (piece, low, high))
            start = np.repeat(at, many) - self.off[entry]
            inside = np.flatnonzero((start >= low) & (start + self.size[entry] <= high))
            found = [self._equal(codes_of(block), start, entry, inside)]
            if base.any() or len(block) > BLOCK:  # a long text's entries may go on in the next piece
                for i in np.setdiff1d(np.arange(len(entry)), inside, assume_unique=True).tolist():
                    place = int(base[piece[i]] + start[i] - low[i])
                    if place >= 0 and texts[number[piece[i]]].startswith(self.words[entry[i]], place):
                        found.append(np.array([i]))
            kept = np.concatenate(found)
            yield number[piece[kept]], base[piece[kept]] + start[kept] - low[kept], entry[kept]

    def _equal(self, codes: np.ndarray, start: np.ndarray, entry: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Of the candidates ``left``, those that agree with their entry in every character."""
        done, n = [], 0
        while len(left):
            whole = self.size[entry[left]] == n
            done.append(left[whole])
            left = left[~whole]
            left = left[codes[start[left] + n] == self.codes[self.first[entry[left]] + n]]
            n += 1
        return np.concatenate([np.empty(0, np.int64), *done])


def anchors_in(block: str, held: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the (sorted) grams in a block, and each one's number."""
    hashes = gram_hashes(block)
    at = np.flatnonzero(held[_top(hashes, SET_BITS)])
    which = np.searchsorted(grams, hashes[at])
    which[which == len(grams)] = 0
    real = grams[which] == hashes[at]
    return at[real], which[real]


def parted(entries: DataFrame) -> tuple[Entries, DataFrame]:
    """What every task holds (of the entries that aren't long, those with the most frequent anchors), and all others."""
    short = F.length("word") <= NEAR_LENGTH
    near = entries.filter(short).orderBy(F.desc("seen"), "word").limit(NEAR).toPandas()
    far = ~short
    if len(near) == NEAR:
        seen, word = (near[c].iloc[-1] for c in ("seen", "word"))
        far = far | (F.col("seen") < int(seen)) | ((F.col("seen") == int(seen)) & (F.col("word") > str(word)))
    return Entries(near), entries.filter(far)


def _lowered(column: pa.Array) -> list[str]:
    return [lowered(t or "") for t in column.to_pylist()]


def _near(source: DataFrame, entries: Entries) -> DataFrame:
    """(record_id, start, word) of the places of entries that the tasks hold."""
    sent = source.sparkSession.sparkContext.broadcast(entries)
    schema = StructType().add("record_id", source.schema["record_id"].dataType).add("start", IntegerType()).add("word", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(sent.value.words, pa.string())
        for batch in batches:
            keys, texts = batch.columns
            for number, place, entry in sent.value.places(_lowered(texts)):
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(number)), pa.array((place + 1).astype(np.int32)), words.take(pa.array(entry))], ["record_id", "start", "word"])

    return source.mapInArrow(run, schema)


def _windows(source: DataFrame, anchors: pd.DataFrame) -> DataFrame:
    """(record_id, at, lead, gram, window) of every place of an anchor (gram, off, rest: the widest of its entries)."""
    order = np.argsort(anchors["gram"].to_numpy().view(np.uint64))
    sent = source.sparkSession.sparkContext.broadcast((anchors["gram"].to_numpy().view(np.uint64)[order], anchors["off"].to_numpy()[order], anchors["rest"].to_numpy()[order]))
    schema = StructType().add("record_id", source.schema["record_id"].dataType).add("at", IntegerType()).add("lead", IntegerType()).add("gram", LongType()).add("window", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, off, rest = sent.value
        held = np.zeros(1 << SET_BITS, bool)
        held[_top(grams, SET_BITS)] = True
        for batch in batches:
            keys, texts = batch.column(0), _lowered(batch.column(1))
            for pieces, block in blocks(texts):
                at, which = anchors_in(block, held, grams)
                piece = np.searchsorted([p for p, _, _ in pieces], at, "right") - 1
                rows = []
                for a, w, p in zip(at.tolist(), which.tolist(), piece.tolist(), strict=True):
                    first, n, base = pieces[p]
                    text, place = texts[n], base + a - first
                    if place + GRAM > len(text) or a - first >= BLOCK:  # across two texts, or in the next piece as well
                        continue
                    lead = min(int(off[w]), place)
                    rows.append((n, place, lead, int(grams[w].astype(np.int64)), text[place - lead : place + int(rest[w])]))
                n, *found = zip(*rows, strict=True) if rows else [()] * 5
                types = (pa.int32(), pa.int32(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(n, pa.int64())), *(pa.array(c, t) for c, t in zip(found, types, strict=True))], ["record_id", "at", "lead", "gram", "window"])

    return source.mapInArrow(run, schema)


def _far(source: DataFrame, entries: DataFrame) -> DataFrame | None:
    """(record_id, start, word) of the places of any number of entries, or None if there are no entries."""
    anchors = entries.groupBy("gram").agg(F.max("off").alias("off"), F.max("rest").alias("rest"))
    passes = max(1, -(-anchors.count() // ANCHORS))
    found = None
    for n in range(passes):
        mine = (anchors if passes == 1 else anchors.filter(F.pmod("gram", F.lit(passes)) == n)).toPandas()
        if len(mine):
            places = _windows(source, mine)
            found = places if found is None else found.union(places)
    if found is None:
        return None
    same = (F.col("lead") >= F.col("off")) & (F.expr("substring(window, lead - off + 1, length(word))") == F.col("word"))
    hits = found.join(entries.select("word", "gram", "off"), "gram").filter(same)
    return hits.select("record_id", (F.col("at") - F.col("off") + 1).alias("start"), "word")


def _source(df: DataFrame, text: str, key: str) -> DataFrame:
    return df.select(F.col(key).alias("record_id"), F.col(text).cast("string").alias("text")).filter(F.length("text") >= GRAM)


def dictionary(df: DataFrame, text: str, words: DataFrame, word: str) -> DataFrame:
    """The entries with their anchors in the texts (see ``anchored``), written."""
    return saved(anchored(words, word, gram_counts(df, text)), "anchors")


def contains_join(df: DataFrame, text: str, words: DataFrame, word: str, key: str = "record_id") -> DataFrame:
    """(record_id, start, word) for each place of a dictionary entry in a text; start counts from 1, ``word`` is in lower case.

    Entries shorter than a gram aren't looked for. Null texts, entries and dictionaries give nothing; rows of one key give
    their places each. A dictionary of over a million anchors takes one pass over the texts for each million, as its
    anchors are broadcast.
    """
    near, others = parted(dictionary(df, text, words, word))
    return joined(df, text, key, near, others)


def joined(df: DataFrame, text: str, key: str, near: Entries, others: DataFrame) -> DataFrame:
    """``contains_join`` with the two parts of a dictionary."""
    source = _source(df, text, key)
    found, far = _near(source, near), _far(source, others)
    return found if far is None else found.union(far)


def far_places(df: DataFrame, text: str, key: str, others: DataFrame) -> DataFrame | None:
    """(record_id, start, word) of the entries that tasks don't hold, or None if there are none."""
    return _far(_source(df, text, key), others)


def entry_counts(df: DataFrame, text: str, words: DataFrame, word: str, key: str = "record_id") -> DataFrame:
    """(record_id, n_words): how many different entries the texts of a key hold, for keys whose texts hold any.

    What one text holds is counted within the text; only keys that stand in several rows are gathered entry by entry.
    """
    near, others = parted(dictionary(df, text, words, word))
    source = _source(df, text, key)
    sent = source.sparkSession.sparkContext.broadcast(near)
    schema = StructType().add("record_id", source.schema["record_id"].dataType).add("entries", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = max(1, len(sent.value.words))
            held_by = [np.unique(number * total + entry) for number, _, entry in sent.value.places(_lowered(batch.column(1)))]
            pairs = np.unique(np.concatenate([np.empty(0, np.int64), *held_by]))
            number, ends = np.unique(pairs // total, return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(ends, len(pairs)).astype(np.int32)), pa.array((pairs % total).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(number)), lists], ["record_id", "entries"])

    held = saved(source.mapInArrow(run, schema), "entries")
    rows = held.groupBy("record_id").agg(F.count("*").alias("rows"), F.max(F.size("entries")).cast("long").alias("n_words"))
    again = rows.filter("rows > 1").select(F.col("record_id").alias("again"))
    mixed = held.join(again, F.col("record_id").eqNullSafe(F.col("again")), "left_semi").select("record_id", F.explode("entries").alias("entry"))
    counts = rows.filter("rows = 1").select("record_id", "n_words").union(mixed.distinct().groupBy("record_id").agg(F.count("*").alias("n_words")))
    far = _far(source, others)
    if far is None:
        return counts
    more = far.select("record_id", "word").distinct().groupBy("record_id").agg(F.count("*").alias("n_words"))
    return counts.union(more).groupBy("record_id").agg(F.sum("n_words").alias("n_words"))
