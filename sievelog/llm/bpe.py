"""Byte-level BPE encoding and decoding with a pair occurrence index.

A task takes its texts in blocks. The different pre-tokens of a block become one symbol array with links to the next
and previous symbol. An index maps the rank of each pair to all its positions in the block; a heap holds the active
ranks. Ranks are applied in ascending order, each at all its places at once, and only the lists of the pairs that
appear beside a merge are extended. Words are independent, so the lowest active rank of the block is the lowest of
every word that has it, which is the order in which a word-by-word encoder merges.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried

#: The pre-token pattern of the vocabulary file's ByteLevel step (a fixed value of the format). White space is spelled
#: out, as the regex module counts U+001C to U+001F as white space and the ByteLevel step doesn't.
_S = r"\t-\r\x20\x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """What a byte-level BPE file holds: ids of single bytes, ranked merges, bytes of each id, added tokens."""

    def __init__(self, spec: str):
        doc = json.loads(spec)
        vocab, merges = doc["model"]["vocab"], doc["model"]["merges"]
        letters = byte_letters()
        back = {c: i for i, c in enumerate(letters)}
        self.byte_id = np.array([vocab[c] for c in letters], np.int64)
        added = {x["content"]: x["id"] for x in doc.get("added_tokens", [])}
        self.size = max([*vocab.values(), *added.values()]) + 1
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in added.items():
            self.bytes[i] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.left, self.right = left, right
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.added = added
        self.split = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.words = regex.compile(PATTERN)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        key = a * self.size + b
        i = np.searchsorted(self.keys, key)
        i[i == len(self.keys)] = 0
        return np.where(self.keys[i] == key, self.ranks[i], -1)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers, by the pair occurrence index over all of them."""
        if not words:
            return []
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        n = len(data)
        word = np.repeat(np.arange(len(words)), sizes)
        symbol = np.append(self.byte_id[data], -1)  # position n stands for "none"
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[n] = n
        after[ends[sizes > 0] - 1] = n
        before[(ends - sizes)[sizes > 0]] = n
        before[n] = n
        merged = np.full(n + 1, -1, np.int32)
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Put the pairs that begin at these positions into the index."""
            ranks = self.rank(symbol[at], symbol[after[at]])
            ok = ranks >= 0
            if not ok.any():
                return
            at, ranks = at[ok], ranks[ok]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            cuts = [0, *cuts.tolist(), len(at)]
            for r, lo, hi in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
                if r in places:
                    places[r].append(at[lo:hi])
                else:
                    places[r] = [at[lo:hi]]
                    heapq.heappush(active, r)

        start = np.flatnonzero(after[:n] < n)
        note(start)
        while active:
            r = heapq.heappop(active)
            found = places.pop(r)
            at = found[0] if len(found) == 1 else np.concatenate(found)
            a, b, made = self.left[r], self.right[r], self.made[r]
            at = at[(symbol[at] == a) & (symbol[after[at]] == b)]
            if a == b and len(at) > 1:  # of overlapping places, the first, third, ... of each run
                at = np.sort(at)
                chained = np.append(False, after[at[:-1]] == at[1:])
                index = np.arange(len(at))
                at = at[(index - np.maximum.accumulate(np.where(chained, 0, index))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            symbol[at] = made
            symbol[gone] = -2
            after[at] = beyond
            before[beyond] = at
            before[n], after[n] = n, n
            merged[at] = r
            earlier = before[at]
            around = np.concatenate([earlier[(earlier < n) & (merged[earlier] != r)], at[beyond < n]])
            if len(around):
                note(around)
        alive = np.flatnonzero(symbol[:n] >= 0)
        ids, counts = symbol[alive], np.bincount(word[alive], minlength=len(words))
        data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return [data[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)]


class Numbers(dict):
    """Numbers what it is asked for in the order in which it is first met."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Encoder:
    """Encodes texts block by block, keeping up to ``cache`` encoded pieces between blocks.

    Texts are cut at single spaces. No pre-token spans white space and what precedes it, so the pieces of a text can be
    split into pre-tokens one by one unless a cut touches other white space; such a text is split as a whole.
    """

    def __init__(self, vocabulary: Vocabulary, cache: int = 250_000):
        self.vocabulary, self.cache = vocabulary, cache
        self.clear()

    def clear(self) -> None:
        self.pieces, self.piece_ids = Numbers(), []
        self.words, self.word_ids = Numbers(), []
        self.uncut: set[int] = set()

    def parts(self, text: str) -> list:
        """Pre-tokens in order, with the id in place of an added token's string."""
        v = self.vocabulary
        if not v.split or not any(x in text for x in v.added):
            return v.words.findall(text)
        out: list = []
        for piece in v.split.split(text):
            if piece in v.added:
                out.append(v.added[piece])
            else:
                out.extend(v.words.findall(piece))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if len(self.piece_ids) > self.cache:
            self.clear()
        piece, word = self.pieces.__getitem__, self.words.__getitem__
        old, old_words = len(self.piece_ids), len(self.word_ids)
        added = any(a in t for t in texts for a in self.vocabulary.added)
        find = self.parts if added else self.vocabulary.words.findall
        cut = []
        for t in texts:
            first, *rest = t.split(" ")
            cut.append(array("i", chain((piece((first,)),), map(piece, rest))))
        flat, ends = array("i"), array("i")
        for i, x in enumerate(islice(self.pieces, old, None), old):
            body = x if isinstance(x, str) else x[0]
            if body and not body[0].isspace() and not body[-1].isspace() and not (added and any(a in body for a in self.vocabulary.added)):
                flat.extend(map(word, find(" " + body if body is x else body)))
            else:
                self.uncut.add(i)
            ends.append(len(flat))
        whole = {i: array("i", map(word, self.parts(texts[i]))) for i, numbers in enumerate(cut) if not self.uncut.isdisjoint(numbers)}
        fresh = list(islice(self.words, old_words, None))
        self.word_ids.extend(np.array(w, "<u4").tobytes() if isinstance(w, int) else b"" for w in fresh)
        plain = [i for i, w in enumerate(fresh) if isinstance(w, str)]
        for i, ids in zip(plain, self.vocabulary.encode_words([fresh[i].encode("utf-8", "surrogatepass") for i in plain]), strict=True):
            self.word_ids[old_words + i] = ids
        get_word = self.word_ids.__getitem__
        self.piece_ids.extend(b"".join(map(get_word, flat[lo:hi])) for lo, hi in zip(chain((0,), ends), ends, strict=False))
        get = self.piece_ids.__getitem__
        return [b"".join(map(get_word, whole[i])) if i in whole else b"".join(map(get, numbers)) for i, numbers in enumerate(cut)]

    def decode(self, ids: bytes) -> str:
        """Text of the ids: their bytes joined, invalid UTF-8 replaced."""
        return b"".join(map(self.vocabulary.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def read_vocabulary(spark: SparkSession, path: str) -> str:
    """The file's text, read by Spark, so that it may lie in any store; it is small (a few MB), as vocabularies are."""
    return "".join(r.value for r in spark.read.text(path if "://" in path else f"file://{path}", wholetext=True).collect())


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), block_chars: int = 4_000_000, with_ids: bool = True, with_decoded: bool = False) -> DataFrame:
    """Ids of every text, and of those ids the decoded text: keep, n_tokens long, ids_sha256, decoded_sha256, and
    token_ids array<int> if ``with_ids``, decoded string if ``with_decoded``.

    ``vocabulary`` is a byte-level BPE file's path. A text is encoded whole, with strings of added tokens as those
    tokens. A null or empty text has no tokens. Repeated rows are encoded each; further columns are ignored. A task holds
    one block of about ``block_chars`` characters (a longer text is a block of its own) and ``Encoder.cache`` pre-tokens.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_vocabulary(spark, vocabulary))
    kept = [f"keep_{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], F.col(text).cast("string").alias("body"))
    kinds = {k: source.schema[k].dataType for k in kept}
    source = source.select(*carried(source, kept), "body")
    types = ", ".join(f"{k} {source.schema[k].dataType.simpleString()}" for k in kept)
    schema = f"{types}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", token_ids array<int>" if with_ids else "") + (", decoded string" if with_decoded else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(Vocabulary(spec.value))
        for batch in batches:
            texts = [t or "" for t in batch.pop("body")]
            sizes = np.cumsum([len(t) for t in texts]) // block_chars
            cuts = [0, *(np.flatnonzero(sizes[1:] != sizes[:-1]) + 1).tolist(), len(texts)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                ids = encoder.encode(texts[lo:hi])
                decoded = [encoder.decode(x) for x in ids]
                out = batch.iloc[lo:hi].copy()
                out["n_tokens"] = [len(x) // 4 for x in ids]
                out["ids_sha256"] = [hashlib.sha256(x).hexdigest() for x in ids]
                out["decoded_sha256"] = [hashlib.sha256(x.encode("utf-8")).hexdigest() for x in decoded]
                if with_ids:
                    out["token_ids"] = [np.frombuffer(x, "<u4").astype(np.int32) for x in ids]
                if with_decoded:
                    out["decoded"] = decoded
                yield out

    out = source.mapInPandas(run, schema).withColumns({k: F.col(k).cast(kind) for k, kind in kinds.items()})
    return out.withColumnsRenamed(dict(zip(kept, keep, strict=True)))
