"""Byte-level BPE encoding as a monoid: the encodings of two neighbours are joined at their border.

A sequence of tokens is the encoding of its bytes just when each two neighbouring tokens are the encoding of theirs: merges
on both sides of a border that none crosses run as they would alone, and the first merge that crosses one crosses it in
the encoding of the two tokens beside it as well. So where a window over the border is encoded anew and its first and last
tokens come out as they were, all tokens outside stay as they are. A word's halves are encoded recursively and joined by
such windows, which grow until that holds. Decoding concatenates the tokens' bytes pairwise up a tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain
from operator import add

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PATTERN, read_vocabulary
from .common import carried

RESULTS = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "token_ids": "array<int>", "decoded": "binary"}


#: Bytes of a leaf.
LEAF = 4
#: A blank beside other white space, or at either end.
LOOSE = re.compile(r" \s|\s |^ | $")


class RankTree:
    """A file of ranked byte strings; encodes words by joining encodings of their halves."""

    def __init__(self, spec: str, pattern: str = PATTERN, memo: int = 400_000):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in spec.splitlines() if line.strip())}
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        self.pattern, self.memo, self.none = regex.compile(pattern), memo, len(self.bytes)
        self.names = list(map(str, range(len(self.bytes))))
        self.words: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.windows: dict[bytes, tuple[bytes, ...]] = {}
        self.trees: dict[bytes, tuple[bytes, ...]] = {}

    def window(self, data: bytes) -> tuple[bytes, ...]:
        """Tokens of a window: the lowest rank is merged, of equal ones the leftmost, until none is left."""
        found = self.windows.get(data)
        if found is not None:
            return found
        tokens = self.merged(data) if len(data) <= 24 else self.merged_by_heap(data)
        return self.kept(self.windows, data, tokens)

    def merged(self, data: bytes) -> tuple[bytes, ...]:
        """A short window's tokens: the ranks of its pairs stand in a list that is searched for each merge."""
        known, none = self.ranks.get, self.none
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [known(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = known(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = known(parts[i - 1] + parts[i], none)
        return tuple(parts)

    def merged_by_heap(self, data: bytes) -> tuple[bytes, ...]:
        """A long window's tokens: its pairs stand in a heap."""
        ranks, n = self.ranks, len(data)
        end, before = list(range(1, n + 1)), list(range(-1, n))  # the symbol that begins at i ends at end[i]; 0: gone
        heap = [(ranks[data[i : i + 2]], i, i + 1, i + 2) for i in range(n - 1) if data[i : i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            if end[i] != middle or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                rank = ranks.get(data[i : end[stop]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, stop, end[stop]))
            if i > 0:
                first = before[i]
                rank = ranks.get(data[first:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, first, i, stop))
        out, i = [], 0
        while i < n:
            out.append(data[i : end[i]])
            i = end[i]
        return tuple(out)

    def kept(self, table: dict, data: bytes, tokens: tuple[bytes, ...]) -> tuple[bytes, ...]:
        """Remember the tokens of short data."""
        if len(data) <= 32:
            if len(table) >= self.memo:
                table.clear()
            table[data] = tokens
        return tokens

    def join(self, left: tuple[bytes, ...], right: tuple[bytes, ...]) -> tuple[bytes, ...]:
        """Tokens of both sides' bytes together; a side whose outermost token in the window changes grows."""
        a = b = 1
        while True:
            head, tail = left[-a:], right[:b]
            middle = self.window(b"".join(head + tail))
            left_holds, right_holds = a >= len(left) or middle[0] == head[0], b >= len(right) or middle[-1] == tail[-1]
            if left_holds and right_holds:
                return left[: len(left) - len(head)] + middle + right[len(tail) :]
            a, b = a if left_holds else 2 * a, b if right_holds else 2 * b

    def tree(self, data: bytes) -> tuple[bytes, ...]:
        """Tokens of a word's bytes: its halves', joined. Up to four bytes are a leaf."""
        if len(data) <= LEAF:
            return self.window(data)
        found = self.trees.get(data)
        if found is None:
            half = len(data) // 2
            found = self.kept(self.trees, data, self.join(self.tree(data[:half]), self.tree(data[half:])))
        return found

    def whole(self, word: str) -> tuple[int, ...]:
        """Ids of a pre-token. One that is a token as a whole is that token, whether or not merges lead to it."""
        data = word.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(data)
        return (rank,) if rank is not None else tuple(map(self.ranks.__getitem__, self.tree(data)))

    def word(self, word: str) -> tuple[int, ...]:
        ids = self.pieces.get(word[1:]) if word[0] == " " else None
        return self.noted(self.words, word, ids or self.whole(word))

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of what stands between two blanks, with the blank before it. Letters alone are one pre-token."""
        return self.noted(self.pieces, piece, self.whole(" " + piece) if piece.isalpha() else self.found(" " + piece))

    def noted(self, table: dict[str, tuple[int, ...]], key: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        """Remember ids; a full table is begun anew."""
        if len(table) >= self.memo:
            table.clear()
        table[key] = ids
        return ids

    def found(self, text: str) -> tuple[int, ...]:
        known = self.words.get
        return tuple(chain.from_iterable([known(w) or self.word(w) for w in self.pattern.findall(text)]))

    def encode(self, text: str) -> list[int]:
        """Ids of a text, pre-token by pre-token. Where every blank stands alone, each begins a pre-token, so the pieces
        between them can be encoded one by one."""
        if LOOSE.search(text):
            return list(self.found(text))
        known = self.pieces.get
        first, *rest = text.split(" ")
        return [*self.found(first), *chain.from_iterable([known(p) or self.piece(p) for p in rest])]

    def decode(self, ids: list[int]) -> bytes:
        """The tokens' bytes, concatenated pairwise up a tree."""
        level = list(map(self.bytes.__getitem__, ids))
        while len(level) > 1:
            above = list(map(add, level[::2], level[1::2]))
            level = above if len(level) % 2 == 0 else [*above, level[-1]]
        return level[0] if level else b""


def tree_encode(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), block_chars: int = 4_000_000, with_ids: bool = True, with_decoded: bool = False) -> DataFrame:
    """Ids of every text and the bytes that they decode to: keep, n_tokens long, ids_sha256 (of the decimal ids joined by
    commas), decoded_sha256 (of the decoded bytes), and token_ids array<int> if ``with_ids``, decoded binary if
    ``with_decoded``.

    ``vocabulary`` is the path of a file of base64 tokens with their ranks. Texts are encoded whole, without special tokens:
    strings that look like them are ordinary text. A null or empty text has no tokens (n_tokens 0, digests of nothing).
    Repeated rows are encoded each, an empty table gives an empty one, further columns are ignored; a kept column that is
    named like a result is refused. A task holds a block of about ``block_chars`` characters (a longer text is a block of
    its own) and bounded tables of words, windows and subtrees.
    """
    clash = sorted({c.lower() for c in keep} & set(RESULTS))
    if clash:
        raise ValueError(f"kept columns are named like results: {clash}")
    spec = docs.sparkSession.sparkContext.broadcast(read_vocabulary(docs.sparkSession, vocabulary))
    kept = [f"keep_{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], F.col(text).cast("string").alias("body"))
    kinds = {k: source.schema[k].dataType for k in kept}
    source = source.select(*carried(source, kept), "body")
    types = "".join(f"{k} {source.schema[k].dataType.simpleString()}, " for k in kept)
    names = [*list(RESULTS)[:3], *(["token_ids"] if with_ids else []), *(["decoded"] if with_decoded else [])]
    schema = types + ", ".join(f"{n} {RESULTS[n]}" for n in names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks = RankTree(spec.value)

        def described(text: str) -> tuple:
            ids = ranks.encode(text)
            decoded = ranks.decode(ids)
            found = (len(ids), hashlib.sha256(",".join(map(ranks.names.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest())
            return found + ((np.array(ids, np.int32),) if with_ids else ()) + ((decoded,) if with_decoded else ())

        for batch in batches:
            texts = [t or "" for t in batch.pop("body")]
            sizes = np.cumsum([len(t) for t in texts]) // block_chars
            cuts = [0, *(np.flatnonzero(sizes[1:] != sizes[:-1]) + 1).tolist(), len(texts)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                out, rows = batch.iloc[lo:hi].copy(), [described(t) for t in texts[lo:hi]]
                for name, column in zip(names, zip(*rows, strict=True), strict=True):
                    out[name] = column
                yield out

    out = source.mapInPandas(run, schema).withColumns({k: F.col(k).cast(kind) for k, kind in kinds.items()})
    return out.withColumnsRenamed(dict(zip(kept, keep, strict=True)))
