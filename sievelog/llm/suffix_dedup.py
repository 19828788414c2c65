"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (smaller doc_id, or earlier in the same
document). Equal strings of that length have equal minima over the hashes of their ``gram``-byte grams, so that minimum
is the key of the suffix bucket that a string's first position falls into: all copies of a string meet in one bucket,
and a run of positions that share the minimum travels as one segment. Buckets are sorted one at a time:

1. Documents are packed into chunk rows (about ``chunk_bytes`` of text each, compressed) and written once.
2. Each chunk sends the different minima of its positions to their bucket; a bucket answers which of them other chunks
   have too. Positions whose minimum occurs once can't repeat and go no further.
3. For the others, each chunk sends the segments, one per content, to their bucket.
4. A bucket keeps the first of equal segments. What is left (different segments with a common minimum) is sorted as
   suffixes: first by their leading bytes, then, where those tie, by the ranks of the next sample positions. The sample
   is a difference cover modulo ``PERIOD``: for any two positions there is a shift below PERIOD at which both are in the
   sample, so ranks computed for the sample alone decide every longer tie, whatever its length.
5. The answers go back to the chunks, which cut the documents.

Memory is bounded by a chunk, or by a bucket: their number grows with the input. Copies within a chunk are sent once,
so a passage that a third of all documents hold costs a bucket one segment per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: A difference cover: every residue modulo 31 is the difference of two of these.
PERIOD, COVER = 31, (0, 1, 4, 10, 12, 17)
HEAD = 16  # bytes of the first sort
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def cover_shifts() -> np.ndarray:
    """shift[i, j]: the smallest shift below PERIOD with both i + shift and j + shift in the cover, modulo PERIOD."""
    out = np.full((PERIOD, PERIOD), -1, np.int64)
    for i in range(PERIOD):
        for j in range(PERIOD):
            out[i, j] = next(s for s in range(PERIOD) if (i + s) % PERIOD in COVER and (j + s) % PERIOD in COVER)
    return out


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each gram of a power-of-two size, by doubling."""
    h, m, size = data.astype(np.uint64) + np.uint64(1), _ODD, 1
    with np.errstate(over="ignore"):
        while size < gram:
            h = h[: len(h) - size] * m + h[size:]
            m, size = m * m * _ODD, 2 * size
            h ^= h >> np.uint64(29)
            h *= _MIX
        h ^= h >> np.uint64(32)
    return h


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    out, size = h, 1
    while 2 * size <= width:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    return np.minimum(out[: len(h) - width + 1], out[width - size : width - size + len(h) - width + 1])


def runs(text: bytes, length: int, gram: int, longest: int = 4096) -> tuple[np.ndarray, ...]:
    """Key, first position and number of positions of each run of positions with one minimum, none over ``longest``, and
    whether the minimum occurs again within the run (periodic text: the run may repeat itself)."""
    if len(text) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    width = length - gram + 1
    h = gram_hashes(np.frombuffer(text, np.uint8), gram)
    low = window_minima(h, width)
    start = np.append(0, np.flatnonzero(low[1:] != low[:-1]) + 1)
    size = np.diff(np.append(start, len(low)))
    if size.max() > longest:
        pieces = -(-size // longest)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start, size = np.repeat(start, pieces) + within * longest, np.repeat(size, pieces) - within * longest
        size = np.minimum(size, longest)
    reach = size + width - 1
    first = np.cumsum(reach) - reach
    met = h[np.arange(reach.sum()) + np.repeat(start - first, reach)] == np.repeat(low[start], reach)
    return low[start], start, size, np.add.reduceat(met, first, dtype=np.int64) > 1


def _grouped(order: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """Numbers of the groups of rows with equal columns, given an order that brings them together."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group


def classes(data: np.ndarray, at: np.ndarray, length: int, bucket: np.ndarray | None = None) -> np.ndarray:
    """A number for each position in ``at``, equal for two positions just if their next ``length`` bytes are equal.
    ``bucket``: a number that positions with equal bytes share.

    ``data`` must go on for at least ``length`` + PERIOD bytes after each position (what lies past a suffix's
    ``length`` bytes isn't looked at).
    """
    head = min(HEAD, length)
    if length <= head + PERIOD:
        return np.unique(np.lib.stride_tricks.sliding_window_view(data, length)[at], axis=0, return_inverse=True)[1].reshape(-1)
    view = np.lib.stride_tricks.sliding_window_view(data, 8)
    word = lambda p: np.ascontiguousarray(view[p]).view(">u8").reshape(-1).astype(np.uint64)
    bucket = np.zeros(len(at), np.int64) if bucket is None else bucket
    first, second = word(at), word(at + 8)
    group = _grouped(np.lexsort((second, first, bucket)), bucket, first, second)
    # The last bytes tell most of what the first don't: without them a group of common leading bytes has many classes.
    tied = np.flatnonzero(np.bincount(group)[group] > 1)
    if len(tied):
        first, second, g = word(at[tied] + length - 16), word(at[tied] + length - 8), group[tied]
        group[tied] = len(at) + _grouped(np.lexsort((second, first, g)), g, first, second)
        group = np.unique(group, return_inverse=True)[1].reshape(-1)
    tied = np.bincount(group)[group] > 1
    if not tied.any():
        return group
    # Ranks of the sample: all cover positions that a tied suffix can be compared at.
    mask = np.zeros(len(data) + PERIOD + 1, bool)
    spread = np.zeros(len(mask) + 1, np.int32)
    np.add.at(spread, at[tied], 1)
    np.add.at(spread, at[tied] + PERIOD, -1)
    mask[: len(spread) - 1] = np.cumsum(spread)[:-1] > 0
    position = np.arange(len(mask))
    sample = position[mask & np.isin(position % PERIOD, COVER)]
    rest = length - PERIOD + 1  # a sample's suffix is compared on so many bytes, enough after any shift
    padded = np.append(data, np.zeros(length + PERIOD, np.uint8))
    rank = np.zeros(len(padded), np.int64)
    rank[sample] = np.unique(np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, rest)[sample]).view(f"V{rest}").reshape(-1), return_inverse=True)[1].reshape(-1)
    shifts = cover_shifts()
    heads = np.lib.stride_tricks.sliding_window_view(padded, PERIOD - 1)
    out, todo, number = group.copy(), np.flatnonzero(tied), int(group.max()) + 1
    while len(todo):
        # The first of each group stands for it; who equals it is done, the others form new groups.
        g = group[todo]
        order = np.argsort(g, kind="stable")
        todo, g = todo[order], g[order]
        first = np.append(True, g[1:] != g[:-1])
        lead = todo[np.maximum.accumulate(np.where(first, np.arange(len(todo)), 0))]
        i, j = at[todo], at[lead]
        s = shifts[i % PERIOD, j % PERIOD]
        same = rank[i + s] == rank[j + s]
        # the bytes before the shift, and those after the compared part of the sample's suffix
        early = heads[i] == heads[j]
        same &= (early | (np.arange(PERIOD - 1) >= s[:, None])).all(axis=1)
        late = heads[i + length - PERIOD + 1] == heads[j + length - PERIOD + 1]
        same &= late.all(axis=1)
        fresh = np.unique(g)
        numbers = number + np.searchsorted(fresh, g)
        number += len(fresh)
        out[todo[same]] = numbers[same]
        todo = todo[~same]
    return out


def repeats(segments: list[bytes], order: np.ndarray, length: int, keys: np.ndarray) -> list[np.ndarray]:
    """For each of different segments, the offsets whose string of ``length`` bytes an earlier one has too.

    ``order`` ranks the segments' first bytes; positions of one segment follow each other, and segments of one document
    overlap only where they are cut from one run, at different positions.
    """
    sizes = np.array([len(s) for s in segments], np.int64)
    base = np.cumsum(sizes) - sizes
    data = np.append(np.frombuffer(b"".join(segments), np.uint8), np.zeros(length + PERIOD, np.uint8))
    count = sizes - length + 1
    owner = np.repeat(np.arange(len(segments)), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = base[owner] + offset
    number = classes(data, at, length, keys[owner])
    sort = np.lexsort((offset, order[owner], number))
    n = number[sort]
    later = np.zeros(len(at), bool)
    later[sort[1:]] = n[1:] == n[:-1]
    return np.split(offset[later], np.searchsorted(owner[later], np.arange(1, len(segments))))


def _spans(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First value and length of each run of consecutive numbers."""
    if not len(offsets):
        return offsets, offsets
    cut = np.flatnonzero(np.diff(offsets) != 1) + 1
    first = np.append(0, cut)
    return offsets[first], np.diff(np.append(first, len(offsets)))


def _pack(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def _open(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _columns(*arrays: np.ndarray) -> bytes:
    """Equally long columns of 64-bit numbers as one compressed value."""
    return _pack(np.stack([np.ascontiguousarray(a).astype(np.uint64, copy=False) for a in arrays]).tobytes() if arrays[0].size else b"")


def _read(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(_open(blob), np.uint64).reshape(n, -1) if len(blob) else np.zeros((n, 0), np.uint64)


def chunked(docs: DataFrame, key: str, text: str, chunk_bytes: int) -> DataFrame:
    """Rows (chunk, ids array<string>, sizes array<long>, body binary) of whole documents, in the order of the partitions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list = []
        texts: list[bytes] = []
        held, n, part = 0, 0, TaskContext.get().partitionId()

        def row() -> pd.DataFrame:
            return pd.DataFrame({"chunk": [(part << 32) + n], "ids": [ids], "sizes": [[len(t) for t in texts]], "body": [_pack(b"".join(texts), 3)]})

        for batch in batches:
            for i, t in zip(batch["k"].tolist(), batch["t"], strict=True):
                t = (t or "").encode("utf-8", "surrogatepass")
                if texts and held + len(t) > chunk_bytes:
                    yield row()
                    ids, texts, held, n = [], [], 0, n + 1
                ids.append(None if pd.isna(i) else i)
                texts.append(t)
                held += len(t)
        if texts:
            yield row()

    source = docs.select(F.col(key).cast("decimal(20,0)").cast("string").alias("k"), F.col(text).cast("string").alias("t"))
    return source.mapInPandas(run, "chunk long, ids array<string>, sizes array<long>, body binary")


def _texts(sizes: np.ndarray, body: bytes) -> list[bytes]:
    data, ends = _open(body) if len(body) else b"", np.cumsum(np.asarray(sizes, np.int64)).tolist()
    return [data[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)]


def _chunk_runs(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Key, document number, position, size and self-repeat of all runs of a chunk."""
    found = [runs(t, length, gram) for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(x[0]) for x in found])
    join = lambda i, kind: np.concatenate([f[i] for f in found]) if found else np.zeros(0, kind)
    return join(0, np.uint64), doc, join(1, np.int64), join(2, np.int64), join(3, bool)


def _rank_of(ids: list) -> np.ndarray:
    """Order of a chunk's documents as a sortable unsigned number: the id moved above zero, a null id last."""
    return np.array([(1 << 64) - 1 if i is None else int(i) + (1 << 63) for i in ids], np.uint64)


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = 32, key: str = "doc_id", text: str = "text", chunk_bytes: int = 8_000_000, bucket_bytes: int = 64_000_000, with_text: bool = True) -> DataFrame:
    """One row per input row: key, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and with ``with_text``
    kept binary (the bytes left) and spans array<struct<start, size>>.

    Texts are UTF-8 bytes; a null or empty text has none. Documents are ordered by key, null keys last, and rows that
    repeat a key by their place in the input as written to the scratch table: of repeated rows the first stays whole.
    An empty table gives an empty table; further columns are ignored. ``gram`` is a power of two below ``length``.
    """
    if gram & (gram - 1) or not 0 < gram < length or length <= HEAD:
        raise ValueError("gram must be a power of two below length, and length over 16")
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixes")
    chunks = scratch.save(chunked(docs, key, text, chunk_bytes), "chunks")
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // bucket_bytes + 1)

    def send_keys(batches):
        for batch in batches:
            for chunk, sizes, body in zip(batch["chunk"], batch["sizes"], batch["body"], strict=True):
                own = np.unique(_chunk_runs(_texts(sizes, body), length, gram)[0])
                home = (own % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(home, kind="stable")
                own, home = own[order], home[order]
                which, first = np.unique(home, return_index=True)
                if len(which):
                    yield pd.DataFrame({"bucket": which, "chunk": chunk, "keys": [_pack(np.sort(x).tobytes()) for x in np.split(own, first[1:])]})

    def shared_keys(group: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(_open(x), np.uint64) for x in group["keys"]]
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        often = values[counts > 1]
        out = []
        for x in parts:
            i = np.searchsorted(often, x)
            i[i == len(often)] = 0
            out.append(_pack((x[often[i] == x] if len(often) else x[:0]).tobytes()))
        return pd.DataFrame({"chunk": group["chunk"], "shared": out})

    sent = chunks.select("chunk", "sizes", "body").mapInPandas(send_keys, "bucket long, chunk long, keys binary")
    shared = sent.groupBy("bucket").applyInPandas(shared_keys, "chunk long, shared binary").groupBy("chunk").agg(F.collect_list("shared").alias("shared"))
    shared = scratch.save(shared, "shared")

    def send_segments(batches):
        for batch in batches:
            for chunk, ids, sizes, body, known in zip(batch["chunk"], batch["ids"], batch["sizes"], batch["body"], batch["shared"], strict=True):
                texts = _texts(sizes, body)
                keys, doc, start, size, periodic = _chunk_runs(texts, length, gram)
                far = np.concatenate([np.frombuffer(_open(x), np.uint64) for x in known]) if known is not None and len(known) else np.zeros(0, np.uint64)
                values, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
                pick = np.flatnonzero((np.isin(values, far) | (counts > 1))[inverse] | periodic)
                rank = _rank_of(ids)
                place = np.lexsort((start[pick], doc[pick], rank[doc[pick]]))
                pick = pick[place]
                seen: dict[bytes, int] = {}
                gone, once = [], []
                for p, d, s, z in zip(pick.tolist(), doc[pick].tolist(), start[pick].tolist(), size[pick].tolist(), strict=True):
                    content = texts[d][s : s + z + length - 1]
                    if content in seen:
                        gone.append(p)
                    else:
                        seen[content] = p
                        once.append((p, content))
                if gone:
                    gone = np.array(gone)
                    yield pd.DataFrame({"bucket": [-1], "chunk": [chunk], "meta": [_columns(doc[gone], start[gone], size[gone])], "body": [b""]})
                if not once:
                    continue
                at = np.array([p for p, _ in once])
                home = (keys[at] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(home, kind="stable")
                which, first = np.unique(home[order], return_index=True)
                out = {"bucket": which, "chunk": chunk, "meta": [], "body": []}
                for x in np.split(order, first[1:]):
                    q = at[x]
                    out["meta"].append(_columns(keys[q], rank[doc[q]], doc[q], start[q], size[q], periodic[q]))
                    out["body"].append(_pack(b"".join(once[i][1] for i in x.tolist())))
                yield pd.DataFrame(out)

    segments = scratch.save(chunks.join(shared, "chunk", "left").select("chunk", "ids", "sizes", "body", "shared").mapInPandas(send_segments, "bucket long, chunk long, meta binary, body binary"), "segments")

    def sort_bucket(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk").reset_index(drop=True)
        metas = [_read(m, 6) for m in group["meta"]]
        meta = np.concatenate(metas, axis=1)
        source = np.repeat(np.arange(len(metas)), [m.shape[1] for m in metas])
        contents: list[bytes] = []
        for m, body in zip(metas, group["body"], strict=True):
            data, ends = _open(body), np.cumsum(m[4].astype(np.int64) + length - 1).tolist()
            contents.extend(data[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False))
        keys, start, size = meta[0], meta[3].astype(np.int64), meta[4].astype(np.int64)
        place = np.lexsort((start, meta[2], source, meta[1]))  # by document, then by position
        later, first_of = np.zeros(len(contents), bool), {}
        for p in place.tolist():
            if first_of.setdefault(contents[p], p) != p:
                later[p] = True
        rows = [np.stack([source[later], meta[2][later].astype(np.int64), start[later], size[later]])]
        rank = np.empty(len(place), np.int64)
        rank[place] = np.arange(len(place))
        left = np.flatnonzero(~later)
        values, inverse, counts = np.unique(keys[left], return_inverse=True, return_counts=True)
        mixed = left[(counts > 1)[inverse] | (meta[5][left] > 0)]
        if len(mixed):
            for p, offsets in zip(mixed.tolist(), repeats([contents[p] for p in mixed.tolist()], rank[mixed], length, keys[mixed]), strict=True):
                if len(offsets):
                    a, n = _spans(offsets)
                    rows.append(np.stack([np.full(len(a), source[p]), np.full(len(a), int(meta[2][p])), start[p] + a, n]))
        found = np.concatenate(rows, axis=1)
        found = found[:, np.argsort(found[0], kind="stable")]
        which, first = np.unique(found[0], return_index=True)
        parts = np.split(found[1:], first[1:], axis=1) if len(which) else []
        return pd.DataFrame({"chunk": group["chunk"].to_numpy()[which], "gone": [_columns(*x) for x in parts]})

    sorted_out = segments.filter("bucket >= 0").groupBy("bucket").applyInPandas(sort_bucket, "chunk long, gone binary")
    answers = sorted_out.union(segments.filter("bucket < 0").select("chunk", F.col("meta").alias("gone")))
    answers = scratch.save(answers.groupBy("chunk").agg(F.collect_list("gone").alias("gone")), "answers")
    scratch.drop("segments")
    scratch.drop("shared")

    def cut(batches):
        for batch in batches:
            for ids, sizes, body, gone in zip(batch["ids"], batch["sizes"], batch["body"], batch["gone"], strict=True):
                texts = _texts(sizes, body)
                doc, start, size = np.concatenate([_read(x, 3) for x in gone], axis=1).astype(np.int64) if gone is not None and len(gone) else np.zeros((3, 0), np.int64)
                out: dict[str, list] = {c: [] for c in ("k", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans")}
                order = np.argsort(doc, kind="stable")
                first = np.searchsorted(doc[order], np.arange(len(texts) + 1))
                for d, t in enumerate(texts):
                    own = order[first[d] : first[d + 1]]
                    keep, spans = t, []
                    if len(own):
                        change = np.zeros(len(t) + 1, np.int32)
                        np.add.at(change, start[own], 1)
                        np.add.at(change, np.minimum(start[own] + size[own] + length - 1, len(t)), -1)
                        bad = np.cumsum(change)[:-1] > 0
                        keep = np.frombuffer(t, np.uint8)[~bad].tobytes()
                        a, n = _spans(np.flatnonzero(bad))
                        spans = [{"start": int(x), "size": int(y)} for x, y in zip(a, n, strict=True)]
                    out["k"].append(None if ids[d] is None else int(ids[d]))
                    out["n_bytes"].append(len(t))
                    out["n_removed"].append(len(t) - len(keep))
                    out["n_spans"].append(len(spans))
                    out["kept_sha256"].append(hashlib.sha256(keep).hexdigest())
                    out["kept"].append(keep)
                    out["spans"].append(spans)
                if not with_text:
                    del out["kept"], out["spans"]
                yield pd.DataFrame(out).astype({"k": "Int64"})

    schema = "k long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary, spans array<struct<start: long, size: long>>" if with_text else "")
    result = chunks.join(answers, "chunk", "left").select("ids", "sizes", "body", "gone").mapInPandas(cut, schema)
    return result.withColumnRenamed("k", key)
