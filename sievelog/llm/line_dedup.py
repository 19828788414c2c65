"""Line dedup by pairwise alignment.

Documents that overlap are found through lines that at most ``rare`` documents hold: each such line pairs its holders.
A passage of which every line is held by more documents has no such line; there, runs of those frequent lines with
``min_words`` words pair a document with the run's first holder, which is exact, however many hold it: a block of
frequent lines is the union of its shortest runs. Each pair is aligned by patience diff, and the aligned blocks of at
least ``min_words`` words go from the later document.

A line or run that a large part of all documents holds is met by broadcasting it (there are at most ``HOT`` such), so no
key's rows go to one task, and the lines of a document with many partners are dealt to several.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT, Scratch, fresh, met

def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of pairs sorted by their first number, a longest run with both numbers increasing (patience sorting)."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tops, y)
        back[i] = at[k - 1] if k else -1
        if k == len(tops):
            tops.append(y)
            at.append(i)
        else:
            tops[k], at[k] = y, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def common_runs(late: list[int], early: list[int]) -> list[tuple[int, int, int]]:
    """Runs of lines (first in late, first in early, end in late) that stand in both: for every line of ``late`` the longest
    run that ends there, unless it goes on with the next line. Every run that both hold lies within one of them.

    A suffix automaton of the earlier document is walked along the later one, so lines that repeat cost no more than others.
    """
    after: list[dict[int, int]] = [{}]
    link, length, end = [-1], [0], [-1]
    last = 0
    for j, line in enumerate(early):
        new, p = len(after), last
        after.append({})
        length.append(length[last] + 1)
        end.append(j)
        link.append(0)
        while p >= 0 and line not in after[p]:
            after[p][line] = new
            p = link[p]
        if p >= 0:
            q = after[p][line]
            if length[q] > length[p] + 1:
                clone = len(after)
                after.append(dict(after[q]))
                length.append(length[p] + 1)
                end.append(end[q])
                link.append(link[q])
                while p >= 0 and after[p].get(line) == q:
                    after[p][line] = clone
                    p = link[p]
                link[q] = q = clone
            link[new] = q
        last = new
    runs, state, n = [], 0, 0
    for i, line in enumerate(late):
        before, held = n, end[state]
        while state and line not in after[state]:
            state = link[state]
            n = length[state]
        if line in after[state]:
            state, n = after[state][line], n + 1
        if before and n != before + 1:
            runs.append((i - before, held - before + 1, i))
    if n:
        runs.append((len(late) - n, end[state] - n + 1, len(late)))
    return runs


def aligned_blocks(late: list[int], early: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """Blocks (first line, end) of the later document that the earlier one holds, by patience diff.

    Common runs of fewer than ``min_words`` words are noise. The most runs that stand in one order in both are aligned
    (patience sorting), then the most of those that are left over because they stand elsewhere, until all are.
    """
    known = set(early)
    if sum(w for line, w in zip(late, words, strict=True) if line in known) < min_words:
        return []
    out, left = [], sorted((lo, at, hi) for lo, at, hi in common_runs(late, early) if sum(words[lo:hi]) >= min_words)
    while left:
        aligned = set(longest_increasing([(lo, at) for lo, at, _ in left]))
        out += [(lo, hi) for lo, at, hi in left if (lo, at) in aligned]
        left = [x for x in left if x[:2] not in aligned]
    return out


def line_runs(words: list[int], often: list[bool], min_words: int) -> set[tuple[int, int]]:
    """Of lines that are all frequent, the shortest runs (first line, end) of ``min_words`` words or more that begin or end
    at a line, or hold a line and the next."""
    runs: set[tuple[int, int]] = set()
    n = len(words)
    runs |= {(i - 1, i + 1) for i in range(1, n) if often[i - 1] and often[i] and max(words[i - 1], words[i]) >= min_words}
    for order in (range(n), range(n - 1, -1, -1)):
        total, back = 0, []
        for i in order:
            if not often[i]:
                total, back = 0, []
                continue
            back.append(i)
            total += words[i]
            first = 0
            while total - words[back[first]] >= min_words:
                total -= words[back[first]]
                first += 1
            back = back[first:] if first else back
            if total >= min_words:
                a, b = sorted((i, back[0]))
                runs.add((a, b + 1))
    return runs


def line_blocks(docs: DataFrame, min_words: int = 20, key: str = "doc_id", text: str = "text", rare: int = 5) -> DataFrame:
    """Blocks to delete: (doc, version, blocks array<struct<first, end>>) of each document that has any.

    A document is its key with a hash of its text (version); rows that repeat both are one document. Lines are what is
    between newlines, without white space at either end; blank lines count for nothing, a block goes on behind them.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    who = F.struct(F.col("doc").isNull().alias("last"), "doc", "version")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows: list[tuple] = []
            for doc, version, body in zip(batch["doc"], batch["version"], batch["body"], strict=True):
                lines = [(i, x) for i, x in enumerate(map(str.strip, body.split("\n"))) if x]
                if lines:
                    rows.append((doc, version, [digest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for _, x in lines], [i for i, _ in lines], [len(x.split()) for _, x in lines]))
            if rows:
                yield pd.DataFrame(rows, columns=["doc", "version", "lines", "at", "words"]).astype({"doc": "Int64"})

    source = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("version"), F.col(text).alias("body"))
    one = source.filter("body IS NOT NULL").mapInPandas(split, "doc long, version long, lines array<long>, at array<int>, words array<int>")
    packed = scratch.save(one.groupBy("doc", "version").agg(*[F.any_value(c).alias(c) for c in ("lines", "at", "words")]), "packed")

    # Lines of more than one document, with the number of their holders.
    every = packed.select("doc", "version", F.posexplode("lines").alias("pos", "line"))
    counts = packed.select(F.explode(F.array_distinct("lines")).alias("line")).groupBy("line").agg(F.count("*").alias("n")).filter("n > 1")
    counts = scratch.save(counts, "counts")
    total = packed.agg(F.sum(F.size("lines"))).first()[0] or 0
    shared = scratch.save(met(every, counts, "line", total), "shared")

    # Pairs by rare lines: a line's holders are at most ``rare``.
    holders = shared.filter(F.col("n") <= rare).groupBy("line").agg(F.array_sort(F.collect_set(who)).alias("held"))
    couples = F.flatten(F.transform("held", lambda x, i: F.transform(F.slice("held", 1, i), lambda y: F.struct(x.alias("late"), y.alias("early")))))
    by_lines = holders.select(F.explode(couples).alias("x")).select("x.late", "x.early").filter("late <> early")

    # Pairs by runs of frequent lines: with the run's first holder.
    def run_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, version, lines, words, places in zip(batch["doc"], batch["version"], batch["lines"], batch["words"], batch["often"], strict=True):
                often = [False] * len(lines)
                for i in places:
                    often[i] = True
                rows += [(doc, version, xxhash.xxh3_64_intdigest(lines[a:b].tobytes()) - (1 << 63)) for a, b in line_runs(words.tolist(), often, min_words)]
            if rows:
                yield pd.DataFrame(rows, columns=["doc", "version", "run"]).astype({"doc": "Int64"})

    often = shared.filter(F.col("n") > rare).groupBy(F.col("doc").alias("d"), F.col("version").alias("v")).agg(F.collect_list("pos").alias("often"))
    of_often = packed.join(often, F.col("doc").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v"))).select("doc", "version", "lines", "words", "often")
    runs = scratch.save(of_often.mapInPandas(run_hashes, "doc long, version long, run long"), "runs")
    firsts = scratch.save(runs.groupBy("run").agg(F.count("*").alias("n"), F.min(who).alias("early"), F.max(who).alias("high")).filter("early <> high").drop("high"), "firsts")
    by_runs = met(runs.select("run", who.alias("late")), firsts, "run", runs.count()).select("late", "early").filter("late <> early")
    pairs = scratch.save(by_lines.unionByName(by_runs).distinct(), "pairs")

    # Both documents' lines beside each pair; those of an earlier document with many partners are dealt to several tasks.
    partners = pairs.groupBy("early").agg(F.count("*").alias("n"))
    most = max(1000, pairs.count() // HOT)
    dealt = scratch.save(partners.filter(F.col("n") > most).select("early", F.ceil(F.col("n") / most).cast("int").alias("parts")), "dealt")

    def side(name: str) -> DataFrame:
        return packed.select(who.alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("lines", "at", "words")])

    parts: Column = F.coalesce("parts", F.lit(1))
    salted = pairs.join(F.broadcast(dealt), "early", "left").select("late", "early", F.pmod(F.xxhash64("late"), parts).cast("int").alias("part"))
    copied = side("early").join(F.broadcast(dealt), "early", "left").select("early", "early_lines", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    ready = salted.join(copied, ["early", "part"]).join(side("late"), "late")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, version, early, lines, at, words in zip(*(batch[c] for c in ("doc", "version", "early_lines", "late_lines", "late_at", "late_words")), strict=True):
                rows += [(doc, version, int(at[a]), int(at[b - 1]) + 1) for a, b in aligned_blocks(lines.tolist(), early.tolist(), words.tolist(), min_words)]
            if rows:
                yield pd.DataFrame(rows, columns=["doc", "version", "first", "end"]).astype({"doc": "Int64"})

    aligned = ready.select("late.doc", "late.version", "early_lines", "late_lines", "late_at", "late_words").mapInPandas(align, "doc long, version long, first int, end int")
    gathered = aligned.groupBy("doc", "version").agg(F.array_sort(F.collect_set(F.struct("first", "end"))).alias("blocks"))

    def unite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for blocks in batch["blocks"]:
                whole: list[dict] = []
                for b in blocks:
                    if whole and b["first"] < whole[-1]["end"]:
                        whole[-1]["end"] = max(whole[-1]["end"], b["end"])
                    else:
                        whole.append({"first": b["first"], "end": b["end"]})
                out.append(whole)
            yield pd.DataFrame({"doc": batch["doc"].astype("Int64"), "version": batch["version"], "blocks": out})

    return scratch.save(gathered.mapInPandas(unite, "doc long, version long, blocks array<struct<first: int, end: int>>"), "blocks")


def line_dedup(docs: DataFrame, min_words: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_lines, n_removed (lines) and ``text`` without the blocks that an earlier document holds.

    Documents are ordered by key, null keys last, then by a hash of the text. A null text stays null, an empty one empty;
    rows that repeat key and text share one result, whatever their other columns hold. Equal texts under different keys
    are copies: all but the first lose every block. An empty table gives an empty table.
    """
    blocks = line_blocks(docs, min_words, key, text)
    version = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    own = fresh(docs, "__")
    named = docs.withColumns({f"{own}doc": F.col(key).cast("long"), f"{own}version": version})
    hit = blocks.withColumnsRenamed({c: f"{own}hit_{c}" for c in blocks.columns})
    # A merge join at every size: the blocks grow with the documents, so they are never sent whole to each task.
    joined = named.join(hit.hint("merge"), named[f"{own}doc"].eqNullSafe(hit[f"{own}hit_doc"]) & (named[f"{own}version"] == hit[f"{own}hit_version"]), "left")
    numbered = F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    left = F.filter(numbered, lambda s: ~F.exists(f"{own}hit_blocks", lambda b: (s["i"] >= b["first"]) & (s["i"] < b["end"])))
    kept = joined.withColumn(f"{own}left", F.when(F.col(f"{own}hit_blocks").isNotNull(), F.transform(left, lambda s: s["x"])))
    n = F.size(F.split(F.col(text), "\n", -1))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(n).cast("long")
    removed = F.when(F.col(f"{own}left").isNull(), 0).otherwise(n - F.size(f"{own}left")).cast("long")
    new_text = F.when(F.col(f"{own}left").isNull(), F.col(text)).otherwise(F.array_join(f"{own}left", "\n"))
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return kept.select(*[new_text.alias(text) if c == text else F.col(c) for c in others], n_lines.alias("n_lines"), removed.alias("n_removed"))


def drop_repeated_blocks(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """``documents`` without repeated blocks; a document of which nothing but white space is left goes, one that was
    blank before stays. n_chars is counted anew."""
    out = line_dedup(docs, min_words).filter("n_removed = 0 OR text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def digest(text: str | None) -> str:
    return hashlib.sha256((text or "").encode("utf-8", "surrogatepass")).hexdigest()
