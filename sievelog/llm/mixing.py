"""Mixing of sources to target weights by a multivariate-hypergeometric splitting tree; DataFrame functions only.

Each source's words form a stream: its documents in the order of a keyed hash, found by counting over two levels of
hash ranges and within the smallest range, so no source is sorted in one task. The stream is cut into blocks of words. A
source's quota is the exact number of blocks that its target needs (the last one in part); more than one pass over a
source draws its blocks again. A binary tree over the output shards splits the quotas: at each node the numbers of
blocks that go left follow the multivariate hypergeometric law given the left half's capacity, source by source, so the
leaves hold what dealing out all drawn blocks at random would give, without any such permutation. Each shard then takes
its own range of a source's blocks in a pseudo-random order of them (a swap-or-not permutation, computed per block), so
the shards' blocks are disjoint, and a shard is shuffled by a keyed hash of its own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Scratch

ROUNDS = 32


def _unit(*cols) -> Column:
    """A number in [0, 1) from a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, shifted by 8 for small n; error below 1e-10."""
    x = n.cast("double") + 9.0
    series = (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    m = n.cast("double")
    below = F.log((m + 1) * (m + 2) * (m + 3) * (m + 4)) + F.log((m + 5) * (m + 6) * (m + 7) * (m + 8))
    return series - below


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``good`` among ``total`` are in ``draws``: the inverse distribution function at u, summed over the
    support within 12 standard deviations (what lies beyond has a probability below 1e-30)."""

    def bounds(g: Column) -> Column:
        n, good, draws = g["n"], g["good"], g["draws"]
        t = F.greatest(n, F.lit(2)).cast("double")
        mean = draws * good / t
        sd = F.sqrt(F.greatest(F.lit(0.0), mean * (t - good) / t * (t - draws) / (t - 1)))
        constant = _log_factorial(good) + _log_factorial(n - good) + _log_factorial(draws) + _log_factorial(n - draws) - _log_factorial(n)
        low, high = F.greatest(F.lit(0).cast("long"), draws - (n - good)), F.least(good, draws)
        return F.struct(low.alias("low"), high.alias("high"), F.greatest(low, F.floor(mean - 12 * sd).cast("long") - 12).alias("from"), F.least(high, F.ceil(mean + 12 * sd).cast("long") + 12).alias("to"), constant.alias("constant"), g["n"].alias("n"), g["good"].alias("good"), g["draws"].alias("draws"), g["u"].alias("u"))

    def weighed(b: Column) -> Column:
        p = lambda k: F.exp(b["constant"] - _log_factorial(k) - _log_factorial(b["good"] - k) - _log_factorial(b["draws"] - k) - _log_factorial(b["n"] - b["good"] - b["draws"] + k))
        return F.struct(b["from"].alias("from"), b["u"].alias("u"), F.transform(F.sequence(b["from"], b["to"]), p).alias("p"))

    def aimed(w: Column) -> Column:
        return F.struct(w["from"].alias("from"), w["p"].alias("p"), (w["u"] * F.aggregate(w["p"], F.lit(0.0), lambda a, x: a + x)).alias("aim"))

    def picked(w: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("i"))
        return w["from"] + F.aggregate(w["p"], start, lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["i"] + (a["sum"] <= w["aim"]).cast("long")).alias("i")))["i"]

    given = F.struct(total.alias("n"), good.alias("good"), draws.alias("draws"), u.alias("u"))
    draw = lambda b: F.when(b["low"] >= b["high"], b["low"]).otherwise(_let(_let(weighed(b), aimed), picked))
    return _let(_let(given, bounds), draw)


def swap_or_not(x: Column, n: Column, seed: int, *keys: Column) -> Column:
    """The place of x in a pseudo-random permutation of 0..n-1: in each round x and its mirror change places or not."""

    def turn(a: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit(seed), r, *keys), n) - a, n)
        swap = F.xxhash64(F.lit(seed + 1), r, F.greatest(a, mirror), *keys).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, mirror).otherwise(a)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, turn)


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, limit: float) -> DataFrame:
    """Rows (source, source_size) with target double: ``share`` of all words by weight (given by the order of the sources,
    null last, in turn), none over ``limit`` times its source, the excess reshared by weight.

    The one row per source is ranked in one window; sources are names in a catalogue, a few thousand at most.
    """
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("__w", F.element_at(turn, F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, len(weights)).cast("int") + 1))
    # A source is at its limit just if all at its level of limit by weight fit the budget: fill levels from the lowest.
    level = F.col("__cap") / F.col("__w")
    every, up_to = Window.partitionBy(), Window.orderBy("__level", "__w", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    known = ranked.withColumn("__cap", limit * F.col("source_size")).withColumn("__level", level)
    known = known.withColumns({"__budget": share * F.sum("source_size").over(every), "__all_w": F.sum("__w").over(every), "__w_before": F.coalesce(F.sum("__w").over(up_to), F.lit(0.0)), "__cap_before": F.coalesce(F.sum("__cap").over(up_to), F.lit(0.0))})
    known = known.withColumn("__full", F.col("__level") * (F.col("__all_w") - F.col("__w_before")) + F.col("__cap_before") <= F.col("__budget"))
    full_cap, full_w = F.sum(F.when(F.col("__full"), F.col("__cap")).otherwise(0.0)).over(every), F.sum(F.when(F.col("__full"), F.col("__w")).otherwise(0.0)).over(every)
    known = known.withColumn("__rise", (F.col("__budget") - full_cap) / (F.col("__all_w") - full_w))
    target = F.when(F.col("__full"), F.col("__cap")).otherwise(F.least("__cap", F.col("__w") * F.col("__rise")))
    return known.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, limit: float = 2.0, shards: int = 64, block_words: int = 2048, seed: int = 17, text: str = "text", key: str = "doc_id", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) of a mix.

    documents: doc (key), version (hash of the text), source, size, source_size, target, at (first word in the source's
    stream); one row per input row. pieces: shard, turn (order within the shard), source, at, doc, version, pass, first
    and words: the words of a document that a drawn block holds. Blocks have ``block_words`` words, more only where all
    sources together would have over 2^20 blocks. Sizes are numbers of words; a null or empty text has none and is in no
    piece. Null sources are one source, null keys are allowed, repeated rows are documents of their own that differ
    only in their place. An empty table gives empty tables.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    version = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(key).alias("doc"), version.alias("version"), F.col(source).cast("string").alias("source"), size.alias("size"))
    place = F.xxhash64(F.lit(seed), "doc", "version")
    rows = scratch.save(rows.withColumns({"h": place, "b1": F.pmod(place, F.lit(256)), "b2": F.pmod(F.shiftright(place, 8), F.lit(256))}), "rows")
    null = F.col("source").isNull().alias("no_source")
    name = F.coalesce("source", F.lit("")).alias("name")
    rows = rows.select("*", null, name)
    own = ["name", "no_source"]
    small = rows.groupBy(*own, "b1", "b2").agg(F.sum("size").alias("n"))
    large = small.groupBy(*own, "b1").agg(F.sum("n").alias("n"))
    before = lambda *part, by: F.coalesce(F.sum("n").over(Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    large_at = large.select(*own, "b1", before(*own, by="b1").alias("at1"))
    small_at = small.select(*own, "b1", "b2", before(*own, "b1", by="b2").alias("at2"))
    offsets = scratch.save(small_at.join(large_at, [*own, "b1"]).select(*own, "b1", "b2", (F.col("at1") + F.col("at2")).alias("at0")), "offsets")
    sizes = large.groupBy(*own).agg(F.sum("n").alias("source_size")).select(F.when(~F.col("no_source"), F.col("name")).alias("source"), "source_size", *own)
    goal = targets(sizes.select("source", "source_size"), weights, share, limit)
    goal = goal.withColumns({"no_source": null, "name": name})
    words = F.sum("source_size").over(Window.partitionBy())
    block = F.greatest(F.lit(block_words).cast("long"), F.ceil(words / F.lit(1 << 20)).cast("long"))
    goal = goal.withColumn("block", block).withColumns({"blocks": F.ceil(F.col("source_size") / F.col("block")).cast("long"), "quota": F.least(F.round("target").cast("long"), F.floor(F.lit(limit) * F.col("source_size")).cast("long"))})
    # A pass draws the blocks of the whole source; the last pass only as many as are missing, and of the last one a part.
    passes = F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(0).cast("long")
    goal = goal.withColumn("passes", passes).withColumn("rest", F.col("quota") - F.col("passes") * F.col("source_size"))
    last_nth = swap_or_not(F.col("blocks") - 1, F.col("blocks"), seed + 4, F.col("name"), F.col("no_source"), F.col("passes"))
    goal = goal.withColumns({"tail": F.col("blocks") * F.col("block") - F.col("source_size"), "last_nth": F.when(F.col("blocks") > 0, last_nth)})
    missing = F.ceil(F.col("rest") / F.col("block")).cast("long")
    short = (F.col("last_nth") < missing) & (missing * F.col("block") - F.col("tail") < F.col("rest"))
    goal = goal.withColumn("draws", F.col("passes") * F.col("blocks") + F.when(F.col("rest") > 0, missing + short.cast("long")).otherwise(0))
    goal = scratch.save(goal, "goal")
    within = Window.partitionBy(*own, "b1", "b2").orderBy("h", F.col("doc").asc_nulls_last(), "version").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)).cast("long"))
    placed = scratch.save(placed, "placed").join(offsets, [*own, "b1", "b2"]).withColumn("at", F.col("at0") + F.col("before"))
    documents = scratch.save(placed.select("doc", "version", "name", "no_source", "size", "at"), "documents").join(goal, own)
    # The tree: one row per node, counts in the order of the sources.
    node = goal.agg(F.array_sort(F.collect_list(F.struct("no_source", "name", "draws"))).alias("all")).select(F.lit(1).cast("long").alias("node"), F.lit(shards).cast("long").alias("width"), F.lit(0).cast("long").alias("low"), F.transform("all", lambda s: s["draws"]).alias("counts"), "all")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
    half = F.expr("(width + 1) div 2")
    room = F.floor(F.col("total") * F.col("half") / F.col("width") + _unit(F.lit(seed + 2), "node")).cast("long")

    def draw(a: Column, c: Column) -> Column:
        take = hypergeometric(a["total"], c, a["room"], _unit(F.lit(seed + 3), F.col("node"), a["i"]))
        return _let(take, lambda t: F.struct((a["total"] - c).alias("total"), (a["room"] - t).alias("room"), (a["i"] + 1).alias("i"), F.concat(a["out"], F.array(t)).alias("out")))

    start = F.struct(F.col("total").alias("total"), F.col("room").alias("room"), F.lit(0).alias("i"), F.array().cast("array<bigint>").alias("out"))
    left = F.when(F.col("width") > 1, F.aggregate("counts", start, draw)["out"]).otherwise(F.col("counts"))
    children = F.array(
        F.struct((F.col("node") * 2).alias("node"), F.col("half").alias("width"), F.col("low").alias("low"), F.col("left").alias("counts")),
        F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("width") - F.col("half")).alias("width"), (F.col("low") + F.col("half")).alias("low"), F.zip_with("counts", "left", lambda c, x: c - x).alias("counts")),
    )
    for _ in range((shards - 1).bit_length()):
        split = node.withColumns({"total": total, "half": half}).withColumn("room", F.when(F.col("width") > 1, F.least("total", room)).otherwise(F.col("total")))
        node = split.withColumn("left", left).select(F.explode(children).alias("x"), "all").select("x.*", "all").filter("width > 0")
    leaves = node.select("low", F.explode(F.arrays_zip("all", "counts")).alias("x")).select(F.col("low").alias("shard"), "x.all.no_source", "x.all.name", F.col("x.counts").alias("n")).filter("n > 0")
    leaves = scratch.save(leaves, "leaves")
    from_ = F.coalesce(F.sum("n").over(Window.partitionBy(*own).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    slots = leaves.withColumn("from", from_).select(*own, "shard", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)).alias("draw"))
    # Each document's share of each block, once per pass.
    end = F.col("at") + F.col("size")
    parts = documents.filter("size > 0").withColumn("b", F.explode(F.sequence(F.expr("at div block"), F.expr("(at + size - 1) div block"))))
    first = F.greatest(F.col("at"), F.col("b") * F.col("block"))
    parts = parts.withColumns({"first": first - F.col("at"), "words": F.least(end, (F.col("b") + 1) * F.col("block")) - first, "in_block": first - F.col("b") * F.col("block")})
    parts = parts.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
    order = swap_or_not(F.col("b"), F.col("blocks"), seed + 4, F.col("name"), F.col("no_source"), F.col("pass"))
    parts = parts.withColumn("nth", order).withColumn("draw", F.col("pass") * F.col("blocks") + F.col("nth"))
    # Words of the last pass drawn before this block; the source's short last block may come among them.
    drawn = F.col("nth") * F.col("block") - F.when(F.col("last_nth") < F.col("nth"), F.col("tail")).otherwise(0)
    room = F.when(F.col("pass") < F.col("passes"), F.col("words")).otherwise(F.least(F.col("words"), F.greatest(F.lit(0).cast("long"), F.col("rest") - drawn - F.col("in_block"))))
    parts = parts.withColumn("words", room).filter("words > 0")
    pieces = parts.join(slots, [*own, "draw"])
    pieces = pieces.select("shard", F.xxhash64(F.lit(seed + 5), "name", "no_source", "draw", "first", "at").alias("turn"), F.when(~F.col("no_source"), F.col("name")).alias("source"), "at", "doc", "version", "pass", "first", "words")
    documents = documents.select("doc", "version", F.when(~F.col("no_source"), F.col("name")).alias("source"), "size", "source_size", "target", "at")
    return documents, pieces


def shuffled(pieces: DataFrame, shards: int = 64) -> DataFrame:
    """Pieces in the order of their shards, each shard in an order of its own: ready to be written shard by shard."""
    return pieces.repartition(shards, "shard").sortWithinPartitions("shard", "turn")


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Per input row: doc_id, source, size, source_size, target and taken (words of all its pieces). The row's place in its
    source's stream tells repeated rows apart; rows without words take nothing."""
    documents, pieces = mix(docs, **options)
    marked = documents.filter("size > 0").select("*", F.lit(0).cast("long").alias("words"))
    drawn = pieces.select("doc", "version", "source", F.lit(None).cast("long").alias("size"), F.lit(None).cast("long").alias("source_size"), F.lit(None).cast("double").alias("target"), "at", "words")
    some = marked.unionByName(drawn).groupBy("source", "at", "doc", "version").agg(F.max("size").alias("size"), F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("words").alias("taken"))
    none = documents.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return some.unionByName(none.select(some.columns)).select(F.col("doc").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``documents`` in the mix: a row for each document and pass that has drawn words, with the drawn words as its text
    (the whole text where all are drawn, else the drawn stretches, each as it stands in the text, on lines of their
    own) and n_chars counted anew. Of rows that repeat doc_id, text and source one stands for all, whatever their other
    columns hold, and comes once for each pass of each. Rows without words are in no mix; null keys, texts and sources
    are values like any other; further columns keep their values; an empty table gives an empty table."""
    scratch = Scratch(docs.sparkSession, "mixed")
    documents, pieces = mix(docs, **options)
    stretch = F.struct("first", "words")
    drawn = scratch.save(pieces.groupBy("source", "at", "doc", "version", "pass").agg(F.array_sort(F.collect_list(stretch)).alias("stretches"), F.sum("words").alias("taken")), "stretches")
    drawn = drawn.select(F.col("doc").alias("__doc"), F.col("version").alias("__version"), F.col("source").alias("__source"), F.col("at").alias("__at"), "pass", "stretches", "taken")
    version = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    known = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("__row"), version.alias("__v"))
    again = scratch.save(documents.groupBy("doc", "version", "source").count().filter("count > 1"), "again")
    same = lambda left, right: left["doc_id"].eqNullSafe(right[right.columns[0]]) & (left["__v"] == right[right.columns[1]]) & left["source"].eqNullSafe(right[right.columns[2]])
    once = known.join(again, same(known, again), "left_anti").unionByName(known.join(again, same(known, again), "left_semi").dropDuplicates(["doc_id", "__v", "source"]))
    joined = once.join(drawn, same(once, drawn))
    tokens = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    # neighbouring stretches belong together
    merged = F.aggregate("stretches", F.array().cast("array<struct<first: bigint, words: bigint>>"), lambda a, s: F.when((F.size(a) > 0) & (F.element_at(a, -1)["first"] + F.element_at(a, -1)["words"] == s["first"]), F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["first"].alias("first"), (F.element_at(a, -1)["words"] + s["words"]).alias("words"))))).otherwise(F.concat(a, F.array(F.struct(s["first"].alias("first"), s["words"].alias("words"))))))
    whole = F.col("taken") >= F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    parts = F.array_join(F.transform(merged, lambda s: F.rtrim(F.array_join(F.slice(tokens, (s["first"] + 1).cast("int"), s["words"].cast("int")), ""))), "\n")
    out = joined.withColumn("text", F.when(whole, F.col("text")).otherwise(parts))
    counted = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return out.select(*[counted.get(c, F.col("__row")[c]).alias(c) for c in docs.columns])
