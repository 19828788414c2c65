"""Whole log records, from raw to published: every value that is sensitive anywhere is replaced everywhere.

A record is a JSON text. It is taken apart once: its leaves are classed by the path that leads to them, texts of messages by
their format, JSON inside messages again by path. What is written then is the record's layout, a list of pieces of which
every second one is the text of a leaf that holds something or may be swept, and the places of marked values in them. What is
found grows the registry; then every leaf that may be swept is searched for all registered values. Tasks hold the registry
(``held``), so a record meets its tokens where it stands; only entries beyond what a task holds send their places to their
records by a join. The published record depends on nothing but the raw record and the registry, so it can be made anew at
any time, and is the same each time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import detectors as D
from ..sources.scratch import saved
from . import json_text, marks
from .contains import COUNT_BITS, GRAM, _far, _top, anchored, blocks, gram_hashes, lowered
from .formats import AGENT_PREFIX, text_format
from .held import Names, Words, parted_names, parted_words
from .registry import grow_registry, norm
from .sweep import patterns

#: Fields whose texts are messages, and fields that the sweep leaves alone (fixed values; names without case).
MESSAGES = ("message", "details", "description", "log_message", "error_message", "event_message")
GUARDED = (
    "streamname", "stream_name", "messagetype", "message_type", "pipelineentrypoint", "pipelinename", "pipeline", "fieldextractorname", "rulecategory", "rulename", "status_name", "statusname", "mo_name", "moname", "name", "sensitivity", "severitycode", "severity", "type", "subtype",
    "_partition", "_created_at", "_created_at_uuid", "_org_id", "channel", "api", "version", "kind", "event_data_type", "event_id", "opcode",
)
#: Texts of up to this many characters aren't swept outside messages (a fixed value).
SHORT = 10
#: Marked values that a task gathers before it sends them on; characters of a field whose marks a task remembers.
GATHERED, MEMO = 200_000, 64
MADE = (
    "struct<pieces: array<string>, kinds: array<tinyint>, swept: array<boolean>, kept: array<struct<first: int, last: int, text: string>>, "
    "at: array<int>, start: array<int>, len: array<int>, hexed: array<boolean>, category: array<string>, value: array<string>, odd: array<string>, text: string>"
)
PLACE = "struct<at: int, start: int, len: int, priority: int, token: string>"
MARK = ("at", "start", "len", "hexed", "category", "value")
#: How a piece is written: as it is, in quotes, in quotes within JSON that is a text itself; a number only where its text changes.
PLAIN, QUOTED, INNER, NUMBER, INNER_NUMBER = range(5)


def _batch(rows: list[tuple], types: tuple[pa.DataType, ...], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ((),) * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))


def identity(*columns: Column) -> Column:
    """A digest of what makes two rows one: equal rows share their places."""
    return F.md5(F.to_json(F.struct(*columns)))


def split_prefix(text: str) -> tuple[str, str]:
    """What stands before a message's JSON, and the JSON."""
    at = text.find("{")
    return (text[:at], text[at:]) if at >= 0 else (text, "")


def inner_json(form: str, text: str):
    """The object in a message of a format that is JSON, else None."""
    if form not in ("winlogbeat", "aws_cloudtrail"):
        return None
    prefix, body = split_prefix(text)
    return json_text.parsed(body) if not prefix.strip() or (form == "winlogbeat" and re.fullmatch(AGENT_PREFIX + r"\s*", prefix)) else None


class Layouts:
    """Pieces of a batch's records, one record after the other. Those at odd places are texts: what they hold is marked, and
    they are swept if they may be."""

    def __init__(self):
        self.parts: list[str] = []
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.swept: list[bool] = []
        self.kept: list[tuple[int, int, str]] = []
        self.marks: list = []  # the fields of one mark after the other
        self.odd: list[str] = []
        self.texts: list[str | None] = []
        self.ends: list[tuple[int, int, int, int, int]] = [(0, 0, 0, 0, 0)]

    def text(self, kind: int, value: str, swept: bool, found: list[tuple]) -> None:
        if found:
            at = len(self.kinds) - self.ends[-1][1]
            for mark in found:
                self.marks += (at, *mark)
                if not mark[4].isascii():
                    self.odd.append(mark[4])
        self.pieces += ("".join(self.parts), value)
        self.parts.clear()
        self.kinds.append(kind)
        self.swept.append(swept)

    def edge(self) -> int:
        """Ends a piece; the number of the one that begins."""
        self.text(PLAIN, "", False, [])
        return len(self.pieces) - self.ends[-1][0]

    def done(self, text: str | None) -> None:
        """Ends a record. Its text is kept if that is laid out otherwise."""
        low, first, *_ = self.ends[-1]
        if len(self.kinds) > first:
            self.pieces.append("".join(self.parts))
            laid = self.pieces[low:]
            laid[1::2] = [json_text.quoted(p) if kind == QUOTED else written(p, kind, False) for p, kind in zip(laid[1::2], self.kinds[first:], strict=True)]
            text = None if "".join(laid) == text else text
        self.parts.clear()
        self.texts.append(text)
        self.ends.append((len(self.pieces), len(self.kinds), len(self.kept), len(self.marks) // len(MARK), len(self.odd)))

    def array(self) -> pa.Array:
        pieces, texts, kept, marks, odd = (pa.array(c, pa.int32()) for c in zip(*self.ends, strict=True))
        lists = lambda ends, values, kind: pa.ListArray.from_arrays(ends, pa.array(values, kind))
        again = _batch(self.kept, (pa.int32(), pa.int32(), pa.string()), ("first", "last", "text"))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.string())
        columns = {
            "pieces": lists(pieces, self.pieces, pa.string()), "kinds": lists(texts, self.kinds, pa.int8()), "swept": lists(texts, self.swept, pa.bool_()), "kept": pa.ListArray.from_arrays(kept, pa.StructArray.from_arrays(again.columns, names=again.schema.names)),
            **{name: lists(marks, self.marks[i :: len(MARK)], kind) for i, (name, kind) in enumerate(zip(MARK, kinds, strict=True))}, "odd": lists(odd, self.odd, pa.string()), "text": pa.array(self.texts, pa.string()),
        }
        return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def shaped(segments: list[marks.Segment]) -> list[tuple[int, int, bool, str, str]]:
    """(start, len, hexed, category, value) of marked segments."""
    return [(start, n, category.endswith("/hex"), category.removesuffix("/hex"), v) for start, n, category, v in marks.marked(segments)]


def written(text: str, kind: int, changed: bool) -> str:
    """A text as it stands in the record."""
    if kind == QUOTED:
        return json_text.quoted(text)
    if kind == PLAIN:
        return text
    if kind == INNER:
        return json_text.escaped(json_text.quoted(text))
    if not changed or text.isdecimal():
        return str(int(text)) if changed else text
    return json_text.quoted(text) if kind == NUMBER else json_text.escaped(json_text.quoted(text))


def take_message(layout: Layouts, value: str, form: str, domains: tuple[marks.Step, ...], quoted: bool) -> None:
    """A message's text, or the texts of its JSON; ``quoted``: as a text of a record. A message of which nothing is replaced
    stays as it was laid out."""
    inner = inner_json(form, value)
    if inner is None:
        layout.text(QUOTED if quoted else PLAIN, value, True, shaped(marks.mark(value, form, domains)))
        return
    prefix = split_prefix(value)[0]
    shape = (lambda t: layout.parts.append(json_text.escaped(t))) if quoted else layout.parts.append

    def leaf(name, parent, text, passed, guarded, about, number) -> None:
        found = shaped(marks.mark_json(form, name, parent, text, domains))
        kind = (INNER_NUMBER if number else INNER) if quoted else NUMBER if number else QUOTED
        if found or len(text) >= GRAM:
            layout.text(kind, text, True, found)
        else:
            layout.parts.append(written(text, kind, False))

    other = quoted and prefix + json_text.shown(inner) != value
    first = layout.edge() if other else 0
    if quoted:
        layout.parts.append('"')
    shape(prefix)
    json_text.laid_out(inner, shape, leaf)
    if quoted:
        layout.parts.append('"')
    if other:
        layout.kept.append((first, layout.edge() - 2, json_text.quoted(value)))


def take_record(layout: Layouts, text: str | None, domains: tuple[marks.Step, ...]) -> None:
    """The layout of a JSON record; what isn't JSON has none."""
    record, write = json_text.parsed(text), layout.parts.append

    def leaf(name, parent, value, passed, guarded, about, number) -> None:
        if name in _MESSAGES and not number:
            take_message(layout, value, text_format(value, *about), domains, True)
            return
        found = () if passed else field_marks(name, value) if len(value) <= MEMO else shaped(marks.mark_field(name, value))
        kind = NUMBER if number else QUOTED
        swept = not guarded and len(value) > SHORT
        if found or swept:
            layout.text(kind, value, swept, found)
        else:
            write(written(value, kind, False))

    if record is not None:
        json_text.laid_out(record, write, leaf, _PASSED, _GUARDED)
    layout.done(text)


def take_alone(layout: Layouts, text: str | None, form: str, domains: tuple[marks.Step, ...]) -> None:
    """The layout of a message that stands alone."""
    if text is not None:
        take_message(layout, text, form, domains, False)
    layout.done(text)


_PASSED, _GUARDED, _MESSAGES = frozenset(marks.PASSED), frozenset(GUARDED), frozenset(MESSAGES)


@lru_cache(1 << 15)
def field_marks(name: str, value: str) -> list[tuple[int, int, bool, str, str]]:
    return shaped(marks.mark_field(name, value))


def taken_apart(rows: DataFrame, body: str, columns: list[Column], customer_domains: tuple[str, ...]) -> DataFrame:
    """The rows without ``body``, but with their layout, written. ``columns``: the record, or a message with its stream, type
    and pipeline."""

    @F.arrow_udf(MADE)
    def run(*given: pa.Array) -> pa.Array:
        domains, layout = marks.domain_step(customer_domains), Layouts()
        if len(given) == 1:
            for text in given[0].to_pylist():
                take_record(layout, text, domains)
        else:
            for text, *about in zip(*(c.to_pylist() for c in given), strict=True):
                take_alone(layout, text, "" if text is None else text_format(text, *(x or "" for x in about)), domains)
        return layout.array()

    return saved(rows.withColumn("__made", run(*columns)).drop(body), "records")


def firsts(found: pa.Table) -> pa.Table:
    """Of marked values (category, value, record_id, at, start; a record's in order) of each spelling the first one."""
    if not len(found):
        return found
    found = found.combine_chunks()
    codes = [found[c].combine_chunks().dictionary_encode() for c in ("category", "value", "record_id")]
    category, value, rid = (c.indices.to_numpy().astype(np.int64) for c in codes)
    ids = codes[2].dictionary
    rank = np.empty(len(ids), np.int64)
    rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    order = np.lexsort((rank[rid], category, value))  # stable: of one record the first
    new = np.ones(len(order), bool)
    new[1:] = (category[order][1:] != category[order][:-1]) | (value[order][1:] != value[order][:-1])
    return found.take(pa.array(order[new]))


def candidates(rows: DataFrame) -> DataFrame:
    """What ``grow_registry`` takes, in order of record and place: of each spelling of a value the first one of a task's
    rows."""
    schema = "category string, value string, record_id string, at int, start int"
    names = ["category", "value", "record_id", "at", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for batch in batches:
            rid, *lists = batch.columns
            many = lists[0].value_lengths().fill_null(0).to_numpy()
            category, value, at, start = (c.flatten() for c in lists)
            found = firsts(pa.table([category, value, rid.take(pa.array(np.repeat(np.arange(len(many)), many))), at, start], names))
            gathered.append(found)
            size += len(found)
            if size > GATHERED:
                gathered = [firsts(pa.concat_tables(gathered))]
                size = len(gathered[0])
                if 2 * size > GATHERED:
                    yield from gathered[0].to_batches()
                    gathered, size = [], 0
        if gathered:
            yield from firsts(pa.concat_tables(gathered)).to_batches()

    found = rows.select("__rid", *(f"__made.{c}" for c in ("category", "value", "at", "start"))).mapInArrow(run, schema)
    return found.select("category", "value", "record_id", F.struct("at", "start").alias("start"))


def texts_of(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of layouts: the number of pieces of each record and of its first text, and the record and the piece of
    each text."""
    many = pieces.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    texts = many // 2
    record, first = np.repeat(np.arange(len(many)), texts), np.cumsum(texts) - texts
    return many, first, record, (np.cumsum(many) - many)[record] + 2 * (np.arange(len(record)) - first[record]) + 1


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def swept_grams(rows: DataFrame) -> np.ndarray:
    """``contains.gram_counts`` of the texts that are swept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            pieces, swept = batch.columns
            place = texts_of(pieces)[3][_flat(swept).astype(bool)]
            for _, block in blocks([lowered(t) for t in pieces.flatten().take(pa.array(place)).to_pylist()]):
                counts += np.bincount(_top(gram_hashes(block), COUNT_BITS), minlength=1 << COUNT_BITS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["slot", "n"])

    found = rows.select("__made.pieces", "__made.swept").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    counts[found["slot"]] = found["n"]
    return counts


def free(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of spans in order (of two at one place the longer first) those that are taken from the left, each where the last one
    left off, as in ``sweep.free_spans``. Spans that overlap none are seen once."""
    head = np.ones(len(start), bool)
    head[1:] = start[1:] >= np.maximum.accumulate(end)[:-1]
    now = np.flatnonzero(head)
    until, taken = np.append(now[1:], len(start))[: len(now)], [np.empty(0, np.int64)]
    while len(now):
        taken.append(now)
        after = np.searchsorted(start, end[now])
        more = after < until
        now, until = after[more], until[more]
    return np.sort(np.concatenate(taken))


class Known:
    """A registry as the tasks hold it, and the places (rid, spans) of the entries that they don't hold, or None."""

    def __init__(self, rows: DataFrame, registry: DataFrame, counts: np.ndarray | None):
        names, far = parted_names(registry)
        words, places = None, []
        if far is not None:
            marked = rows.select("__rid", F.explode(F.arrays_zip(*(f"__made.{c}" for c in MARK))).alias("m")).withColumn("norm", norm(F.col("m.value")))
            token = F.when(F.col("m.hexed"), D.ip_to_hex(F.col("sanitized"))).otherwise(F.col("sanitized"))
            met = marked.join(far.select(F.col("category").alias("c"), "norm", "sanitized"), ["norm"]).filter("m.category = c")
            places.append(met.select("__rid", "m.at", "m.start", "m.len", F.lit(1).alias("priority"), token.alias("token")))
        if counts is not None:
            known = saved(patterns(registry), "patterns")
            entries = saved(anchored(known, "norm", counts), "anchors").join(known.withColumnRenamed("norm", "word"), "word")
            words, far = parted_words(entries)
            if far is not None:
                texts = rows.select("__rid", "__made.swept", F.posexplode("__made.pieces").alias("n", "text")).filter("n % 2 = 1")
                texts = texts.withColumn("at", F.shiftright("n", 1)).filter(F.get("swept", F.col("at")) & (F.length("text") >= GRAM))
                hits = _far(texts.select(F.struct("__rid", "at").alias("record_id"), "text"), far)
                if hits is not None:
                    hits = hits.join(far.select("word", "token"), "word")
                    places.append(hits.select("record_id.*", "start", F.length("word").alias("len"), F.lit(2).alias("priority"), "token"))
        self.sent = rows.sparkSession.sparkContext.broadcast((names, words))
        self.places = None
        for some in places:
            self.places = some if self.places is None else self.places.unionByName(some)

    def met(self, rows: DataFrame) -> DataFrame:
        """The rows with their places of entries that tasks don't hold."""
        if self.places is None:
            return rows.withColumn("__far", F.lit(None).cast(f"array<{PLACE}>"))
        lists = self.places.groupBy(F.col("__rid").alias("__of")).agg(F.collect_set(F.struct("at", "start", "len", "priority", "token")).cast(f"array<{PLACE}>").alias("__far"))
        return rows.join(lists, F.col("__rid") == F.col("__of"), "left").drop("__of")


def _marked() -> list[Column]:
    """Marked values; lower case of those that are more than ASCII is Spark's."""
    odd = F.col("__made.odd")
    return [F.when(F.size(odd) > 0, F.transform(odd, norm)), *(F.col(f"__made.{c}") for c in ("category", "value", "at", "start", "len", "hexed"))]


def names_of(odd: pa.Array, category: pa.Array, value: pa.Array) -> pa.Array:
    """``held.name_of`` of marked values."""
    value = value.flatten()
    low = pc.ascii_lower(pc.ascii_trim(value, " "))
    if len(odd.flatten()):
        low = pc.replace_with_mask(low, pc.invert(pc.string_is_ascii(value)), odd.flatten())
    return pc.binary_join_element_wise(category.flatten(), low, "\0")


class Found:
    """Places of a batch's registered values: marked ones, then (``swept_too``) all others."""

    def __init__(self, held: tuple[Names, Words | None], pieces: pa.Array, swept: pa.Array, marked: list[pa.Array], far: pa.Array):
        self.names, self.words = held
        self.many, self.first, self.record, self.place = texts_of(pieces)
        self.swept = _flat(swept).astype(bool)
        odd, category, value, at, start, length, hexed = marked
        which = self.names.find(names_of(odd, category, value))
        real = which >= 0
        self.marks = self._spans(at, _flat(at), _flat(start), _flat(length), real)
        self.which, self.hexed = which[real], _flat(hexed).astype(bool)[real]
        columns = dict(zip(("at", "start", "len", "priority", "token"), far.flatten().flatten(), strict=True))
        real = np.ones(len(columns["at"]), bool)
        self.far = self._spans(far, *(columns[c].to_numpy(zero_copy_only=False) for c in ("at", "start", "len")), real)
        self.level, self.token = columns["priority"].to_numpy(zero_copy_only=False), columns["token"].to_pylist()

    def _spans(self, lists: pa.Array, at: np.ndarray, start: np.ndarray, length: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start from 0, end)"""
        many = lists.value_lengths().fill_null(0).to_numpy()
        text = np.repeat(self.first, many)[real] + at[real].astype(np.int64)
        start = start[real].astype(np.int64) - 1
        return text, start, start + length[real].astype(np.int64)

    def sweeps(self, texts: list[str], mine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, end, word) of all words in the texts of these numbers."""
        none = np.empty(0, np.int64)
        if self.words is None:
            return none, none, none, none
        found = [(mine[n], at, word) for n, at, word in self.words.places([lowered(texts[i]) for i in mine.tolist()])]
        text, start, word = (np.concatenate([none, *c]) for c in zip(*found, strict=True)) if found else (none, none, none)
        return text, start, start + self.words.size[word], word

    def holders(self, flat: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """Whether each record holds any place. Records with marked ones aren't searched any further."""
        held = np.zeros(len(self.many), bool)
        for text, _, _ in (self.marks, self.far):
            held[self.record[text]] = True
        left = np.flatnonzero(self.swept & ~held[self.record])
        if self.words is not None and len(left):
            text = self.sweeps(flat(self.place[left]), np.arange(len(left)))[0]
            held[self.record[left[text]]] = True
        return held

    def chosen(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(text, start, end, token) of the places that are replaced, in order."""
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        base = np.cumsum(size) - size
        swept = self.sweeps(texts, np.flatnonzero(self.swept))
        tokens = self.names.tokens.take(pa.array(self.which)).to_pylist()
        for i in np.flatnonzero(self.hexed).tolist():
            tokens[i] = "%02X%02X%02X%02X" % tuple(int(p) for p in tokens[i].split(".")[:4])
        parts = [(*self.marks, np.arange(len(self.which)), 1)]
        tokens += self.token
        parts += [tuple(c[self.level == n] for c in (*self.far, len(self.which) + np.arange(len(self.level)))) + (n,) for n in (1, 2)]
        parts.append((*swept[:3], len(tokens) + np.arange(len(swept[3])), 2))
        kept = (np.empty(0, np.int64),) * 4
        for level in (1, 2):
            text, start, end, token = (np.concatenate(c) for c in zip(*(p[:4] for p in parts if p[4] == level), strict=True))
            low, high = base[text] + start, base[text] + end
            if level == 2 and len(kept[0]):
                before = np.searchsorted(kept[2], low, "right")
                clear = (before == len(kept[2])) | (kept[1][np.minimum(before, len(kept[1]) - 1)] >= high)
                text, low, high, token = (c[clear] for c in (text, low, high, token))
            order = np.lexsort((-high, low))
            order = order[free(low[order], high[order])]
            kept = tuple(np.concatenate([k, c[order]]) for k, c in zip(kept, (text, low, high, token), strict=True))
            order = np.argsort(kept[1], kind="stable")
            kept = tuple(c[order] for c in kept)
        text, low, high, token = kept
        near = token < len(tokens)
        word = swept[3][token[~near] - len(tokens)]
        tokens += self.words.tokens.take(pa.array(word)).to_pylist() if len(word) else []
        token = token.copy()
        token[~near] = len(tokens) - len(word) + np.arange(len(word))
        return text, low - base[text], high - base[text], [tokens[i] for i in token.tolist()]


def made_anew(found: Found, pieces: list[str], kinds: list[int], kept: list[list | None], texts: list[str | None]) -> pa.Array:
    """The records with the tokens of their places, and the number of those; a record without places keeps its text."""
    place = found.place.tolist()
    text, start, end, token = found.chosen([pieces[i] for i in place])
    count = np.bincount(found.record[text], minlength=len(found.many)).tolist()
    new: dict[int, str] = {}
    now, parts, at, value = -1, [], 0, ""
    for t, lo, hi, tok in zip(text.tolist(), start.tolist(), end.tolist(), token, strict=True):
        if t != now:
            if now >= 0:
                parts.append(value[at:])
                new[now] = "".join(parts)
            now, parts, at, value = t, [], 0, pieces[place[t]]
        parts.append(value[at:lo])
        parts.append(tok)
        at = hi
    if now >= 0:
        parts.append(value[at:])
        new[now] = "".join(parts)
    changed = set()
    for t, (i, kind) in enumerate(zip(place, kinds, strict=True)):
        value = new.get(t)
        if value is not None:
            changed.add(i)
            pieces[i] = written(value, kind, True)
        elif kind:
            pieces[i] = written(pieces[i], kind, False)
    out, low = [], 0
    for n, many, old, original in zip(count, found.many.tolist(), kept, texts, strict=True):
        if not n and (original is not None or not many):
            out.append(original)
        elif old:
            mine = pieces[low : low + many]
            for x in old:
                if not any(low + i in changed for i in range(x["first"] + 1, x["last"], 2)):
                    mine[x["first"] : x["last"] + 1] = [x["text"], *[""] * (x["last"] - x["first"])]
            out.append("".join(mine))
        else:
            out.append("".join(pieces[low : low + many]))
        low += many
    return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(count, pa.int32())], names=["text", "n"])


def rebuilt(rows: DataFrame, known: Known, body: str, columns: list[str]) -> DataFrame:
    """``columns`` with all tokens of the registry in ``body``, laid out anew; n_replaced counts them."""
    sent = known.sent

    @F.arrow_udf("struct<text: string, n: int>")
    def rewrite(pieces: pa.Array, kinds: pa.Array, swept: pa.Array, kept: pa.Array, text: pa.Array, far: pa.Array, *marked: pa.Array) -> pa.Array:
        found = Found(sent.value, pieces, swept, list(marked), far)
        return made_anew(found, pieces.flatten().to_pylist(), kinds.flatten().to_pylist(), kept.to_pylist(), text.to_pylist())

    new = known.met(rows).withColumn("__new", rewrite(*(F.col(f"__made.{c}") for c in ("pieces", "kinds", "swept", "kept", "text")), F.col("__far"), *_marked()))
    return new.select(*[F.col("__new.text").alias(c) if c == body else F.col(c) for c in columns], F.col("__new.n").alias("n_replaced"))


def holding(rows: DataFrame, known: Known) -> DataFrame:
    """The rows that hold one of the registry's entries where it would be replaced."""
    sent = known.sent

    @F.arrow_udf("boolean")
    def holds(pieces: pa.Array, swept: pa.Array, far: pa.Array, *marked: pa.Array) -> pa.Array:
        flat = pieces.flatten()
        return pa.array(Found(sent.value, pieces, swept, list(marked), far).holders(lambda at: flat.take(pa.array(at)).to_pylist()))

    met = known.met(rows).withColumn("__holds", holds(F.col("__made.pieces"), F.col("__made.swept"), F.col("__far"), *_marked()))
    return met.filter("__holds").select(rows.columns)


class Sanitized:
    """Rows between raw and published. ``rows`` carry a digest ``__rid`` of what they say, so equal rows have equal places,
    and their layout ``__made``; they are written once."""

    def __init__(self, rows: DataFrame, given: list[Column], body: str, customer_domains: tuple[str, ...] = ()):
        self.columns, self.body = rows.columns, body
        self.rows = taken_apart(rows, body, given, customer_domains)
        self._counts: np.ndarray | None = None

    @classmethod
    def records(cls, records: DataFrame, body: str, customer_domains: tuple[str, ...] = ()) -> Sanitized:
        """JSON records. Null and malformed ones have no places and are published as they are."""
        return cls(records.withColumn("__rid", identity(F.col(body))), [F.col(body)], body, customer_domains)

    @classmethod
    def messages(cls, rows: DataFrame, message: str, stream: str, kind: str, pipeline: str, customer_domains: tuple[str, ...] = ()) -> Sanitized:
        """Messages that stand alone, with the columns that name their format."""
        given = [F.col(c) for c in (message, stream, kind, pipeline)]
        return cls(rows.withColumn("__rid", identity(*given)), given, message, customer_domains)

    def grown(self, registry: DataFrame, secret: bytes) -> DataFrame:
        """The registry with all marked values, written. A configuration's seeds stand in it before."""
        return saved(grow_registry(registry, saved(candidates(self.rows), "candidates"), secret), "registry")

    def known(self, registry: DataFrame, sweep: bool, rows: DataFrame) -> Known:
        """The registry as tasks hold it. Which grams are rare in the texts is counted once for all registries."""
        if sweep and self._counts is None:
            self._counts = swept_grams(self.rows)
        return Known(rows, registry, self._counts if sweep else None)

    def published(self, registry: DataFrame, sweep: bool = True, rids: DataFrame | None = None) -> DataFrame:
        """The rows, or those of ``rids`` (rid, or rows that ``holders`` gave), with all tokens of the registry, n_replaced
        and __rid."""
        rows = self.rows
        if rids is not None:
            rows = rids if "__made" in rids.columns else rows.join(rids, F.col("__rid") == F.col("rid"), "left_semi")
        return rebuilt(rows, self.known(registry, sweep, rows), self.body, self.columns)

    def holders(self, entries: DataFrame) -> DataFrame:
        """The rows, with their layout, that hold one of these registry entries where it would be replaced."""
        return holding(self.rows, self.known(entries, True, self.rows))

    def republished(self, earlier: DataFrame, before: DataFrame, grown: DataFrame) -> DataFrame:
        """``earlier`` (published under the registry ``before``) brought to the state of ``grown``: only rows that hold an
        entry which ``before`` lacks are made anew from raw; all others stay as they were written."""
        fresh = grown.join(before.select("category", "norm"), ["category", "norm"], "left_anti")
        held = saved(self.holders(fresh), "holders")
        rids = held.select("__rid").distinct()
        if 2 * held.count() < self.rows.count():
            kept = earlier.join(rids, "__rid", "left_anti")
        else:  # the rows that stay are the fewer ones
            kept = earlier.join(saved(earlier.select("__rid").distinct().join(rids, "__rid", "left_anti"), "kept"), "__rid", "left_semi")
        return kept.select(earlier.columns).unionByName(self.published(grown, rids=held))


def converged(raw: Sanitized, registry: DataFrame, detect: Callable[[DataFrame], DataFrame], secret: bytes, cycles: int = 5) -> tuple[DataFrame, DataFrame, list[int]]:
    """Publish, let ``detect`` look at what is published (record_id, start, category, value of what is still there), register
    what it finds, and publish the rows that hold it again, until it finds nothing new or the cycles end.

    Returns the published rows, the registry and the number of new entries of each cycle. Each cycle's tables are written.
    """
    registry = raw.grown(registry, secret)
    out, new = saved(raw.published(registry), "published"), []
    for _ in range(cycles):
        grown = saved(grow_registry(registry, detect(out), secret), "registry")
        new.append(grown.count() - registry.count())
        if not new[-1]:
            break
        out = saved(raw.republished(out, registry, grown), "published")
        registry = grown
    return out, registry, new
