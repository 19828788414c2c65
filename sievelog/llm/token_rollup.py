"""Token counts as delta-maintained rollups.

A batch of changes (inserts, revised counts, deletes of documents under a tokenizer version) becomes signed deltas: what
the documents counted before goes out, what they count now comes in. Totals by source, language and version are sums of
committed deltas. A batch is written to a waiting folder and takes effect by one rename to its own name; applying it again
finds the name and changes nothing, and a job that dies before leaves nothing that counts. One writer applies batches at a
time.

The log of counts is laid out in buckets of documents. What a batch's documents counted before is read from their buckets
alone, so a small batch reads a small part of the log, and ``compact`` makes one base of all batches so far, so the log is
no longer than the documents that hold and the batches since.
"""

from __future__ import annotations

import base64
import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import read_vocabulary

CHANGE = "op string, doc_id long, version string, source string, lang string, n_tokens long"
LOG = "doc_id long, version string, source string, lang string, n_tokens long, gone boolean, seq long, bucket int"
DELTA = "source string, lang string, version string, n_docs long, n_tokens long"


class TokenRollup:
    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))

    def batches(self) -> list[str]:
        """Names of the committed batches (one short name a batch, however large)."""
        top = self._path("batches")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(top)) if self._fs.exists(top) else []

    def _base(self) -> tuple[str | None, frozenset[str]]:
        """The last base and the names of the batches in it."""
        top = self._path("bases")
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(top)) if self._fs.exists(top) else []
        if not names:
            return None, frozenset()
        held = self.spark.read.schema("name string").json(f"{self.folder}/bases/{names[-1]}/batches").collect()
        return f"{self.folder}/bases/{names[-1]}", frozenset(r.name for r in held)

    def _read(self, what: str, schema: str) -> DataFrame:
        base, held = self._base()
        paths = ([f"{base}/{what}"] if base else []) + [f"{self.folder}/batches/{b}/{what}" for b in self.batches() if b not in held]
        # Each folder is laid out in buckets of its own, so they are read one by one; compaction keeps them few.
        tables = [self.spark.read.schema(schema).parquet(p) for p in paths] or [self.spark.createDataFrame([], schema)]
        return reduce(DataFrame.unionByName, tables)

    def _bucket(self):
        return F.pmod(F.xxhash64("doc_id", "version"), F.lit(self.buckets)).cast("int")

    def _state(self, buckets: list[int] | None = None) -> DataFrame:
        rows = self._read("log", LOG)
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(buckets))
        last = rows.groupBy("doc_id", "version").agg(F.max_by(F.struct("source", "lang", "n_tokens", "gone", "seq"), "seq").alias("x"))
        return last.select("doc_id", "version", "x.*").filter("NOT gone")

    def state(self) -> DataFrame:
        """The count that holds for each document and version: that of the last batch that has it."""
        return self._state().drop("gone", "seq")

    def _write_log(self, log: DataFrame, path: str) -> None:
        log.withColumn("bucket", self._bucket()).repartition("bucket").write.partitionBy("bucket").parquet(path)

    def _rename(self, waiting: str, name: str) -> None:
        target = self._path(name)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._path(waiting), target):
            raise RuntimeError(f"{name} couldn't be committed")

    def compact(self) -> None:
        """Make one base of all batches so far; it takes effect by one rename, and readers need the logs before it no more."""
        names, waiting = self.batches(), f"_waiting/{uuid.uuid4().hex}"
        if not set(names) - self._base()[1]:
            return
        self._write_log(self._state(), f"{self.folder}/{waiting}/log")
        self.totals().coalesce(1).write.parquet(f"{self.folder}/{waiting}/delta")
        self.spark.createDataFrame([(n,) for n in names], "name string").coalesce(1).write.json(f"{self.folder}/{waiting}/batches")
        self._rename(waiting, f"bases/{len(names):012d}")

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens; groups that are back at nothing are left out."""
        sums = self._read("delta", DELTA).groupBy("source", "lang", "version").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 OR n_tokens <> 0")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of changes (op 'upsert' or 'delete', doc_id, version, source, lang, n_tokens); False if it has been
        applied before.

        A delete needs doc_id and version only, and one of an unknown document does nothing. Of several changes of one
        document and version in a batch an upsert goes before a delete, then the larger n_tokens, source and lang hold. A
        null n_tokens counts 0; null source, lang, doc_id and version are values like any other. An empty batch is
        committed and changes nothing. Further columns are ignored.
        """
        if "/" in batch or batch.startswith((".", "_")):
            raise ValueError("a batch's name is one folder's name")
        if batch in self.batches():
            return False
        waiting = f"_waiting/{uuid.uuid4().hex}"
        unknown = changes.filter(~F.coalesce(F.col("op").isin("upsert", "delete"), F.lit(False)))
        if not unknown.isEmpty():
            raise ValueError("op is 'upsert' or 'delete'")
        value = F.struct((F.col("op") == "upsert").alias("stays"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), F.col("source"), F.col("lang"))
        new = changes.groupBy("doc_id", "version").agg(F.max(value).alias("new"))
        touched = [r.bucket for r in new.select(self._bucket().alias("bucket")).distinct().collect()]  # at most ``buckets``
        old = self._state(touched).select(F.col("doc_id").alias("old_id"), F.col("version").alias("old_version"), F.struct("source", "lang", "n_tokens").alias("old"))
        both = new.join(old, new["doc_id"].eqNullSafe(old["old_id"]) & new["version"].eqNullSafe(old["old_version"]), "left")
        log = both.filter("new.stays OR old IS NOT NULL").select("doc_id", "version", "new.source", "new.lang", "new.n_tokens", (~F.col("new.stays")).alias("gone"), F.lit(len(self.batches())).cast("long").alias("seq"), "old")
        self._write_log(log, f"{self.folder}/{waiting}/log")
        held = self.spark.read.schema(log.schema).parquet(f"{self.folder}/{waiting}/log")
        came = held.filter("NOT gone").select("source", "lang", "version", F.lit(1).alias("sign"), "n_tokens")
        went = held.filter("old IS NOT NULL").select("old.source", "old.lang", "version", F.lit(-1).alias("sign"), "old.n_tokens")
        delta = came.union(went).groupBy("source", "lang", "version").agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))
        delta.coalesce(1).write.parquet(f"{self.folder}/{waiting}/delta")
        self._rename(waiting, f"batches/{batch}")
        return True


def token_counter(spark: SparkSession, ranks: str, pattern: str):
    """A column function: tokens of a text under a rank file (base64 token and rank a line); null or empty: 0."""
    spec = spark.sparkContext.broadcast(read_vocabulary(spark, ranks))

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        import tiktoken

        key = (spec.value[:64], len(spec.value), pattern)
        if key not in _ENCODINGS:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in spec.value.splitlines() if line)}
            _ENCODINGS[key] = tiktoken.Encoding("counter", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        encode = _ENCODINGS[key].encode_ordinary
        return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count


_ENCODINGS: dict = {}


def count_changes(docs: DataFrame, counter, version: str) -> DataFrame:
    """Upserts of the documents' counts under a version."""
    return docs.select(F.lit("upsert").alias("op"), "doc_id", F.lit(version).alias("version"), "source", "lang", counter(F.col("text")).alias("n_tokens"))
