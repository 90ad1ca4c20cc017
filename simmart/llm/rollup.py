"""Delta-maintained token counts.

A rollup is a folder with one folder per committed batch, which holds the sums
of the batch's signed changes by source, language and tokenizer version. Totals
are sums over all batches: an insert adds a document's counts, a delete takes
them away, a revised count does both, and what has come down to no document is
left out. A batch that is committed under a known id changes nothing, so a
commit may be repeated after any failure; one that broke off is written anew.
`compacted` starts a new rollup from an old one's totals.

Null sources and languages are groups of their own. Null text has no token.
Repeated rows count as often as they come; a change with a null sign, or null
count, raises an error when the batch is committed.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from simmart.llm.common import kept, new_folder, per_batch, prepared, texts

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens", "n_chars"]


class ByteTokens:
    """Counts of byte-level BPE tokens."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        import base64

        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self._encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def count(self, text: str) -> int:
        return len(self._encoding.encode_ordinary(text))


def counted(docs: DataFrame, tokenizers: dict[str, str], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, source, lang, tokenizer, n_tokens, n_chars) of every document and
    tokenizer version; tokenizers are files of ranks by name of the version."""
    files = {name: Path(path).read_bytes() for name, path in sorted(tokenizers.items())}
    marks = {name: hashlib.sha256(data).hexdigest() for name, data in files.items()}
    kind = dict(docs.dtypes)[key]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        every = texts(batch.column(3))
        parts = []
        for name, data in files.items():
            tokens = kept(("byte tokens", marks[name], pattern), lambda data=data: ByteTokens(data, pattern))
            columns = [
                *batch.columns[:3],
                pa.array([name] * len(every), pa.string()),
                pa.array([tokens.count(t) for t in every], pa.int64()),
                pa.array([len(t) for t in every], pa.int64()),
            ]
            parts.append(pa.RecordBatch.from_arrays(columns, ["key", "source", "lang", "tokenizer", "n_tokens", "n_chars"]))
        return pa.concat_batches(parts)

    rows = docs.select(F.col(key).alias("key"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col(text).alias("text"))
    schema = f"key {kind}, source string, lang string, tokenizer string, n_tokens bigint, n_chars bigint"
    return per_batch(rows, run, schema).withColumnRenamed("key", key)


def changes(counts: DataFrame, sign: Column | int) -> DataFrame:
    """Counts as inserts (sign 1) or deletes (sign -1); by a column, as either.
    A revision is the delete of the old counts and the insert of the new."""
    sign = F.lit(sign) if isinstance(sign, int) else sign
    return counts.select(*KEYS, sign.cast("bigint").alias("sign"), "n_tokens", "n_chars")


class Rollup:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = prepared(spark), path

    def _system(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._system().exists(self.spark._jvm.org.apache.hadoop.fs.Path(path))

    @staticmethod
    def _digest(batch: str) -> str:
        return hashlib.sha256(batch.encode()).hexdigest()[:32]

    def _folder(self, batch: str) -> str:
        return f"{self.path}/batch={self._digest(batch)}"

    def _batches(self) -> list[str]:
        """Digests of the batches whose write was finished."""
        if not self._exists(self.path):
            return []
        found = self._system().listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(self.path))
        names = sorted(s.getPath().getName() for s in found)
        return [n[6:] for n in names if n.startswith("batch=") and self._exists(f"{self.path}/{n}/_SUCCESS")]

    def _known(self) -> DataFrame:
        """Digests of the batches that are in the totals an older rollup gave."""
        path = f"{self.path}/_known"
        return self.spark.read.parquet(path) if self._exists(path) else self.spark.createDataFrame([], "digest string")

    def committed(self, batch: str) -> bool:
        """Whether the writer's mark of a finished write is there, or the batch
        is in the totals of the rollup that this one was compacted from."""
        if self._exists(f"{self._folder(batch)}/_SUCCESS"):
            return True
        return not self._known().where(F.col("digest") == self._digest(batch)).isEmpty()

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Adds a batch of signed changes; False if it was there already."""
        if self.committed(batch):
            return False
        sign = F.coalesce("sign", F.raise_error(F.lit("a change without a sign")).cast("bigint"))
        known = {c: F.coalesce(c, F.raise_error(F.lit(f"a change without {c}")).cast("bigint")) for c in SUMS[1:]}
        sums = [F.sum(sign).alias("n_docs"), *(F.sum(sign * known[c]).alias(c) for c in SUMS[1:])]
        deltas.groupBy(*KEYS).agg(*sums).write.mode("overwrite").parquet(self._folder(batch))
        return True

    def totals(self) -> DataFrame:
        """Current sums by source, language and tokenizer version, of the
        committed batches."""
        schema = ", ".join([*(f"{c} string" for c in KEYS), *(f"{c} bigint" for c in SUMS)])
        folders = [f"{self.path}/batch={b}" for b in self._batches()]
        parts = self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)
        found = parts.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))
        return found.where(" or ".join(f"{c} <> 0" for c in SUMS))

    def compacted(self, path: str) -> Rollup:
        """A new rollup, with the totals so far as its first batch. It knows the
        batches that are in them: committed again, they change nothing."""
        new = Rollup(self.spark, path)
        own = self.spark.createDataFrame([(b,) for b in self._batches()], "digest string")
        own.unionByName(self._known()).distinct().coalesce(1).write.mode("overwrite").parquet(f"{path}/_known")
        self.totals().write.mode("overwrite").parquet(new._folder("totals"))
        return new


def maintained(docs: DataFrame, labels: DataFrame, tokenizers: dict[str, str], pattern: str) -> DataFrame:
    """Totals after three batches and a repeated one: all documents come in by
    the first tokenizer version; those labelled toxic are deleted; those
    labelled good are counted anew by the second version, which replaces the
    first one's count; and the deletion is committed again."""
    spark = prepared(docs.sparkSession)
    rollup = Rollup(spark, new_folder(spark, "rollup"))
    first = next(iter(tokenizers))
    marks = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
    counts = counted(docs, tokenizers, pattern)
    path = new_folder(spark, "counts")
    counts.write.parquet(path)  # the ledger from which deletes and revisions are signed
    counts = spark.read.parquet(path)
    marked, old = counts.join(marks, "doc_id"), F.col("tokenizer") == first
    deleted = changes(marked.where(old & (F.col("toxic") == 1)), -1)
    revised = changes(
        marked.where("coalesce(toxic, 0) <> 1 and quality = 1"), F.when(old, -1).otherwise(1)
    )
    rollup.commit("inserts", changes(counts.where(old), 1))
    rollup.commit("deletes", deleted)
    rollup.commit("revisions", revised)
    rollup.commit("deletes", deleted)
    return rollup.totals()
