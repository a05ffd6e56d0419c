"""Token counts as delta-maintained rollups.

Totals of documents and tokens by source, language and tokenizer version are sums of signed changes. A
batch of inserts (+), deletes (-) and revised counts (- old, + new) is summed up and committed under its
id as one folder of the store, by a rename that only the first writer of an id wins; committing an id
again changes nothing. The totals are maintained: every few batches a snapshot is published the same way, the
one before plus the batches since, with the names of all batches it contains. Reading takes the last snapshot
and the batches that it doesn't contain, so it doesn't grow with the number of batches.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD
from .packing import encoder

KEYS = ("source", "lang", "tokenizer")
DELTAS = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
#: Batches after which a snapshot is published.
COMPACT = 16
#: Tokenizer versions, as patterns whose matches are the tokens: words, and words apart from other characters.
TOKENIZERS = {"words-1": WORD, "pieces-1": r"[0-9A-Za-z]+|[^0-9A-Za-z\x20\x09-\x0D]"}


def count_tokens(text: Column, pattern: str) -> Column:
    """Number of tokens of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def counted(docs: DataFrame, tokenizers: Mapping[str, str] = TOKENIZERS, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(id, source, lang, tokenizer, tokens): a row for each row of docs and tokenizer, all from one scan."""
    counts = F.array(*(F.struct(F.lit(name).alias("tokenizer"), count_tokens(docs[text_col], pattern).alias("tokens")) for name, pattern in tokenizers.items()))
    return docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), docs[lang_col].alias("lang"), F.explode(counts).alias("c")).select("id", "source", "lang", "c.*")


def vocabularies() -> dict[str, tuple[str, str | None]]:
    """Tokenizer versions of real vocabularies: rank file, and JSON file where there is one."""
    import public_tokenizers as P

    return {"byte_bpe_50k": (P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")), "byte_bpe_multi_50k": (P.path("byte_bpe_multi_50k.tiktoken"), None)}


def encoded(docs: DataFrame, version: str, files: tuple[str, str | None], id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(id, source, lang, tokenizer, tokens) for every row: the number of a vocabulary's tokens; null text: 0."""
    one = docs.select(*(docs[c].alias(n) for n, c in (("id", id_col), ("source", source_col), ("lang", lang_col), ("text", text_col))))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*files)
        for b in batches:
            n = pa.array([len(encode(t)) if t else 0 for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*map(b.column, ("id", "source", "lang")), pa.array([version] * b.num_rows, pa.string()), n], ["id", *KEYS, "tokens"])

    kinds = {f.name: f.dataType.simpleString() for f in one.schema}
    return one.mapInArrow(each, f"id {kinds['id']}, source {kinds['source']}, lang {kinds['lang']}, tokenizer string, tokens bigint")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).alias("docs"), "tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).alias("docs"), (-F.col("tokens")).alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts that replace others: of another tokenizer version, source or language, or simply other numbers."""
    return deletes(old).unionByName(inserts(new))


class Rollup:
    """A store of committed batches under a folder that all executors share.

    Null sources and languages are groups like any other; repeated changes each count; an empty batch is
    committed and adds nothing.
    """

    def __init__(self, spark: SparkSession, path: str, compact: int = COMPACT):
        self.spark, self.path, self.compact_every = spark, path.rstrip("/"), compact

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _names(self, folder: str) -> list[str]:
        fs, place = self._fs(f"{self.path}/{folder}")
        return sorted(x.getPath().getName() for x in fs.listStatus(place)) if fs.exists(place) else []

    def _folder(self, batch_id: str) -> str:
        return f"{self.path}/committed/{hashlib.sha256(batch_id.encode()).hexdigest()[:32]}"

    def has(self, batch_id: str) -> bool:
        fs, place = self._fs(self._folder(batch_id))
        return fs.exists(place)

    def _publish(self, staged: str, to: str) -> bool:
        """Renames a folder to its place; False if another one is there."""
        fs, target = self._fs(to)
        fs.mkdirs(target.getParent())
        _, source = self._fs(staged)
        if fs.exists(target) or not fs.rename(source, target):
            fs.delete(source, True)
            return False
        # Of two writers at once the second one's folder ends up inside the first one's, where nobody looks.
        inside = self.spark._jvm.org.apache.hadoop.fs.Path(target, source.getName())
        if fs.exists(inside):
            fs.delete(inside, True)
            return False
        return True

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch of changes (source, lang, tokenizer, docs, tokens); False if it was committed before."""
        if self.has(batch_id):
            return False
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        summed = changes.groupBy(*KEYS).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))
        summed.where("docs <> 0 or tokens <> 0").write.parquet(staged)
        if not self._publish(staged, self._folder(batch_id)):
            return False
        if len(self._open()[2]) >= self.compact_every:
            self.compact()
        return True

    def _open(self) -> tuple[int, str | None, list[str]]:
        """The number and folder of the last snapshot, and the committed batches that it doesn't contain."""
        number = max((int(n) for n in self._names("snapshots")), default=0)
        batches = self._names("committed")
        if not number:
            return 0, None, batches
        last = f"{self.path}/snapshots/{number:012d}"
        held = {r[0] for r in self.spark.read.schema("batch string").parquet(f"{last}/batches").collect()}
        return number, last, [b for b in batches if b not in held]

    def _sums(self, last: str | None, batches: list[str]) -> DataFrame:
        files = [f"{last}/sums/part-*"] * bool(last)
        for b in batches:
            fs, place = self._fs(f"{self.path}/committed/{b}/part-*")
            files += [place.toString()] * bool(len(fs.globStatus(place) or ()))
        found = self.spark.read.schema(DELTAS).parquet(*files) if files else self.spark.createDataFrame([], DELTAS)
        return found.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")

    def compact(self) -> bool:
        """Publishes the totals as the next snapshot; False if another writer has done so, which is as good."""
        number, last, batches = self._open()
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        self._sums(last, batches).write.parquet(f"{staged}/sums")
        held = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        if last:
            held = held.union(self.spark.read.schema("batch string").parquet(f"{last}/batches"))
        held.write.parquet(f"{staged}/batches")
        return self._publish(staged, f"{self.path}/snapshots/{number + 1:012d}")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) of what is there; groups that sum up to nothing are left out."""
        _, last, batches = self._open()
        return self._sums(last, batches).select(*KEYS, F.col("docs").alias("n_docs"), F.col("tokens").alias("n_tokens"))
