"""Packing documents into windows of tokens by deficit round-robin over source queues.

Every source is a queue of its documents' tokens. A round gives each queue a quantum, its target share of one
window; the queue sends the whole tokens of the quanta it was given and carries the rest, its deficit, into
the next round. As no queue runs empty before its end, what it has sent after r rounds has a closed form,
floor(r * quantum) or all it holds, and so has the place of each round in the one stream that is cut into
windows. Deficits thus carry across windows and partitions without a sequential run: prefix sums over
(queue, partition) tell where a partition's tokens stand in their queue, and each task places its own
documents. A window holds each source's share but for one token; what earlier rounds left over, less than
one token for each queue, moves the edge between windows within the largest queues, which go first in
a round. Only the last window is padded.

A source of less than one token a window can't be in every window. These sources share one queue, in the
order of their documents; where even that has less than one token a window it sends PACKET tokens at once. So
there are at most window + 2 queues, however many sources there are. Sources with a target of 0 come last.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import written

WINDOW, PACKET, END_ID = 1024, 256, 0
#: Characters that tiktoken takes at once where it has given up on a whole text.
LONGEST = 100_000
#: Documents that a task looks at together, and pieces that it returns at once; numbers it holds while it places pieces.
TOGETHER, AT_ONCE, NUMBERS = 512, 1024, 1 << 20


@lru_cache(maxsize=4)
def encoder(rank_path: str, json_path: str | None):
    """A function text -> ids, from the two files of one vocabulary.

    tiktoken reads the ranks and gives the ids of tokenizers in a fifth of the time. tokenizers itself, from
    the JSON file, encodes texts that hold an added token such as <|endoftext|>, which has an id of its own,
    and runs of about a million spaces, where tiktoken's pattern matcher gives up. A vocabulary without a JSON
    file has no added tokens, and such runs are cut there.
    """
    import public_tokenizers
    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    added = []
    if json_path:
        with open(json_path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f)["added_tokens"]]

    @lru_cache(maxsize=1)
    def slow():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(json_path)

    def encode(text: str) -> list[int]:
        if not any(t in text for t in added):
            try:
                return fast(text)
            except BaseException as e:  # the matcher's panic isn't an Exception
                if type(e).__name__ != "PanicException":
                    raise
                if not json_path:
                    return [i for k in range(0, len(text), LONGEST) for i in fast(text[k : k + LONGEST])]
        return slow().encode(text, add_special_tokens=False).ids

    return encode


def default_files() -> tuple[str, str]:
    """The vocabulary of byte_bpe_50k.json, as ranks and as JSON."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of TOGETHER rows at most, so that a task holds few texts at a time; none is empty."""
    for b in batches:
        for k in range(0, b.num_rows, TOGETHER):
            yield b.slice(k, TOGETHER)


def tokenize(docs: DataFrame, files: tuple[str, str], id_col: str, source_col: str, text_col: str) -> DataFrame:
    """id, source, part (of the input), inside (tokens of the source ahead of the row in that part), n and ids
    (unsigned 16-bit, little-endian) with END_ID at the end."""
    one = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), docs[text_col].alias("text"), F.spark_partition_id().cast("long").alias("part"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*files)
        ahead: dict[object, int] = {}
        for b in _slices(batches):
            made = [np.array([*encode(t or ""), END_ID], "<u2") for t in b.column("text").to_pylist()]
            inside = []
            for source, x in zip(b.column("source").to_pylist(), made, strict=True):
                inside.append(ahead.get(source, 0))
                ahead[source] = inside[-1] + len(x)
            columns = [b.column("id"), b.column("source"), b.column("part"), pa.array(inside, pa.int64()), pa.array(map(len, made), pa.int64()), pa.array([x.tobytes() for x in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "source", "part", "inside", "n", "ids"])

    kinds = {f.name: f.dataType.simpleString() for f in one.schema}
    return one.mapInArrow(each, f"id {kinds['id']}, source {kinds['source']}, part bigint, inside bigint, n bigint, ids binary")


def _before(value: str, keys: tuple[str, ...], *by: str) -> Column:
    return F.coalesce(F.sum(value).over(W.partitionBy(*keys).orderBy(*by).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


#: Queues without a number of their own: sources that share one, and sources that come last.
SHARED, LAST = -1, -2


class Rounds:
    """The places of queues' tokens in the stream: quanta, tokens and packets of the queues in order, then
    how many tokens come last. All of a queue is sent when its tokens are."""

    def __init__(self, quanta: list[float], tokens: list[int], packets: list[int]):
        self.quanta, self.packets = np.array(quanta, np.float64), np.array(packets, np.float64)
        self.tokens = np.array(tokens, np.int64)

    def sent(self, rounds: np.ndarray, queue: np.ndarray | None = None) -> np.ndarray:
        """Tokens sent before each round, by the queue given for it or (a column each) by all queues."""
        r = rounds.astype(np.float64)
        q, p, t = (self.quanta, self.packets, self.tokens) if queue is None else (self.quanta[queue], self.packets[queue], self.tokens[queue])
        r = r[:, None] if queue is None else r
        return np.minimum(np.floor(r * q / p) * p, t).astype(np.int64)

    def round_of(self, token: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """The round that sends each token of a queue."""
        q, p = self.quanta[queue], self.packets[queue]
        r = np.ceil((np.floor(token / p) + 1) * p / q).astype(np.int64) - 1
        for _ in range(2):  # floats may be off by one round at its edges
            r -= self.sent(r, queue) > token
            r += self.sent(r + 1, queue) <= token
        return r

    def pieces(self, queue: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cuts stretches of n > 0 tokens from start on by rounds: (owner, offset in it, length, place in the stream)."""
        first, last = self.round_of(start, queue), self.round_of(start + n - 1, queue)
        # Rounds that a queue leaves out are as many as its quantum is small, so there packets are counted.
        packed = self.packets[queue] > 1
        unit = self.packets[queue].astype(np.int64)
        many = np.where(packed, (start + n - 1) // unit - start // unit, last - first) + 1
        owner = np.repeat(np.arange(len(n)), many)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        of = queue[owner]
        r = first[owner] + k
        if packed.any():
            at = np.maximum(start[owner], (start[owner] // unit[owner] + k) * unit[owner])
            r = np.where(packed[owner], self.round_of(np.minimum(at, (start + n - 1)[owner]), of), r)
        low, high = np.maximum(self.sent(r, of), start[owner]), np.minimum(self.sent(r + 1, of), (start + n)[owner])
        if packed.any():  # packets of one round are one piece
            low = np.where(packed[owner], np.maximum(low, at), low)
            high = np.where(packed[owner], np.minimum(high, (start[owner] // unit[owner] + k + 1) * unit[owner]), high)
        keep = high > low
        owner, of, r, low, high = (x[keep] for x in (owner, of, r, low, high))
        return owner, low - start[owner], high - low, self._places(of, r, low)

    def _places(self, queue: np.ndarray, rounds: np.ndarray, token: np.ndarray) -> np.ndarray:
        out = np.empty(len(rounds), np.int64)
        order = np.argsort(rounds, kind="stable")
        step = max(1, NUMBERS // max(1, len(self.quanta)))
        for a in range(0, len(order), step):
            i = order[a : a + step]
            own, back = np.unique(rounds[i], return_inverse=True)
            before, after = self.sent(own), self.sent(own + 1)
            ahead = np.cumsum(after - before, axis=1) - (after - before)  # of the queues earlier in the round
            base = before.sum(axis=1)
            q = queue[i]
            out[i] = base[back] + ahead[back, q] + token[i] - before[back, q]
        return out


def _queues(per: DataFrame, targets: dict[str | None, float] | None, window: int) -> DataFrame:
    """(source, tokens, quantum) of sources (source, tokens): their targets as tokens of one window."""
    share = F.col("tokens") / F.lit(per.agg(F.sum("tokens")).first()[0] or 1)
    if targets:
        if wrong := [s for s, t in targets.items() if not 0 <= t < float("inf")]:
            raise ValueError(f"targets must be numbers from 0 on: {wrong}")
        wanted = per.sparkSession.createDataFrame([(s, float(t)) for s, t in targets.items()], "w string, wanted double")
        per = per.join(wanted, F.col("source").cast("string").eqNullSafe(F.col("w")), "left")
        share = F.coalesce("wanted", share)
    per = per.select("source", "tokens", share.alias("share"))
    return per.select("source", "tokens", (F.col("share") * window / F.lit(float(per.agg(F.sum("share")).first()[0] or 1))).alias("quantum"))


def layout(rows: DataFrame, targets: dict[str | None, float] | None = None, window: int = WINDOW, packet: int = PACKET) -> tuple[DataFrame, Rounds]:
    """Where the rows (source, part, n) of tokenize() stand: (source, part, queue, base), base being the tokens of
    the queue ahead of the source's in that part; and the rounds. The last queue's tokens come after all rounds.

    targets: a source's share of every window, in proportion; without them, and for sources they don't name, it
    is the source's share of all tokens, at which all queues end together. Where one ends earlier, the others
    fill the windows in their proportions. A target of 0 puts a source's tokens behind all others.
    """
    sums = written(rows.groupBy("source", "part").agg(F.sum("n").alias("sum")), "pack-sums")
    per = written(_queues(sums.groupBy("source").agg(F.sum("sum").alias("tokens")), targets, window), "pack-sources")
    # Quanta sum up to the window, so at most window sources have a token of each.
    own = per.where("quantum >= 1").orderBy(F.desc("quantum"), F.col("source").asc_nulls_last()).limit(window).collect()
    rest = per.where("quantum > 0 and quantum < 1").agg(F.sum("quantum").alias("quantum"), F.sum("tokens").alias("tokens")).first()
    quanta, tokens, packets = ([r.quantum for r in own], [r.tokens for r in own], [1] * len(own))
    if rest.tokens:
        quanta.append(rest.quantum)
        tokens.append(rest.tokens)
        packets.append(1 if rest.quantum >= 1 else packet)
    names = per.sparkSession.createDataFrame([(i, r.source) for i, r in enumerate(own)], f"own int, name {per.schema['source'].dataType.simpleString()}")
    few = F.when(F.col("quantum") > 0, F.lit(SHARED)).otherwise(F.lit(LAST))
    of = per.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name")), "left").select(F.col("source").alias("s"), F.coalesce("own", few).alias("queue"))
    placed = sums.join(of, F.col("source").eqNullSafe(F.col("s"))).select("source", "part", "queue", "sum")
    parts = placed.groupBy("queue", "part").agg(F.sum("sum").alias("total"))
    parts = written(parts.select(F.col("queue").alias("q"), F.col("part").alias("p"), _before("total", ("queue",), "part").alias("base")), "pack-parts")
    inside = placed.withColumn("ahead", _before("sum", ("queue", "part"), "source"))
    bases = inside.join(parts, (F.col("queue") == F.col("q")) & (F.col("part") == F.col("p"))).select("source", "part", "queue", (F.col("base") + F.col("ahead")).alias("base"))
    return written(bases, "pack-bases"), Rounds(quanta, tokens, packets)


def pack(
    docs: DataFrame,
    files: tuple[str, str] | None = None,
    targets: dict[str | None, float] | None = None,
    window: int = WINDOW,
    packet: int = PACKET,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Each token of a document, its end id included, lies in exactly one piece; a sequence's pieces leave no
    gap. A null or empty text is the end id alone; a null source is a source; repeated rows are documents
    of their own; other columns are ignored; an empty table gives an empty result.

    The tokens are written once to the shared folder and not shuffled; sums by (source, partition of the
    input) alone go through the layout.
    """
    tokens = written(tokenize(docs, files or default_files(), id_col, source_col, text_col), "pack-tokens")
    bases, rounds = layout(tokens.select("source", "part", "n"), targets, window, packet)
    bases = bases.toDF("s", "p", "queue", "base")
    met = tokens.join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).select("id", (F.col("base") + F.col("inside")).alias("before"), "queue", "n", "ids")
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    shared, after = len(rounds.quanta) - 1, int(rounds.tokens.sum())

    def placed(before: np.ndarray, queue: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """owner, start, length, place in the stream; pieces that follow one another are one."""
        late = queue == LAST
        owner, start, length, at = rounds.pieces(np.where(queue[~late] == SHARED, shared, queue[~late]), before[~late], n[~late])
        owner = np.concatenate([np.flatnonzero(~late)[owner], np.flatnonzero(late)])
        start, length = np.append(start, np.zeros(late.sum(), np.int64)), np.append(length, n[late])
        at = np.append(at, after + before[late])
        order = np.lexsort((start, owner))
        owner, start, length, at = (x[order] for x in (owner, start, length, at))
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + length[:-1])
        first = np.flatnonzero(new)
        return owner[first], start[first], np.add.reduceat(length, first) if len(first) else length, at[first]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            owner, start, length, at = placed(*(b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("before", "queue", "n")))
            # The stream is cut into windows.
            low, high = at // window, (at + length - 1) // window
            many = high - low + 1
            w = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
            owner, start, length, at = (np.repeat(x, many) for x in (owner, start, length, at))
            begin, end = np.maximum(at, w * window), np.minimum(at + length, (w + 1) * window)
            start, length, off = start + begin - at, end - begin, begin - w * window
            ids = [np.frombuffer(x, "<u2").astype("<u4") for x in b.column("ids").to_pylist()]
            for k in range(0, len(start), AT_ONCE):
                i = slice(k, k + AT_ONCE)
                parts = [ids[o][s : s + m] for o, s, m in zip(owner[i].tolist(), start[i].tolist(), length[i].tolist(), strict=True)]
                of = pa.array(owner[i])
                out = [b.column("id").take(of), pa.array(start[i]), pa.array(length[i]), pa.array(map(zlib.crc32, parts), pa.int64()), b.column("n").take(of), pa.array(w[i]), pa.array(off[i])]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length[i])), pa.int32()), pa.array(np.concatenate(parts).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(out, names + ["ids"] * with_ids)

    schema = f"id {met.schema['id'].dataType.simpleString()}" + "".join(f", {x} bigint" for x in names[1:]) + ", ids array<int>" * with_ids
    return met.mapInArrow(each, schema).withColumnRenamed("id", id_col)
