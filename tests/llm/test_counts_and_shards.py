import re
import shutil
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from terrasync.llm import sharding, token_counts
from terrasync.llm.common import shared_dir


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def test_rollup(spark, odd, odd_rows, none, tmp_path):
    rollup = token_counts.Rollup(spark, f"file://{tmp_path}/r")
    assert totals(rollup) == {}
    counts = token_counts.counted(odd)
    assert rollup.commit("load", token_counts.inserts(counts)) and not rollup.commit("load", token_counts.inserts(counts))
    want = defaultdict(lambda: [0, 0])
    for r in odd_rows:
        for name, pattern in token_counts.TOKENIZERS.items():
            x = want[r[3], r[2], name]
            x[0] += 1
            x[1] += len(re.findall(pattern, r[1] or ""))
    assert totals(rollup) == {k: tuple(v) for k, v in want.items()}
    rollup.commit("nothing", token_counts.inserts(token_counts.counted(none)))
    half = counts.where("id % 2 = 0")
    rollup.commit("out", token_counts.deletes(half))
    rollup.commit("back", token_counts.inserts(half))
    assert totals(rollup) == {k: tuple(v) for k, v in want.items()}
    old = counts.where("source = 's1'")
    rollup.commit("moved", token_counts.revisions(old, old.withColumns({"source": old["lang"], "tokens": old["tokens"] * 2})))
    got = totals(rollup)
    assert not any(k[0] == "s1" for k in got)
    assert sum(v[1] for v in got.values()) == sum(v[1] for v in want.values()) + sum(v[1] for k, v in want.items() if k[0] == "s1")
    rollup.commit("all out", token_counts.deletes(counts.where("source <> 's1' or source is null")).unionByName(token_counts.deletes(old.withColumns({"source": old["lang"], "tokens": old["tokens"] * 2}))))
    assert totals(rollup) == {}


def test_writers_at_once(spark, odd, tmp_path, monkeypatch):
    """A second writer that saw no batch before its rename adds nothing, and neither does what it may leave inside."""
    rollup = token_counts.Rollup(spark, f"file://{tmp_path}/r")
    changes = token_counts.inserts(token_counts.counted(odd))
    assert rollup.commit("load", changes)
    want = totals(rollup)
    (folder,) = (tmp_path / "r" / "committed").iterdir()
    shutil.copytree(folder, folder / "second")
    assert totals(rollup) == want
    monkeypatch.setattr(rollup, "has", lambda _: False)
    assert not rollup.commit("load", changes) and totals(rollup) == want


def test_shards(odd, odd_rows, none):
    for limit in (1 << 30, 20_000, 3000, 1):
        got = sharding.shard_documents(odd, limit).collect()
        assert len(got) == len(odd_rows)
        shards = defaultdict(list)
        for r in got:
            shards[r.shard, r.page].append(r)
        names = {r.shard for r in got}
        assert not any(a != b and b.startswith(a) for a in names for b in names)  # no bucket lies within another
        for rows in shards.values():
            size = sum(r.n_bytes for r in rows)
            assert {r.shard_bytes for r in rows} == {size} and (size <= limit or len(rows) == 1)
        # Only buckets that were too large were split: a shard's sibling and it exceed the limit together.
        for s in names - {""}:
            family = [r for r in got if r.shard.startswith(s[:-1])]
            assert sum(r.n_bytes for r in family) > limit and len(family) > 1
        assert Counter(str(r.doc_id) for r in got) == Counter(str(r[0]) for r in odd_rows)
    assert sharding.shard_documents(none).collect() == []


def test_overflow_pages(spark):
    """A third of the rows have no id: their pages hold to the limit, whatever partitions they come from."""
    rows = [(None if i % 3 == 0 else i, "x" * (i % 50)) for i in range(900)]
    for parts in (1, 7):
        got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts), 500).collect()
        assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((i, len(t)) for i, t in rows)
        pages = defaultdict(int)
        for r in got:
            pages[r.shard, r.page] += r.n_bytes
        assert all(r.shard_bytes == pages[r.shard, r.page] <= 500 for r in got)
        full = {r.page for r in got if r.doc_id is None}
        assert full == set(range(len(full))) and len(full) > 20


def test_written_shards(spark, odd, tmp_path):
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    sharding.write_shards(docs, f"file://{tmp_path}/s", 5000)
    back = spark.read.parquet(f"file://{tmp_path}/s")
    assert back.count() == docs.count() and back.select("shard").distinct().count() > 3
    assert shared_dir(spark)


def test_written_shards_of_repeated_ids(spark, odd, odd_rows, none, tmp_path):
    """Rows that share an id, or have none, are written once each, and pages hold to the limit."""
    sharding.write_shards(odd.withColumn("page", F.lit("mine")), f"file://{tmp_path}/odd", 3000)
    back = spark.read.parquet(f"file://{tmp_path}/odd").collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter(r[:2] for r in odd_rows)

    rows = [(None if i % 3 == 0 else i % 7, f"{i:03}" + "x" * (i % 5)) for i in range(600)] + [(None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    sharding.write_shards(docs, f"file://{tmp_path}/many", 200)
    back = spark.read.parquet(f"file://{tmp_path}/many").collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter(rows)
    pages = defaultdict(int)
    for r in back:
        pages[r.shard, r.page] += len(r.text or "")
    assert max(pages.values()) <= 200 and len(pages) > 12
    sharding.write_shards(none, f"file://{tmp_path}/none")


def test_snapshots(spark, odd, odd_rows, tmp_path):
    """Totals stay what they are through snapshots, batches stay known, and reading leaves compacted ones alone."""
    rollup = token_counts.Rollup(spark, f"file://{tmp_path}/r", compact=2)
    plain = token_counts.Rollup(spark, f"file://{tmp_path}/p", compact=1000)
    counts = token_counts.counted(odd)
    for i in range(5):
        changes = (token_counts.deletes if i == 2 else token_counts.inserts)(counts.where(f"coalesce(id, 0) % 5 <= {i}"))
        assert rollup.commit(f"b{i}", changes) and plain.commit(f"b{i}", changes)
        assert totals(rollup) == totals(plain)
    number, last, open_ = rollup._open()
    assert number == 2 and len(open_) == 1
    assert not rollup.commit("b0", token_counts.inserts(counts)) and totals(rollup) == totals(plain)
    for folder in (tmp_path / "r" / "committed").iterdir():  # what a snapshot holds isn't read again
        if folder.name not in open_:
            shutil.rmtree(folder)
    assert totals(rollup) == totals(plain)


def test_op7_counts_real_tokens(spark):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    from terrasync.llm import packing, queries

    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "labels"))
    toxic = {r.doc_id for r in labels if r.toxic == 1}
    poor = {r.doc_id for r in labels if r.quality == 0 and r.toxic == 0}
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other = packing.encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), None)
    want = defaultdict(lambda: [0, 0])
    for d in docs:
        if d.doc_id not in toxic:
            english = d.lang == "en"
            n = len(first.encode(d.text or "", add_special_tokens=False).ids if english else other(d.text or ""))
            x = want["quarantine" if d.doc_id in poor else d.source, d.lang, "byte_bpe_50k" if english else "byte_bpe_multi_50k"]
            x[0] += 1
            x[1] += n
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in queries.op7_token_counts(spark, sf).collect()}
    assert got == {k: tuple(v) for k, v in want.items()} and len({k[2] for k in got}) == 2
    assert tiktoken and other(" " * 1_200_000)


def test_rollup_against_sql(spark):
    import duckdb

    from terrasync.llm import queries

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    (name,) = queries.MORE_QUERIES
    got = queries.MORE_QUERIES[name](spark, "/root/testdata/sf0.001")
    want = con.execute(queries.MORE_ORACLES[name]).df()
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.itertuples(index=False, name=None)))
