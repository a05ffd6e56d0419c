"""The registered queries over sf0.001: against their SQL, or against brute force where there is none."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
from terrasync.llm import queries, secret_scan

from .test_mixing import targets
from .test_secret_scan import brute as secrets_of
from .test_simhash import components, near, plain

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and dict(got.dtypes) == dict(want.dtypes)
    assert sorted(map(tuple, got[columns].astype(str).to_numpy())) == sorted(map(tuple, want[columns].astype(str).to_numpy()))


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_op1(spark, docs):
    got = {r.doc_id: r for r in queries.op1_secret_scan(spark, SF).collect()}
    assert set(got) == {d.doc_id for d in docs}
    for d in docs:
        r, base = got[d.doc_id], secrets_of(d.text or "", secret_scan.BASE_RULES)
        kinds = ["assign", "access", "hex"]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        text = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_op4(spark, docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts, by = defaultdict(list), defaultdict(list)
    for r in queries.op4_packing(spark, SF).collect():
        parts[r.doc_id].append(r)
        by[r.sequence_id].append((r.offset, r.length))
    for d in docs:
        ids, at = np.array([*t.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(parts[d.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    full = []
    for ps in by.values():
        ps.sort()
        assert [o for o, _ in ps] == [0, *np.cumsum([n for _, n in ps])[:-1]]
        full.append(sum(n for _, n in ps))
    assert max(full) <= 1024 and sum(1024 - f for f in full) < 1024


def test_op5(spark, docs):
    got = queries.op5_source_mix(spark, SF).collect()
    size = {d.doc_id: len((d.text or "").encode().split()) for d in docs}
    assert {r.doc_id: r["size"] for r in got} == size
    sizes, taken = Counter(), Counter()
    for d in docs:
        sizes[d.source] += size[d.doc_id]
    want = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    largest = {s: max(size[d.doc_id] for d in docs if d.source == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 for s in sizes)  # ten documents a source here


def test_op9(spark, docs):
    got = {r.doc_id: r for r in queries.op9_simhash_near_dedup(spark, SF).collect()}
    docs = sorted(docs, key=lambda d: d.doc_id)
    fps = [plain(d.text) for d in docs]
    comp = components(near(fps), range(len(docs)))
    for i, d in enumerate(docs):
        assert got[d.doc_id].fingerprint == f"{fps[i]:016x}" and got[d.doc_id].component_id == docs[comp[i]].doc_id


def test_op12(spark, docs):
    got = {r.doc_id: r for r in queries.op12_toxicity(spark, SF).collect()}
    assert set(got) == {d.doc_id for d in docs}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for i, r in got.items())
    clean = [got[i].predicted for i, t in toxic.items() if t == 0 and got[i].held_out]
    assert np.mean(clean) < 0.05  # few labels are there at this size; accuracy is tested in test_toxicity.py


def test_op13(spark):
    got = queries.op13_embedding_whitening(spark, SF).toPandas()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding and all(c is not None and np.isfinite(c) for c in r.embedding)]
    x = np.floor(1024 * np.array([v for _, v in rows], float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    assert len(got) == 8 * n and (got.identity_error < 1e-9).all() and list(got.columns) == "vec_id component n deviation whitened explained identity_error".split()
    for k in range(8):
        one = got[got.component == k + 1].set_index("vec_id").loc[[i for i, _ in rows]]
        want = y @ u[:, -1 - k] / np.sqrt(e[-1 - k])
        assert np.allclose(np.abs(one.whitened), np.abs(want), atol=1e-6) and np.allclose(one.explained, e[-1 - k] / e.sum())
        assert one.deviation.tolist() == ((n * x - s) ** 2).sum(axis=1).tolist()


def test_pipeline_runs(spark, docs):
    got = entry.queries()["pipeline"](spark, SF).toPandas()
    assert set(got.doc_id) <= {d.doc_id for d in docs} and len(got) and isinstance(got, pd.DataFrame)
