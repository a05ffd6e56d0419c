import corpus_pipeline
from terrasync.llm import quality, secret_scan, simhash
from terrasync.llm.common import written


def test_stages(spark, tmp_path, odd, odd_rows):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "secrets", "mix", "pack"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs = written(stage(spark, docs, str(tmp_path)), f"test-{name}")
        if name != "pack":
            assert docs.columns == odd.columns
    good = [r for r in odd_rows if quality.passes(quality.Document(r[1]), quality.RULES)]
    assert seen["quality_rules"].count() == len(good)
    fps = {simhash.fingerprint(r[1]) for r in good}
    assert seen["near_dedup"].count() <= len(fps) + 1
    assert not any(secret_scan.find([r.text for r in seen["secrets"].collect()], secret_scan.RULES[1:]))  # marks hold no secrets
    assert {r.doc_id for r in seen["mix"].collect()} <= {r.doc_id for r in seen["secrets"].collect()}
    assert seen["pack"].select("doc_id").distinct().count() == seen["mix"].select("doc_id").distinct().count()
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(str, seen["pack"].select("doc_id", "start", "length", "ids_crc32").collect()))
