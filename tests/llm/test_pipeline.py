"""The pipeline's stages against plain versions of them."""

import sys
from collections import defaultdict

import corpus_pipeline
from trailmark.llm import packing, pii, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "pii", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    left = docs.collect()
    if network is not None:
        score = toxicity.Scorer(network).score
        left = [r for r in left if score(r.text or "") < 0.5]
    prints = {r.doc_id: simhash.fingerprint(r.text or "") for r in left}
    kept = []
    for r in sorted(left, key=lambda r: r.doc_id):  # smallest id of each component
        group, todo = {r.doc_id}, [r.doc_id]
        while todo:
            x = todo.pop()
            for y in prints:
                if y not in group and ((prints[x] ^ prints[y]) % (1 << 64)).bit_count() <= 2:
                    group.add(y)
                    todo.append(y)
        if r.doc_id == min(group):
            kept.append(r)
    texts = {r.doc_id: pii.redact_text(r.text or "") for r in kept}
    want = {(r.doc_id, r.piece, r.ids_crc32) for r in packing.pieces(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    got = corpus_pipeline.run(spark, SF)
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in got.collect()} == want
    held = defaultdict(int)
    for r in got.collect():
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 4096


def test_columns_and_odd_rows(spark, docs_of):
    rows = docs_of([(1, "write to a@b.org now"), (2, None), (None, "x y"), (3, ""), (3, "")])
    docs = rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == rows.columns and docs.dtypes == rows.dtypes, name
    got = {(r.doc_id, r.text, r.n_chars) for r in docs.collect()}
    assert got == {(1, "write to <email> now", 20), (2, None, 0), (None, "x y", 3)}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows.limit(0), SF).count() == 0


def test_core_library_does_not_import_the_subpackage():
    import subprocess
    code = "import sys, trailmark.cli, trailmark.plans.events, trailmark.streaming; " \
           "sys.exit(any(m.startswith('trailmark.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code]).returncode == 0
