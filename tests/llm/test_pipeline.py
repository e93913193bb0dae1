"""The pipeline stage by stage against brute force, each on its own input."""

from collections import Counter, defaultdict

import corpus_pipeline as cp
from lathe.llm import mixing as mx
from lathe.llm import sentence_pieces as sp
from lathe.session import materialize
from test_mixing import water, words
from test_near_dedup import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "mixing", "sentence_pieces"] and cp.ORACLE_SQL is None
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = materialize(cp.quality_stage(spark, docs, SF), "t")
    assert good.columns == COLUMNS
    have = {r.doc_id for r in good.collect()}
    assert sum(i in have for i, x in labels.items() if x == 1) >= 0.97 * sum(labels.values())
    once = materialize(cp.near_dedup_stage(spark, good, SF), "t")
    assert once.columns == COLUMNS
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert sorted(r.doc_id for r in once.collect()) == sorted({c if n else i for i, n, c in brute(rows)})
    mix = materialize(cp.mixing_stage(spark, once, SF), "t")
    assert mix.columns == COLUMNS
    sizes, taken = defaultdict(int), defaultdict(int)
    texts = {}
    for r in once.collect():
        sizes[r.source] += words(r.text)
        texts[r.doc_id] = r.text
    copies = Counter()
    for r in mix.collect():
        taken[r.source] += words(r.text)
        copies[r.doc_id] += 1
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    want = water(sizes)
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes) and max(copies.values()) <= mx.CAP + 1
    ids = cp.sentence_pieces_stage(spark, mix, SF).collect()
    pieces = sp.Pieces(sp.production_model())
    assert Counter((r.doc_id, sp.decode(r.ids, pieces)) for r in ids) == Counter((r.doc_id, r.text) for r in mix.collect())
    assert all(r.lossless for r in ids)
    whole = cp.run(spark, SF)
    assert Counter((r.doc_id, tuple(r.ids)) for r in whole.collect()) == Counter((r.doc_id, tuple(r.ids)) for r in ids)


def test_empty_table_passes_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
