import math
from collections import Counter

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lathe.llm import sentence_pieces as sp

SF = "/root/testdata/sf0.001"
MODEL = sp.production_model()
LIB = sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def ids_of(texts, keys=None, theta=1.0):
    lat = sp.Lattices(sp.Pieces(MODEL, theta))
    flat, n = sp.encode(texts, sp.key_seeds(keys or list(range(len(texts)))), lat)
    ends = [0, *np.cumsum(n)]
    return [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)], lat.pieces


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab e\n ▁\x00é中")), max_size=40),
                max_size=4))
def test_decoding_is_lossless(texts):
    got, pieces = ids_of(texts)
    assert [sp.decode(i, pieces) for i in got] == texts


def test_the_library_decodes_sampled_ids():
    texts = ["Hello world, this is a test.", "two  spaces\nand a line", " lead and trail ", "déjà vu 中文 🙂", "a" * 700]
    got, _ = ids_of(texts)
    assert [LIB.decode(i) for i in got] == texts


def segmentations(text, pieces):
    if not text:
        yield (), 1.0
    for e in range(1, len(text) + 1):
        hit = pieces.piece.get(text[:e])
        if hit:
            for rest, w in segmentations(text[e:], pieces):
                yield (hit[0], *rest), w * hit[1]


def test_tables_of_new_units_are_built_in_little_memory():
    import tracemalloc

    lat = sp.Lattices(sp.Pieces(MODEL))
    units = [f"{sp.MARK}word{i:07d}" for i in range(20_000)]
    tracemalloc.start()
    try:
        lat.add_all(units)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(lat.index) == len(units) and peak < 60e6, peak


def test_ids_do_not_depend_on_the_tables_kept(monkeypatch):
    texts = [f"one {i} other{i * 7} words, and 中文{i} {'unspaced' * 6}{i}" for i in range(200)]
    want, pieces = ids_of(texts)
    monkeypatch.setattr(sp, "TABLED_AT_ONCE", 50)
    monkeypatch.setattr(sp, "EDGES", 100)
    lat, seeds = sp.Lattices(pieces), sp.key_seeds(list(range(200)))
    for i in range(0, 200, 20):
        flat, n = sp.encode(texts[i:i + 20], seeds[i:i + 20], lat)
        assert flat.tolist() == [x for ids in want[i:i + 20] for x in ids] and n.tolist() == list(map(len, want[i:i + 20]))


def test_draws_follow_the_posterior():
    word = "there"
    n = 20_000
    got, pieces = ids_of([word] * n, list(range(n)))
    want = dict(segmentations(sp.MARK + word, pieces))
    total = sum(want.values())
    seen = Counter(map(tuple, got))
    # all draws are segmentations, and each one expected a few dozen times is drawn
    assert set(seen) <= set(want) and {s for s, w in want.items() if w / total * n >= 30} <= set(seen) and len(seen) >= 4
    for s, w in want.items():
        p = w / total
        assert abs(seen[s] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


def test_large_theta_gives_the_best_segmentation():
    got, pieces = ids_of(["therefore"], theta=15.0)
    plain = sp.Pieces(MODEL)
    best = max(segmentations(sp.MARK + "therefore", plain), key=lambda x: x[1])
    assert tuple(got[0]) == best[0]


def test_same_key_same_draw_in_any_batch():
    texts = ["the weather is nothing like the forecast " * 5] * 3
    together, _ = ids_of(texts, [7, 8, 7])
    alone, _ = ids_of(texts[:1], [7])
    assert together[0] == together[2] == alone[0] != together[1]


def test_long_unit_does_not_underflow():
    text = "".join(chr(97 + i * i % 26) for i in range(30_000))
    got, pieces = ids_of([text])
    assert sp.decode(got[0], pieces) == text and len(got[0]) < 25_000


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " "), (None, "no key"), (5, "twice"), (5, "twice"), (6, "word " * 20_000), (7, "▁\x00▁")]
    df = spark.createDataFrame([(*r, [1], True) for r in rows], "doc_id long, text string, ids array<int>, lossless boolean")
    got = sp.encode_rows(df, MODEL)
    out = got.collect()
    assert len(out) == len(rows) and all(r.lossless for r in out)
    by = {r.doc_id: r for r in out}
    assert by[1].n_tokens == by[2].n_tokens == 0 and by[6].n_chars == 100_000
    back = {r.doc_id: r.text for r in sp.decode_rows(got, MODEL).collect()}
    assert back == {k: t or "" for k, t in rows}
    assert sp.encode_rows(df.limit(0), MODEL).count() == 0


def test_query_is_lossless_and_repeats(spark):
    a = sp.op2_sentence_pieces(spark, SF)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    one = {r.doc_id: (r.ids, r.n_chars, r.lossless) for r in a.collect()}
    two = {r.doc_id: (r.ids, r.n_chars, r.lossless) for r in sp.op2_sentence_pieces(spark, SF).repartition(3).collect()}
    assert one == two and len(one) == len(texts)
    assert all(x[2] and x[1] == len(texts[k]) for k, x in one.items())
    some = dict(list(texts.items())[:20])
    assert all(LIB.decode(one[k][0]) == t for k, t in some.items() if "▁" not in t)
