import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from lathe.llm import recurrent_lm as lm

SF = "/root/testdata/sf0.01"


def tokens(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})), lm.END]


def vocabulary(k=2000):
    return lm.Vocabulary([f"w{i}" for i in range(k)], np.arange(k, 0, -1), k * (k + 1) // 2 + 500, k + 300)


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    v = vocabulary()
    p = {k: a.astype(np.float64) for k, a in lm.start(v).items()}
    ranks = rng.integers(0, 2001, (6, 5))
    ranks[:, :2] = rng.integers(0, 64, (6, 2))
    enter, first = v.enter[ranks], rng.random((6, 5)) < 0.2
    first[0] = True
    run = lambda: lm.window_gradient(p, v, ranks, enter, first, np.zeros((5, lm.H)))
    grads = run()[1]
    for k in p:
        at = [(int(enter[t, b]), int(rng.integers(0, 3 * lm.H))) for t, b in ((0, 1), (2, 3))] if k == "x" else [
            tuple(rng.integers(0, d) for d in p[k].shape) for _ in range(4)]
        for i in at:
            old = p[k][i]
            p[k][i] = old + 1e-2
            up = -run()[0].sum()
            p[k][i] = old - 1e-2
            down = -run()[0].sum()
            p[k][i] = old
            assert abs((up - down) / 2e-2 - grads[k][i]) < 2e-3


def test_probabilities_add_up_and_state_is_carried():
    v = vocabulary()
    p = lm.unflat(lm.flat(lm.start(v)))
    every = np.arange(2001)
    h = np.tile(np.random.default_rng(1).standard_normal((1, lm.H)).astype(np.float32), (2001, 1))
    lp, _ = lm.outputs(p, h, v.cls, v.place, v.inside)
    assert abs(np.exp(lp).sum() - 1) < 1e-3
    docs = [v.read(" ".join(f"w{(i * k) % 2100}" for i in range(n)))[:2] for k, n in ((3, 90), (7, 5), (11, 0), (5, 33))]
    got = lm.score_block(p, v, docs)
    for (ranks, enter), total in zip(docs, got, strict=True):
        state, want = np.zeros((1, lm.H), np.float32), 0.0
        for r, e in zip(ranks, enter, strict=True):
            want += lm.outputs(p, state, v.cls[[r]], v.place[[r]], v.inside[[r]])[0][0]
            state, _ = lm.step(p, np.array([e]), state)
        assert abs(want - total) < 1e-3 * max(1, abs(want))


def test_query_against_plain_counts_and_held_out_likelihood(spark):
    docs = [(r.doc_id, tokens(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    c = Counter(w for i, ws in docs if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in lm.op7_recurrent_lm(spark, SF).collect()}
    assert len(got) == len(docs)
    for i, ws in docs:
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(r.base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) < 1e-6 * max(1, len(ws))
    out = [got[i] for i, _ in docs if held[i]]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_small_vocabulary_reaches_rare_words_by_the_join(spark, monkeypatch):
    rows = [(i, "the cat sat on the mat " * 3 + f"word{i % 7}") for i in range(60)]
    rows += [(100, None), (101, ""), (None, "The CAT"), (5, rows[5][1]), (102, "unseen\x85word here"), (103, "the " * 30_000)]
    df = spark.createDataFrame([(*r, 1.0, True) for r in rows], "doc_id long, text string, score double, held_out boolean")
    a = {(r.doc_id, r.n_tokens): r for r in lm.score_documents(df).collect()}
    monkeypatch.setattr(lm, "TABLED", 3)
    b = {(r.doc_id, r.n_tokens): r for r in lm.score_documents(df).collect()}
    assert set(a) == set(b) and len(lm.score_documents(df).collect()) == len(rows)
    for k in a:
        assert a[k].n_known == b[k].n_known and abs(a[k].base_score - b[k].base_score) < 1e-6 * k[1]
        assert all(math.isfinite(x.score) and x.score <= 0 for x in (a[k], b[k]))
    assert a[100, 1].n_tokens == 1 and (101, 1) in a
    assert lm.score_documents(df.limit(0)).count() == 0
    alone = lm.score_documents(df.where("crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")).collect()
    assert alone and all(r.train_tokens == 0 and r.base_score == 0 and r.n_known == 0 for r in alone)


ODD = ["", " ", "\t A  b\x0b\x0c\r\nC ", "x", "É ÀB\u0130k", "a\x1cb c\x85d\xa0e\u3000f\u2028g", "\x00 \x00B", "w3 W3 w1999 w2000 äöüß",
       "Mw1\u20ac w1", "\n\n", "w0 " * 70]


def test_all_texts_of_a_piece_are_read_at_once():
    words, size = lm.split_words(pa.array(ODD))
    assert words.to_pylist() == [w for t in ODD for w in tokens(t)] and size.tolist() == [len(tokens(t)) for t in ODD]
    assert [*lm.split_words(pa.array(ODD, pa.large_string()).slice(2))[1]] == [len(tokens(t)) for t in ODD[2:]]
    assert [len(x) for x in lm.split_words(pa.array([], pa.string()))] == [0, 0]
    v = vocabulary()
    rank = {f"w{i}": i for i in range(2000)}
    ranks, enter, size, rare, n_rare = v.read_all(pa.array(ODD))
    every = [w for t in ODD for w in tokens(t)]
    assert ranks.tolist() == [rank.get(w, 2000) for w in every] and rare.to_pylist() == [w for w in every if w not in rank]
    border = lm.CLASSES * lm.WIDTH
    assert enter.tolist() == [rank[w] if rank.get(w, border) < border else
                              border + zlib.crc32(w[-3:].encode()) % lm.SUFFIXES for w in every]
    assert n_rare.tolist() == [sum(w not in rank for w in tokens(t)) for t in ODD]


def test_blocks_end_at_the_document_that_fills_them(monkeypatch):
    monkeypatch.setattr(lm, "TOKENS", 40)
    monkeypatch.setattr(lm, "PIECE", 100)
    monkeypatch.setattr(lm, "SIDE", 3)
    texts = [" ".join(f"w{(i * k) % 2100}" for i in range(n)) for k, n in zip(range(3, 43), [7, 0, 30, 90, 1, 39, 0, 5] * 5, strict=True)]
    v, calls, split = vocabulary(), [], lm.split_words
    monkeypatch.setattr(lm, "split_words", lambda t: calls.append(len(t)) or split(t))
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[a:b], pa.string())], names=["t"]) for a, b in ((0, 17), (17, 17), (17, 40))]
    got = list(lm._blocks(iter(batches), v, 0))
    assert sum(calls) == 40 and len(calls) < 40
    want, n = [[]], 0
    for t in texts:
        if n >= 40:
            want.append([])
            n = 0
        want[-1].append(t)
        n += len(tokens(t))
    assert [[x for r in rows for x in r.column(0).to_pylist()] for rows, *_ in got] == want
    p = lm.unflat(lm.flat(lm.start(v)))
    for (_, docs, rare, n_rare), some in zip(got, want, strict=True):
        alone = [v.read(t) for t in some]
        assert all((a == b).all() for d, w in zip(docs, alone, strict=True) for a, b in zip(d, w[:2], strict=True))
        assert pa.concat_arrays(rare).to_pylist() == [x for w in alone for x in w[2]]
        assert np.concatenate(n_rare).tolist() == [len(w[2]) for w in alone]
        each = [lm.score_block(p, v, [w[:2]])[0] for w in alone]
        assert np.allclose(lm.score_block(p, v, docs), each, rtol=1e-5)


def test_counts_of_odd_texts(spark):
    df = spark.createDataFrame([(0, t) for t in [*ODD, *ODD, None]], "doc_id long, text string")
    docs = df.select(lm.text_or_empty("text").alias("_text"), lm.F.lit(False).alias("_held"))
    got = {r.word: r.c for r in lm.counted(docs).collect()}
    assert got == Counter(w for t in [*ODD, *ODD, None] for w in tokens(t))
