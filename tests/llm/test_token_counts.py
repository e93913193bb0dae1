import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from lathe.llm import token_counts as tc

SF = "/root/testdata/sf0.001"
SPEC = tc.read_spec(public_tokenizers.path("byte_bpe_50k.json"))
WHOLE = frozenset(tc.prove_whole(SPEC))


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(SPEC)
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_proof_keeps_single_tokens_only():
    assert " the" in WHOLE and "hello" in WHOLE and len(WHOLE) > 40_000
    assert set(library(sorted(WHOLE))) == {1}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab '\t\n\r   \x1c\x85é中9½<|")),
                        max_size=40), max_size=5))
def test_counts_equal_the_library(texts):
    assert tc.count_texts(texts, SPEC, WHOLE) == library(texts)


def test_every_plain_character_alone_and_between_letters():
    chars = [chr(c) for c in range(0x2100) if c and tc._PLAIN.fullmatch(chr(c))]
    texts = [f"a{c}b {c}{c}  {c} 1{c}1 x" for c in chars]
    assert tc.count_texts(texts, SPEC, WHOLE) == library(texts)


def test_edge_cases(spark, monkeypatch):
    texts = [None, "", " ", "a<|endoftext|>b<|endoftext|>", "<|endoftext", "word " * 3000, "x" * 5000, "don't  stop\n\n\n now"]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "a b", "", 2), (3, texts[3], "", 3)],
                               "doc_id long, text string, n_tokens string, over_limit int")
    rows = sorted(tc.token_counts(df, SPEC).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    want = dict(zip(range(len(texts)), library(texts), strict=True))
    assert [r.n_tokens for r in rows if r.doc_id is not None] == [want[r.doc_id] for r in rows if r.doc_id is not None]
    assert rows[-1].n_tokens == 2 and len(rows) == len(texts) + 2
    assert [r.over_limit for r in rows][:3] == [False] * 3 and rows[-4].over_limit
    assert tc.token_counts(df.limit(0), SPEC).count() == 0
    monkeypatch.setattr(tc, "LONG", 10)  # the lazy walk of very long texts
    assert tc.count_texts(texts, SPEC, WHOLE) == library(texts)


def test_query_against_the_library(spark):
    rows = tc.op10_token_counts(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = dict(zip(docs, library(list(docs.values())), strict=True))
    assert {r.doc_id: r.n_tokens for r in rows} == want
    assert all(r.n_bytes == len(docs[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 1024) for r in rows)


def test_shortcut_is_refused_where_it_is_not_proven():
    other = tc.read_spec(public_tokenizers.path("word_bpe_49k.json"))
    assert tc.prove_whole(other) == []
    assert tc.count_texts(["Hello there"], other, frozenset())[0] > 0


def test_merging_by_rank_is_proven_for_this_vocabulary():
    ranks = tc.merge_ranks(SPEC)
    assert ranks and len(ranks) == 50256 and ranks[b" the"] < ranks[b" their"]
