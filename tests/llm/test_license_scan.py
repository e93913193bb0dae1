import re

import pytest

from lathe.llm import license_scan as ls
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def base(text):
    words = re.findall(ls.WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))
    at = [(i, label) for label, phrase in ls.BASE for p in [phrase.split()]
          for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), \
        ",".join(sorted({x for _, x in at}))


def scan(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "x", 2.0) for i, t in enumerate(texts)], "doc_id long, text string, labels string, score double")
    return {r.doc_id: r for r in ls.license_scan(df, **kw).collect()}


def test_base_phrases_and_edges(spark):
    texts = [None, "", "cc", "CC BY", "cc-by, cc by! CC\nBY", "cc by cc by", "all rights reserved all rights", "all all rights reserved",
             "General Public License " * 400, "cc é by", "by cc"]
    got = scan(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(t), t
        assert r.score == (1.0 if r.n_base else 0.0)


def test_altered_notice_is_found_across_neighbouring_diagonals(spark):
    notice = dict(ls.NOTICES)["bsd"].split()
    lost = " ".join(notice[:9] + notice[10:])
    added = " ".join(notice[:6] + ["certainly"] + notice[6:])
    other = " ".join(reversed(notice))
    got = scan(spark, [f"intro words {lost} tail", f"x {added} y z", other, " ".join(notice)])
    assert got[0].labels == "bsd" and got[1].labels == "bsd" and got[2].labels == "" and got[3].score == 1.0
    assert 0.75 <= got[0].score < 1 and got[0].n_base == 0 and got[0].base_labels == ""


def test_repeated_rows_null_id_and_empty_table(spark):
    df = spark.createDataFrame([(1, "cc by"), (1, "cc by"), (1, "other"), (None, "cc by")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_base) for r in ls.license_scan(df).collect())
    assert got == [(False, 0), (False, 1), (False, 1), (True, 1)]
    assert ls.license_scan(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        ls.template_pairs(spark, [("a", "one", True)])


def test_query_matches_oracle_and_brute_force(spark):
    status, detail = compare(spark, duck(SF), "op1", ls.op1_license_scan, ls._oracle(), SF, check_types=True)
    assert status == "ok", detail
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in ls.op1_license_scan(spark, SF).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
