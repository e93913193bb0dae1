"""Token counts by the whole-token shortcut.

A byte-level BPE tokenizer first cuts a text into pre-tokens and then merges
bytes inside each pre-token. Most pre-tokens are vocabulary entries. Once per
query ``prove_whole`` encodes every vocabulary string alone with the library
and keeps those that come back as exactly one token; a pre-token in that set
counts 1 without any merging. Only the others are merged.

Where white space is single (``_SINGLE``), every space starts a pre-token and
every newline is one, so the count of a text is a sum over its space-separated
chunks, and a worker remembers chunks it has met. The pre-token pattern runs
in Python for texts made of characters on which both regex engines agree
(``_PLAIN``); any other text is counted by the library as a whole, so counts
are exact for every text.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted one by one; a null id is kept; an empty table gives an empty
result; other columns of the input are ignored. Very long lines are walked
match by match, never as one token list.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import table
from lathe.llm.registry import register

# Characters on which ``re`` agrees with the library's \\p{L}, \\p{N} and \\s.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u0391-\u03a1\u03a3-\u03ce"
                    r"\u0400-\u0481\u2010-\u2027\u2030-\u205e]*")
# The byte-level pre-token pattern on those characters.
_PRE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_UNEVEN = re.compile(r"[ \n][ \n]|[\t\r]")
LIMIT = 1024
CACHE = 500_000  # chunks remembered per worker; then it starts anew
LONG = 1_000_000  # characters of a line from which matches are walked lazily

_LOADED: dict = {}


def _load(spec: str):
    """The library's tokenizer for a file content, once per Python worker."""
    key = hash(spec)
    if key not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(spec)
        tok.no_padding()
        tok.no_truncation()
        _LOADED[key] = tok
    return _LOADED[key]


def _n(tok, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]


def specials(spec: str) -> list[str] | None:
    """Strings the library cuts out first; None if one has options beyond a
    plain literal match (then every text is counted by the library)."""
    added = json.loads(spec).get("added_tokens", [])
    if any(a.get("single_word") or a.get("lstrip") or a.get("rstrip") for a in added):
        return None
    return [a["content"] for a in added]


def shortcut_holds(spec: str) -> bool:
    """The shortcut is proven for byte-level BPE with this pattern only."""
    j = json.loads(spec)
    p = j.get("pre_tokenizer") or {}
    return (j["model"]["type"] == "BPE" and j.get("normalizer") is None and p.get("type") == "ByteLevel"
            and p.get("use_regex", True) and not p.get("add_prefix_space") and specials(spec) is not None
            and not j["model"].get("ignore_merges"))


def prove_whole(spec: str) -> list[str]:
    """Vocabulary strings that are one pre-token and encode alone as one
    token. Bounded by the vocabulary."""
    if not shortcut_holds(spec):
        return []
    tok = _load(spec)
    cut = set(specials(spec) or [])
    texts = [tok.decode([i], skip_special_tokens=False) for i in tok.get_vocab(with_added_tokens=False).values()]
    texts = [t for t in set(texts) if t and "�" not in t and t not in cut
             and _PLAIN.fullmatch(t) and _PRE.fullmatch(t) and _PRE.findall(t) == [t]]
    return sorted(t for t, n in zip(texts, _n(tok, texts), strict=True) if n == 1)


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def merge_ranks(spec: str) -> dict[bytes, int] | None:
    """Byte strings by merge rank, if the vocabulary's ids follow the order of
    its merges (then merging by id is merging by rank); else None."""
    model = json.loads(spec)["model"]
    vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [vocab.get(a + b, -1) for a, b in merges]
    if ids != sorted(set(ids)) or -1 in ids:
        return None
    from tokenizers.pre_tokenizers import ByteLevel

    back = {}  # printable stand-in of each byte, as the library shows it
    for c in range(0x180):
        raw = chr(c).encode()
        for stand, byte in zip(ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(c))[0][0], raw,
                               strict=True):
            back[stand] = byte
    for byte in range(256):
        back.setdefault(chr(byte) if chr(byte).isprintable() else "", byte)
    single = {t: i for t, i in vocab.items() if len(t) == 1}
    wanted = {a + b for a, b in merges} | set(single)
    if len(single) != 256 or not all(ch in back for t in wanted for ch in t):
        return None
    return {bytes(back[ch] for ch in t): vocab[t] for t in wanted}


class _Chunks(dict):
    """Token counts of chunks, counted on first sight."""

    def __init__(self, before: str, whole: frozenset, merge):
        super().__init__()
        self.before, self.whole, self.merge = before, whole, merge

    def __missing__(self, chunk: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = self[chunk] = sum(1 if p in self.whole else self.merge(p) for p in _PRE.findall(self.before + chunk))
        return n


class _Counter:
    """Counts texts for one tokenizer; one per Python worker."""

    def __init__(self, spec: str, whole: frozenset):
        self.tok, self.whole = _load(spec), whole
        ranks = merge_ranks(spec) if whole else None
        if ranks:
            import tiktoken

            core = tiktoken._tiktoken.CoreBPE(ranks, {}, r"[\s\S]+")
            self.merge = lambda piece: len(core.encode_single_piece(piece.encode()))
        else:
            self.merge = lambda piece: _n(self.tok, [piece])[0]
        self.first, self.rest = _Chunks("", whole, self.merge), _Chunks(" ", whole, self.merge)
        cuts = specials(spec)
        self.cutter = re.compile("|".join(map(re.escape, cuts))) if cuts else None

    def run(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not _PLAIN.fullmatch(text):
            return _n(self.tok, [text])[0]
        if _UNEVEN.search(text) or text[:1] in " \n" or text[-1:] in " \n":
            return self.walk(text)
        total, get = text.count("\n"), self.rest.__getitem__
        for line in text.split("\n"):
            if len(line) > LONG:
                total += self.walk(line)
            else:
                head, *words = line.split(" ")
                total += self.first[head] + sum(map(get, words))
        return total

    def walk(self, text: str) -> int:
        return sum(1 if (p := m.group()) in self.whole else self.merge(p) for m in _PRE.finditer(text))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.whole:
            return _n(self.tok, [text])[0]
        if self.cutter is None:
            return self.run(text)
        runs = self.cutter.split(text)
        return len(runs) - 1 + sum(self.run(r) for r in runs if r)


def count_texts(texts: list[str | None], spec: str, whole: frozenset) -> list[int]:
    key = ("counter", hash(spec), len(whole))
    if key not in _LOADED:
        _LOADED[key] = _Counter(spec, whole)
    return list(map(_LOADED[key].count, texts))


def token_counts(df: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` per row. ``spec`` is the
    tokenizer file's content; it and the proven strings are broadcast, bounded
    by the vocabulary."""
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((spec, frozenset(prove_whole(spec))))
    id_type = df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, whole = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(1).to_pylist()
                total = count_texts(texts, spec, whole)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                     pa.array(total, pa.int64()), pa.array([n > limit for n in total], pa.bool_())],
                    names=["_id", "n_bytes", "n_tokens", "over_limit"])

    out = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"_id {id_type.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("_id", id_col)


@register("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), read_spec(public_tokenizers.path("byte_bpe_50k.json")))
