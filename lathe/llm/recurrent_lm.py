"""LM scoring with a gated recurrent language model.

Counts: every training document's tokens are counted by Spark. The most
frequent tokens, at most ``TABLED``, are tabled in each worker; the counts of
all others reach their documents by a join.

Model: a gated recurrent unit reads a document token by token; the state after
the tokens so far predicts the next one as P(class | state) P(token | class).
The ``CLASSES * WIDTH`` most frequent tokens fill classes of ``WIDTH``, inside
which a softmax of the state picks the token; other tabled tokens fall into
classes by frequency, inside which a token has its share of the class's
counts; all tokens that are not tabled are one class, inside which a token of
count c has (c + 1) / (N_r + V_r + 1), as in the base score. Biases start at
the corpus' log frequencies, so training starts from the class unigram model.

Training: truncated backpropagation in numpy. Each Spark partition deals its
training documents to parallel streams, reads them in windows of ``WINDOW``
tokens with the state carried from window to window (and reset between
documents), and updates after every window; every training document is read
once, in one of ``ROUNDS`` rounds chosen by hash, and after a round the
partitions' parameters are averaged by Spark, weighted by tokens. Parameters
have a fixed size; nothing else reaches the driver.

Scoring: documents of a block run side by side, in windows with the state
carried, so a score is the log-likelihood of the complete text.

Defined results: a null text counts as empty, which has one token, the end; a
null id has crc32 of the empty text; repeated rows are trained on and scored
each; without training documents N = V = 0 and base scores are 0; an empty
table gives an empty result; other columns are ignored. A block holds
``TOKENS`` tokens or one document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import table, text_or_empty
from lathe.llm.registry import register
from lathe.session import materialize

TABLED = 200_000
CLASSES, WIDTH = 16, 32
TAIL = 12
SUFFIXES = 512
H = 16
WINDOW = 32
SEGMENT = 1024  # tokens after which training starts from the zero state again
STREAMS = 512
ROUNDS = 2
RATE = 0.02
FULL = 4096  # tokens of a window from which a step has its full length
TOKENS = 3_000_000
PIECE = 1 << 24  # bytes of text that are cut into words at once
SIDE = 1024  # documents that are scored side by side
SEED = 3
END = ""  # no word is empty

def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Tokens of all texts, A-Z lower-cased, each text's end behind its words,
    and every text's number of tokens. Arrow cuts at runs of the same
    characters as ``[\x20\x09-\x0D]+`` and keeps the empty parts at both ends of
    a text: behind an added blank the last one is the end, while a first one
    stands for blanks before the first word."""
    closed = pc.binary_join_element_wise(pc.ascii_lower(texts).cast(pa.string()), pa.scalar(" "), "")
    lists = pc.ascii_split_whitespace(closed)
    words, size = lists.flatten(), lists.value_lengths().to_numpy().astype(np.int64)
    start = np.cumsum(size) - size
    blank = pc.binary_length(words.take(pa.array(start))).to_numpy() == 0
    if blank.any():
        keep = np.ones(len(words), bool)
        keep[start[blank]] = False
        words, size = words.filter(pa.array(keep)), size - blank
    return words, size


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2


class Vocabulary:
    """Tabled tokens by rank with their class, place in it and count."""

    def __init__(self, words: list[str], counts: np.ndarray, n: int, v: int):
        self.words = pa.array(words, pa.string())
        self.n, self.v = n, v
        k = len(words)
        self.counts = np.append(counts, 0).astype(np.float64)  # last: not tabled
        rank = np.arange(k + 1)
        tail = CLASSES + (np.log2(np.maximum(rank, CLASSES * WIDTH) / (CLASSES * WIDTH))
                          / math.log2(max(2, TABLED / (CLASSES * WIDTH))) * (TAIL - 1)).astype(np.int64)
        self.rare = CLASSES + TAIL
        self.cls = np.where(rank < CLASSES * WIDTH, rank // WIDTH, tail)
        self.cls[k] = self.rare
        self.place = np.where(rank < CLASSES * WIDTH, rank % WIDTH, -1)
        self.place[k] = -1
        mass = np.bincount(self.cls, weights=self.counts, minlength=self.rare + 1)
        self.inside = np.where((self.place < 0) & (self.counts > 0), np.log(np.maximum(self.counts, 1))
                               - np.log(np.maximum(mass[self.cls], 1)), 0.0)
        self.inside[k] = 0.0
        self.n_rare, self.v_rare = n - int(self.counts.sum()), v - k
        mass[self.rare] = self.n_rare
        self.class_bias = np.log(mass + 1.0)
        inner = np.zeros(CLASSES * WIDTH)
        inner[:min(k, CLASSES * WIDTH)] = self.counts[:-1][:CLASSES * WIDTH]
        self.word_bias = np.log(inner + 0.5).reshape(CLASSES, WIDTH)
        self.cls, self.place = self.cls.astype(np.int16), self.place.astype(np.int16)
        enter = np.append(np.arange(k), 0)
        enter[CLASSES * WIDTH:k] = self.suffixes(self.words[CLASSES * WIDTH:])
        self.enter = enter.astype(np.int16)
        self.log_count = np.log10(self.counts + 1)

    @staticmethod
    def suffixes(words: pa.Array) -> np.ndarray:
        """Input ids by a hash of the last three letters."""
        ends = pc.utf8_slice_codeunits(words, -3).dictionary_encode()
        ids = [CLASSES * WIDTH + zlib.crc32(w.encode()) % SUFFIXES for w in ends.dictionary.to_pylist()]
        return np.array(ids, np.int16)[ends.indices.to_numpy()]

    def read_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Ranks (``len(words)``: not tabled) and input ids of all tokens, each
        text's number of them, the words that are not tabled and each text's
        number of those."""
        k = len(self.words)
        words, size = split_words(texts)
        ranks = pc.index_in(words, self.words).fill_null(k).to_numpy()
        enter = self.enter[ranks]
        lost = np.flatnonzero(ranks == k)
        rare = words.take(pa.array(lost))
        enter[lost] = self.suffixes(rare)
        return ranks, enter, size, rare, np.diff(np.searchsorted(lost, np.append(0, np.cumsum(size))))

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """One text's ranks, input ids and words that are not tabled."""
        ranks, enter, _, rare, _ = self.read_all(pa.array([text], pa.string()))
        return ranks, enter, rare.to_pylist()


SHAPES = {"x": (CLASSES * WIDTH + SUFFIXES, 3 * H), "u": (H, 3 * H), "wc": (H, CLASSES + TAIL + 1),
          "bc": (CLASSES + TAIL + 1,), "ww": (CLASSES, H, WIDTH), "bw": (CLASSES, WIDTH)}


def start(v: Vocabulary) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    p = {k: (0.1 * rng.standard_normal(s)).astype(np.float32) for k, s in SHAPES.items()}
    p["bc"], p["bw"] = v.class_bias.astype(np.float32), v.word_bias.astype(np.float32)
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def unflat(a: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = a[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def step(p, enter, h):
    """One step of the unit; also what its gradient needs."""
    a = p["x"].take(enter, axis=0)
    g = h @ p["u"]
    zr = np.tanh((a[:, :2 * H] + g[:, :2 * H]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
    z, r = zr[:, :H], zr[:, H:]
    n = np.tanh(a[:, 2 * H:] + r * g[:, 2 * H:])
    return n + z * (h - n), (z, r, n, g)


def _exps(a):
    """A softmax's numerators and denominators."""
    a -= a.max(axis=1, keepdims=True)
    np.exp(a, out=a)
    return a, a.sum(axis=1)


def outputs(p, h, cls, place, inside, grads=None):
    """Natural log probability of each token from its state; adds gradients of
    the sum of -log P and returns those of the states."""
    of, sums = _exps(h @ p["wc"] + p["bc"])
    rows = np.arange(len(cls))
    own = of[rows, cls] / sums
    out = np.log(np.maximum(own, 1e-30)) + inside
    dh = None
    if grads is not None:
        of /= sums[:, None]
        of[rows, cls] = own - 1
        grads["wc"] += h.T @ of
        grads["bc"] += of.sum(axis=0)
        dh = of @ p["wc"].T
    inner = np.flatnonzero(place >= 0)
    inner = inner[np.argsort(cls[inner].astype(np.int16), kind="stable")]
    edge = np.searchsorted(cls[inner], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        at = inner[edge[c]:edge[c + 1]]
        if not len(at):
            continue
        hc = h.take(at, axis=0)
        pw, sums = _exps(hc @ p["ww"][c] + p["bw"][c])
        k, w = np.arange(len(at)), place[at]
        own = pw[k, w] / sums
        out[at] += np.log(np.maximum(own, 1e-30))
        if grads is not None:
            pw /= sums[:, None]
            pw[k, w] = own - 1
            grads["ww"][c] += hc.T @ pw
            grads["bw"][c] += pw.sum(axis=0)
            dh[at] += pw @ p["ww"][c].T
    return out, dh


def window_gradient(p, v: Vocabulary, ranks, enter, first, h):
    """Log probabilities and gradients of one window (time x stream); ``first``
    marks starts, where the state is 0 and no gradient passes."""
    t_max, b = ranks.shape
    states, kept = np.empty((t_max, b, H), np.float32), []
    resets = first.any(axis=1)
    for t in range(t_max):
        states[t] = h
        if resets[t]:
            states[t][first[t]] = 0
        h, saved = step(p, enter[t], states[t])
        kept.append(saved)
    grads = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    flat_ranks = ranks.ravel()
    lp, dh_out = outputs(p, states.reshape(-1, H), v.cls[flat_ranks], v.place[flat_ranks], v.inside[flat_ranks], grads)
    dh_out = dh_out.reshape(t_max, b, H)
    dh = np.zeros((b, H), np.float32)
    da, dg = np.empty((t_max, b, 3 * H), np.float32), np.empty((t_max, b, 3 * H), np.float32)
    back = p["u"].T.copy()
    for t in range(t_max - 1, -1, -1):
        z, r, n, g = kept[t]
        a, d = da[t], dg[t]
        a[:, :H] = dh * (states[t] - n) * z * (1 - z)
        a[:, 2 * H:] = dn = dh * (1 - z) * (1 - n * n)
        a[:, H:2 * H] = dn * g[:, 2 * H:] * r * (1 - r)
        d[:, :2 * H] = a[:, :2 * H]
        d[:, 2 * H:] = dn * r
        dh = dh * z + d @ back + dh_out[t]
        if resets[t]:
            dh[first[t]] = 0
    grads["u"] += states.reshape(-1, H).T @ dg.reshape(-1, 3 * H)
    ids = enter.ravel()
    order = np.argsort(ids.astype(np.int16), kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))
    grads["x"][ids[order][cuts]] = np.add.reduceat(da.reshape(-1, 3 * H)[order], cuts)
    return lp, grads, h


class Trainer:
    """Adam over windows of parallel streams."""

    def __init__(self, p, v: Vocabulary):
        self.p, self.v, self.n = p, v, 0
        self.m = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
        self.s = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
        self.steps = 0

    def update(self, grads, tokens):
        self.steps += 1
        rate = RATE * min(1.0, tokens / FULL) * math.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for k, g in grads.items():
            g = np.clip(g / tokens, -0.05, 0.05)
            self.m[k] += 0.1 * (g - self.m[k])
            self.s[k] += 0.01 * (g * g - self.s[k])
            self.p[k] -= (rate * self.m[k] / (np.sqrt(self.s[k]) + 1e-5)).astype(np.float32)

    def block(self, docs: list[tuple[np.ndarray, np.ndarray]]):
        """Segments of documents dealt to streams, longest first, always to the
        shortest stream."""
        import heapq

        docs = [(r[i:i + SEGMENT], e[i:i + SEGMENT]) for r, e in docs for i in range(0, len(r), SEGMENT)]
        n_streams = max(1, min(STREAMS, len(docs)))
        heap = [(0, i) for i in range(n_streams)]
        streams: list[list[int]] = [[] for _ in heap]
        for k in sorted(range(len(docs)), key=lambda k: -len(docs[k][0])):
            n, i = heapq.heappop(heap)
            streams[i].append(k)
            heapq.heappush(heap, (n + len(docs[k][0]), i))
        streams.sort(key=lambda s: -sum(len(docs[k][0]) for k in s))
        size = np.array([sum(len(docs[k][0]) for k in s) for s in streams])
        ranks, enter = (np.concatenate([docs[k][j] for s in streams for k in s]) for j in (0, 1))
        first = np.zeros(len(ranks), bool)
        first[np.cumsum([0] + [len(docs[k][0]) for s in streams for k in s])[:-1]] = True
        base = np.cumsum(size) - size
        h = np.zeros((n_streams, H), np.float32)
        for t in range(0, int(size[0]), WINDOW):
            live = int(np.searchsorted(-size, -t, side="left"))  # streams longer than t
            steps = np.minimum(size[:live] - t, WINDOW)
            for m in np.unique(steps):  # streams that end here have a shorter window
                who = np.flatnonzero(steps == m)
                at = base[who] + t + np.arange(m)[:, None]
                _, grads, h[who] = window_gradient(self.p, self.v, ranks[at], enter[at], first[at], h[who])
                self.update(grads, at.size)
                self.n += at.size


def _side_by_side(p, v: Vocabulary, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Natural log probability of each document, longest first."""
    size = np.array([len(d[0]) for d in docs])
    base = np.cumsum(size) - size
    ranks, enter = (np.concatenate([d[j] for d in docs]) for j in (0, 1))
    total = np.zeros(len(docs))
    h = np.zeros((len(docs), H), np.float32)
    for t0 in range(0, int(size[0]), WINDOW):
        states, who, what = [], [], []
        for t in range(t0, min(t0 + WINDOW, int(size[0]))):
            live = int(np.searchsorted(-size, -t, side="left"))
            at = base[:live] + t
            states.append(h[:live].copy())
            who.append(np.arange(live))
            what.append(ranks[at])
            h[:live], _ = step(p, enter[at], h[:live])
        what = np.concatenate(what)
        lp, _ = outputs(p, np.concatenate(states), v.cls[what], v.place[what], v.inside[what])
        total += np.bincount(np.concatenate(who), weights=lp, minlength=len(docs))
    return total


def score_block(p, v: Vocabulary, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Natural log probability of each document, class of rare tokens
    included; ``SIDE`` documents of like length at a time, so that their states
    stay in the processor's cache."""
    order = np.argsort([-len(d[0]) for d in docs], kind="stable")
    out = np.empty(len(docs))
    for i in range(0, len(docs), SIDE):
        some = order[i:i + SIDE]
        out[some] = _side_by_side(p, v, [docs[k] for k in some])
    return out


def _pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of at most ``PIECE`` bytes of text or one row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text)).to_numpy().astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, PIECE + (ends[at - 1] if at else 0), side="right")))
            yield batch.slice(at, to - at)
            at = to


def _blocks(batches: Iterator[pa.RecordBatch], v: Vocabulary, text: int):
    """(row batch pieces, documents, pieces of the words that are not tabled,
    their number in each document) of about TOKENS tokens."""
    rows, docs, rare, n_rare, n = [], [], [], [], 0
    for piece in _pieces(batches, text):
        ranks, enter, size, lost, n_lost = v.read_all(piece.column(text))
        ends, lost_ends = np.append(0, np.cumsum(size)), np.append(0, np.cumsum(n_lost))
        at = 0
        while at < piece.num_rows:  # up to the document that fills the block
            to = min(int(np.searchsorted(ends, ends[at] + TOKENS - n)), piece.num_rows)
            rows.append(piece.slice(at, to - at))
            docs += [(ranks[a:b], enter[a:b]) for a, b in zip(ends[at:to], ends[at + 1:to + 1], strict=True)]
            rare.append(lost[int(lost_ends[at]):int(lost_ends[to])])
            n_rare.append(n_lost[at:to])
            n += int(ends[to] - ends[at])
            if n >= TOKENS:
                yield rows, docs, rare, n_rare
                rows, docs, rare, n_rare, n = [], [], [], [], 0
            at = to
    if docs:
        yield rows, docs, rare, n_rare


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, c`` of each piece."""
    for piece in _pieces(batches, 0):
        found = pc.value_counts(split_words(piece.column(0))[0])
        yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "c"])


def counted(docs: DataFrame) -> DataFrame:
    """``word, c`` over all training documents, the end included."""
    return (docs.where(~F.col("_held")).select("_text").mapInArrow(_count, "word string, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def most_frequent(counts: DataFrame) -> pd.DataFrame:
    """The tokens whose count reaches a border below which more than
    ``TABLED`` tokens would qualify, by count and text. The border comes from
    a histogram over eighths of octaves (at most 512 rows), so only tabled
    tokens reach the driver."""
    step = F.floor(F.log2("c") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).count().toPandas().sort_values("step", ascending=False)
    fits = sizes["step"][sizes["count"].cumsum() <= TABLED]
    if fits.empty:
        return pd.DataFrame({"word": [], "c": []}).astype({"word": object, "c": np.int64})
    top = counts.where(step >= int(fits.min())).toPandas()
    return top.sort_values(["c", "word"], ascending=[False, True], ignore_index=True)


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"), held_out(id_col).alias("_held"))
    counts = materialize(counted(docs), "counts")
    n, n_words = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    top = most_frequent(counts)
    vocabulary = Vocabulary(top["word"].tolist(), top["c"].to_numpy(), n or 0, n_words)
    words = spark.sparkContext.broadcast(vocabulary)
    params = flat(start(vocabulary))
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(params)

        def fit(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(unflat(shared.value), words.value)
            for _, some, _, _ in _blocks(batches, words.value, 0):
                trainer.block(some)
            if trainer.n:
                out = flat(trainer.p).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(np.array([0, len(out)], np.int32), pa.array(out)),
                     pa.array([float(trainer.n)])], names=["p", "n"])

        own = docs.where(~F.col("_held") & (F.pmod(F.xxhash64("_id", "_text"), F.lit(ROUNDS)) == turn)).select("_text")
        models = materialize(own.mapInArrow(fit, "p array<double>, n double"), "models")
        mean = (models.select("n", F.posexplode("p").alias("i", "x")).groupBy("i")
                .agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("x")).toPandas())  # the size of one model
        if len(mean):
            params = mean.sort_values("i")["x"].to_numpy()
    final = spark.sparkContext.broadcast(params)
    kind = df.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v, p = words.value, unflat(final.value)
        key = TaskContext.get().partitionId() << 33
        for rows, some, lost, n_lost in _blocks(batches, v, 1):
            got = score_block(p, v, some)
            n_rare = np.concatenate(n_lost)
            size = np.array([len(d[0]) for d in some])
            keys = np.arange(key, key + len(some))
            key += len(some)
            table_ = pa.Table.from_batches(rows)
            rare = pa.ListArray.from_arrays(np.append(0, np.cumsum(n_rare)).astype(np.int32), pa.concat_arrays(lost))
            out = pa.Table.from_arrays(
                [table_.column(0), table_.column(2), pa.array(keys), pa.array(size), pa.array(size - n_rare),
                 pa.array([float(v.log_count[d[0]].sum()) for d in some]), pa.array(got / math.log(10)), rare],
                names=["_id", "_held", "_key", "n_tokens", "tabled", "logs", "model", "rare"])
            yield from out.combine_chunks().to_batches(max_chunksize=2000)

    scored = materialize(docs.select("_id", "_text", "_held").mapInArrow(
        score, f"_id {kind}, _held boolean, _key long, n_tokens long, tabled long, logs double, model double, "
        "rare array<string>"), "scores")
    lost = scored.select("_key", F.explode_outer("rare").alias("_w")).where("_w is not null").groupBy("_key", "_w").agg(
        F.count(F.lit(1)).alias("_n"))
    known = lost.join(counts.withColumnRenamed("word", "_word"), F.col("_w") == F.col("_word"), "left").groupBy(
        F.col("_key").alias("_k")).agg(F.sum(F.col("_n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("_logs"),
                                       F.sum(F.when(F.col("c") > 0, F.col("_n"))).alias("_known"))
    got = scored.drop("rare").join(known, F.col("_key") == F.col("_k"), "left")
    logs = F.coalesce("_logs", F.lit(0.0))
    base_norm = math.log10(vocabulary.n + vocabulary.v + 1)
    rare_norm = math.log10(vocabulary.n_rare + vocabulary.v_rare + 1)
    return got.select(
        F.col("_id").alias(id_col), F.col("_held").alias("held_out"), "n_tokens",
        (F.col("tabled") + F.coalesce("_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocabulary.n).cast("long").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * F.lit(base_norm)).alias("base_score"),
        (F.col("model") + logs - (F.col("n_tokens") - F.col("tabled")) * F.lit(rare_norm)).alias("score"))


@register("op7_recurrent_lm")
def op7_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
