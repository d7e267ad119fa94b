"""Language-model scores of whole documents.

P(token) = P(class | state) * P(token | class). The state is that of a gated
recurrent network over classes, carried through the whole document. Within a
class a word has its share of the class's training tokens, counted over the
whole corpus. The HEAD most frequent words are clustered into classes by what
stands around them in all training texts; every other word belongs to the rare class of the words
that end alike, which keeps a place for words never seen.

The network learns from all training documents, each read whole, with the state
carried from window to window: tasks train on from common weights, which are
averaged between rounds.

Counts of all words are summed by Spark, and stay a table: head words, a bounded
list, are settled where the texts are; the others, each of which by that has at
most 1/HEAD of the tokens, meet their counts in an ordinary join.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import column_of, crc32_of_id, slices, table, text_of
from terrafold.llm.gru import RATE, STEPS, Adam, Network
from terrafold.llm.token_store import raw_texts
from terrafold.workspace import stored

HEAD = 100_000
CLASSES = 40
# Bytes at a word's end that choose its rare class.
ENDING = 3
# Rounds of training, between which the tasks' weights are averaged. The first FEW read all
# training documents, the others their own share of them, whatever the corpus's size.
TURNS, FEW = 4, 0
# Frequent words that describe their neighbours, and how far they are looked for.
CONTEXT, REACH, ROUNDS = 96, 4, 12
# Different words counted before they are handed on; tokens scored together.
COUNTED, SCORED = 300_000, 3_000_000
# Tokens whose neighbours are looked up at once.
NEAR = 500_000
# Windows a task should learn from at least before it takes more streams, up to so many.
WINDOWS, STREAMS = 100, 256
# Weights are averaged as whole FINEths, by shares of WEIGHTS parts of all tokens.
FINE, LARGEST, WEIGHTS = 1 << 30, 512.0, 1 << 20
HELD_OUT, FOLDS = 2, 7
SLICE = 4 << 20


def words_of(raw: bytes) -> list[bytes]:
    """A-Z lower-cased; runs without ASCII white space."""
    return raw.lower().split()


def flat_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` all texts one after the other, and where those of each begin and end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, ends = lists.values.cast(pa.binary()), lists.offsets.to_numpy()
    full = pc.binary_length(words).to_numpy() > 0  # white space at an end parts off an empty word
    if not full.all():
        ends, words = np.append(0, np.cumsum(full))[ends], words.filter(pa.array(full))
    return words, ends


def fold():
    return crc32_of_id("doc_id") % FOLDS


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c over all texts of ``docs``."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            texts = column_of(batch, "text")
            for a, b in slices(texts, SLICE):
                found = pc.value_counts(flat_words(texts.slice(a, b - a))[0])
                held.append(pa.Table.from_arrays(found.flatten(), ["word", "n"]))
                size += len(found)
                if size > 2 * COUNTED:
                    held = [_added(held)]
                    size = len(held[0])
                    if size > COUNTED:
                        yield from held.pop().to_batches()
                        size = 0
        if held:
            yield from _added(held).to_batches()

    return (docs.select(text_of().alias("text")).mapInArrow(run, "word binary, n bigint")
            .groupBy("word").agg(F.sum("n").alias("c")))


def _added(counts: list[pa.Table]) -> pa.Table:
    """One row a word, its ``n`` summed."""
    sums = pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return sums.select(["word", "n_sum"]).rename_columns(["word", "n"]).combine_chunks()


@dataclass
class Head:
    """The most frequent words, their counts, and the corpus totals."""

    words: list[bytes]
    counts: np.ndarray
    ends: int
    tokens: int
    kinds: int

    def __post_init__(self):
        self.index = {w: i for i, w in enumerate(self.words)}
        self.column = pa.array(self.words, pa.binary())

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int32, len(words))


    def read(self, words: pa.Array) -> np.ndarray:
        """``read_row`` of words that lie one after the other."""
        read = pc.fill_null(pc.index_in(words, self.column), -1).to_numpy().copy()
        rest = np.flatnonzero(read < 0)
        if not len(rest):
            return read
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
        sizes = np.minimum(np.diff(ends)[rest], ENDING)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        codes = sizes << 8 * ENDING
        for back in range(ENDING):
            there = sizes > back
            codes[there] |= data[ends[rest[there] + 1] - 1 - back].astype(np.int32) << 8 * back
        read[rest] = -1 - codes
        return read


# Class 0 is the end; then come the head's classes, then as many rare ones.
END_CLASS = 0


@dataclass
class Classes:
    """The class of each head word, and of the endings of rare words."""

    of_head: np.ndarray
    of_ending: dict[bytes, int]
    most: int

    def rare(self, word: bytes) -> int:
        return 1 + self.most + self.of_ending.get(word[-ENDING:], 0)

    def row(self, read: np.ndarray) -> np.ndarray:
        """``class_row`` of a text as ``read_row`` gives it, a byte each."""
        out = np.empty(len(read) + 1, np.uint8)
        known = read >= 0
        out[:-1][known] = self.of_head[read[known]]
        if not known.all():
            out[:-1][~known] = [self.rare(ending_of(c)) for c in read[~known].tolist()]
        out[-1] = END_CLASS
        return out


def read_row(words: list[bytes], head: Head) -> np.ndarray:
    """Ids of a text's head words; of other words their endings, as numbers below -1."""
    read = head.ids(words)
    rest = np.flatnonzero(read < 0)
    read[rest] = [code_of(words[i][-ENDING:]) for i in rest.tolist()]
    return read


# Endings that a worker remembers the number of.
ENDINGS = 1 << 16


@lru_cache(ENDINGS)
def code_of(end: bytes) -> int:
    """An ending as a number below -1."""
    return -1 - (len(end) << 8 * ENDING | int.from_bytes(end, "big"))


@lru_cache(ENDINGS)
def ending_of(code: int) -> bytes:
    """The ending that ``read_row`` made a number of."""
    code = -1 - code
    return (code & (1 << 8 * ENDING) - 1).to_bytes(ENDING, "big")[ENDING - (code >> 8 * ENDING):]


def learn_classes(texts: list[np.ndarray], head: Head, most: int = CLASSES,
                  seed: int = 5) -> Classes:
    """Cluster head words by the frequent words around them in ``texts``."""
    seen = np.zeros(len(head.words) * min(CONTEXT, len(head.words)), np.int64)
    add_neighbours(seen, texts, head)
    return cluster(seen, head, most, seed)


def add_neighbours(seen: np.ndarray, texts: list[np.ndarray], head: Head):
    """Add to ``seen`` how often each head word has each context word within REACH."""
    context = min(CONTEXT, len(head.words))
    if not context or not texts:
        return
    apart = np.full(REACH, -1, texts[0].dtype)
    line = np.concatenate([apart, *chain.from_iterable((t, apart) for t in texts)]).astype(np.int64)
    common = np.flatnonzero((line >= 0) & (line < context))
    names = line[common]
    for gap in range(1, REACH + 1):
        for beside in (line[common - gap], line[common + gap]):
            near = beside >= 0
            np.add.at(seen, beside[near] * context + names[near], 1)


def neighbours(train: DataFrame, head: Head) -> np.ndarray:
    """``add_neighbours`` of all texts of ``train``; HEAD times CONTEXT cells at most."""
    cells = len(head.words) * min(CONTEXT, len(head.words))

    def run(batches):
        seen, held, size = np.zeros(cells, np.int64), [], 0
        for batch in batches:
            for raw in raw_texts(column_of(batch, "read")):
                held.append(np.frombuffer(raw, np.int32))
                size += len(held[-1]) + REACH
                if size >= NEAR:
                    add_neighbours(seen, held, head)
                    held, size = [], 0
        add_neighbours(seen, held, head)
        there = np.flatnonzero(seen)
        for at in range(0, len(there), COUNTED):
            some = there[at:at + COUNTED]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)),
                                              pa.array(seen[some])], ["cell", "n"])

    out = np.zeros(cells, np.int64)
    found = (_as_read(train, head).select("read").mapInArrow(run, "cell int, n bigint")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out


def cluster(seen: np.ndarray, head: Head, most: int = CLASSES, seed: int = 5) -> Classes:
    """Classes of the rows of ``seen``, as unit vectors, by count."""
    n = len(head.words)
    if not n:
        return Classes(np.zeros(0, np.int32), {}, 1)
    context, most = min(CONTEXT, n), min(most, n)
    seen = np.sqrt(seen.reshape(n, context).astype(np.float32))
    norm = np.linalg.norm(seen, axis=1, keepdims=True)
    known = norm[:, 0] > 0
    points = np.where(known[:, None], seen / np.maximum(norm, 1e-9), 0)
    points -= points[known].mean(axis=0) if known.any() else 0
    weight = np.sqrt(head.counts.astype(np.float64))
    rng = np.random.default_rng(seed)
    usable = np.flatnonzero(known)
    if len(usable) >= most:
        chance = weight[usable] / weight[usable].sum()
        middles = points[rng.choice(usable, most, replace=False, p=chance)]
        for _ in range(ROUNDS):
            own = _nearest(points, middles)
            sums = np.zeros_like(middles)
            np.add.at(sums, own[usable], points[usable] * weight[usable, None])
            size = np.linalg.norm(sums, axis=1, keepdims=True)
            middles = np.where(size > 0, sums / np.maximum(size, 1e-9), middles)
        own = _nearest(points, middles)
    else:
        own = np.arange(n) % most
    # An ending's class is that of most of the tokens that end so; words without
    # known neighbours take it over.
    votes: dict[bytes, np.ndarray] = {}
    for i, word in enumerate(head.words):
        if known[i] or len(usable) < most:
            votes.setdefault(word[-ENDING:], np.zeros(most))[own[i]] += head.counts[i]
    of_ending = {e: int(v.argmax()) for e, v in votes.items()}
    for i in np.flatnonzero(~known):
        own[i] = of_ending.get(head.words[i][-ENDING:], 0)
    return Classes((1 + own).astype(np.int32), of_ending, most)


def _nearest(points: np.ndarray, middles: np.ndarray) -> np.ndarray:
    return np.concatenate([(points[i:i + 20_000] @ middles.T).argmax(axis=1)
                           for i in range(0, len(points), 20_000)] or [np.zeros(0, np.int64)])


def class_row(words: list[bytes], ids: np.ndarray, classes: Classes) -> np.ndarray:
    """The classes of a text's words and of its end."""
    out = np.empty(len(words) + 1, np.int16)
    if len(words):
        known = ids >= 0
        out[:-1][known] = classes.of_head[ids[known]]
        rest = np.flatnonzero(~known)
        out[rest] = [classes.rare(words[i]) for i in rest.tolist()]
    out[-1] = END_CLASS
    return out


def _least_count(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach; 2 or more.

    Words met once stay out: the rare classes learn from them what new words are
    like. Two passes over the counts, first by powers of two, then between two.
    """
    def reached(bounds: list[int]) -> int:
        row = counts.agg(*[F.count_if(F.col("c") >= b) for b in bounds]).first()
        return next(i for i, n in enumerate(row) if (n or 0) <= most)

    powers = [1 << i for i in range(1, 63)]
    high = powers[reached(powers)]
    if high == 2:
        return 2
    low = high // 2
    steps = sorted({low + (high - low) * i // 64 for i in range(1, 65)})
    return steps[reached(steps)]


def _as_read(train: DataFrame, head: Head) -> DataFrame:
    """``read``, a text as ``read_row`` gives it, and the ``share`` that it is learned in.

    Words are looked up once for all who need them; what is read already stays as it is.
    """
    if "read" in train.columns:
        return train

    def run(batches):
        for batch in batches:
            texts, shares = column_of(batch, "text"), column_of(batch, "share")
            for a, b in slices(texts, SLICE):
                words, ends = flat_words(texts.slice(a, b - a))
                rows = pa.BinaryArray.from_buffers(
                    pa.binary(), b - a, [None, pa.py_buffer((ends * 4).astype(np.int32)),
                                         pa.py_buffer(head.read(words))])
                yield pa.RecordBatch.from_arrays([rows, shares.slice(a, b - a)], ["read", "share"])

    h = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_of())
    return train.select(text_of().alias("text"),
                        F.pmod(h, F.lit(TURNS)).cast("int").alias("share")).mapInArrow(
        run, "read binary, share int")


def _lines(train: DataFrame, head: Head, classes: Classes) -> DataFrame:
    """``line``, the classes of a text, a byte each, and the ``share`` that it is learned in."""
    def run(batches):
        for batch in batches:
            lines = [classes.row(np.frombuffer(raw, np.int32)).tobytes()
                     for raw in raw_texts(column_of(batch, "read"))]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()),
                                              column_of(batch, "share")], ["line", "share"])

    return _as_read(train, head).select("read", "share").mapInArrow(run, "line binary, share int")


def trained(lines: DataFrame, net: Network, tokens: int) -> Network:
    """``net`` after TURNS rounds over all ``lines``, which hold ``tokens`` tokens."""
    for turn in range(TURNS if tokens else 0):
        some = lines if turn < FEW else lines.where(F.col("share") == turn)
        net = _round(some, net, tokens, RATE * (1 - 0.9 * turn / TURNS))
    return net


def _round(lines: DataFrame, net: Network, tokens: int, rate: float) -> Network:
    """Each task trains on from ``net``; the mean of their weights, by the tokens they read.

    Weights are summed as whole numbers, so their order does not matter.
    """
    def run(batches):
        own = Network(*[p.copy() for p in net.parts()])
        adam, rng, read, held, size = Adam(own, rate), np.random.default_rng(11), 0, [], 0

        def learn():
            adam.learn(held, rng, streams=min(STREAMS, max(8, size // (STEPS * WINDOWS))))

        for batch in batches:
            for raw in raw_texts(column_of(batch, "line")):
                held.append(np.frombuffer(raw, np.uint8))
                size += len(raw)
                read += len(raw)
                if size >= SCORED:
                    learn()
                    held, size = [], 0
        if held:
            learn()
        if read:
            flat = np.concatenate([p.ravel() for p in own.parts()]).astype(np.float64)
            weight = -(-read * WEIGHTS // tokens)
            sums = np.rint(np.clip(flat, -LARGEST, LARGEST) * FINE).astype(np.int64) * weight
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat) + 1)), pa.array(np.append(sums, weight))],
                ["k", "v"])

    found = (lines.select("line").mapInArrow(run, "k bigint, v bigint")
             .groupBy("k").agg(F.sum("v").alias("v")).toArrow())  # one a weight
    if not len(found):
        return net
    sums = np.zeros(len(found), np.int64)
    sums[found["k"].to_numpy()] = found["v"].to_numpy()
    flat, out = (sums[:-1] / (float(sums[-1]) * FINE)).astype(np.float32), []
    for part in net.parts():
        out.append(flat[:part.size].reshape(part.shape))
        flat = flat[part.size:]
    return Network(*out)


def scores(docs: DataFrame, train: DataFrame, head_words: int = HEAD) -> DataFrame:
    """Per row of ``docs`` doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` holds the documents to learn from. A text's tokens are its words and
    one end; null is the empty text, its end alone. base_score adds one to the
    counts of single words; score is the model's log10 probability of the text.
    Learning from no document gives score = base_score = 0. Repeated rows come
    out repeated, an empty table gives none.
    """
    counts = stored(word_counts(train), "counts")
    ends = train.count()
    total = counts.agg(F.count("*").alias("kinds"), F.sum("c").alias("n")).first()
    least = _least_count(counts, head_words)
    top = counts.where(F.col("c") >= least).collect()  # at most HEAD rows
    top.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    head = Head([bytes(r["word"]) for r in top], np.array([r["c"] for r in top], np.int64), ends,
                (total["n"] or 0) + ends, total["kinds"] + (1 if ends else 0))
    known = stored(_as_read(train, head), "read")
    classes = cluster(neighbours(known, head), head)
    rare, rare_tokens = _rare_classes(counts, head, classes)
    shares = rare_tokens + 0.5
    shares[END_CLASS] += ends
    shares[:1 + classes.most] += np.bincount(classes.of_head, head.counts,
                                             minlength=1 + classes.most)
    net = Network.fresh(shares / shares.sum())
    if head.tokens:
        net = trained(stored(_lines(known, head, classes), "lines"), net, head.tokens)
    rows = stored(_settled(docs, head, classes, net, rare), "settled")
    # A word without a count adds nothing, so the join may leave it out.
    met = (rows.select("row", F.explode("rare").alias("r"))
           .select("row", F.col("r.word").alias("word"), F.col("r.n").alias("n"))
           .join(counts, "word"))
    sums = met.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"),
                                  F.sum("n").alias("known"))
    more = F.coalesce(F.col("more"), F.lit(0.0))
    return rows.join(sums, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(head.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("model") + more if head.tokens else F.col("base")).alias("score"))


def _rare_classes(counts: DataFrame, head: Head,
                  classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Per rare class the log10 of what its counts, one added to each, are shares of; its tokens."""
    def run(batches):
        tokens, kinds = (np.zeros(1 + 2 * classes.most, np.int64) for _ in "ab")
        for batch in batches:
            for word, c in zip(column_of(batch, "word").to_pylist(),
                               column_of(batch, "c").to_pylist()):
                if word not in head.index:
                    tokens[classes.rare(word)] += c
                    kinds[classes.rare(word)] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(tokens))), pa.array(tokens), pa.array(kinds)],
            ["k", "tokens", "kinds"])

    found = counts.mapInArrow(run, "k bigint, tokens bigint, kinds bigint").groupBy("k").agg(
        F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).collect()  # one a class
    out, sums = np.zeros(1 + 2 * classes.most), np.zeros(1 + 2 * classes.most)
    for r in found:
        out[r["k"]] = np.log10(r["tokens"] + r["kinds"] + 1)
        sums[r["k"]] = r["tokens"]
    return out, sums


def _settled(docs: DataFrame, head: Head, classes: Classes, net: Network,
             rare: np.ndarray) -> DataFrame:
    """Everything but the counts of rare words, which are listed per row with how often they come."""
    smooth = np.log10(head.tokens + head.kinds + 1)
    in_class = np.bincount(classes.of_head, head.counts, minlength=1 + classes.most)
    base_of = np.log10(head.counts + 1) - smooth
    own_of = np.log10(head.counts) - np.log10(in_class[classes.of_head])
    base_end = np.log10(head.ends + 1) - smooth

    def run(batches):
        part, made, rows, lines, size = TaskContext.get().partitionId() << 33, 0, [], [], 0
        rest: list[Counter] = []

        def scored():
            learned = net.score(lines) / np.log(10)
            ids, n, known, base, own = zip(*rows)
            words, times = (pa.array([v for r in rest for v in of(r)], kind) for of, kind in (
                (Counter.keys, pa.binary()), (Counter.values, pa.int64())))
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, rest)]), pa.int32()),
                pa.StructArray.from_arrays([words, times], ["word", "n"]))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(made - len(rows), made) + part), pa.array(ids, kind_arrow),
                 pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(np.array(own) + learned), lists],
                ["row", "doc_id", "n_tokens", "n_known", "base", "model", "rare"])

        for batch in batches:
            texts, ids = column_of(batch, "text"), column_of(batch, "doc_id").to_pylist()
            for a, b in slices(texts, SLICE):
                words, ends = flat_words(texts.slice(a, b - a))
                read = head.read(words)
                others = words.filter(pa.array(read < 0)).to_pylist()
                before = np.append(0, np.cumsum(read < 0))[ends].tolist()
                for i, doc in enumerate(ids[a:b]):
                    found = read[ends[i]:ends[i + 1]]
                    line = classes.row(found)
                    known = found[found >= 0]
                    rest.append(Counter(others[before[i]:before[i + 1]]))
                    n_rest = len(found) - len(known)
                    rows.append((
                        doc, len(found) + 1, len(known) + (1 if head.ends else 0),
                        float(base_of[known].sum()) + base_end - n_rest * smooth,
                        float(own_of[known].sum())
                        - float(rare[line[:-1][found < 0].astype(np.int64)].sum())))
                    lines.append(line)
                    made += 1
                    size += len(line)
                    if size >= SCORED:
                        yield scored()
                        rows, lines, size = [], [], 0
                        rest.clear()
        if rows:
            yield scored()

    source = docs.select("doc_id", text_of().alias("text"))
    from pyspark.sql.pandas.types import to_arrow_type

    kind_arrow = to_arrow_type(source.schema["doc_id"].dataType)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"row bigint, doc_id {kind}, n_tokens bigint, n_known bigint, base double, "
             "model double, rare array<struct<word: binary, n: bigint>>")


def op10_lm_score(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    docs = table(spark, sf_dir, "documents")
    found = scores(docs, docs.where(fold() != HELD_OUT))
    return found.withColumn("held_out", fold() == HELD_OUT).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
