"""Mixture-controlled packing by deficit round robin.

Every source is a queue of tokens, paid out in quanta of QUANTUM tokens so that
documents are not cut into crumbs. Each window of LENGTH tokens earns every
queue a credit, its target share of the window plus the deficit carried from
the window before; the queue pays out whole quanta of its credit, places left
over go to the queues furthest behind, and what was not paid out is carried on:
a queue too small for a quantum a window saves up. So every window is within
one quantum a queue of its target, and deficits even out over the windows. What
each queue holds beyond its whole quanta fills the last windows, queue by queue.

The same rule deals the whole corpus to spans of windows, and each span to
smaller spans, down to single windows: a tree of rounds in which deficits are
carried from child to child and every span's totals are kept exactly. A task
walks down only to the windows its documents fall into, so no state passes
between tasks, and all windows but the last are full.

Tokens keep the order of the stored table; a token's place in its queue is a
running total over the table's parts.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import bounded, column_of, slices, table, text_of
from terrafold.llm.running import running
from terrafold.llm.token_store import ids_column, raw_texts
from terrafold.llm.tokens import WORD_VOCABULARY, encoder
from terrafold.workspace import stored

LENGTH, QUANTUM = 4096, 256
END_ID = 2
# Queues dealt at once. The smaller sources share one more queue, itself dealt to them by
# a tree of rounds, BRANCH sources or branches a node, about a quantum, and at least TURN
# tokens, each a round.
QUEUES, BRANCH, TURN = 1000, 64, 16
# Nodes of that tree whose rounds a task remembers, and spans of each.
NODES, NODE_SPANS = 64, 8
# Children a span of windows is dealt to.
FAN = 64
# Spans whose rounds a task remembers, and documents it cuts at once.
SPANS, AT_ONCE = 512, 256


def deal(totals: np.ndarray, sizes: list[int], shares: np.ndarray | None = None) -> np.ndarray:
    """Deficit round robin: how many tokens of each queue go to each of ``sizes``, in order.

    ``totals`` sum to the sum of ``sizes``; ``shares`` are the targets, the
    totals' own proportions by default. A queue never pays more than it holds.
    """
    left = totals.copy()
    target = totals / max(1, totals.sum()) if shares is None else shares
    deficit = np.zeros(len(totals))
    out = np.zeros((len(sizes), len(totals)), np.int64)
    for i, size in enumerate(sizes[:-1]):
        share = _open_shares(target, left)
        credit = np.where(left > 0, deficit + share * size, 0)
        take = np.minimum(np.maximum(np.floor(credit), 0), left).astype(np.int64)
        short = size - int(take.sum())
        while short > len(totals):  # a queue ran out: the others share what it leaves
            room = left - take
            more = np.minimum(np.floor(_open_shares(target, room) * short), room).astype(np.int64)
            if not more.any():
                break
            take += more
            short -= int(more.sum())
        while short:
            behind = np.argsort(take - credit if short > 0 else credit - take, kind="stable")
            able = behind[(left - take if short > 0 else take)[behind] > 0][:abs(short)]
            take[able] += 1 if short > 0 else -1
            short += -len(able) if short > 0 else len(able)
        out[i] = take
        deficit = credit - take
        left -= take
    out[-1] = left
    return out


def _open_shares(target: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The targets of the queues that still hold tokens, in proportion."""
    share = np.where(left > 0, target, 0)
    return share / share.sum() if share.sum() > 0 else left / max(1, left.sum())


def quantum_of(length: int, quantum: int = QUANTUM) -> int:
    """The largest quantum up to the one asked for that parts a window evenly."""
    return next(q for q in range(min(quantum, length), 0, -1) if length % q == 0)


class Plan:
    """Which place of which window each token of each queue has.

    Rounds deal whole quanta; what the queues hold beyond them follows after.
    """

    def __init__(self, totals: list[int], length: int = LENGTH,
                 shares: list[float] | None = None, spans: int = SPANS, quantum: int = QUANTUM):
        self.most = spans
        self.length, self.quantum = length, quantum_of(length, quantum)
        tokens = np.array(totals, np.int64)
        self.totals = tokens // self.quantum
        rest = tokens - self.totals * self.quantum
        dealt = int(self.totals.sum())
        self.rest = (dealt * self.quantum + np.cumsum(rest) - rest).tolist()
        self.whole = (self.totals * self.quantum).tolist()
        self.shares = None if shares is None else np.array(shares) / sum(shares)
        self.window = length // self.quantum
        windows = -(-dealt // self.window)
        self.height = 1
        while FAN ** self.height < windows:
            self.height += 1
        self.spans: OrderedDict = OrderedDict()

    def _span(self, level: int, index: int, totals: np.ndarray):
        """Of a span: running totals a queue over its children, what each child gets, and where."""
        key = (level, index)
        if key in self.spans:
            self.spans.move_to_end(key)
            return self.spans[key]
        size = FAN ** (level - 1) * self.window
        full, rest = divmod(int(totals.sum()), size)
        sizes = [size] * full + ([rest] if rest else [])
        dealt = deal(totals, sizes, self.shares)
        bounds = np.zeros((len(sizes) + 1, len(totals)), np.int64)
        np.cumsum(dealt, axis=0, out=bounds[1:])
        found = self.spans[key] = (bounds.T.tolist(), dealt, np.cumsum(dealt, axis=1) - dealt)
        if len(self.spans) > self.most:
            self.spans.popitem(last=False)
        return found

    def pieces(self, queue: int, start: int, n: int):
        """(skipped, length, window, offset) of the tokens start..start+n of a queue, in order."""
        done, whole, quantum = 0, min(n, self.whole[queue] - start), self.quantum
        while done < whole:
            at, into = divmod(start + done, quantum)
            index, totals = 0, self.totals
            for level in range(self.height, 0, -1):
                bounds, dealt, offsets = self._span(level, index, totals)
                child = bisect_right(bounds[queue], at) - 1
                at -= bounds[queue][child]
                first, index, totals = index * FAN, index * FAN + child, dealt[child]
            # The windows of the lowest span follow each other in the same lists.
            line = bounds[queue]
            while done < whole and child < len(line) - 1:
                room = (line[child + 1] - line[child] - at) * quantum - into
                if room > 0:
                    size = min(room, whole - done)
                    yield (done, size, first + child,
                           (int(offsets[child][queue]) + at) * quantum + into)
                    done += size
                child, at, into = child + 1, 0, 0
        while done < n:  # beyond the whole quanta
            window, offset = divmod(self.rest[queue] + start + done - self.whole[queue],
                                    self.length)
            size = min(self.length - offset, n - done)
            yield done, size, window, offset
            done += size


def tokenised(docs: DataFrame, vocabulary: str = WORD_VOCABULARY,
              end_id: int = END_ID) -> DataFrame:
    """doc_id, queue, part, before, n, ids: each text's ids and their place in queue and part.

    The ids are bytes, which Spark moves as a whole: 16 bits each where all fit,
    else 32.
    """
    def run(batches):
        part, held, tool = TaskContext.get().partitionId(), {}, encoder(vocabulary)
        wide = max(tool.size - 1, end_id) >> 16
        for batch in batches:
            texts = column_of(batch, "text")
            for a, b in slices(texts):
                packed = tool.encode(raw_texts(texts.slice(a, b - a)), end_id)
                queues, before = column_of(batch, "queue").slice(a, b - a), []
                for queue, ids in zip(queues.to_pylist(), packed):
                    before.append(held.get(queue, 0))
                    held[queue] = before[-1] + len(ids) // 4
                sizes = [len(p) // 4 for p in packed]
                if not wide:
                    packed = [np.frombuffer(p, "<u4").astype("<u2").tobytes() for p in packed]
                yield pa.RecordBatch.from_arrays(
                    [column_of(batch, "doc_id").slice(a, b - a), queues,
                     pa.array([part] * len(packed), pa.int64()), pa.array(before, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                    ["doc_id", "queue", "part", "before", "n", "ids"])

    # A null source is a queue of its own, apart from any text a source may hold.
    queue = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    rows = docs.select("doc_id", queue.alias("queue"), text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, queue string, part bigint, before bigint, n bigint, ids binary")


def pack(docs: DataFrame, vocabulary: str = WORD_VOCABULARY, end_id: int = END_ID,
         length: int = LENGTH, shares: dict[str, float] | None = None,
         queues: int = QUEUES, quantum: int = QUANTUM, with_ids: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source_queue, ids.

    Without ``with_ids`` the ids themselves are left out.
    One row a piece; every token of every row is in exactly one piece, null texts
    are their end id alone, repeated rows are packed as often as they come, an
    empty table gives none. ``shares`` gives sources a target proportion (those
    left out keep what remains in proportion to their size); by default each
    source's share of all tokens is its target, which no window misses by more
    than a quantum and the deficit it carries on. Sources outside the ``queues``
    largest, unless named in ``shares``, are such a queue together; inside it,
    each is dealt its share of their tokens in turns of about a quantum.

    Documents are cut once for every ``quantum`` tokens of their source at most,
    and once more where a window ends beyond their source's whole quanta.
    """
    tokens = stored(tokenised(docs, vocabulary, end_id), "tokens")
    parts = stored(tokens.groupBy("queue", "part").agg(F.sum("n").alias("n")), "parts")
    sums = parts.groupBy("queue").agg(F.sum("n").alias("n"))
    asked = F.col("queue").isin([f"={k}" for k in shares]) if shares else F.lit(False)
    # At most QUEUES rows, and as many as shares were given.
    own = (sums.orderBy(F.desc(asked), F.desc("n"), "queue")
           .limit(queues + len(shares or {})).collect())
    slots = {r["queue"]: i for i, r in enumerate(own)}
    held = [r["n"] for r in own]
    total = parts.agg(F.sum("n")).first()[0] or 0
    held.append(total - sum(held))
    target = _targets(slots, held, shares)
    spark = docs.sparkSession
    named = F.broadcast(spark.createDataFrame(list(slots.items()), "queue string, slot int"))
    placed = (parts.join(named, "queue", "left")
              .withColumn("slot", F.coalesce("slot", F.lit(len(slots)))))
    placed = running(placed, ["slot", "queue", "part"], "n", "base")
    starts = F.array(*[F.lit(int(x)) for x in np.cumsum([0, *held[:-1]])])
    bases = stored(placed.select("queue", "part", "slot",
                                 (F.col("base") - F.get(starts, F.col("slot"))).alias("base")),
                   "bases")
    rows = tokens.join(bounded(bases), ["queue", "part"]).select(
        "doc_id", "queue", "slot", (F.col("base") + F.col("before")).alias("place"), "n", "ids")
    if not held[-1]:
        return _pieces(rows.withColumn("path", F.lit(None).cast(PATH)), held, length, target,
                       quantum, with_ids)
    small = _tree(sums.join(named, "queue", "left_anti"))
    # Each small source holds less than one of QUEUES shares, so no key is hot.
    spread = (rows.where(F.col("slot") == len(slots))
              .join(bounded(small, SMALL), "queue")
              .withColumn("place", F.col("place") - F.col("first")).drop("first"))
    rows = rows.where(F.col("slot") < len(slots)).withColumn("path", F.lit(None).cast(PATH))
    return _pieces(rows.unionByName(spread), held, length, target, quantum, with_ids)


# From a source up to the root: its node, its place there, and the totals of all places.
PATH = "array<struct<node: bigint, slot: int, totals: array<bigint>>>"
# Sources whose paths are broadcast.
SMALL = 10_000


def _tree(sums: DataFrame) -> DataFrame:
    """queue, ``first`` (the tokens of queues before it by name) and PATH of each source.

    Sources are ranked by size, so those that share a node are of like size.
    """
    ranked = running(sums.withColumn("one", F.lit(1)).withColumn("less", -F.col("n")),
                     ["less", "queue"], "one", "rank").select("queue", "n", "rank")
    rows = stored(running(ranked, ["queue"], "n", "first"), "ranked")
    left, below = rows.count(), rows.select(F.col("rank").alias("key"), "n")
    out, steps, size = rows.drop("n"), [], 1
    while left > 1 or not steps:
        level = len(steps)
        node = F.floor(F.col("key") / BRANCH).cast("bigint")
        nodes = stored(below.groupBy(node.alias("node")).agg(F.sort_array(F.collect_list(
            F.struct("key", "n")))["n"].alias("totals"), F.sum("n").alias("n")), "nodes")
        mine = F.floor(F.col("rank") / size).cast("bigint")
        out = (out.withColumn("node", F.floor(mine / BRANCH).cast("bigint"))
               .join(nodes.select("node", "totals"), "node")
               .withColumn(f"step{level}", F.struct(
                   "node", F.pmod(mine, F.lit(BRANCH)).cast("int").alias("slot"), "totals"))
               .drop("node", "totals"))
        steps.append(f"step{level}")
        below, size = nodes.select(F.col("node").alias("key"), "n"), size * BRANCH
        left = -(-left // BRANCH)
    return stored(out.select("queue", "first", F.array(*steps).cast(PATH).alias("path")), "tree")


def _targets(slots: dict[str, int], held: list[int], shares: dict[str, float] | None):
    if not shares:
        return None
    given = {slots[f"={k}"]: v for k, v in shares.items() if f"={k}" in slots}
    rest = max(0.0, 1 - sum(given.values()))
    others = sum(n for i, n in enumerate(held) if i not in given)
    out = [given.get(i, rest * n / others if others else 0.0) for i, n in enumerate(held)]
    return out if sum(out) > 0 else None


def _pieces(rows: DataFrame, held: list[int], length: int, target, quantum: int,
            with_ids: bool) -> DataFrame:
    quantum = quantum_of(length, quantum)
    turn = -(-TURN // quantum) * quantum

    def run(batches):
        plan, nodes = Plan(held, length, target, quantum=quantum), OrderedDict()

        def places(path, place, n):
            """(skipped, place, length) in the queue the windows are dealt from."""
            runs = [(0, place, n)]
            for level, step in enumerate(path or ()):
                key = (level, step["node"])
                if key not in nodes:
                    nodes[key] = Plan(step["totals"], turn * len(step["totals"]),
                                      spans=NODE_SPANS, quantum=quantum)
                    if len(nodes) > NODES:
                        nodes.popitem(last=False)
                nodes.move_to_end(key)
                node = nodes[key]
                runs = [(skipped + done, window * node.length + offset, size)
                        for skipped, at, m in runs
                        for done, size, window, offset in node.pieces(step["slot"], at, m)]
            return runs

        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch, out = whole.slice(at, AT_ONCE), []
                for i, (queue, slot, place, path, n, packed) in enumerate(zip(
                        *[column_of(batch, c).to_pylist()
                          for c in ("queue", "slot", "place", "path", "n", "ids")])):
                    if len(packed) < 4 * n:
                        packed = np.frombuffer(packed, "<u2").astype("<u4").tobytes()
                    for skipped, at_place, m in places(path, place, n):
                        for done, size, window, offset in plan.pieces(slot, at_place, m):
                            start = skipped + done
                            ids = packed[4 * start:4 * (start + size)]
                            out.append((i, start, size, zlib.crc32(ids), n, window, offset,
                                        queue, ids))
                if out:
                    yield _batch(batch, out, with_ids)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
             "sequence_id bigint, offset bigint, source_queue string"
             + (", ids array<int>" if with_ids else ""))


def _batch(batch: pa.RecordBatch, out: list[tuple], with_ids: bool) -> pa.RecordBatch:
    i, start, size, crc, n, window, offset, queue, ids = zip(*out)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
             "source_queue"]
    columns = [column_of(batch, "doc_id").take(pa.array(i)),
               *[pa.array(x, pa.int64()) for x in (start, size, crc, n, window, offset)],
               pa.array(queue, pa.string())]
    if with_ids:
        names, columns = [*names, "ids"], [*columns, ids_column(list(ids))]
    return pa.RecordBatch.from_arrays(columns, names)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    """The pieces of all documents, without their ids."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
