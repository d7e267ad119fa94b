"""Token counts by a compiled finite-state transducer.

The merges of a BPE vocabulary are compiled, as states are met, into a
deterministic transducer: it reads one symbol of a word and emits by how many
the token count changes. A state holds every suffix of the word so far that
could still begin a longer token, with the token before that suffix and the
count up to there; nothing else of the past can matter, because a row of tokens
is what the merges give exactly if each two neighbours stay apart when encoded
by themselves. ASCII white space resets the transducer.

Texts are cut into chunks. What a chunk does to any entry state is a state map:
the symbols before its first reset, which meet the entry state; a count that no
longer depends on it; the symbols after the last reset, which make the exit
state. Maps compose associatively, so the chunks of a text are counted apart
from each other and composed in a parallel prefix scan, level by level.
"""

from __future__ import annotations

import json
from unicodedata import category, normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terrafold.llm.common import column_of, digest_of, slices, table, text_of
from terrafold.llm.token_store import raw_texts
from terrafold.llm.tokens import (
    REMEMBERED,
    WORD_VOCABULARY,
    Remembered,
    byte_letters,
    runs_of,
    vocabulary_path,
)
from terrafold.workspace import stored

LIMIT = 2048
# Characters a chunk, and chunk maps composed at once.
CHUNK_CHARS = 1 << 15
FAN = 64
# States kept; beyond it the table starts anew.
STATES = 100_000

_SPACES = b" \t\n\r\x0b\x0c"
_COUNTERS: dict[str, Counter] = {}


class Transducer:
    """Emitted token counts along the symbols of one word.

    Symbols are the vocabulary's single characters, the word's last one in its
    word-end form. State 0 is the word's beginning.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str,
                 most_states: int = STATES):
        self.ids = vocabulary
        self.end = end
        self.rank = {}
        self.symbols: dict[int, tuple[int, ...]] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[int | None] = [None]
        self.most_states = most_states
        for text, token in vocabulary.items():
            if len(text.removesuffix(end)) == 1 or text == end:
                self._plant(token, (token,))
        for order, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list | tuple) else pair.split(" ")
            left, right = vocabulary[a], vocabulary[b]
            made = vocabulary[a + b]
            self.rank[left, right] = (order, made)
            if made not in self.symbols:
                self.halves[made] = (left, right)
                self._plant(made, self.symbols[left] + self.symbols[right])
        self.apart: dict[tuple[int, int], bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.number = {((0, None, 0),): 0}
        self.states = [((0, None, 0),)]
        self.steps: list[dict[int, tuple[int, int]]] = [{}]

    def _plant(self, token: int, symbols: tuple[int, ...]) -> None:
        self.symbols[token] = symbols
        node = 0
        for s in symbols:
            if s not in self.trie[node]:
                self.trie[node][s] = len(self.trie)
                self.trie.append({})
                self.token_at.append(None)
            node = self.trie[node][s]
        # Only a token that the merges make of its own symbols can ever be emitted.
        if self._merged(symbols) == [token]:
            self.token_at[node] = token

    def _merged(self, symbols) -> list[int]:
        """The merges applied to a short row of symbols, lowest rank first."""
        row = list(symbols)
        while len(row) > 1:
            best = min(((self.rank[p][0], i) for i, p in enumerate(zip(row, row[1:]))
                        if p in self.rank), default=None)
            if best is None:
                break
            i = best[1]
            row[i:i + 2] = [self.rank[row[i], row[i + 1]][1]]
        return row

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """From the outermost symbol to the token itself: (part, rank that uses it up)."""
        key = (token, side)
        if key not in self.spines:
            inner = self.halves.get(token)
            if inner is None:
                self.spines[key] = [(token, float("inf"))]
            else:
                half = self._spine(inner[side], side)
                self.spines[key] = [*half[:-1], (half[-1][0], self.rank[inner][0]),
                                    (token, float("inf"))]
        return self.spines[key]

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether a and b next to each other are never joined across their border.

        Both grow along the border in order of rank; a merge across it happens if
        its rank comes before either side is used up, the left one on a tie.
        """
        key = (a, b)
        known = self.apart.get(key)
        if known is not None:
            return known
        left, right, i, j = self._spine(a, 1), self._spine(b, 0), 0, 0
        rank, known = self.rank, True
        while True:
            (x, used_x), (y, used_y) = left[i], right[j]
            merge = rank.get((x, y))
            if merge is not None and merge[0] < used_x and merge[0] <= used_y:
                known = False
                break
            if used_x <= used_y:
                i += 1
                if i == len(left):
                    break
            else:
                j += 1
        if len(self.apart) > 4 * self.most_states:
            self.apart.clear()
        self.apart[key] = known
        return known

    def _step(self, state: int, symbol: int) -> tuple[int, int]:
        """Compile one transition: the next state and the emitted change of the count."""
        went, last, before = [], None, 0
        for node, token, count in self.states[state]:
            child = self.trie[node].get(symbol)
            if child is None:
                continue
            here = self.token_at[child]
            if here is not None and (token is None or self._stay_apart(token, here)):
                last, before = here, count
            if self.trie[child]:
                went.append((child, token, count))
        if last is None:
            raise ValueError("the vocabulary cannot express a symbol")
        emitted = before + 1
        after = ((0, last, 0), *((n, t, c - emitted) for n, t, c in went))
        if after not in self.number:
            self.number[after] = len(self.states)
            self.states.append(after)
            self.steps.append({})
        out = self.steps[state][symbol] = (self.number[after], emitted)
        return out

    def count(self, symbols: list[int]) -> int:
        """Tokens of one word."""
        if len(self.states) > self.most_states:
            self._clear()
        steps, state, total = self.steps, 0, 0
        for s in symbols:
            found = steps[state].get(s)
            state, emitted = found if found is not None else self._step(state, s)
            total += emitted
        return total


class Counter(Remembered):
    """Token counts of runs: normalise, cut into words, run the transducer over each."""

    def __init__(self, name: str, most: int = REMEMBERED):
        super().__init__(most)
        with open(vocabulary_path(name), encoding="utf-8") as file:
            plan = json.load(file)
        model = plan["model"]
        end = model["end_of_word_suffix"]
        self.machine = Transducer(model["vocab"], model["merges"], end)
        letters = byte_letters()
        self.inner = [model["vocab"][c] for c in letters]
        self.final = [model["vocab"][c + end] for c in letters]
        self.word = regex.compile(plan["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        added = sorted((t["content"] for t in plan["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added)))
        self.words = Words(self, most)
        self.plan = Tokenizer.from_file(vocabulary_path(name))
        self.classes: dict[str, str] = {}

    def learn(self, run: bytes) -> int:
        text = run.decode("utf-8", "replace")
        if "<|" in text:
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.count_plain, parts))
        return self.count_plain(text)

    def count_plain(self, run: str) -> int:
        if run.isascii():
            return sum(map(self.count_word, self.word.findall(run.lower())))
        if any(category(c) == "Cn" for c in run):
            # Editions of the standard differ in these; the tokenizer's own decides.
            lower = self.plan.normalizer.normalize_str(run)
        else:
            # Letter by letter: the tokenizer's lower case knows no context.
            lower = "".join(c.lower() for c in normalize("NFC", run))
        shown = "".join(self.stand_in(c) if category(c) == "Cn" else c for c in lower)
        return sum(self.count_word(lower[m.start():m.end()]) for m in self.word.finditer(shown))

    def stand_in(self, char: str) -> str:
        """For a character that editions of the standard class differently: one of its class.

        The tokenizer's own cutting decides, once a character.
        """
        if char not in self.classes:
            def joins(other: str) -> bool:
                return len(self.plan.pre_tokenizer.pre_tokenize_str(other + char)) == 1

            self.classes[char] = "a" if joins("a") else "!" if joins("!") else "1"
        return self.classes[char]

    def count_word(self, word: str) -> int:
        return self.words[word]

    def count(self, texts: list[bytes]) -> list[int]:
        get = self.__getitem__
        found = [sum(map(get, runs_of(t))) for t in texts]
        self.trim()
        self.words.trim()
        return found


class Words(Remembered):
    """Token counts of single words."""

    def __init__(self, counter: Counter, most: int = REMEMBERED):
        super().__init__(most)
        self.counter = counter

    def learn(self, word: str) -> int:
        raw, of = word.encode(), self.counter
        return of.machine.count([*[of.inner[b] for b in raw[:-1]], of.final[raw[-1]]])


def counter(name: str) -> Counter:
    if name not in _COUNTERS:
        _COUNTERS[name] = Counter(name)
    return _COUNTERS[name]


def state_map(raw: bytes, tool: Counter) -> tuple[bytes, int, bytes, bool]:
    """(symbols before the first reset, count, symbols after the last reset, any reset)."""
    marks = [i for i in (raw.find(bytes([s])) for s in _SPACES) if i >= 0]
    if not marks:
        return raw, 0, b"", False
    first, last = min(marks), max(raw.rfind(bytes([s])) for s in _SPACES)
    return raw[:first], tool.count([raw[first:last]])[0], raw[last + 1:], True


def compose(maps: list[tuple], tool: Counter) -> tuple[bytes, int, bytes, bool]:
    """The map of neighbouring chunks from their maps in order; associative."""
    head, total, tail, reset = [], 0, [], False
    for h, n, t, r in maps:
        (tail if reset else head).append(h)
        if r:
            if reset:
                total += tool.count([b"".join(tail)])[0]
            total, tail, reset = total + n, [t], True
    return b"".join(head), total, b"".join(tail), reset


def closed(found: tuple, tool: Counter) -> int:
    """The count of a whole text from its map: entered at the beginning, ended at the end."""
    head, total, tail, _ = found
    return total + sum(tool.count([head, tail]))


def counts(docs: DataFrame, vocabulary: str = WORD_VOCABULARY,
           chunk_chars: int = CHUNK_CHARS, fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes, n_tokens per row; null counts as the empty text, of no tokens.

    Repeated rows come out repeated; an empty table gives no rows.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    short = rows.where(F.char_length("text") <= chunk_chars)
    one = _counted(short.withColumn("n_bytes", F.octet_length("text").cast("bigint")), kind,
                   vocabulary)
    pieces = (rows.where(F.char_length("text") > chunk_chars)
              .select("doc_id", digest_of().alias("digest"),
                      F.octet_length("text").cast("bigint").alias("n_bytes"),
                      F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk_chars}}}"), F.lit(0))
                      .alias("chunks"))
              .select("doc_id", "digest", "n_bytes", F.posexplode("chunks").alias("at", "text"))
              # Each chunk to a task of its own choosing, so that long texts are shared out.
              .repartition("doc_id", "digest", "at"))
    mapped = stored(_mapped(pieces, kind, vocabulary), "maps")
    level = stored(mapped.groupBy("doc_id", "digest", "at").agg(
        F.first("n_bytes").alias("n_bytes"), F.first("map").alias("map"),
        F.count("*").alias("copies")), "level")
    while (level.agg(F.max("at")).first()[0] or 0) > 0:
        groups = (level.withColumn("to", F.floor(F.col("at") / fan).cast("int"))
                  .groupBy("doc_id", "digest", "to")
                  .agg(F.first("n_bytes").alias("n_bytes"), F.max("copies").alias("copies"),
                       F.array_sort(F.collect_list(F.struct("at", "map"))).alias("maps"))
                  .withColumnRenamed("to", "at"))
        level = stored(_composed(groups, kind, vocabulary), "level")
    whole = _closed(level, kind, vocabulary)
    return one.unionByName(whole)


_MAP = "struct<head: binary, count: bigint, tail: binary, reset: boolean>"


def _as_map(found: dict) -> tuple:
    return found["head"], found["count"], found["tail"], found["reset"]


def _as_struct(found: tuple) -> dict:
    return dict(zip(("head", "count", "tail", "reset"), found))


_ARROW_MAP = pa.struct([("head", pa.binary()), ("count", pa.int64()), ("tail", pa.binary()),
                        ("reset", pa.bool_())])


def _counted(rows: DataFrame, kind: str, vocabulary: str) -> DataFrame:
    def run(batches):
        tool = counter(vocabulary)
        for batch in batches:
            texts = column_of(batch, "text")
            for a, b in slices(texts):
                found = tool.count(raw_texts(texts.slice(a, b - a)))
                yield pa.RecordBatch.from_arrays(
                    [*[column_of(batch, c).slice(a, b - a) for c in ("doc_id", "n_bytes")],
                     pa.array(found, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")


def _mapped(pieces: DataFrame, kind: str, vocabulary: str) -> DataFrame:
    kept = ["doc_id", "digest", "n_bytes", "at"]

    def run(batches):
        tool = counter(vocabulary)
        for batch in batches:
            texts = column_of(batch, "text")
            for a, b in slices(texts):
                maps = [_as_struct(state_map(t, tool))
                        for t in raw_texts(texts.slice(a, b - a))]
                yield pa.RecordBatch.from_arrays(
                    [*[column_of(batch, c).slice(a, b - a) for c in kept],
                     pa.array(maps, _ARROW_MAP)], [*kept, "map"])

    return pieces.mapInArrow(
        run, f"doc_id {kind}, digest binary, n_bytes bigint, at int, map {_MAP}")


def _composed(groups: DataFrame, kind: str, vocabulary: str) -> DataFrame:
    kept = ["doc_id", "digest", "at", "n_bytes", "copies"]

    def run(batches):
        tool = counter(vocabulary)
        for batch in batches:
            maps = [_as_struct(compose([_as_map(m["map"]) for m in row], tool))
                    for row in column_of(batch, "maps").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[column_of(batch, c) for c in kept], pa.array(maps, _ARROW_MAP)],
                [*kept, "map"])

    return groups.mapInArrow(
        run, f"doc_id {kind}, digest binary, at int, n_bytes bigint, copies bigint, map {_MAP}")


def _closed(level: DataFrame, kind: str, vocabulary: str) -> DataFrame:
    def run(batches):
        tool = counter(vocabulary)
        for batch in batches:
            found = [closed(_as_map(m), tool) for m in column_of(batch, "map").to_pylist()]
            copies = column_of(batch, "copies").to_numpy()
            again = pa.array(np.repeat(np.arange(len(found)), copies))
            yield pa.RecordBatch.from_arrays(
                [*[column_of(batch, c).take(again) for c in ("doc_id", "n_bytes")],
                 pa.array(found, pa.int64()).take(again)], ["doc_id", "n_bytes", "n_tokens"])

    return level.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    return counts(table(spark, sf_dir, "documents")).withColumn(
        "over_limit", F.col("n_tokens") > LIMIT)
