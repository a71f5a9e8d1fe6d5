"""Best-fit packing of token sequences.

A document's tokens (and the end token) are one piece; only documents
longer than ``CAPACITY`` are cut, into pieces of that length and a rest.
The pieces' length histogram (at most ``CAPACITY`` numbers, whatever the
corpus) is all that reaches the driver.  There the configuration linear
program (a configuration is a multiset of lengths that fits one sequence)
is solved by multiplicative weights over all configurations at once: a
configuration has the product of its lengths' weights, a knapsack dynamic
program sums them up, and each step multiplies a length's weight by its
demand over its cover.  Free tokens have a penalty, which is sharpened until
the cover (uncovered pieces counted in sequences of their own) is within
``GAP`` of a lower bound, proved by the logarithms of the weights as prices and the
highest-priced configuration.  Whole sequences are drawn from the solution,
as far as pieces are left; the program is solved again for what remains, until a
round places less than ``PROGRESS`` of it.  The remaining pieces are placed
best fit, longest first, also into the free room of the sequences drawn.
The plan is a table of (length, first rank, sequence, offset) runs; the
pieces of a length are ranked by a distributed prefix sum and look their
place up.

Defined results: null text equals empty text (one piece: the end token);
texts of any length are tokenized whole; repeated rows are packed each;
an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.llm.common import Scratch, prefix_sums

CAPACITY = 4096
END_TOKEN = 1
LP_STEPS = 10  # steps of the multiplicative weights between two proofs
GAP = 0.0001  # the linear program is solved when its bounds are so close
SOFTEST = 1e-100  # weight of a wholly free sequence at the start; it is squared until the bounds meet
TINY = 1e-280  # below, doubles lose precision
SAMPLES = 50_000  # configurations drawn in one round; a larger plan uses each several times
PROGRESS = 0.1  # a round that places less than this share of what is left is the last
MEMO_WORDS = 400_000  # words a worker remembers; then it starts anew
CHUNK_CHARS = 8_000_000  # text tokenized at once

#: All letters below U+0100.
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


MARKS = ".,!?;:"
#: A word of plain letters (below U+0100, where composed form changes nothing), then sentence marks.
PLAIN = r"^[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+[.,!?;:]*$"


class WordIds:
    """Token ids of whitespace-separated words, each encoded once.

    A space or newline always ends a token of this vocabulary and leaves no
    id, so a text's ids are those of its words in order.  Plain words are
    taken apart for a whole chunk at once: their letters go to the model
    directly, in lower case, and the ids of the sentence marks behind them
    follow; all others take the tokenizer's whole path."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: 256 + i for i, b in enumerate(hidden)}
        self.clear()

    def clear(self) -> None:
        self.letters: dict[str, int] = {}
        self.others: dict[str, int] = {}
        # entry 0 has no ids
        self.starts, self.lens, self.pool = array("q", [0]), array("q", [0]), array("I")

    def add(self, ids: list[int]) -> int:
        self.starts.append(len(self.pool))
        self.lens.append(len(ids))
        self.pool.extend(ids)
        return len(self.starts) - 1

    def place_letters(self, core: str) -> int:
        shown = core if core.isascii() else core.encode().decode("latin-1").translate(self.alphabet)
        k = self.letters[core] = self.add([t.id for t in self.model.tokenize(shown)])
        return k

    def place_other(self, text: str) -> int:
        k = self.others[text] = self.add(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return k

    @staticmethod
    def entries(texts: pa.Array, known: dict[str, int], place) -> np.ndarray:
        """The entry of each text, looked up once for equal ones."""
        coded = texts.dictionary_encode()
        get = known.get
        at = np.array([k if (k := get(w)) is not None else place(w) for w in coded.dictionary.to_pylist()], np.int64)
        return at[coded.indices.to_numpy()] if len(at) else np.zeros(0, np.int64)

    def of(self, words: pa.Array) -> np.ndarray:
        """Two entries for each word: its letters and the marks behind them, or the whole word and entry 0."""
        if len(self.starts) > MEMO_WORDS:
            self.clear()
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
        out = np.zeros((len(words), 2), np.int64)
        some = words.filter(pa.array(plain))
        cores = pc.utf8_rtrim(some, MARKS)
        out[plain, 0] = self.entries(pc.utf8_lower(cores), self.letters, self.place_letters)
        length = pc.utf8_length(some).to_numpy()
        marked = np.flatnonzero(pc.utf8_length(cores).to_numpy() < length)
        if len(marked):
            tails = pc.utf8_ltrim(some.take(pa.array(marked)), LETTERS)
            out[np.flatnonzero(plain)[marked], 1] = self.entries(tails, self.others, self.place_other)
        out[~plain, 0] = self.entries(words.filter(pa.array(~plain)), self.others, self.place_other)
        return out


def text_ids(words: WordIds, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a chunk of texts, and where each text's ids begin (one more at the end)."""
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    coded = lists.flatten().dictionary_encode()
    entry = words.of(coded.dictionary)[coded.indices.to_numpy()].ravel()
    start, length, pool = (np.array(x) for x in (words.starts, words.lens, words.pool))
    start, length = start[entry], length[entry]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    ids = pool[np.repeat(start - (ends - length), length) + np.arange(total)]
    bounds = np.concatenate([[0], ends[1::2]])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    return ids, bounds


def pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_token: int = END_TOKEN) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_path)
        end = np.array([end_token], np.uint32)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            cuts = np.unique(np.searchsorted(sizes, np.arange(1, sizes[-1] // CHUNK_CHARS + 1) * CHUNK_CHARS)) if len(sizes) else []
            edges = [0, *[int(c) for c in cuts if 0 < c < len(texts)], len(texts)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                ids, bounds = text_ids(words, texts.slice(a, b - a))
                row, piece, start, length, crc = [], [], [], [], []
                for i in range(b - a):
                    own = np.concatenate([ids[bounds[i]:bounds[i + 1]], end])
                    for k, s in enumerate(range(0, len(own), capacity)):
                        part = own[s:s + capacity]
                        row.append(a + i)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.astype("<u4", copy=False).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType),
                           *T._parse_datatype_string(PIECES).fields[1:]])
    return df.select(id_col, text_col).mapInArrow(cut, schema)


def best_configuration(price: np.ndarray, capacity: int) -> float:
    """Unbounded knapsack: the highest price of a multiset of lengths that fits
    ``capacity``; ``price`` holds -inf where there is no such length."""
    best, dense = np.zeros(capacity + 1), price[1:]  # best[capacity - c] is that of room c
    for c in range(1, capacity + 1):
        best[capacity - c] = max(best[capacity - c + 1], (best[capacity - c + 1:] + dense[:c]).max())
    return float(best[0])


def simple_bound(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> float:
    """The largest of known lower bounds on the linear program: the tokens, and the
    rounded prices floor((k + 1) x) / k of a share x of the capacity (x itself where
    (k + 1) x is whole)."""
    low = float(lengths @ demand) / capacity
    for k in range(1, capacity):
        whole, rest = np.divmod((k + 1) * lengths, capacity)
        low = max(low, float(np.where(rest == 0, lengths / capacity, whole / k) @ demand))
    return low


def normalized(weight: np.ndarray) -> np.ndarray:
    """The weights times exp(t * length), for the t that makes their sum 1.  All
    configurations of one total length change by the same factor."""
    at = weight.nonzero()[0]
    logs = np.log(weight[at])
    lo, hi = -800.0, 800.0
    while hi - lo > 1e-14 * max(1, abs(lo)):
        t = (lo + hi) / 2
        e = logs + t * at
        total = e.max() + np.log(np.exp(e - e.max()).sum())
        if abs(total) < 1e-12:
            break
        lo, hi = (lo, t) if total > 0 else (t, hi)
    out = np.zeros(len(weight))
    out[at] = np.exp(logs + t * at)
    return out


def completions(weight: np.ndarray, waste: float, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each total c the weight of all sequences of lengths that sum up to c, and
    of those up to c, ``waste`` being the factor of each token left free."""
    back, dense = np.zeros(capacity + 1), weight[1:]
    back[capacity] = 1.0
    for c in range(1, capacity + 1):
        back[capacity - c] = back[capacity - c + 1:] @ dense[:c]
    exact = back[::-1].copy()
    most, total = np.empty(capacity + 1), 0.0
    for c, x in enumerate(exact.tolist()):
        most[c] = total = total * waste + x
    return exact, most


class Fractional:
    """Solution of the configuration linear program: configurations have the product
    of their lengths' weights (and of ``waste`` for each free token), ``value``
    sequences in all; ``low`` <= LP value <= ``high``."""

    def __init__(self, lengths: np.ndarray, demand: np.ndarray, capacity: int, steps: int, waste: float | None = None):
        """With ``waste``, the penalty of an earlier solution, that one is taken and nothing proved."""
        tokens, alone = float(lengths @ demand), 1 / (capacity // lengths)
        self.low, self.high = 0.0 if waste else simple_bound(lengths, demand, capacity), float("inf")
        weight = np.zeros(capacity + 1)
        weight[lengths] = demand / demand.sum()
        weight, before, still, prove = normalized(weight), float("inf"), 0, waste is None
        waste = waste or SOFTEST ** (1 / capacity)
        while True:
            for _ in range(steps):
                exact, most = completions(weight, waste, capacity)
                if most[capacity] < TINY:
                    break
                # expected pieces of a length in a configuration
                pieces = (weight * np.convolve(exact, most)[capacity::-1])[lengths] / most[capacity]
                value = tokens / float(pieces @ lengths)
                ratio = demand / np.maximum(value * pieces, TINY)
                used, weight = weight, weight.copy()
                weight[lengths] *= np.clip(ratio, 1e-4, 1e4)
                weight = normalized(np.where(weight > 0, np.maximum(weight, TINY), 0))
            if most[capacity] < TINY:
                if self.high < float("inf"):
                    break  # as sharp as doubles can hold
                waste **= 0.5
                continue
            # what isn't covered takes sequences of its own length
            short = float(np.maximum(demand - value * pieces, 0) @ alone)
            if prove:
                price = np.full(capacity + 1, -np.inf)
                price[lengths] = np.maximum(np.log(used[lengths]) - lengths * np.log(waste), 0)
                best = best_configuration(price, capacity)
                if best > 0:
                    self.low = max(self.low, float(price[lengths] @ demand) / best)
            if value + short < self.high:
                self.high, self.value, self.weight, self.waste, self.most = value + short, value, used, waste, most
            if not prove or self.high <= (1 + GAP) * self.low:
                break
            if short <= GAP / 4 * self.low or value + short > (1 - GAP / 20) * before:
                still = still + 1 if self.high >= (1 - GAP / 20) * before else 0
                if still > 3:
                    break  # neither more steps nor a sharper penalty bring it on
                waste *= waste
            before = min(before, value + short)

    def sample(self, n: int, rng: np.random.Generator) -> np.ndarray:
        """``n`` configurations, one a row, filled up with 0.  Those with the same room
        left are dealt evenly over what may follow."""
        capacity = len(self.weight) - 1
        room, items = np.full(n, capacity), [[] for _ in range(n)]
        for c in range(capacity, 0, -1):
            at = (room == c).nonzero()[0]
            if not len(at):
                continue
            # the last entry (length 0): what is left stays free
            share = np.cumsum(np.append(self.weight[c:0:-1] * self.most[:c], self.waste ** c))
            drawn = np.searchsorted(share, (np.arange(len(at)) + rng.random()) / len(at) * share[-1], "right")
            taken = c - np.minimum(drawn, c)
            room[at] = np.where(taken > 0, c - taken, 0)
            for i, x in zip(at.tolist(), taken.tolist()):
                if x:
                    items[i].append(x)
        out = np.zeros((n, max(map(len, items))), np.int64)
        for i, x in enumerate(items):
            out[i, :len(x)] = sorted(x, reverse=True)
        return out


class Packing:
    """``plan``: configurations (lengths, longest first) and how many sequences use
    each; together they hold every piece of the histogram exactly once.  ``low`` and
    ``high`` enclose the LP value (sequences wholly filled by one piece included),
    ``best_fit`` is the share of the tokens that the best fit placed."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, steps: int = LP_STEPS):
        self.plan: list[tuple[list[int], int]] = []
        self.low = self.high = float(histogram.get(capacity) or 0)
        self.best_fit = 0.0
        if histogram.get(capacity):
            self.plan.append(([capacity], histogram[capacity]))
        left = np.zeros(capacity + 1, np.int64)
        for x, n in histogram.items():
            if x < capacity:
                left[x] = n
        total = tokens = int(left @ np.arange(capacity + 1))
        if not total:
            return
        rng, lp = np.random.default_rng(1), None
        while tokens:
            lengths = left.nonzero()[0]
            demand = left[lengths].astype(float)
            if lp is None:
                lp = Fractional(lengths, demand, capacity, steps)
                self.low, self.high = self.low + lp.low, self.high + lp.high
            else:
                lp = Fractional(lengths, demand, capacity, steps, lp.waste)
            # rounding: as many whole sequences as the solution has, as far as pieces are left
            many = max(1, round(lp.value))
            unit = -(-many // SAMPLES)
            drawn, times = np.unique(lp.sample(-(-many // unit), rng), axis=0, return_counts=True)
            order = np.argsort(-times, kind="stable")
            for row, n in zip(drawn[order].tolist(), (times[order] * unit).tolist()):
                config = [x for x in row if x]
                n = min(n, *(int(left[x]) // config.count(x) for x in dict.fromkeys(config)))
                if n > 0:
                    for x in config:
                        left[x] -= n
                    self.plan.append((config, n))
            rest = int(left @ np.arange(capacity + 1))
            if rest > (1 - PROGRESS) * tokens:
                break
            tokens = rest
        self.best_fit = int(left @ np.arange(capacity + 1)) / (total + capacity * (histogram.get(capacity) or 0))
        self.fit_rest(left, capacity)
        self.high = min(self.high, sum(n for _, n in self.plan))  # the plan is a cover, too

    def fit_rest(self, left: np.ndarray, capacity: int) -> None:
        """Best fit, longest first: a piece goes where it leaves the least room, or starts a sequence."""
        by_room: list[list[tuple[list[int], int]]] = [[] for _ in range(capacity + 1)]
        some = np.zeros(capacity + 1, bool)

        def keep(config: list[int], n: int) -> None:
            if n > 0:
                room = capacity - sum(config)
                by_room[room].append((config, n))
                some[room] = True

        for config, n in self.plan:
            keep(config, n)
        for x in left.nonzero()[0][::-1].tolist():
            n = int(left[x])
            while n:
                room = x + int(some[x:].argmax())
                if not some[room]:
                    per = capacity // x
                    keep([x] * per, n // per)
                    keep([x] * (n % per), min(1, n % per))
                    break
                config, times = by_room[room].pop()
                some[room] = bool(by_room[room])
                k = min(n, times)
                keep(config, times - k)
                keep([*config, x], k)
                n -= k
        # the pieces of one length lie together
        self.plan = [(sorted(config, reverse=True), n) for group in by_room for config, n in group]


def solve(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = LP_STEPS) -> list[tuple[list[int], int]]:
    """Configurations (lengths, longest first) and how many sequences use each;
    together they hold every piece of the histogram exactly once."""
    return Packing(histogram, capacity, steps).plan


def place_table(plan: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length its runs: first rank, pieces per sequence, first
    sequence, offset of the first piece of that length."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for config, times in plan:
        offset = 0
        for length in dict.fromkeys(config):
            per = config.count(length)
            runs.setdefault(length, []).append((ranks.get(length, 0), per, sequence, offset))
            ranks[length] = ranks.get(length, 0) + per * times
            offset += per * length
        sequence += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in runs.items()}


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_token: int = END_TOKEN) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    spark = df.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.table(pieces(df, tokenizer_path, id_col, text_col, capacity, end_token)
                        .withColumn("one", F.lit(1)), "pieces")
    # at most `capacity` rows, however long the corpus
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = spark.sparkContext.broadcast(place_table(solve(histogram, capacity)))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.empty((len(length), 2), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for x in np.unique(lengths):
            at = (lengths == x).nonzero()[0]
            first, per, sequence, offset = table.value[int(x)]
            run = np.searchsorted(first, ranks[at], "right") - 1
            nth = ranks[at] - first[run]
            out[at, 0] = sequence[run] + nth // per[run]
            out[at, 1] = offset[run] + nth % per[run] * x
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    ranked = prefix_sums(cut, scratch, ["length"], ["doc_id", "piece", "ids_crc32"], "one", "rank")
    return ranked.withColumn("p", place("length", "rank")) \
        .select(F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32", "p.sequence_id", "p.offset")
