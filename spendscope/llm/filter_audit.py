"""Filter interaction audit by truth-table survival words.

Five filters look at every text.  A document's failures are five bits, and
its survival word has one bit for each of the 32 subsets of filters: set
when the document survives that subset.  Per part (language) and label,
carry-save positional popcounts turn the words into the number of
survivors of every subset.  Those 32 counts answer everything that is
asked of an order of filters: what each step removes, what it would have
removed alone, and its Shapley share over all orders.

Filter E (a text identical to one with a smaller id) needs the whole
table: the smallest id of each text digest is aggregated (map-side first),
and rows meet it by their own id, so no task holds a group of copies.

Defined results: null text equals empty text; words are maximal runs of
``[^\\x20\\x09-\\x0D]``; a null part equals the empty one; a null id is
neither smaller nor larger than another, so such a row never fails E, and
has no label; rows that repeat an id and a text are not copies of each
other; of several labels of an id any 1 counts; an empty table gives no
rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.llm.common import Scratch

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of the words
MOST_UPPER = 10  # percent of the code points
SYMBOLS = "#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HELD_PARTS = 4096  # parts whose counts a task keeps before it hands them on


def failures(df: DataFrame, id_col: str, text_col: str, part_col: str, least_words: int, least_distinct: int,
             most_upper: int, symbols: str) -> DataFrame:
    """(id, part, digest, fails): the failure bits of filters A to D of every row."""
    marks = symbols.encode()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pc.fill_null(batch.column(2), "")
            n_chars = pc.utf8_length(text).to_numpy()
            fails, digests = np.zeros(len(n_chars), np.int32), []
            for i, b in enumerate(text.cast(pa.binary()).to_pylist()):
                words = b.split()  # bytes split at exactly the six characters that end words
                n = len(words)
                fails[i] = ((n < least_words) | (100 * len(set(words)) < least_distinct * n) << 1
                            | (100 * (len(b) - len(b.translate(None, UPPER))) > most_upper * int(n_chars[i])) << 2
                            | (len(b.translate(None, marks)) < len(b)) << 3)
                digests.append(hashlib.sha256(b).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(fails)],
                                             names=["id", "part", "digest", "fails"])

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType)]
                          + T._parse_datatype_string("part string, digest binary, fails int").fields)
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                     F.col(text_col).alias("text")).mapInArrow(look, schema)


def survival_word(fails: int) -> int:
    """Bit s is set when no filter of subset s is among the failures."""
    return sum(1 << s for s in range(SUBSETS) if not s & fails)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set.

    Full adders work on all bits at once: three words of one weight become
    a sum word of that weight and a carry word of the next, until at most
    two words of each weight are left to be read bit by bit."""
    counts, bit, weight = np.zeros(32, np.int64), np.arange(32, dtype=np.uint32), 1
    level = words.astype(np.uint32)
    while len(level):
        carries = []
        while len(level) > 2:
            k = len(level) // 3
            a, b, c = level[:k], level[k:2 * k], level[2 * k:3 * k]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, level[3 * k:]])
        for word in level:
            counts += weight * ((word >> bit) & np.uint32(1)).astype(np.int64)
        level, weight = np.concatenate([*carries, np.zeros(0, np.uint32)]), 2 * weight
    return counts


def survival_words(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                   good_col: str = "quality", toxic_col: str = "toxic", least_words: int = LEAST_WORDS,
                   least_distinct: int = LEAST_DISTINCT, most_upper: int = MOST_UPPER, symbols: str = SYMBOLS) -> DataFrame:
    """One row per input row: id, part, fails (bits of A to E), word, good, toxic."""
    scratch = Scratch(df.sparkSession, "filter-audit")
    rows = scratch.table(failures(df, id_col, text_col, part_col, least_words, least_distinct, most_upper, symbols), "rows")
    known = rows.where("id IS NOT NULL")
    firsts = known.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.coalesce(F.max(F.col(good_col) == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col(toxic_col) == 1), F.lit(False)).alias("toxic"))
    seen = known.join(firsts, ["id", "digest"], "left").join(marked, "id", "left")
    last = 1 << FILTERS.index("E")
    seen = seen.withColumn("fails", F.col("fails") + F.when(F.col("first"), 0).otherwise(last)).drop("first", "digest")
    nameless = rows.where("id IS NULL").select("id", "part", "fails", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    table = F.array(*[F.lit(int(np.uint32(survival_word(f)).view(np.int32))) for f in range(SUBSETS)])
    return seen.unionByName(nameless).select(
        "id", "part", "fails", F.get(table, F.col("fails")).alias("word"), F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))


def survivors(words: DataFrame) -> DataFrame:
    """(part, subset, n, n_good, n_toxic) from ``survival_words``: how many rows survive each subset of filters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def sums() -> pa.RecordBatch:
            n = np.array(list(held.values())).reshape(-1, 3, 32)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(list(held), object), 32), pa.string()),
                 pa.array(np.tile(np.arange(32, dtype=np.int32), len(held))), *[pa.array(n[:, k].ravel()) for k in range(3)]],
                names=["part", "subset", "n", "n_good", "n_toxic"])

        for batch in batches:
            part = batch.column(0).dictionary_encode()
            code = part.indices.to_numpy()
            word = batch.column(1).to_numpy().view(np.uint32)
            labels = [np.ones(len(word), bool), *[batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3)]]
            order = np.argsort(code, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
                if len(at):
                    name = part.dictionary[int(code[at[0]])].as_py()
                    held[name] = held.get(name, 0) + np.stack([positional_popcount(word[at[x[at]]]) for x in labels])
            if len(held) > HELD_PARTS:
                yield sums()
                held.clear()
        if held:
            yield sums()

    return words.select("part", "word", "good", "toxic") \
        .mapInArrow(count, "part string, subset int, n long, n_good long, n_toxic long") \
        .groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "n_good", "n_toxic")])


def interactions(counts: DataFrame) -> DataFrame:
    """The audit of every order of the filters, from ``survivors``: one row per part, order and step."""
    per_part = counts.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("subset", "n", "n_good", "n_toxic"))).alias("c")) \
        .select("part", *[F.col(f"c.{k}").alias(k) for k in ("n", "n_good", "n_toxic")])  # 32 of each
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = list(itertools.permutations(range(len(FILTERS))))
        bits = 1 << np.array(orders)
        after = np.cumsum(bits, axis=1)
        before, all_else = after - bits, SUBSETS - 1 - bits
        for batch in batches:
            for part, *sums in zip(*[c.to_pylist() for c in batch.columns]):
                n, good, toxic = (np.array(x, np.int64) for x in sums)
                removed = n[before] - n[after]
                shapley = np.bincount(np.array(orders).ravel(), removed.ravel(), len(FILTERS)).astype(np.int64)
                columns = [n[after], removed, n[0] - n[bits] - removed, n[all_else] - n[SUBSETS - 1],
                           good[before] - good[after], toxic[before] - toxic[after], shapley[np.array(orders)]]
                steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders))
                text = ["".join(FILTERS[f] for f in o) for o in orders for _ in o]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(text), pa.string()), pa.array(text), pa.array(steps),
                                                  *[pa.array(c.ravel()) for c in columns]], names=names)

    return per_part.mapInArrow(audit, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names[3:]))


def filter_audit(df: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """All orders of the five filters over ``df``; parameters as for ``survival_words``."""
    return interactions(survivors(survival_words(df, labels, **parameters)))
