"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of word 5-grams (words: runs of ``[^\\x20\\x09-\\x0D]``; a
text of fewer words is one gram of all its words), as 64-bit hashes.
Documents with equal sets are copies and form one class; pairs are sought
between classes only.

1. ``HASHES`` MinHash values per class; classes that agree on a whole band of
   ``ROWS`` values meet.  A pair at the threshold misses all bands with
   probability (1 - 0.8^5)^32 = 3e-6.
2. All that meet in a band are compared with each other, by the low bytes of
   their MinHash values, ``STEP`` at a time; a pair is dropped as soon as the
   posterior probability (uniform prior, binomial agreement) that it reaches
   the threshold is below ``TOLERANCE``.  Bytes that agree by chance only keep
   a pair longer.  A band with more than ``BLOCK`` classes is split into blocks
   that are compared two by two.  A band hands on a spanning forest of the
   pairs that are left, never the pairs, so every such pair is connected: the
   parts that are connected hold all pairs that can reach the threshold.
3. The connected parts are compared in blocks of about ``BLOCK`` classes
   against each other, so no task holds more than two blocks: the same
   incremental pruning on the whole MinHash values, then exactly on the gram
   sets.  A block hands on the number of links of each class and a spanning
   forest of them.

Defined results: null text equals empty text; texts without a word are
copies of each other; repeated rows are copies; ids may be null or repeat;
an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.llm.common import Scratch, connected_components, shuffle_partitions, sorted_groups
from spendscope.llm.text import chunks, is_not_space, mix64, word_hashes

WORDS = 5
THRESHOLD = 0.8
ROWS, BANDS = 5, 32
HASHES = ROWS * BANDS
TOLERANCE = 1e-6
STEP = 32
BLOCK = 512

FACTORS = mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
OFFSETS = mix64(FACTORS)


def gram_sets(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct gram hashes of the texts, sorted within each, and where each text's begin
    (one more at the end)."""
    h, _, _, _, of, _ = word_hashes(texts, is_not_space)
    n = np.diff(of)
    grams = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for k in range(words):
        grams = grams * np.uint64(0xD6E8FEB86659FD93) + h[k:len(h) - words + 1 + k]
    text = np.repeat(np.arange(len(texts)), n)
    whole = text[:len(grams)] == text[words - 1:] if len(grams) else np.zeros(0, bool)
    grams, owner = mix64(grams[whole]), text[:len(whole)][whole]
    few = ((n > 0) & (n < words)).nonzero()[0]
    if len(few):
        short = np.array([np.bitwise_xor.reduce(mix64(h[of[i]:of[i + 1]] + np.arange(n[i], dtype=np.uint64))) for i in few])
        grams = np.concatenate([grams, mix64(short + n[few].astype(np.uint64))])
        owner = np.concatenate([owner, few])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(texts) + 1))


def signatures(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values (uint32), a row for each text; texts without a gram have the highest values."""
    out = np.full((len(starts) - 1, HASHES), 0xFFFFFFFF, np.uint32)
    some = (np.diff(starts) > 0).nonzero()[0]
    if len(some):
        first = starts[some]
        for i in range(HASHES):
            value = ((grams * FACTORS[i] + OFFSETS[i]) >> np.uint64(32)).astype(np.uint32)
            out[some, i] = np.minimum.reduceat(value, first)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(sig), BANDS), np.uint64)
    for k in range(ROWS):
        keys = mix64(keys + sig[:, k::ROWS].astype(np.uint64) + np.uint64(k + 1))
    return mix64(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest agreements of n values at which the similarity, uniform before, still
    reaches the threshold with at least the tolerance as posterior probability:
    P(sim >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        if total >= tolerance:
            return m
    return n + 1


def survivors(one: np.ndarray, others: np.ndarray, threshold: float) -> np.ndarray:
    """Rows of ``others`` whose agreement with ``one`` leaves the threshold possible,
    compared STEP values at a time."""
    left, matches = np.arange(len(others)), np.zeros(len(others), np.int64)
    for a in range(0, HASHES, STEP):
        matches = matches + (others[left, a:a + STEP] == one[a:a + STEP]).sum(axis=1)
        on = matches >= least_matches_table(threshold)[a // STEP]
        left, matches = left[on], matches[on]
        if not len(left):
            break
    return left


_TABLES: dict[float, list[int]] = {}


def least_matches_table(threshold: float) -> list[int]:
    if threshold not in _TABLES:
        _TABLES[threshold] = [least_matches(n, threshold, TOLERANCE) for n in range(STEP, HASHES + 1, STEP)]
    return _TABLES[threshold]


def find(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def compare_blocks(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between two blocks (or within one) of a neighbourhood: rows (a, b, n) with
    the number n of a's links (b null), or with an edge a - b of a spanning forest (n null)."""
    group = group.drop_duplicates("node").sort_values(["block", "node"])
    i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
    node, block = group["node"].to_numpy(), group["block"].to_numpy()
    sig = np.stack([np.frombuffer(s, np.uint32) for s in group["sig"]])
    sets = [np.frombuffer(s, np.uint64) for s in group["grams"]]
    size = np.array([len(s) for s in sets])
    # grams by number, so that a set is marked in an array
    number = np.unique(np.concatenate(sets), return_inverse=True)[1] if size.sum() else np.zeros(0, np.int64)
    ends = np.cumsum(size)
    sets = [number[e - n:e] for e, n in zip(ends, size)]
    mark = np.zeros(len(number) + 1, bool)
    links, parent, edges = np.zeros(len(node), np.int64), {}, []
    for x in range(len(node)):
        if i != j and block[x] == j:
            break  # the second block's own pairs belong to its own group
        others = np.arange(x + 1, len(node)) if i == j else (block == j).nonzero()[0]
        low, high = np.minimum(size[x], size[others]), np.maximum(size[x], size[others])
        others = others[low >= threshold * high - 1e-9]
        if not len(others) or not size[x]:
            continue
        others = others[survivors(sig[x], sig[others], threshold)]
        mark[sets[x]] = True
        for y in others:
            both = int(mark[sets[y]].sum())
            if both >= threshold * (size[x] + size[y] - both) - 1e-9:
                links[x] += 1
                links[y] += 1
                a, b = find(parent, x), find(parent, int(y))
                if a != b:
                    parent[a] = b
                    edges.append((node[x], node[y]))
        mark[sets[x]] = False
    some = links.nonzero()[0]
    out = pd.DataFrame({"a": pd.array([*node[some], *[a for a, _ in edges]], dtype="Int64"),
                        "b": pd.array([*[None] * len(some), *[b for _, b in edges]], dtype="Int64"),
                        "n": pd.array([*links[some], *[None] * len(edges)], dtype="Int64")})
    return out


def _sets(batches: Iterator[pa.RecordBatch], column: int, words: int):
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "").to_pylist()
        for first, part in chunks(texts):
            grams, starts = gram_sets(part, words)
            ids = [hashlib.blake2b(grams[a:b].tobytes(), digest_size=16).digest() for a, b in zip(starts[:-1], starts[1:])]
            yield batch, first, part, grams, starts, ids


def gram_classes(df: DataFrame, words: int) -> DataFrame:
    """(id, md5, set_id, size, keys, low) of every row; ``low`` has the low bytes of the MinHash values."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, part, grams, starts, ids in _sets(batches, 1, words):
            sig = signatures(grams, starts)
            keys = band_keys(sig)
            size = np.diff(starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(part)),
                 pa.array([hashlib.md5(t.encode()).hexdigest() for t in part]), pa.array(ids, pa.binary()), pa.array(size, pa.int64()),
                 pa.ListArray.from_arrays(np.arange(0, len(part) + 1, dtype=np.int32) * BANDS, keys.ravel()),
                 pa.array([s.tobytes() for s in sig.astype(np.uint8)], pa.binary())], names=["id", "md5", "set_id", "size", "keys", "low"])

    schema = T.StructType([T.StructField("id", df.schema["id"].dataType), *T._parse_datatype_string(
        "md5 string, set_id binary, size long, keys array<long>, low binary").fields])
    return df.select("id", "text").mapInArrow(rows, schema)


def band_forest(low: np.ndarray, first: np.ndarray | None, threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of rows of ``low`` that the pruning leaves; with ``first``,
    of the pairs between rows where it holds and rows where it doesn't."""
    part, out, every = np.arange(len(low)), [], np.arange(len(low))
    for x in range(len(low)) if first is None else np.flatnonzero(first):
        others = every[x + 1:] if first is None else np.flatnonzero(~first)
        others = others[part[others] != part[x]]
        if not len(others):
            continue
        for y in others[survivors(low[x], low[others], threshold)]:
            if part[y] != part[x]:
                out.append((x, int(y)))
                part[part == part[y]] = part[x]
    return out


def met_edges(met: DataFrame, threshold: float, block: int) -> DataFrame:
    """(a, b): per band a spanning forest of the pairs that may reach the threshold.  ``met`` has
    (key, n, node, low): bands with the number of their classes."""
    dealt = met.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")) \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))) \
        .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "low") \
        .repartition(shuffle_partitions(met.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j")

    def whole_groups(batches: Iterator[pa.RecordBatch]):
        """(key, i, j, block, node, low) arrays that end with the end of a group."""
        held: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = [batch.column(k).to_numpy() for k in range(5)]
            low = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(-1, HASHES)
            now = (*numbers, low)
            if held:
                now = tuple(np.concatenate([a, b]) for a, b in zip(held.pop(), now))
            new = np.flatnonzero((np.diff(now[0]) != 0) | (np.diff(now[1]) != 0) | (np.diff(now[2]) != 0)) + 1
            if len(new):
                yield [0, *new], tuple(x[:new[-1]] for x in now)
                held.append(tuple(x[new[-1]:] for x in now))
            else:
                held.append(now)
        if held:
            yield [0, len(held[0][0])], held[0]

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = least_matches_table(threshold)[-1]
        for starts, (_, i, j, inside, node, low) in whole_groups(batches):
            starts = np.array(starts)
            size = np.diff(starts)
            # most bands have two classes: these are compared at once
            at = starts[:-1][(size == 2) & ((i == j)[starts[:-1]] | (inside[starts[:-1]] != inside[np.minimum(starts[:-1] + 1, len(i) - 1)]))]
            near = at[(low[at] == low[at + 1]).sum(axis=1) >= need] if len(at) else at
            a, b = [node[near]], [node[near + 1]]
            for s, n in zip(starts[:-1][size > 2], size[size > 2]):
                own = slice(s, s + n)
                found = band_forest(low[own], None if i[s] == j[s] else inside[own] == i[s], threshold)
                if found:
                    x, y = np.array(found).T
                    a.append(node[own][x])
                    b.append(node[own][y])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return dealt.mapInArrow(edges, "a long, b long").distinct()


def similarity_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``id_col``, class_id (smallest id of its copies), copies,
    n_links (other classes at or above the threshold), group_id (smallest id of all that
    links connect), kept (true for one row of each group)."""
    spark = df.sparkSession
    scratch = Scratch(spark, "ngram-join")
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = scratch.table(gram_classes(docs, words).withColumn("row", F.monotonically_increasing_id()), "rows")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    classes = scratch.table(rows.groupBy("set_id").agg(F.min(first).alias("f"), F.count("*").alias("copies"))
                            .select("set_id", F.col("f.id").alias("class_id"), F.col("f.row").alias("node"), "copies"), "classes")
    heads = scratch.table(rows.where("size > 0").join(classes.select("node").hint("merge"), F.col("row") == F.col("node"))
                          .select("node", "keys", "low"), "heads")

    # the bands that a class shares, at most BANDS, then its bytes go to each of them
    met = heads.select("node", F.explode("keys").alias("key"))
    shared = met.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    bands = met.join(shared.hint("merge"), "key").groupBy("node").agg(F.collect_list(F.struct("key", "n")).alias("bands"))
    met = heads.select("node", "low").join(bands.hint("merge"), "node").select("node", "low", F.explode("bands").alias("b")) \
        .select("b.key", "b.n", "node", "low")
    near = scratch.table(met_edges(met, threshold, BLOCK), "near")
    around = connected_components(near, scratch)
    sizes = around.groupBy("component").agg(F.count("*").alias("n"))
    members = around.join(sizes, "component").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")) \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .select("node", "component", "blocks", "block")
    members = scratch.table(members.join(classes, "node").select("node", "component", "blocks", "block", "set_id",
                                                                 F.col("class_id").alias("head_id")), "members")
    scratch.drop(heads)

    # the members' texts, read again; a repeated id may bring another text, which its set tells
    texts = docs.join(members.hint("merge"), F.col("id").eqNullSafe(F.col("head_id"))) \
        .select("text", "set_id", "node", "component", "blocks", "block")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, part, grams, starts, ids in _sets(batches, 0, words):
            here = batch.slice(first, len(part))
            sig = signatures(grams, starts)
            right = pa.array([a == b for a, b in zip(ids, here.column(1).to_pylist())])
            yield pa.RecordBatch.from_arrays(
                [*here.columns[2:], pa.array([s.tobytes() for s in sig], pa.binary()),
                 pa.array([grams[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])], pa.binary())],
                names=["node", "component", "blocks", "block", "sig", "grams"]).filter(right)

    loaded = texts.mapInArrow(sets, "node long, component long, blocks int, block int, sig binary, grams binary") \
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))) \
        .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "block", "node", "sig", "grams") \
        .repartition(shuffle_partitions(spark), "component", "i", "j").sortWithinPartitions("component", "i", "j")

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for group in sorted_groups(batches, ["component", "i", "j"]):
            if len(group) > 1:
                out.append(compare_blocks(group, threshold))
                held += len(out[-1])
            if held > 10_000:
                yield pd.concat(out)
                out, held = [], 0
        if out:
            yield pd.concat(out)

    found = scratch.table(loaded.mapInPandas(links, "a long, b long, n long"), "links")
    counts = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n_links")).withColumnRenamed("a", "node")
    linked = scratch.table(connected_components(found.where("b IS NOT NULL").select("a", "b"), scratch), "groups")
    decided = classes.join(counts, "node", "left").join(linked, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    firsts = decided.groupBy("component").agg(F.min(F.struct(
        F.col("class_id").isNull().alias("no_id"), F.col("class_id").alias("id"), F.col("node").alias("row"))).alias("f"))
    decided = scratch.table(decided.join(firsts, "component").select(
        "set_id", "class_id", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("f.id").alias("group_id"), F.col("f.row").alias("kept_row")), "decided")
    scratch.drop(near, members, found, linked)
    return rows.select("id", "md5", "row", "set_id").join(decided.hint("merge"), "set_id") \
        .select(F.col("id").alias(id_col), "class_id", "copies", "n_links", "group_id",
                (F.col("row") == F.col("kept_row")).alias("kept"), F.col("md5").alias("text_md5"))


def one_of_each_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with ``df``'s own columns: one of each group."""
    own = [F.col(f"`{c}`") for c in df.columns]
    keys = ["__id", "__md5"]
    kept = similarity_join(df, id_col, text_col).where("kept") \
        .select(F.col(id_col).alias("k__id"), F.col("text_md5").alias("k__md5"))
    marked = df.withColumn("__id", F.col(id_col)) \
        .withColumn("__md5", F.md5(F.coalesce(text_col, F.lit("")).cast("binary")))
    on = [F.col(c).eqNullSafe(F.col(f"k{c}")) for c in keys]
    # rows equal in id and text are repeats of one row: one of them stays
    return marked.join(kept, on, "left_semi").dropDuplicates(keys).select(*own)
