"""Document fingerprints: a Merkle tree over chunks, paragraphs and sections.

A paragraph is a line.  It consists of chunks, which end where a hash of the
last ``WINDOW`` characters is a multiple of ``CHUNK_CHARS``: at texts of any length and
in any script the cuts depend on the characters beside them only, so equal parts
have equal chunks.  A section ends at a blank
line, or after a paragraph whose digest is a multiple of ``SECTION_EVERY``, so
that an edit moves no boundary but its own.  Every inner node digests its
children's digests; the root digests the whole text too, so two texts are
equal exactly if their roots are.

The fingerprint is the tree as text: ``root|section/section``, a section being
``digest:paragraph;paragraph`` and a paragraph ``digest,leaves``, each leaf in ``LEAF`` signs.
:func:`likeness` compares two trees from the top and goes down only where
digests differ; :func:`differing` names the branches that differ, which
locates an edit.

Defined results: null text equals empty text, whose tree has no section;
texts of any length are read whole; documents are ordered by id, descending,
null ids last, rows of the same id by text; a single document is its own next one;
an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.llm.common import Scratch, shuffle_partitions

CHUNK_CHARS = 20  # characters of a chunk on average
LONGEST = 8 * CHUNK_CHARS  # longer ones repeat themselves; they are cut at their smallest hash
WINDOW = 4
LEAF = 5  # signs of 6 bits that show a leaf
SECTION_EVERY = 8

RANGES_PER_TASK = 4  # id ranges that a task of the comparison reads on average
COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def chunks(line: str) -> list[str]:
    """The line, cut where its characters say."""
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    # the hash at a place is that of the WINDOW characters before it
    mixed = np.zeros(len(points), np.uint32)
    for k in range(WINDOW):
        mixed *= np.uint32(0x01000193)
        mixed[k:] += points[:len(points) - k]
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(13)
    ends = (np.flatnonzero(mixed[:-1] % CHUNK_CHARS == 0) + 1).tolist()
    cuts = [0, *ends, len(line)]
    todo = [(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b - a > LONGEST]
    while todo:
        a, b = todo.pop()
        # the first place after each start where the smallest hash is found, in steps of a chunk
        inside = mixed[a + CHUNK_CHARS - 1:b - 1]
        own, last = [a], a
        for at in (np.flatnonzero(inside == inside.min()) + a + CHUNK_CHARS).tolist():
            if at - last >= CHUNK_CHARS:
                own.append(at)
                last = at
        cuts += own[1:]
        own.append(b)
        todo += [(c, d) for c, d in zip(own[:-1], own[1:]) if d - c > LONGEST]
    if len(cuts) > len(ends) + 2:
        cuts.sort()
    return [line[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=15).digest()


def signs(digests: list[bytes]) -> list[str]:
    shown = base64.urlsafe_b64encode(b"".join(digests)).decode()
    return [shown[k:k + LEAF] for k in range(0, len(shown), 20)]


class Tree:
    """sections: [(digest, [(digest, [leaf, ...]), ...]), ...]; a leaf is shown by
    ``LEAF`` signs, a section or paragraph by 12 hex digits."""

    __slots__ = ("root", "sections", "size")

    def __init__(self, text: str):
        sections, paragraphs = [], []
        for line in text.split("\n"):
            if not line.strip():
                if paragraphs:
                    sections.append(paragraphs)
                    paragraphs = []
                continue
            leaves = [digest(x.encode("utf-8", "surrogatepass")) for x in chunks(line)]
            own = digest(b"".join(leaves))
            paragraphs.append((own.hex()[:12], signs(leaves), own))
            if own[0] % SECTION_EVERY == 0:
                sections.append(paragraphs)
                paragraphs = []
        if paragraphs:
            sections.append(paragraphs)
        tops = [digest(b"".join(p[2] for p in s)) for s in sections]
        self.root = digest(b"".join(tops) + text.encode("utf-8", "surrogatepass")).hex()
        self.sections = [(t.hex()[:12], [(p[0], p[1]) for p in s]) for t, s in zip(tops, sections)]
        self.size = sum(len(p[1]) for _, s in self.sections for p in s)

    def text(self) -> str:
        return self.root + "|" + "/".join(
            top + ":" + ";".join(p + "," + "".join(leaves) for p, leaves in s) for top, s in self.sections)


def parse(fingerprint: str) -> Tree:
    out = Tree.__new__(Tree)
    out.root, _, rest = fingerprint.partition("|")
    out.sections = []
    for s in rest.split("/") if rest else []:
        top, _, paragraphs = s.partition(":")
        out.sections.append((top, [(p, [x[k:k + LEAF] for k in range(0, len(x), LEAF)])
                                   for p, x in (q.split(",") for q in paragraphs.split(";"))]))
    out.size = sum(len(p[1]) for _, s in out.sections for p in s)
    return out


def _unmatched(a: list, b: list) -> tuple[list, list, int]:
    """Children of either side that have no equal partner, and the leaves under those that have."""
    spare = Counter(x[0] for x in b)
    left, same = [], 0
    for x in a:
        if spare[x[0]] > 0:
            spare[x[0]] -= 1
            same += sum(len(p[1]) for p in x[1]) if x[1] and isinstance(x[1][0], tuple) else len(x[1])
        else:
            left.append(x)
    right = []
    for x in reversed(b):
        if spare[x[0]] > 0:
            spare[x[0]] -= 1
            right.append(x)
    return left, right[::-1], same


def likeness(a: Tree, b: Tree) -> float:
    """Share of the leaves that both trees have (Jaccard, counting repeats), found
    from the top: equal branches count whole, differing ones are opened."""
    if a.root == b.root:
        return 1.0
    sa, sb, same = _unmatched(a.sections, b.sections)
    pa, pb, more = _unmatched([p for _, s in sa for p in s], [p for _, s in sb for p in s])
    same += more
    la, lb = Counter(x for p in pa for x in p[1]), Counter(x for p in pb for x in p[1])
    same += (la & lb).total()
    either = a.size + b.size - same
    # texts with different roots are never wholly alike, blank lines aside
    return min(same / either, 1 - 1e-9) if either else 0.0


def differing(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """(section, paragraph) of ``a``'s branches without an equal partner in ``b``."""
    if a.root == b.root:
        return []
    spare = Counter(top for top, _ in b.sections)
    open_a = []
    for i, (top, s) in enumerate(a.sections):
        if spare[top] > 0:
            spare[top] -= 1
        else:
            open_a.append((i, s))
    there = Counter(p for top, s in b.sections if spare[top] > 0 for p, _ in s)
    out = []
    for i, s in open_a:
        for j, (p, _) in enumerate(s):
            if there[p] > 0:
                there[p] -= 1
            else:
                out.append((i, j))
    return out


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as many first characters of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the fingerprint of every row."""

    @F.pandas_udf("string")
    def tree(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: Tree(t).text())

    return df.select(F.col(id_col), tree(F.coalesce(F.col(text_col), F.lit(""))).alias("fingerprint"))


def compare_with_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with the fingerprints of its text and its edited text, and the
    likeness of its own to the edited text's and to the next document's.  Ids are
    whole numbers.

    The ids are cut into ranges (a bounded list of cuts, from quantiles of
    all ids); each range is sorted within one task and read with one row
    of look-ahead.  The first document of a range also goes, marked, to the
    range before it (and the first of all to the last range), so texts move
    once and no neighbour is missed."""
    spark = df.sparkSession
    scratch = Scratch(spark, "merkle")
    tasks = shuffle_partitions(spark)
    n = tasks * RANGES_PER_TASK
    ids = scratch.table(df.select(F.col(id_col).cast("long").alias("id")), "ids")
    cuts = np.array(sorted({int(q) for q in ids.approxQuantile("id", [i / n for i in range(1, n)], 1 / (10 * n))}), np.int64)
    known = spark.sparkContext.broadcast(cuts)
    of_id = F.coalesce("id", F.lit(0).cast("long")), F.col("id").isNull()

    @F.pandas_udf("int")
    def part(doc: pd.Series, null: pd.Series) -> pd.Series:
        cuts = known.value
        return pd.Series(np.where(null, len(cuts), len(cuts) - np.searchsorted(cuts, doc, "right")).astype(np.int32))

    # one row for each range that has documents
    filled = ids.withColumn("part", part(*of_id)).groupBy("part").agg(F.max("id").alias("first")).orderBy("part").collect()
    heads = spark.sparkContext.broadcast((
        np.array([r["part"] for r in filled], np.int32), np.array([r["first"] or 0 for r in filled], np.int64),
        np.array([r["first"] is None for r in filled], bool)))

    @F.pandas_udf("int")
    def ahead_in(part: pd.Series, doc: pd.Series, null: pd.Series) -> pd.Series:
        """The range before, for the first documents of a range; else -1."""
        filled, first, first_null = heads.value
        at = np.searchsorted(filled, part)
        is_first = np.where(null, first_null[at], (first[at] == doc) & ~first_null[at])
        return pd.Series(np.where(is_first, filled[at - 1], -1).astype(np.int32))

    here = F.struct(F.col("part").alias("part"), F.lit(False).alias("ahead"))
    there = F.struct(F.col("before").alias("part"), F.lit(True).alias("ahead"))
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")) \
        .withColumn("part", part(*of_id)).withColumn("before", ahead_in("part", *of_id)) \
        .withColumn("go", F.explode(F.when(F.col("before") >= 0, F.array(here, there)).otherwise(F.array(here)))) \
        .select("go.part", "go.ahead", "id", "text") \
        .repartition(tasks, "part").sortWithinPartitions("part", "ahead", F.desc_nulls_last("id"), "text")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None

        def compared(tree: Tree, following: str) -> tuple:
            doc, text, own = held
            new = edited(text, following)
            other = Tree(new)
            return (doc, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), own.text(),
                    other.text(), likeness(own, other), likeness(own, tree))

        for pdf in batches:
            out = []
            ids_here = [None if pd.isna(x) else int(x) for x in pdf["id"]]
            for ahead, doc, text in zip(pdf["ahead"], ids_here, pdf["text"]):
                if ahead and held is None:
                    continue  # a repeat of the look-ahead row
                tree = Tree(text)
                if held is not None:
                    out.append(compared(tree, text))
                held = None if ahead else (doc, text, tree)
            frame = pd.DataFrame(out, columns=COLUMNS)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
             "near_edited double, near_next double"
    return docs.mapInPandas(rows, schema).withColumnRenamed("doc_id", id_col)
