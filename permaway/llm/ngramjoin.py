"""N-gram Jaccard join by a prefix tree over globally ordered shingle sets."""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permaway.llm.batches import text_batches
from permaway.llm.shingles import shingle_set
from permaway.operators.components import connected_components
from permaway.operators.scratch import cut_clean as cut
from permaway.operators.scratch import hint_small, settle

#: Shingles in one chunk of a block, which one task joins with itself or another chunk.
CHUNK = 150_000
#: Share of a set by which the first prefixes are longer than one common shingle asks for.
EXTRA = Fraction(5, 100)


class PrefixTree:
    """Sets as sorted rank sequences in a path-compressed trie, the frequent ranks first,
    so that similar sets share paths and a probe's partial overlap is counted once for all
    sets below. A node is (edge, depth, least size, largest size, longest below, sets
    that end here, children)."""

    def __init__(self, sequences: list[tuple], sizes: list[int], num: int, den: int):
        self.sizes, self.num, self.den = sizes, num, den
        order = sorted(range(len(sequences)), key=sequences.__getitem__)
        self.root = self._node([(sequences[i], i) for i in order], 0)

    def _node(self, group: list, depth: int):
        first, last = group[0][0], group[-1][0]
        stop, most = depth, min(len(first), len(last))
        while stop < most and first[stop] == last[stop]:
            stop += 1
        ends = [i for s, i in group if len(s) == stop]
        children, at = [], len(ends)
        while at < len(group):
            head, nxt = group[at][0][stop], at
            while nxt < len(group) and group[nxt][0][stop] == head:
                nxt += 1
            children.append(self._node(group[at:nxt], stop))
            at = nxt
        own = [self.sizes[i] for _, i in group]
        return frozenset(first[depth:stop]), stop, min(own), max(own), max(len(s) for s, _ in group), ends, children

    def matches(self, ranks: frozenset, size: int):
        """Indexes of the sets with num * |x and y| >= ... num / den of the union."""
        num, both = self.num, self.num + self.den
        stack = [(self.root, 0)]
        while stack:
            (edge, depth, low, high, longest, ends, children), have = stack.pop()
            if num * size > self.den * high or num * low > self.den * size:
                continue
            have += len(edge & ranks)
            most = have + min(longest - depth, len(ranks) - have)
            # The overlap still possible, against what the smallest set below would need;
            # and what a set below already lacks, against what the largest could spare.
            if both * most < num * (low + size) or self.den * high < both * (depth - have) + num * size:
                continue
            for i in ends:
                if both * have >= num * (self.sizes[i] + size):
                    yield i
            stack.extend((c, have) for c in children)


def linked(ids: np.ndarray, sizes: np.ndarray, sets: list, num: int, den: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets, or between side 0 and side 1."""
    if len(ids) < 2:
        return []
    every = np.concatenate(sets)
    tokens, inverse, count = np.unique(every, return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, -count))] = np.arange(len(tokens))
    ranks, shared = rank[inverse], count[inverse] > 1
    at = np.r_[0, np.cumsum([len(s) for s in sets])]
    seqs = [tuple(np.sort(ranks[a:b][shared[a:b]]).tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    held = np.arange(len(ids)) if side is None else np.flatnonzero(side == 0)
    probes = held if side is None else np.flatnonzero(side == 1)
    if len(held) == 0:
        return []
    tree = PrefixTree([seqs[i] for i in held], [int(sizes[i]) for i in held], num, den)
    out = []
    for i in probes.tolist():
        for j in tree.matches(frozenset(seqs[i]), int(sizes[i])):
            a, b = find(i), find(int(held[j]))
            if a != b:
                parent[a] = b
                out.append((int(ids[i]), int(ids[held[j]])))
    return out


def _sets(docs: DataFrame, k: int, num: int, den: int, whole: bool) -> DataFrame:
    """(doc_id, n, digest, tokens): size and digest of each shingle set, with all of its
    hashes or with the prefix that two linked sets share enough of."""
    docs = text_batches(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n, digests, tokens = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k)
                size = len(s)
                n.append(size)
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                p = size if whole else min(size, prefix_length(size, num, den) + int(EXTRA * size))
                tokens.append(s[:p].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))], ["doc_id", "n", "digest", "tokens"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, n bigint, digest binary, tokens array<bigint>")


def prefix_length(n: int, num: int, den: int) -> int:
    """Sets that reach num / den share one of their first so many elements, in any global order."""
    return n - -(-num * n // den) + 1 if n else 0


def _forest(rows: DataFrame, keys: list[str], num: int, den: int) -> DataFrame:
    """(a, b) links found by joining each group of rows(keys, id, n, tokens[, side])."""

    def run(pdf):
        side = pdf["side"].to_numpy() if "side" in pdf else None
        found = linked(pdf["id"].to_numpy(), pdf["n"].to_numpy(), list(pdf["tokens"]), num, den, side)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy(*keys).applyInPandas(run, "a bigint, b bigint")


def alive_classes(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Ids of the sets that share enough of their prefixes with any others to be linked.

    Under one order of hashes, sets that reach the threshold share EXTRA of the smaller
    size and one more; the smaller size is num / den of the larger at least.
    """
    t = classes.select("id", "n", F.explode("tokens").alias("token"))
    # Aggregates that hot shingles are joined with are written down, so that Spark can split the joins.
    shared = cut(t.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token"))
    met = t.join(shared, "token").groupBy("id").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    need = F.floor(F.floor(F.col("n") * F.lit(num) / F.lit(den)) * F.lit(EXTRA.numerator) / F.lit(EXTRA.denominator))
    return met.where(F.col("c") > need).select("id")


def blocks_of(full: DataFrame, num: int, den: int) -> DataFrame:
    """(id, block): sets that may be linked have one block.

    The order is by the number of sets that have a shingle, rarest first, so prefixes
    hold what only near copies share. Each shingle of a prefix ties its sets to the
    smallest of them: as many rows as prefixes have, not pairs."""
    t = full.select("id", "n", F.explode("tokens").alias("token"))
    df = cut(t.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"))
    own = t.join(df, "token").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("s"))
    # Shingles of one set alone come first and match nothing; what is left of the prefix follows them.
    left = F.expr(f"n - cast(ceil(n * {num} / {den}) as bigint) + 1 - (n - size(s))")
    pre = own.withColumn("left", left).where("left > 0").select("id", F.explode(F.expr("slice(s, 1, int(least(left, size(s))))")).alias("x")).select("id", "x.token")
    pre = cut(pre)
    low = cut(pre.groupBy("token").agg(F.min("id").alias("low"), F.count("*").alias("c")).where("c > 1").select("token", "low"))
    ties = pre.join(low, "token").where("id <> low").select("id", "low").distinct()
    return connected_components(ties, "id", "low").select(F.col("node").alias("id"), F.col("component").alias("block"))


def _spread(load: str, key: str) -> F.Column:
    return F.pmod(F.xxhash64(key), F.greatest(F.ceil(F.col(load) / F.lit(CHUNK)), F.lit(1)))


def join_blocks(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): links that connect what all links would, for rows(block, id, n, tokens).

    A block that fits one chunk is joined by one task. A larger one is dealt out by hash:
    first every chunk is joined with itself; then one set of each component so far is
    dealt and joined again, until that finds nothing; last, chunks that are not of one
    component are joined with each other, so that no link is lost. Chunks of one and the
    same component need no joining, so a very large group of copies stays linear.
    """
    load = rows.groupBy("block").agg(F.sum("n").alias("load"))
    rows = cut(rows.join(load, "block").withColumn("part", _spread("load", "id")))
    links = cut(_forest(rows.select("block", "part", "id", "n", "tokens"), ["block", "part"], num, den))
    large = cut(rows.where(F.col("load") > CHUNK))
    if large.isEmpty():
        return links
    for _ in range(8):
        comp = connected_components(links, "a", "b").select(F.col("node").alias("id"), F.col("component").alias("comp"))
        at = cut(large.select("id", "block", "n").join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id")))
        heads = at.groupBy("block", "comp").agg(F.min("id").alias("id"), F.min_by("n", "id").alias("hn"))
        heads = heads.join(heads.groupBy("block").agg(F.sum("hn").alias("hl"), F.count("*").alias("hc")), "block").where("hc > 1")
        again = large.select("id", "n", "tokens").join(heads.select("block", "id", _spread("hl", "id").alias("part")), "id")
        new = cut(_forest(again, ["block", "part"], num, den))
        if new.isEmpty():
            break
        links = cut(links.unionByName(new))
    size = at.groupBy("block", "comp").agg(F.sum("n").alias("cl"))
    mixed = size.where(F.col("cl") <= CHUNK / 4).groupBy("block").agg(F.sum("cl").alias("ml"))
    place = at.join(size, ["block", "comp"]).join(mixed, "block", "left")
    pure = F.col("cl") > CHUNK / 4
    place = place.select(
        "id", "block",
        F.when(pure, F.col("comp")).alias("comp"),
        F.when(pure, _spread("cl", "id")).otherwise(_spread("ml", "comp")).alias("part"),
    )
    place = cut(place.withColumn("chunk", F.xxhash64("block", F.coalesce("comp", F.lit(-1)), "part")))
    chunks = place.select("block", "chunk", "comp").distinct()
    a, b = chunks.toDF("block", "ca", "pa"), chunks.toDF("block", "cb", "pb")
    pairs = a.join(b, "block").where("ca < cb and not coalesce(pa = pb, false)").select("ca", "cb")
    within = place.where("comp is null").select("id", "chunk")
    sides = pairs.select("ca", "cb", F.explode(F.array(F.struct(F.col("ca").alias("chunk"), F.lit(0).alias("side")), F.struct(F.col("cb").alias("chunk"), F.lit(1).alias("side")))).alias("s")).select("ca", "cb", "s.*")
    sets = large.select("id", "n", "tokens")
    across = place.select("id", "chunk").join(sides, "chunk").join(sets, "id").select("ca", "cb", "side", "id", "n", "tokens")
    alone = within.join(sets, "id").select("chunk", "id", "n", "tokens")
    return links.unionByName(_forest(across, ["ca", "cb"], num, den)).unionByName(_forest(alone, ["chunk"], num, den))


def near_groups(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs.

    A set holds the distinct k-word shingles of the whole text; two documents link when
    |x and y| / |x or y| >= num / den. component_id is the smallest doc_id reachable.
    Null and empty texts, and texts without words, have an empty set and stay alone.
    Rows of equal sets are one class and linked by that; repeated ids count once in it. A
    null id never names a component that has others.
    Other columns are not read; an empty table gives an empty result.
    """
    s = cut(_sets(docs, k, num, den, False))
    classes = s.where("n > 0").groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "n", "tokens")).alias("x"))
    classes = cut(classes.select(F.monotonically_increasing_id().alias("id"), "digest", "x.doc_id", "x.n", "x.tokens"))
    alive = cut(alive_classes(classes, num, den).join(classes.select("id", "doc_id", "digest"), "id"))
    which = hint_small(alive.select("id", F.col("doc_id").alias("_d"), F.col("digest").alias("_g")))
    ids = hint_small(cut(alive.select(F.col("doc_id").alias("_d")).distinct()))
    again = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi")
    full = _sets(again, k, num, den, True).join(which, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("digest") == F.col("_g")))
    full = cut(full.select("id", "n", "tokens").dropDuplicates(["id"]))
    blocks = hint_small(cut(blocks_of(full, num, den)))
    links = join_blocks(full.join(blocks, "id"), num, den)
    comp = connected_components(links, "a", "b").select(F.col("node").alias("id"), "component")
    low = comp.join(classes.select("id", "doc_id"), "id").groupBy("component").agg(F.min("doc_id").alias("low"))
    heads = classes.join(comp, "id", "left").join(low, "component", "left")
    heads = cut(heads.select("digest", F.coalesce("low", "doc_id").alias("head")))
    out = s.select("doc_id", "n", "digest").join(hint_small(heads), "digest", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("head")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs less those that are linked, through others or not, with one of a smaller doc_id.

    Rows of one doc_id stay or go together; of equal texts the smallest doc_id stays, and a row
    without a doc_id goes where one with an id is linked with it. Null texts and texts without
    words are linked with nothing and stay. All columns are kept; an empty table gives none."""
    g = settle(lambda: near_groups(docs, k, num, den).where("not (doc_id <=> component_id)").select(F.col("doc_id").alias("_linked_id")).distinct())
    return docs.join(hint_small(g), F.col("doc_id").eqNullSafe(F.col("_linked_id")), "left_anti")


def op5_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
