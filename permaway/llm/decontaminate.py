"""Benchmark decontamination with a generalised suffix automaton over words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permaway.llm.batches import text_batches
from permaway.operators.scratch import cut, hint_small

#: Every byte that is no part of a word becomes a blank and A-Z become a-z; bytes of
#: other characters stay, so that words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: Item words in one automaton. Larger benchmarks are taken in blocks, one pass each.
BLOCK_WORDS = 200_000


class ItemAutomaton:
    """The suffix automaton of several word sequences.

    trans, link and length are its states; top leads from a state to the one on its
    suffix path whose words include those of length `window`; items tells which items
    hold these; short lists (words, item) of the whole items of under `window` words
    that end on the suffix path.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window, self.names, self.vocab = window, [], {}
        self.trans, self.link, self.length = [{}], [-1], [0]
        ends: list[tuple[int, int, int]] = []
        own: list[set[int]] = [set()]
        self.least = window
        for name, text in items:
            words = text.translate(FOLD).split()
            if not words:
                continue
            k, last = len(self.names), 0
            self.names.append(name)
            for w in words:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
                while len(own) < len(self.trans):
                    own.append(set())
                own[last].add(k)
            if len(words) < window:
                ends.append((last, len(words), k))
                self.least = min(self.least, len(words))
        order = sorted(range(1, len(self.trans)), key=self.length.__getitem__)
        for v in reversed(order):
            own[self.link[v]] |= own[v]
        self.top = [0] * len(self.trans)
        self.short: list[tuple] = [()] * len(self.trans)
        here: dict[int, list] = {}
        for v, n, k in ends:
            here.setdefault(v, []).append((n, k))
        for v in order:
            up = self.link[v]
            self.short[v] = self.short[up] + tuple(here.get(v, ()))
            self.top[v] = 0 if self.length[v] < window else v if self.length[up] < window else self.top[up]
        self.items = {v: own[v] for v in set(self.top)}

    def _extend(self, last: int, c: int) -> int:
        trans, link, length = self.trans, self.link, self.length
        q = trans[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = self._state(length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in trans[p]:
            trans[p][c] = new
            p = link[p]
        if p >= 0:
            q = trans[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _state(self, length: int, link: int, trans: dict) -> int:
        self.trans.append(trans)
        self.link.append(link)
        self.length.append(length)
        return len(self.trans) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        half = self._state(self.length[p] + 1, self.link[q], dict(self.trans[q]))
        self.link[q] = half
        while p >= 0 and self.trans[p].get(c) == q:
            self.trans[p][c] = half
            p = self.link[p]
        return half

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Half-open word spans that windows cover, joined where they touch, and the items met.

        A word that no item has resets the automaton, so only runs of known words that
        are long enough for the shortest window are streamed through it.
        """
        if len(words) < self.least or not self.names:
            return [], set()
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
        known = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        starts, stops = known[::2], known[1::2]
        long = stops - starts >= self.least
        spans: list[list[int]] = []
        met: set[int] = set()
        trans, link, length, window = self.trans, self.link, self.length, self.window
        for a, b in zip(starts[long].tolist(), stops[long].tolist(), strict=True):
            v = n = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                while v and c not in trans[v]:
                    v = link[v]
                    n = length[v]
                if c not in trans[v]:
                    n = 0
                    continue
                v = trans[v][c]
                n += 1
                size = 0
                if n >= window:
                    size = window
                    met |= self.items[self.top[v]]
                for m, k in self.short[v]:
                    if m <= n:
                        met.add(k)
                        size = max(size, m)
                if size:
                    if spans and spans[-1][1] >= i + 1 - size:
                        spans[-1][0] = min(spans[-1][0], i + 1 - size)
                        spans[-1][1] = i + 1
                        while len(spans) > 1 and spans[-2][1] >= spans[-1][0]:
                            spans[-2:] = [[min(spans[-2][0], spans[-1][0]), i + 1]]
                    else:
                        spans.append([i + 1 - size, i + 1])
        return [(a, b) for a, b in spans], met


def word_offsets(folded: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the starts and stops of the words of a folded text."""
    inside = np.frombuffer(folded, np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of about block_words words, drawn one partition after another;
    the driver never holds more than one partition of items and one block."""
    block, held = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator():
        text = (row[1] or "").encode("utf-8", "ignore")
        block.append((row[0] or "", text))
        held += len(text) // 6 + 1
        if held >= block_words:
            yield block
            block, held = [], 0
    yield block


SCAN = "n_words bigint, spans array<struct<a:int,b:int>>, items array<string>"


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans in order, those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan_rows(rows: DataFrame, blocks: list, all_rows: bool = True) -> DataFrame:
    """(row, n_words, spans, items) of rows(row, text): the word spans covered by item windows and
    the ids of the items met; without all_rows only of rows with spans. One narrow pass for each
    block of the benchmark (a broadcast automaton), which bounds what a worker holds; where
    there are several, a row's parts are gathered by row."""
    out = None
    for auto in blocks:

        def scanned(batches, auto=auto):
            a = auto.value
            for batch in batches:
                keep, words, spans, items = [], [], [], []
                for i, text in enumerate(batch.column(1)):
                    w = (text.as_py() or b"").translate(FOLD).split()
                    s, met = a.scan(w)
                    if s or all_rows:
                        keep.append(i)
                        words.append(len(w))
                        spans.append([{"a": x, "b": y} for x, y in s])
                        items.append([a.names[k] for k in met])
                own = [
                    batch.column(0).take(pa.array(keep, pa.int64())),
                    pa.array(words, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                    pa.array(items, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(own, ["row", "n_words", "spans", "items"])

        src = rows.select("row", F.col("text").cast("binary").alias("text"))
        one = src.mapInArrow(scanned, f"row {rows.schema['row'].dataType.simpleString()}, {SCAN}")
        out = one if out is None else out.unionByName(one)
    if len(blocks) > 1:
        out = out.groupBy("row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return out


def automata(docs: DataFrame, benchmark: DataFrame, window: int) -> list:
    return [docs.sparkSession.sparkContext.broadcast(ItemAutomaton(block, window)) for block in benchmark_blocks(benchmark)]


def digest_query(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; one row per row of docs.

    Null and empty texts have no words; items without words never occur. The result is the
    same however many blocks the benchmark takes."""
    docs = text_batches(docs)
    blocks = automata(docs, benchmark, window)
    if len(blocks) == 1:
        flat = scan_rows(docs.select(F.col("doc_id").alias("row"), "text"), blocks).withColumnRenamed("row", "doc_id")
        flat = flat.selectExpr("doc_id", "n_words", "aggregate(spans, 0L, (x, s) -> x + s.b - s.a) as n_hit", "items")
    else:
        rows = cut(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()))
        covered = "array_distinct(flatten(transform(spans, s -> sequence(s.a, s.b - 1))))"
        flat = scan_rows(rows, blocks).join(rows.select("row", "doc_id"), "row").selectExpr("doc_id", "n_words", f"cast(size({covered}) as bigint) as n_hit", "items")
    flat = flat.withColumn("items", F.array_sort(F.array_distinct("items")))
    return flat.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_spans(raw: bytes, spans: list[tuple[int, int]], folded: bytes | None = None) -> bytes:
    """The text less these word spans and what stands between their words; a line break is left."""
    starts, stops = word_offsets(raw.translate(FOLD) if folded is None else folded)
    done, parts = 0, []
    for x, y in spans:
        parts += [raw[done : starts[x]].rstrip(b" \t"), b"\n"]
        done = int(stops[y - 1])
    return b"".join([*parts, raw[done:]])


def too_much(spans: list[tuple[int, int]], n_words: int, most_coverage: float, most_span: int) -> bool:
    return sum(y - x for x, y in spans) > most_coverage * n_words or max(y - x for x, y in spans) > most_span


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, most_coverage: float = 0.5, most_span: int = 400) -> DataFrame:
    """docs without the words that item windows cover.

    A document is dropped where windows cover more than most_coverage of its words or
    one span exceeds most_span words; else the spans go, with what stands between
    their words, and a line break is left. Cutting is repeated until no window is left,
    since the words on both sides of a cut may form one. A document without hits is
    returned as it is, as are null, empty and repeated rows (each for itself). All columns
    are kept, whatever their names; n_chars follows the text; an empty table gives none.

    A benchmark of several blocks gives the same: the spans of all blocks are gathered for each
    row before the limits are applied, and the rows that were cut are scanned again by all.
    """
    docs = text_batches(docs)
    blocks = automata(docs, benchmark, window)
    if len(blocks) == 1:
        return _cleaned_at_once(docs, blocks[0], most_coverage, most_span)
    rows = cut(docs.select(F.struct("*").alias("_d"), F.monotonically_increasing_id().alias("row")))
    now = rows.select("row", F.col("_d.text").alias("text"))
    done, first = None, True
    while True:
        hits = cut(scan_rows(now, blocks, False).select("row", "n_words", "spans"))
        texts = now.join(hint_small(hits), "row")
        limits = (most_coverage, most_span) if first else None

        def cutting(batches, limits=limits):
            for batch in batches:
                out = []
                for text, n, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    s = joined_spans([(x["a"], x["b"]) for x in spans])
                    out.append(None if limits and too_much(s, n, *limits) else without_spans(text.encode(), s).decode())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "text"])

        changed = cut(texts.select("row", "text", "n_words", "spans").mapInArrow(cutting, "row bigint, text string"))
        if changed.isEmpty():
            break
        # A row's last text counts; null marks one that is dropped.
        done = changed if done is None else done.join(changed.select("row"), "row", "left_anti").unionByName(changed)
        done, now, first = cut(done), changed.where("text is not null"), False
    if done is None:
        return docs
    new = done.select(F.col("row").alias("_row"), F.col("text").alias("_text"))
    j = rows.join(hint_small(new), F.col("row") == F.col("_row"), "left").where("_row is null or _text is not null")
    hit = F.col("_row").isNotNull()
    pick = {"text": F.when(hit, F.col("_text")).otherwise(F.col("_d.text")), "n_chars": F.when(hit, F.length("_text")).otherwise(F.col("_d.n_chars")) if "n_chars" in docs.columns else None}
    return j.select(*[pick[c].cast(docs.schema[c].dataType).alias(c) if c in pick else F.col(f"_d.`{c}`") for c in docs.columns])


def _cleaned_at_once(docs: DataFrame, auto, most_coverage: float, most_span: int) -> DataFrame:
    """remove_contamination for one block, in one narrow pass."""
    cols = docs.columns
    at, sizes_at = cols.index("text"), cols.index("n_chars") if "n_chars" in cols else None

    def cleaned(batches):
        a = auto.value
        for batch in batches:
            keep, new = np.ones(batch.num_rows, bool), {}
            for i, text in enumerate(batch.column(at)):
                raw = (text.as_py() or "").encode()
                first = True
                while True:
                    folded = raw.translate(FOLD)
                    words = folded.split()
                    spans, _ = a.scan(words)
                    if not spans:
                        break
                    if first and too_much(spans, len(words), most_coverage, most_span):
                        keep[i] = False
                        break
                    raw, first = without_spans(raw, spans, folded), False
                    new[i] = raw
            if any(keep[i] for i in new):
                columns = list(batch.columns)
                texts = columns[at].to_pylist()
                sizes = None if sizes_at is None else columns[sizes_at].to_pylist()
                for i, raw in new.items():
                    texts[i] = raw.decode()
                    if sizes is not None:
                        sizes[i] = len(texts[i])
                columns[at] = pa.array(texts, columns[at].type)
                if sizes is not None:
                    columns[sizes_at] = pa.array(sizes, columns[sizes_at].type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch if keep.all() else batch.filter(pa.array(keep))

    return docs.mapInArrow(cleaned, docs.schema)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(set(items))).encode()).hexdigest()


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS m, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM b, unnest(generate_series(1, greatest(len(w) - 9, least(len(w), 1)))) AS t(i)),
sizes AS (SELECT DISTINCT m FROM win),
dg AS (SELECT doc_id, i, m, list_slice(w, i, i + m - 1) AS g FROM d, sizes, unnest(generate_series(1, len(w) - m + 1)) AS t(i)),
hit AS (SELECT doc_id, i, dg.m, item FROM dg JOIN win ON dg.m = win.m AND dg.g = win.g),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return digest_query(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
