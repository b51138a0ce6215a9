"""Substring dedup by hashing lines and the sentences in them."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permaway.llm.batches import text_batches
from permaway.llm.rows import KEY, join_found, join_rows, text_keys
from permaway.operators.scratch import cut, hint_small

#: Words from which a sentence within a line is a unit of its own.
SENTENCE_WORDS = 8
#: A sentence ends where one of these signs stands before a blank or tab.
BREAK = re.compile(rb"(?<=[.!?])(?=[ \t])")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ADDED = ("n_units", "n_removed", "removed_chars", "removed_spans")


def normal_unit(unit: bytes) -> bytes:
    """ASCII capitals lowered, runs of ASCII white space made one blank, ends trimmed."""
    return b" ".join(unit.translate(LOWER).split())


def units_of(raw: bytes, words: int = SENTENCE_WORDS):
    """(start, stop, normal form, whether it is a whole line) of the units of a text, in order.

    Every line that holds something is a unit; a line of several sentences is followed by
    those of them that have as many words or more. Offsets are bytes."""
    at = 0
    for line in raw.split(b"\n"):
        parts = BREAK.split(line)
        normal = [normal_unit(p) for p in parts]
        whole = b" ".join(filter(None, normal))
        if whole:
            yield at, at + len(line), whole, True
            if sum(map(bool, normal)) > 1:
                start = at
                for p, n in zip(parts, normal, strict=True):
                    if n.count(b" ") + 1 >= words:
                        yield start, start + len(p), n, False
                    start += len(p)
        at += len(line) + 1


def hashed_units(docs: DataFrame, words: int = SENTENCE_WORDS) -> DataFrame:
    """(doc_id, r1, r2, unit, h1, h2): number and 128-bit digest of every unit of every text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            row, number, digests = [], [], []
            for i, text in enumerate(batch.column(3)):
                for k, u in enumerate(units_of(text.as_py(), words)):
                    row.append(i)
                    number.append(k)
                    digests.append(hashlib.md5(u[2], usedforsecurity=False).digest())
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            own = [batch.column(c).take(pa.array(row, pa.int64())) for c in range(3)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(number, pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1])], [*KEY, "unit", "h1", "h2"])

    src = text_batches(docs).where("text is not null").select("doc_id", *text_keys(F.col("text")), F.col("text").cast("binary").alias("text"))
    return src.mapInArrow(run, f"doc_id {kind}, r1 bigint, r2 bigint, unit int, h1 bigint, h2 bigint")


def repeated_units(docs: DataFrame, words: int = SENTENCE_WORDS) -> DataFrame:
    """(doc_id, r1, r2, gone array<int>): the numbers of units that stood before, in a smaller
    doc_id or further up in the same document.

    The earliest place of a digest is an aggregate that is combined before the shuffle,
    and goes back to the units by a join whose large partitions Spark splits, so a line
    that a third of the documents have is never in one task.
    """
    units = cut(hashed_units(docs, words))
    first = units.groupBy("h1", "h2").agg(F.min(F.struct(*KEY, "unit")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = cut(first.select("h1", "h2", *[F.col(f"first.{c}").alias("_first_" + c) for c in (*KEY, "unit")]))
    again = " and ".join(f"{c} <=> _first_{c}" for c in (*KEY, "unit"))
    gone = join_found(units, first, ["h1", "h2"], "h1").where(f"not ({again})")
    return gone.groupBy(*KEY).agg(F.sort_array(F.collect_set("unit")).alias("gone"))


def without(raw: bytes, gone: set[int], words: int = SENTENCE_WORDS) -> tuple[bytes, int, int, list[tuple[int, int]]]:
    """The text less its units of these numbers, how many units it has and how many went, and
    the byte spans that went. A line that goes takes its line break along, and its sentences
    are not counted again; a line whose sentences leave nothing but blanks goes too."""
    n, spans, lines = 0, [], []
    for start, stop, _, whole in units_of(raw, words):
        if whole:
            lines.append([start, stop, n in gone, []])
        elif n in gone:
            lines[-1][3].append((start, stop))
        n += 1
    at, kept, removed, starts = 0, [], 0, {x[0]: x for x in lines}
    for line in raw.split(b"\n"):
        _, stop, all_gone, parts = starts.get(at, (at, at, False, []))
        left = line
        if not all_gone and parts:
            edges = [at, *(x for p in parts for x in p), stop]
            left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        if all_gone:
            spans.append((at, stop))
            removed += 1
        else:
            spans += parts
            removed += len(parts)
            if left.strip() or not parts:
                kept.append(left)
        at += len(line) + 1
    return b"\n".join(kept), n, removed, spans


def dedup_lines_exact(docs: DataFrame, words: int = SENTENCE_WORDS) -> DataFrame:
    """docs with text less every repeated unit, and what went, by its place in the input.

    Units are lines and, in lines of several sentences, the sentences of eight words or
    more; a sentence and a line that agree are the same unit. New columns, in place of any
    of these names: n_units, n_removed, removed_chars, removed_spans (array of start and
    stop in characters of the input text, stop without the line break). The earliest
    occurrence, by doc_id and then position, stays; blank lines always stay. Rows of one
    doc_id and different texts are documents of their own, ranked by a hash of the text;
    repeated rows lose the same units; a null doc_id comes first. A null text stays null
    with no units; an empty text has none. An empty table gives none. What goes is joined
    to the documents where they are if it is small, so that whole texts are only shuffled
    where it is not.
    """
    gone = cut(repeated_units(docs.select("doc_id", "text"), words))
    own = [c for c in docs.columns if c not in ADDED]
    j = join_rows(text_batches(docs).select(*[F.col(f"`{c}`") for c in own]), hint_small(gone)).select(*[F.col(f"_d.`{c}`") for c in own], F.col("gone").alias("_gone_units"))
    at = own.index("text")

    def run(batches):
        for batch in batches:
            texts, counts, spans = [], [], []
            for text, gone_here in zip(batch.column(at), batch.column(len(own)), strict=True):
                raw = text.as_py()
                if raw is None:
                    out = (None, 0, 0, [])
                elif not (some := gone_here.as_py()):
                    out = (raw, sum(1 for _ in units_of(raw.encode(), words)), 0, [])
                else:
                    b = raw.encode()
                    kept, n, removed, found = without(b, set(some), words)
                    if not raw.isascii():
                        place = np.r_[0, np.cumsum((np.frombuffer(b, np.uint8) & 0xC0) != 0x80)]
                        found = [(int(place[x]), int(place[y])) for x, y in found]
                    out = (kept.decode(), n, removed, found)
                texts.append(out[0])
                counts.append((out[1], out[2], sum(y - x for x, y in out[3])))
                spans.append([{"start": x, "stop": y} for x, y in out[3]])
            columns = [pa.array(texts, c.type) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            new = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            new.append(pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))))
            yield pa.RecordBatch.from_arrays([*columns, *new], [*batch.schema.names[:-1], *ADDED])

    kinds = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in j.schema.fields[:-1]]
    kinds += ["n_units bigint", "n_removed bigint", "removed_chars bigint", "removed_spans array<struct<start:int,stop:int>>"]
    return j.mapInArrow(run, ", ".join(kinds))


SQL = r"""
WITH l AS (SELECT doc_id, i - 1 AS pos, list_extract(l, i) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), unnest(generate_series(1, len(l))) AS t(i)),
s AS (SELECT doc_id, pos, line, i - 1 AS k, list_extract(p, i) AS raw FROM (SELECT *, string_split(regexp_replace(line, '([.!?])([\x20\x09])', '\1' || chr(10) || '\2', 'g'), chr(10)) AS p FROM l), unnest(generate_series(1, len(p))) AS t(i)),
n AS (SELECT *, trim(regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS unit,
  coalesce(sum(length(raw)) OVER (PARTITION BY doc_id, pos ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inner_off FROM s),
w AS (SELECT doc_id, pos, any_value(line) AS line, string_agg(unit, ' ' ORDER BY k) FILTER (unit <> '') AS unit, count(*) FILTER (unit <> '') AS parts FROM n GROUP BY doc_id, pos),
o AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM w),
u AS (SELECT doc_id, pos, -1 AS k, unit, off AS start, off + length(line) AS stop FROM o WHERE unit IS NOT NULL
  UNION ALL SELECT n.doc_id, n.pos, n.k, n.unit, off + inner_off, off + inner_off + length(n.raw) FROM n JOIN o USING (doc_id, pos) WHERE parts > 1 AND len(string_split(n.unit, ' ')) >= 8),
r AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doc_id, pos, k) > 1 AS gone FROM u),
whole AS (SELECT doc_id, pos FROM r WHERE k = -1 AND gone),
cutting AS (SELECT r.* FROM r LEFT JOIN whole ON r.doc_id = whole.doc_id AND r.pos = whole.pos WHERE gone AND (k = -1 OR whole.pos IS NULL)),
rest AS (SELECT n.doc_id, n.pos, string_agg(n.raw, '' ORDER BY n.k) AS line FROM n ANTI JOIN cutting c ON n.doc_id = c.doc_id AND n.pos = c.pos AND (c.k = -1 OR c.k = n.k) GROUP BY n.doc_id, n.pos),
touched AS (SELECT DISTINCT doc_id, pos FROM cutting),
kept AS (SELECT rest.doc_id, string_agg(line, chr(10) ORDER BY rest.pos) AS kept FROM rest LEFT JOIN touched t ON rest.doc_id = t.doc_id AND rest.pos = t.pos
  WHERE t.pos IS NULL OR regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rest.doc_id),
c AS (SELECT doc_id, count(*) AS n_removed, sum(stop - start) AS removed_chars, string_agg((start::BIGINT)::VARCHAR || '-' || (stop::BIGINT)::VARCHAR, ',' ORDER BY start) AS spans FROM cutting GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_units FROM u GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed_chars, 0)::BIGINT AS removed_chars,
  coalesce(spans, '') AS removed_spans, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN m USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def op8_line_hash_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines_exact(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    spans = F.array_join(F.expr("transform(removed_spans, s -> concat(s.start, '-', s.stop))"), ",")
    return out.select("doc_id", "n_units", "n_removed", "removed_chars", spans.alias("removed_spans"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
