"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from permaway.operators.scratch import BROADCAST_BYTES, bytes_of
from permaway.operators.scratch import cut_clean as cut

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Source tables of at most this many rows are broadcast; larger ones are joined by a salted key.
BROADCAST_ROWS = 50_000
SALTS = 64
#: Turns of the draws among which each source takes the one that comes nearest to its target.
TURNS = 64


def draw(key: Column, seed: str, turn: Column) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone, moved on around the circle
    by turn / TURNS."""
    text = F.concat(F.lit(seed), F.lit(":"), F.coalesce(key.cast("string"), F.lit("null")))
    at = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") + turn.cast("bigint") * F.lit((1 << 52) // TURNS)
    return F.pmod(at, F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, target): one row per source of sizes(source, size).

    Sources in code-point order, null last, take the weights in turn and share the
    sum of all sizes. No target exceeds most times its source's size; what is above
    is shared again by weight, which ends at target = least(cap, level * weight) with
    one level for all. The level is found by one pass over the sources in the order
    of cap / weight. The windows run over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (n % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("total", F.sum("source_size").over(whole).cast("double"))
    per = per.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    per = per.withColumn("fits", F.col("level") <= F.col("cap") / F.col("w"))
    per = per.withColumn("k", F.row_number().over(by_fill))
    level = F.min(F.when(F.col("fits"), F.struct("k", "level"))).over(whole)["level"]
    return per.select("source", "source_size", F.least(F.col("cap"), level * F.col("w")).alias("target"))


def _beside(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows(_d struct with source and doc_id, ...) with the columns of table(_source, ...), a cut table
    of a row for each source: a small one is sent to where the rows are, a larger one is joined
    on source and salt, so that a hot source is spread over tasks."""
    same = F.col("_d.source").eqNullSafe(F.col("_source"))
    if table.count() <= BROADCAST_ROWS and bytes_of(table) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), same)
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    with_salt = rows.withColumn("_row_salt", F.pmod(F.xxhash64("_d.doc_id"), F.lit(SALTS)).cast("int"))
    return with_salt.join(salted, same & (F.col("_row_salt") == F.col("_salt")))


def _copies(seed: str) -> Column:
    """floor(rate), and one more where the document's draw is under the fraction."""
    extra = draw(F.col("_d.doc_id"), seed, F.col("_turn")) < F.col("_rate") - F.floor("_rate")
    return F.floor("_rate").cast("bigint") + extra.cast("bigint")


def _rated(rows: DataFrame, sized: DataFrame, weights: tuple[int, ...], most: int, seed: str) -> DataFrame:
    """rows(_d struct with source and doc_id, ...) with its source's figures and copies.

    Draws scatter, most of all in a source of few documents. So every source's words are
    summed up under each turn of the draws, and the turn that comes nearest to the target is
    taken: all sums are one aggregate, combined before its shuffle. A document is as likely
    to get its extra copy under any turn."""
    targets = source_targets(sized, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = cut(targets.withColumnRenamed("source", "_source").withColumn("_rate", rate))
    j = _beside(sized.select(F.struct("doc_id", "source").alias("_d"), "size"), targets)
    j = j.withColumn("_turn", F.explode(F.sequence(F.lit(0), F.lit(TURNS - 1))))
    sums = j.groupBy("_source", "_turn").agg(F.abs(F.sum(F.col("size") * _copies(seed)) - F.first("target")).alias("_off"))
    best = sums.groupBy("_source").agg(F.min(F.struct("_off", "_turn"))["_turn"].alias("_turn")).withColumnRenamed("_source", "_again")
    chosen = cut(targets.join(best, F.col("_source").eqNullSafe(F.col("_again"))).drop("_again"))
    return _beside(rows, chosen).withColumn("_copies", _copies(seed))


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken), one row per input row.

    copies = floor(rate) and one more where the document's draw is under the fraction
    of rate = target / source_size; the draws of a source are turned so that its words come
    as near to its target as any of TURNS turns does. A null or empty text has size 0; a
    null source is a source of its own; repeated rows get the same draw; an empty table
    gives none. Other columns are not read.
    """
    sized = cut(docs.select("doc_id", "source", _size().alias("size")))
    j = _rated(sized.select(F.struct("doc_id", "source").alias("_d"), F.col("size").alias("_size")), sized, weights, most, seed)
    return j.select(
        "_d.doc_id", F.col("_size").alias("size"), "source_size", "target",
        F.col("_copies").alias("copies"), (F.col("_size") * F.col("_copies")).alias("taken"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """The documents of the mix: every row as often as its copies say, numbered from 1 in a
    last column copy (with as many _ before it as make the name new). Sizes are summed in one
    pass and the rows go out in another; texts are not shuffled. Null and empty texts weigh
    nothing and are copied like others; repeated rows get the same copies; ties between turns
    go to the first; an empty table gives none."""
    sized = cut(docs.select("doc_id", "source", _size().alias("size")))
    name = "copy"
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    j = _rated(docs.select(F.struct("*").alias("_d")), sized, weights, most, seed).where("_copies > 0")
    return j.select("_d.*", F.explode(F.expr("sequence(1L, _copies)")).alias(name))


SQL = r"""
WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM s GROUP BY source),
c AS (SELECT *, source_size * 3.0::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE AS total FROM p),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
  row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k FROM c),
v AS (SELECT level FROM l WHERE level <= cap / w ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(cap, (SELECT level FROM v) * w) AS target FROM l),
r AS (SELECT doc_id, s.source, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  ('0x' || md5('mix:' || coalesce(doc_id::VARCHAR, 'null'))[1:13])::BIGINT AS u
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
k AS (SELECT source, turn, abs(sum(size * (floor(rate)::BIGINT + ((((u + turn * 70368744177664) % 4503599627370496)::DOUBLE / 4503599627370496.0::DOUBLE) < rate - floor(rate))::BIGINT)) - any_value(target)) AS off
  FROM r, range(64) AS x(turn) GROUP BY source, turn),
b AS (SELECT source, min(off) AS off FROM k GROUP BY source),
c2 AS (SELECT k.source, min(turn) AS turn FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.off = b.off GROUP BY k.source),
n AS (SELECT r.*, floor(rate)::BIGINT + ((((u + turn * 70368744177664) % 4503599627370496)::DOUBLE / 4503599627370496.0::DOUBLE) < rate - floor(rate))::BIGINT AS copies
  FROM r JOIN c2 ON r.source IS NOT DISTINCT FROM c2.source)
SELECT doc_id, size, source_size, target, copies, size * copies AS taken FROM n
"""


def op9_mix(spark, sf_dir: str) -> DataFrame:
    return plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
