"""What tells one row of documents from another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permaway.operators.scratch import BROADCAST_BYTES, BROADCAST_ROWS, bytes_of

#: The key of a row: its doc_id and 128 bits of its text. Rows that share a doc_id keep their own units.
KEY = ("doc_id", "r1", "r2")


def text_keys(text: Column) -> list[Column]:
    """r1 and r2: hashes of the whole text under two seeds."""
    return [F.xxhash64(text).alias("r1"), F.xxhash64(F.lit(1), text).alias("r2")]


def join_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(_d struct of docs, the columns of found other than its key): found(KEY, ...) beside each row of docs, or nulls."""
    named = found.select(*[F.col(c).alias("_key_" + c) for c in KEY], *[c for c in found.columns if c not in KEY])
    r1, r2 = text_keys(F.col("_d.text"))
    same = F.col("_d.doc_id").eqNullSafe(F.col("_key_doc_id")) & (r1 == F.col("_key_r1")) & (r2 == F.col("_key_r2"))
    return docs.select(F.struct("*").alias("_d")).join(named, same, "left").drop(*["_key_" + c for c in KEY])


#: Words of 64 bits in a sieve; its table has so many rows at most, whatever it is made from.
SIEVE_WORDS = 1 << 20


def _bit(key: str) -> tuple[str, str]:
    return f"shiftrightunsigned({key}, 6) & {SIEVE_WORDS - 1}L", f"shiftleft(1L, int({key} & 63))"


def _sifted(big: DataFrame, found: DataFrame, hashed: str) -> DataFrame:
    """The rows of big whose hashed key found has, and a few others: one bit for each value is sent out."""
    word, bit = _bit(hashed)
    sieve = found.groupBy(F.expr(word).alias("_word")).agg(F.bit_or(F.expr(bit)).alias("_bits"))
    thin = big.withColumn("_w", F.expr(word)).join(F.broadcast(sieve), F.col("_w") == F.col("_word")).where(f"_bits & {bit} <> 0")
    return thin.drop("_w", "_word", "_bits")


def each_text(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) less most rows whose text a row of a smaller doc_id has too: at least one
    row of each text stays. Nothing but a bit for each text is sent, and no text is shuffled."""
    keyed = docs.withColumns({c: x for c, x in zip(KEY[1:], text_keys(F.col("text")), strict=True)})
    first = keyed.groupBy(*KEY[1:]).agg(F.min("doc_id").alias("doc_id"))
    return _sifted(keyed, first, f"xxhash64({', '.join(KEY)})").select(*docs.columns)


def join_found(big: DataFrame, found: DataFrame, keys: list[str], hashed: str) -> DataFrame:
    """big joined with found, a cut table of rows that hold few of big's keys.

    A small table is sent to where big is. Of a larger one a sieve is sent, one bit for each
    value of the hashed key, and only what the bits let through is shuffled: a fixed size, and
    no more than a shuffle of all where the table has grown beyond its use."""
    if bytes_of(found) <= BROADCAST_BYTES and found.count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(found), keys)
    return _sifted(big, found, hashed).join(found, keys)
