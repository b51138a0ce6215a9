"""The network state: one Parquet table for each section and a manifest that says what it was made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permaway.functions import ed25519
from permaway.sources.container import damaged

#: Version of the layout; a state of another version counts as stale.
VERSION, MAGIC = 5, "permaway-state"


def state_path(map_path: str, country: str) -> str:
    """Where the state of a map lies: beside it, by country."""
    return f"{map_path.rstrip('/').rpartition('/')[0]}/state-{country.lower()}"


def write_state(path: str, sections: dict[str, DataFrame], country: str, map_hash: str) -> None:
    """Sections, then the manifest; without a manifest a state does not count."""
    spark = next(iter(sections.values())).sparkSession
    for name, df in sections.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")
    rows = [(MAGIC, VERSION, country, map_hash, name, spark.read.parquet(f"{path}/{name}").count()) for name in sections]
    spark.createDataFrame(rows, "magic string, version int, country string, map_hash string, section string, rows bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def read_state(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    manifest = spark.read.parquet(f"{path}/manifest")
    rows = manifest.collect()  # one row for each section
    if any(r.magic != MAGIC or r.version != VERSION for r in rows):
        raise ValueError(f"{path} holds no state of version {VERSION}")
    return {r.section: spark.read.parquet(f"{path}/{r.section}") for r in rows}


def is_fresh(spark: SparkSession, path: str, country: str | None = None, map_hash: str | None = None) -> bool:
    """Whether a state of this version, country and map is there; anything unreadable is not."""
    try:
        rows = spark.read.parquet(f"{path}/manifest").collect()
    except Exception:
        return False
    return bool(rows) and all(r.magic == MAGIC and r.version == VERSION and country in (None, r.country) and map_hash in (None, r.map_hash) for r in rows)


def fingerprint(df: DataFrame) -> str:
    """SHA-256 of the sorted digests of all rows: alike for the same rows in any order.
    Digests are summed by their first digits, so that only 256 partial ones are joined."""
    row = F.sha2(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), 256)
    h = df.select(row.alias("h")).withColumn("b", F.substring("h", 1, 2))
    sums = [F.sum(F.conv(F.substring("h", i, 12), 16, 10).cast("decimal(38,0)")).alias(f"s{i}") for i in (3, 15, 27, 39)]
    parts = h.groupBy("b").agg(F.count("*").alias("n"), *sums)
    return parts.agg(F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("*")))), 256)).first()[0]


def map_hash(blocks: DataFrame) -> str:
    """Hash of the index of a map: tiles, levels and block hashes."""
    return fingerprint(blocks.select("tile_id", "lod", "sha256"))


def sign_map(blocks: DataFrame, private: bytes) -> bytes:
    return ed25519.sign(private, map_hash(blocks).encode())


def verify_map(blocks: DataFrame, public: bytes, signature: bytes | None) -> bool:
    """The signature of the index, then every block against its hash; a map without one fails."""
    return ed25519.verify(public, map_hash(blocks).encode(), signature) and damaged(blocks).isEmpty()
