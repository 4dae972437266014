"""Key locator of a partitioned table: which partition holds a key.

Beside the table, ``_keys/entries`` holds (key, day) rows in folders by version
and key bucket, and ``_keys/filter`` a Bloom filter per bucket as bitmap
segments.  Every merge appends a version with its own keys; the latest version of a key counts.  A lookup
asks the filters of the batch's buckets first and reads the entries of those buckets only in which
some key may be known, so its cost follows the batch and not the table.

The locator is rebuilt from the table's key columns after many versions, when the keys have doubled, and when
a key column changes its type.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.sources import storage

FOLDER = "_keys"
BITS = 32_768            # bits of one bitmap segment (fixed value of the bitmap functions)
PROBES = 4               # bits per key
BITS_PER_KEY = 12        # about one false answer in two hundred
KEYS_PER_BUCKET = 500_000
LEAST_BUCKETS = 16
MOST_VERSIONS = 64       # appended versions before the locator is rebuilt
FEW_KEYS = 50_000        # keys that may be sent to every task


def no_null_key(key: list[str]) -> Column:
    out = F.lit(True)
    for k in key:
        out = out & F.col(f"`{k}`").isNotNull()
    return out


def counted(keys: DataFrame, n: int) -> DataFrame:
    """``keys`` for a join: sent to every task where their counted number ``n`` is small, else dealt out like the other side.
    Estimates of cached rows are far too small to choose by: a large batch would be collected by the driver."""
    return keys.hint("broadcast" if n <= FEW_KEYS else "merge")


@dataclass
class KeyLocator:
    spark: SparkSession
    path: str
    meta: dict

    @property
    def key(self) -> list[str]:
        return self.meta["key"]

    @staticmethod
    def _meta_file(path: str) -> str:
        return f"{path.rstrip('/')}/{FOLDER}/meta.json"

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KeyLocator | None:
        text = storage.read_text(spark, cls._meta_file(path))
        return cls(spark, path.rstrip("/"), json.loads(text)) if text else None

    @classmethod
    def build(cls, spark: SparkSession, path: str, table: DataFrame, key: list[str], day: str) -> KeyLocator:
        """From the key columns of the whole table; a table whose keys stand in several partitions has a row for each."""
        pairs = table.where(no_null_key(key)).select(*key, F.col(day).alias("day")).distinct()
        n = pairs.count()
        buckets = max(LEAST_BUCKETS, -(-n // KEYS_PER_BUCKET))
        types = [table.schema[k].dataType.simpleString() for k in key]
        meta = {"key": key, "types": types, "day": table.schema[day].dataType.simpleString(), "buckets": buckets,
                "segments": max(1, -(-2 * n * BITS_PER_KEY // (buckets * BITS))), "version": 0, "first": 0, "keys": n, "built": n}
        old = cls.load(spark, path)
        if old:  # versions go on, so that an older lookup's folders are never written again
            meta["version"] = meta["first"] = old.meta["version"] + 1
        built = cls(spark, path.rstrip("/"), meta)
        built._write(pairs, meta["version"])
        built.save()
        return built

    def save(self) -> None:
        storage.write_text(self.spark, self._meta_file(self.path), json.dumps(self.meta))

    def forget(self) -> None:
        storage.delete(self.spark, [f"{self.path}/{FOLDER}"])

    def fits(self, table: T.StructType, key: list[str], day: str) -> bool:
        """Whether it is for these key columns and their present types."""
        return (self.key == key and self.meta["types"] == [table[k].dataType.simpleString() for k in key]
                and self.meta["day"] == table[day].dataType.simpleString())

    def outgrown(self) -> bool:
        return self.meta["version"] - self.meta["first"] >= MOST_VERSIONS or self.meta["keys"] > 2 * max(self.meta["built"], KEYS_PER_BUCKET)

    # -- places of a key
    def _hash(self) -> Column:
        return F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in self.key])

    def bucket(self) -> Column:
        return F.pmod(self._hash(), F.lit(self.meta["buckets"])).cast("int")

    def _bits(self, df: DataFrame) -> DataFrame:
        """A row per key and probe: ``bucket, segment, bit``."""
        probe = F.pmod(F.xxhash64(self._hash(), F.col("__probe")), F.lit(self.meta["segments"] * BITS))
        return (df.withColumn("__probe", F.explode(F.array(*[F.lit(i) for i in range(PROBES)])))
                .select(*[F.col(f"`{k}`") for k in self.key], self.bucket().alias("bucket"), probe.alias("__bit"))
                .select(*[F.col(f"`{k}`") for k in self.key], "bucket", F.floor(F.col("__bit") / BITS).cast("int").alias("segment"), (F.col("__bit") % BITS).alias("bit")))

    # -- writing
    def _write(self, pairs: DataFrame, version: int) -> None:
        root = f"{self.path}/{FOLDER}"
        pairs.select(*self.key, "day", self.bucket().alias("bucket")).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/entries/version={version}")
        bits = self._bits(pairs.select(*self.key)).groupBy("bucket", "segment").agg(F.bitmap_construct_agg("bit").alias("bits"))
        bits.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/filter/version={version}")

    def append(self, pairs: DataFrame, version: int, new_keys: int) -> None:
        """The partitions of a batch's keys after its merge.  Writing a version again gives the same locator."""
        self._write(pairs, version)
        if self.meta["version"] < version:
            self.meta |= {"version": version, "keys": self.meta["keys"] + new_keys}
            self.save()

    # -- lookup
    def _read(self, what: str, schema: str, buckets: list[int]) -> DataFrame:
        """Rows of the listed buckets: a constant filter on the folders."""
        root = f"{self.path}/{FOLDER}/{what}"
        rows = self.spark.read.schema(f"{schema}, version int, bucket int").parquet(root)
        return rows.where((F.col("version") >= self.meta["first"]) & (F.col("version") <= self.meta["version"]) & F.col("bucket").isin(buckets))

    def maybe_known(self, keys: DataFrame, n: int | None = None) -> list[int]:
        """Buckets in which the filter doesn't rule out every key of ``keys``, of which there are ``n``."""
        n = keys.count() if n is None else n
        asked = self._bits(keys)
        buckets = sorted(r[0] for r in asked.select("bucket").distinct().collect())  # as many as there are buckets at most
        if not buckets:
            return []
        filters = self._read("filter", "segment int, bits binary", buckets).groupBy("bucket", "segment").agg(F.bitmap_or_agg("bits").alias("bits"))
        byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
        met = F.expr("shiftright(__byte, cast(bit % 8 as int)) & 1")
        hits = counted(asked, n * PROBES).join(filters, ["bucket", "segment"]).withColumn("__byte", byte).select(*self.key, "bucket", met.alias("met"))
        known = hits.groupBy(*self.key, "bucket").agg(F.sum("met").alias("met")).where(F.col("met") == PROBES)
        return sorted(r[0] for r in known.select("bucket").distinct().collect())

    def locate(self, keys: DataFrame) -> DataFrame:
        """``key.., day`` of the keys that are known (``keys``: distinct, not null)."""
        n = keys.count()
        fields = ", ".join(f"`{k}` {t}" for k, t in zip(self.key, self.meta["types"]))
        rows = self._read("entries", f"{fields}, day {self.meta['day']}", self.maybe_known(keys, n))
        own = rows.join(counted(keys.select(*self.key), n), self.key, "left_semi")
        days = own.groupBy(*self.key, "version").agg(F.collect_set(F.struct("day")).alias("days"))  # partitions of one key: bounded by the calendar
        return days.groupBy(*self.key).agg(F.max_by("days", "version").alias("days")).select(*self.key, F.explode("days").alias("d")).select(*self.key, F.col("d.day").alias("day"))
