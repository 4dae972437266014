"""Keys of keyed hashes as a table: rotated by time, named in every hash, never a literal of the plan.

A key table has ``key_id`` (text without a colon), ``secret`` (binary), ``valid_from`` and optionally ``valid_to`` (null: open), and
``by`` columns where tenants have keys of their own.  A record is hashed under the key that is valid at its time and the hash is written
as ``key_id:digest``, so hashes under old keys can be told from those under new ones and both can be verified while
their keys are in the table.  Plans, ``explain`` and event logs name the table's columns only.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions.masking import HASH_BLOCK, hash_text
from veilspark.operators.protect import apply_policy, protect_json
from veilspark.operators.rules_table import asof_join
from veilspark.policy import Policy

KEY_SCHEMA = "key_id STRING, secret BINARY, valid_from TIMESTAMP, valid_to TIMESTAMP"
KEY_COL = "__veil_key"
REASON_NO_KEY = "no_key"

# key tables up to this many rows go to the records, larger ones are joined along time
MAX_BROADCAST_KEYS = 10_000
SALTS = 32


def add_key(spark: SparkSession, path: str, key_id: str, secret: bytes, valid_from: datetime, valid_to: datetime | None = None) -> None:
    """Append one key to the table at ``path``."""
    if not key_id or ":" in key_id:
        raise ValueError("a key id is a text without a colon")
    if not secret:
        raise ValueError("a key needs a secret")
    spark.createDataFrame([(key_id, bytearray(secret), valid_from, valid_to)], KEY_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _pad(block: Column, byte: int) -> Column:
    """A block of hexadecimal digits with every byte xor-ed, as binary."""
    def one(i: Column) -> Column:
        value = F.conv(F.substring(block, i * 2 + 1, F.lit(2)), 16, 10).cast("int").bitwiseXOR(F.lit(byte))
        return F.lpad(F.hex(value), 2, "0")
    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(HASH_BLOCK - 1)), one), ""))


def padded(keys: DataFrame) -> DataFrame:
    """The key table with the pads of the HMAC (``inner_pad, outer_pad``) instead of the secret; one row a key is all that is computed.

    Keys without an id or a secret are left out, as nothing could be verified with them."""
    whole = F.when(F.octet_length("secret") > HASH_BLOCK, F.sha2("secret", 256)).otherwise(F.hex("secret"))
    block = F.rpad(whole, 2 * HASH_BLOCK, "0")
    rest = [F.col(f"`{c}`") for c in keys.columns if c != "secret"]
    return keys.where("key_id is not null and octet_length(secret) > 0").select(*rest, _pad(block, 0x36).alias("inner_pad"), _pad(block, 0x5C).alias("outer_pad"))


def _small(keys: DataFrame) -> bool:
    return keys.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS


def with_key(df: DataFrame, keys: DataFrame, ts: str, by: list[str] | None = None) -> DataFrame:
    """``df`` plus ``KEY_COL``: the key (``key_id, inner_pad, outer_pad``) that is valid at ``ts``, the latest that began; null where
    there is none, it has ended (``valid_to`` is the first moment without it) or the record has no time.

    Of keys that begin at one moment the greatest id counts.  Up to ``MAX_BROADCAST_KEYS`` keys go to the records
    as one row for each ``by``; more are met by :func:`asof_join`, which deals hot tenants to several tasks."""
    by = list(by or [])
    ends = F.col("valid_to").cast("timestamp") if "valid_to" in keys.columns else F.lit(None).cast("timestamp")
    ready = padded(keys).where("valid_from is not null").select(
        *[F.col(f"`{c}`") for c in by], F.col("valid_from").cast("timestamp").alias("valid_from"), "key_id", ends.alias("valid_to"), "inner_pad", "outer_pad")
    at = F.col(f"`{ts}`").cast("timestamp")
    if _small(keys):
        row = F.struct("valid_from", "key_id", "valid_to", "inner_pad", "outer_pad")
        lists = ready.groupBy(*[F.col(f"`{c}`").alias(f"__by{i}") for i, c in enumerate(by)], F.lit(0).alias("__one")).agg(F.sort_array(F.collect_list(row)).alias("__keys"))
        on = F.col("__zero") == F.col("__one")
        for i, c in enumerate(by):
            on = on & F.col(f"`{c}`").eqNullSafe(F.col(f"__by{i}"))
        met = df.withColumn("__zero", F.lit(0)).join(F.broadcast(lists), on, "left")
        found = F.try_element_at(F.filter("__keys", lambda k: k["valid_from"] <= at), F.lit(-1))
        found_in = met.select(*[F.col(f"`{c}`") for c in df.columns], found.alias("__found"))
    else:
        joined = asof_join(df, ready, by, ts, "valid_from", ["key_id"])
        found_in = joined.select(*[F.col(f"`{c}`") for c in df.columns], F.col("version").alias("__found"))
    valid = F.col("__found").isNotNull() & (F.col("__found.valid_to").isNull() | (at < F.col("__found.valid_to")))
    key = F.when(valid, F.struct("__found.key_id", "__found.inner_pad", "__found.outer_pad"))
    return found_in.select(*[F.col(f"`{c}`") for c in df.columns], key.alias(KEY_COL))


def hashed_fields(policy: Policy) -> list[str]:
    return [r.name for r in policy.effective_rules() if r.is_pii and r.operation == "hash" and r.name != "id"]


def protect_json_keyed(df: DataFrame, policy: Policy, keys: DataFrame, ts: str, value_col: str = "value", *, by: list[str] | None = None,
                       keep: list[str] | None = None, seed_col: Column | None = None) -> DataFrame:
    """``keep`` columns, ``value`` (protected JSON, hashes as ``key_id:digest``) and ``reason``.

    A record without a valid key is rejected as ``no_key`` if the policy hashes anything: it never
    leaves with a hash that needs no key."""
    keep = list(keep or [])
    joined = with_key(df, keys, ts, by)
    res = protect_json(joined, policy, value_col, keep=[*keep, KEY_COL], seed_col=seed_col, hash_key=F.col(KEY_COL))
    return refuse_bare(res, policy)


def refuse_bare(res: DataFrame, policy: Policy) -> DataFrame:
    """Protected records that carry their key: those without one get no value and the reason ``no_key``; the key is dropped."""
    bare = F.col(KEY_COL).isNull() & F.lit(bool(hashed_fields(policy)))
    reason = F.when(F.col("reason").isNull() & bare, F.lit(REASON_NO_KEY)).otherwise(F.col("reason"))
    final = {"value": F.when(reason.isNull(), F.col("value")).alias("value"), "reason": reason.alias("reason")}
    return res.select(*[final.get(c, F.col(f"`{c}`")) for c in res.columns if c != KEY_COL])


def apply_policy_keyed(df: DataFrame, policy: Policy, keys: DataFrame, ts: str, id_col: str | None = "id", *, by: list[str] | None = None,
                       keep: list[str] | None = None, seed_col: Column | None = None) -> DataFrame:
    """Typed columns protected under the key of each row's time; hashed fields of rows without a valid key are null."""
    joined = with_key(df, keys, ts, by)
    return apply_policy(joined, policy, id_col, seed_col=seed_col, hash_key=F.col(KEY_COL), keep=[*(keep or []), KEY_COL]).drop(KEY_COL)


def verify(df: DataFrame, hashed: str, text: str, keys: DataFrame) -> DataFrame:
    """``df`` plus ``verified``: whether ``hashed`` is the hash of ``text`` under the key that it names, valid or ended; null
    where either is null, false where its key is unknown or it names none.

    Empty text is hashed to itself.  The keys go to the rows below a counted size; more are shuffled with the rows,
    dealt to ``SALTS`` parts with a copy of each key, as one key may have made most hashes."""
    ready = padded(keys).groupBy("key_id").agg(F.min(F.struct("inner_pad", "outer_pad")).alias("__pads"))
    named = df.withColumn("__key_id", F.when(F.instr(F.col(f"`{hashed}`"), ":") > 0, F.substring_index(F.col(f"`{hashed}`"), ":", 1)))
    if _small(keys):
        met = named.join(F.broadcast(ready), named["__key_id"] == ready["key_id"], "left")
    else:
        copies = ready.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = named.withColumn("__salt", F.pmod(F.xxhash64(F.col(f"`{hashed}`"), F.col(f"`{text}`")), F.lit(SALTS)).cast("int"))
        met = dealt.join(copies, (dealt["__key_id"] == copies["key_id"]) & (dealt["__salt"] == copies["__part"]), "left")
    key = F.when(F.col("__pads").isNotNull(), F.struct(F.col("__key_id").alias("key_id"), "__pads.inner_pad", "__pads.outer_pad"))
    again = F.when(F.length(F.col(f"`{text}`")) == 0, F.col(f"`{text}`")).otherwise(hash_text(F.col(f"`{text}`"), key))
    either = F.col(f"`{hashed}`").isNull() | F.col(f"`{text}`").isNull()
    same = F.when(~either, F.coalesce(again == F.col(f"`{hashed}`"), F.lit(False)))
    return met.select(*[F.col(f"`{c}`") for c in df.columns], same.alias("verified"))
