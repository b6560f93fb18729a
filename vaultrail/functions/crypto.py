"""Keyring, blind indexes, sealing and digests, all as JVM-side expressions.

Keys reach a plan only as columns that stand for scalar subqueries over the keyring table (five rows at most), so no
key shows in ``explain`` output and no join is needed to use one.
"""

from __future__ import annotations

import hashlib
import hmac
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultrail.functions.text import base64_line, col

# Keyring and sealing format.
MAX_KEYS = 5
SINGLE_KEY_ID = "v1"
IV_BYTES = 12
TAG_BYTES = 16
HMAC_BLOCK = 64
GENESIS = "0" * 64

KEYRING_SCHEMA = (
    "key_id string, position int, active boolean, data_key binary, "
    "ipad binary, opad binary, iv_ipad binary, iv_opad binary"
)


def _pads(key: bytes) -> tuple[bytes, bytes]:
    block = key.ljust(HMAC_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


@dataclass(frozen=True)
class Keyring:
    """Up to five named keys, one of them active for writing."""

    keys: dict[str, str] = field(repr=False)
    active_id: str

    def __post_init__(self):
        if not self.keys:
            raise ValueError("a keyring needs at least one key")
        if len(self.keys) > MAX_KEYS:
            raise ValueError(f"a keyring holds at most {MAX_KEYS} keys")
        if not self.keys.get(self.active_id):
            raise ValueError(f"active key {self.active_id!r} is not in the keyring")

    @classmethod
    def single(cls, key: str) -> "Keyring":
        return cls({SINGLE_KEY_ID: key}, SINGLE_KEY_ID)

    @classmethod
    def from_table(cls, table: DataFrame) -> "Keyring":
        """Load ``(key_id, raw_key, active)`` rows; one row beyond the limit is read to detect excess."""
        rows = table.select("key_id", "raw_key", "active").orderBy("key_id").limit(MAX_KEYS + 1).collect()
        active = [r.key_id for r in rows if r.active]
        if len(active) != 1:
            raise ValueError("exactly one key must be active")
        return cls({r.key_id: r.raw_key for r in rows}, active[0])

    @property
    def ids(self) -> list[str]:
        return list(self.keys)

    def data_key(self, key_id: str) -> bytes:
        return hashlib.sha256(self.keys[key_id].encode()).digest()

    def table(self, spark: SparkSession) -> DataFrame:
        rows = []
        for position, key_id in enumerate(self.keys):
            key = self.data_key(key_id)
            iv_key = hmac.new(key, b"iv", hashlib.sha256).digest()
            rows.append((key_id, position, key_id == self.active_id, key, *_pads(key), *_pads(iv_key)))
        return spark.createDataFrame(rows, KEYRING_SCHEMA)

    def attach(self, df: DataFrame, name: str = "_key") -> DataFrame:
        """Add the active key's row as one struct column.

        The column stands for a single subquery over the keyring, however many expressions use it.
        """
        return df.withColumn(name, self.table(df.sparkSession).where("active").select(F.struct("*")).scalar())

    def attach_all(self, df: DataFrame, name: str = "_keys") -> DataFrame:
        """Add all keys as an array of structs, in keyring order."""
        entry = F.struct("position", "key_id", "ipad", "opad")
        return df.withColumn(name, self.table(df.sparkSession).select(F.array_sort(F.collect_list(entry))).scalar())

    def attach_data_keys(self, df: DataFrame, name: str = "_data_keys") -> DataFrame:
        """Add a map from key id to data key, for readers."""
        pairs = F.map_from_entries(F.collect_list(F.struct("key_id", "data_key")))
        return df.withColumn(name, self.table(df.sparkSession).select(pairs).scalar())

    def tokens(self, value: str) -> list[str]:
        """Blind indexes of one search value under every key, for literal filters that reach the scan."""
        return [hmac.new(self.data_key(k), value.encode(), hashlib.sha256).hexdigest() for k in self.keys]


def sha256_hex(*parts: Column | str) -> Column:
    return F.sha2(F.concat(*[col(p) for p in parts]), 256)


def _hmac(ipad: Column, opad: Column, message: Column) -> Column:
    inner = F.unhex(F.sha2(F.concat(ipad, message), 256))
    return F.sha2(F.concat(opad, inner), 256)


def blind_index(value: Column | str, key: Column) -> Column:
    """Hex HMAC-SHA-256 of ``value``; null stays null."""
    return _hmac(key.getField("ipad"), key.getField("opad"), F.encode(col(value), "UTF-8"))


def blind_indexes(value: Column | str, keys: Column) -> Column:
    """One index per key of the keyring, in keyring order; null for a null value."""
    value = col(value)
    return F.when(value.isNotNull(), F.transform(keys, lambda key: blind_index(value, key)))


def seal(text: Column, row_id: Column, key: Column) -> Column:
    """``keyId:base64(iv, ciphertext, tag)`` under AES-256-GCM.

    The IV is derived from the row id and the text, so a retried task or a second action over the same plan
    produces the same bytes; two rows with different ids never share an IV.
    """
    message = F.encode(F.concat(row_id.cast("string"), F.lit("\n"), text), "UTF-8")
    iv = F.substring(F.unhex(_hmac(key.getField("iv_ipad"), key.getField("iv_opad"), message)), 1, IV_BYTES)
    sealed = F.aes_encrypt(F.encode(text, "UTF-8"), key.getField("data_key"), F.lit("GCM"), F.lit("DEFAULT"), iv)
    return F.concat(key.getField("key_id"), F.lit(":"), base64_line(sealed))


def sealed_length(text: Column, key: Column) -> Column:
    """Length of ``seal(text)`` by arithmetic, without sealing."""
    sealed_bytes = F.octet_length(text) + F.lit(IV_BYTES + TAG_BYTES)
    return F.length(key.getField("key_id")) + 1 + 4 * F.ceil(sealed_bytes / 3)


def sealed_key_id(sealed: Column | str) -> Column:
    return F.substring_index(col(sealed), ":", 1)


def open_sealed(sealed: Column | str, data_keys: Column) -> Column:
    """Plain text of a sealed value, or null when its key is unknown or the bytes do not verify."""
    sealed = col(sealed)
    key = F.try_element_at(data_keys, sealed_key_id(sealed))
    body = F.unbase64(F.substring_index(sealed, ":", -1))
    return F.decode(F.try_aes_decrypt(body, key, F.lit("GCM")), "UTF-8")
