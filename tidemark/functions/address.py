"""Address encoding job: 32-byte public key -> 58-character base32 text with checksum.

The reference calls a remote codec 300 rows at a time.  Here it is a Spark job: take the
distinct keys (each decoded once however often it appears), encode them in an Arrow
pandas UDF (SHA-512/256 is in ``hashlib``, not in Spark), and join the text back.
Format (public chain spec): base32(public_key + last 4 bytes of SHA-512/256(public_key)),
no padding.
"""

from __future__ import annotations

import base64
import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import scratch_path, ship_package

CHECKSUM_BYTES = 4


KEY_BYTES = 32


def encode_one(pk: bytes) -> str:
    chk = hashlib.new("sha512_256", pk).digest()[-CHECKSUM_BYTES:]
    return base64.b32encode(pk + chk).decode("ascii").rstrip("=")


def _encoder(decode):
    """A pandas UDF over ``decode``; text that is no key of 32 bytes gives null."""
    def one(text):
        if text is None:
            return None
        try:
            raw = decode(text)
        except ValueError:
            return None
        return encode_one(raw) if len(raw) == KEY_BYTES else None

    @F.pandas_udf(StringType())
    def encode(keys: pd.Series) -> pd.Series:
        return keys.map(one)
    return encode


encode_hex_key = _encoder(bytes.fromhex)
encode_b64_key = _encoder(lambda s: base64.b64decode(s, validate=True))


def decode_one(address: str | None) -> str | None:
    """The key inside an address as upper-case hex; null for text that is no address."""
    if address is None:
        return None
    try:
        raw = base64.b32decode(address + "=" * (-len(address) % 8))
    except ValueError:
        return None
    pk = raw[:KEY_BYTES]
    return pk.hex().upper() if len(raw) == KEY_BYTES + CHECKSUM_BYTES and encode_one(pk) == address else None


@F.pandas_udf(StringType())
def decode_address(addresses: pd.Series) -> pd.Series:
    return addresses.map(decode_one)


def encode_addresses(df: DataFrame, key_col: str, out_col: str, kind: str = "hex") -> DataFrame:
    """Add ``out_col`` = encoded address of ``key_col`` (hex or base64 public key)."""
    return encode_address_columns(df, {key_col: out_col}, kind)


def address_table(df: DataFrame, cols: list[str], kind: str = "hex") -> DataFrame:
    """(key, address) of the distinct keys of all columns: one scan, each key encoded once."""
    ship_package(df.sparkSession)
    udf = encode_hex_key if kind == "hex" else encode_b64_key
    keys = df.select(F.explode(F.array(*cols)).alias("key")).where("key IS NOT NULL").distinct()
    return keys.select("key", udf("key").alias("address"))


def written(table: DataFrame) -> DataFrame:
    """The table written to the shared work folder once, so that several joins don't make it anew."""
    path = scratch_path(table.sparkSession, "addresses")
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def look_up(df: DataFrame, table: DataFrame, key_col: str, out: dict[str, str]) -> DataFrame:
    """``df`` with columns of the table's row for ``key_col`` (``out``: table column -> new column)."""
    own = table.select(F.col("key").alias("__key"), *(F.col(c).alias(o) for c, o in out.items()))
    return df.join(own, df[key_col] == F.col("__key"), "left").drop("__key")


def encode_address_columns(df: DataFrame, cols: dict[str, str], kind: str = "hex") -> DataFrame:
    """Encode several key columns (e.g. sender and receiver) with one UDF pass over the
    distinct keys of all of them, then join the text back once per column."""
    table = address_table(df, list(cols), kind)
    if len(cols) > 1:
        table = written(table)
    for c, o in cols.items():
        df = look_up(df, table, c, {"address": o})
    return df
