"""SHA-256 tokens that replace masked values."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(value: Column) -> Column:
    """64 hexadecimal characters."""
    return F.sha2(value, 256)


def column_token(column: str) -> str:
    """The constant that replaces every masked value of a column: hash of its name."""
    return hashlib.sha256(column.encode()).hexdigest()


def value_token(value: Column, salt: str = "") -> Column:
    """Hash of a value. Without a secret salt a hashed address can be guessed."""
    return F.sha2(F.concat(F.lit(salt), value), 256)
