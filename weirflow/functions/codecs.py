"""Compression and decryption of text columns.

AES stays in the JVM; only inflate and deflate need Python and run as Arrow-batched pandas
UDFs, on the rows that need them.
"""

from __future__ import annotations

import base64
import gzip
import sys
import zlib
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# executors get these functions by value: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONG_TEXT = 1000


@F.pandas_udf(T.StringType())
def _deflate(s: pd.Series) -> pd.Series:
    return s.map(
        lambda t: base64.b64encode(zlib.compress(t.encode("utf-8"))).decode("ascii"),
        na_action="ignore",
    )


@F.pandas_udf(T.StringType())
def _inflate(s: pd.Series) -> pd.Series:
    return s.map(lambda t: zlib.decompress(base64.b64decode(t)).decode("utf-8"), na_action="ignore")


def _gunzip_or_same(text: str) -> str:
    try:
        # base64 may come in lines
        return gzip.decompress(base64.b64decode("".join(text.split()), validate=True)).decode("utf-8")
    except (ValueError, OSError, EOFError, zlib.error):
        return text


@F.pandas_udf(T.StringType())
def _gunzip_text(s: pd.Series) -> pd.Series:
    return s.map(_gunzip_or_same, na_action="ignore")


def _gunzip_or_none(data) -> str | None:
    try:
        return gzip.decompress(bytes(data)).decode("utf-8")
    except (ValueError, OSError, EOFError, zlib.error):
        return None


def _first_unpacked(candidates) -> str | None:
    texts = (_gunzip_or_none(c) for c in (candidates if candidates is not None else ()))
    return next((t for t in texts if t is not None), None)


@F.pandas_udf(T.StringType())
def _gunzip_first(s: pd.Series) -> pd.Series:
    return s.map(_first_unpacked)


def compress_long(text: Column, longer_than: int = LONG_TEXT) -> Column:
    """Base64 of the deflated text where it is longer than the limit, else the text itself."""
    long = F.length(text) > longer_than
    return F.when(long, _deflate(F.when(long, text))).otherwise(text)


def inflate(text: Column) -> Column:
    """The inverse for a column known to be compressed."""
    return _inflate(text)


def gunzip(text: Column) -> Column:
    """Base64 gzip text unpacked; anything else is returned as it is."""
    return _gunzip_text(text)


def decrypt_line(line: Column, keys: Sequence[str]) -> Column:
    """``hex(iv):hex(body)`` decrypted with the first base64 AES key that gives gzip data.

    A wrong key can still unpad by chance, so each key's result is accepted only when it
    unpacks.  Null when no key fits.
    """
    parts = F.split(line, ":")
    body = F.concat(F.unhex(parts[0]), F.unhex(parts[1]))
    tries = []
    for key in keys:
        plain = F.try_aes_decrypt(body, F.unbase64(F.lit(key)), F.lit("CBC"), F.lit("PKCS"))
        gzipped = F.substring(F.hex(plain), 1, 4) == "1F8B"
        tries.append(F.when(gzipped, plain))
    if not tries:
        return F.lit(None).cast("string")
    # the JVM keeps what looks like gzip, mostly one candidate; Python is called once a row
    return _gunzip_first(F.filter(F.array(*tries), lambda t: t.isNotNull()))


def decrypt_lines_or_fail(line: Column, keys: Sequence[str]) -> Column:
    """As ``decrypt_line``, but a line no key fits fails the job."""
    return F.coalesce(
        decrypt_line(line, keys),
        F.when(line.isNotNull(), F.raise_error(F.lit("no key decrypts the line")).cast("string")),
    )
