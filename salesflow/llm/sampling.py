"""Bounded samples to fit classifiers on, chosen by key digest, and the held-out rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 32


def fold(key: Column, folds: int) -> Column:
    """CRC-32 of the key as text, modulo ``folds``; a missing key counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def chosen(share: float, *parts: Column | str) -> Column:
    """True for about ``share`` of all rows, at random by the digest of ``parts``; they should tell rows apart."""
    return F.lit(True) if share >= 1 else F.pmod(F.xxhash64(*parts, F.lit("sample")), F.lit(_RANGE)) < int(_RANGE * share)


def drawn(rows: DataFrame, counts: dict[str, int], group: str, key: str, text: str, most: int) -> DataFrame:
    """About ``most`` of the distinct (key, text) of every group, or all of a group that has fewer.

    ``counts`` has the number of distinct (key, text) of each group. A pair is
    drawn by its digest, so the sample does not depend on how the table is
    split into files, and a row that is repeated often is drawn as one. The
    shares, one number a group that the driver holds in ``counts`` already, are
    broadcast: rows that are not drawn never leave the scan.
    """
    shares = [(name, most / n) for name, n in counts.items()]
    table = rows.sparkSession.createDataFrame(shares, f"{group} string, _share double")
    draw = F.pmod(F.xxhash64(key, text, F.lit("sample")), F.lit(_RANGE)) < F.col("_share") * _RANGE
    return rows.join(F.broadcast(table), group).where(draw).drop("_share").dropDuplicates([group, key, text])
