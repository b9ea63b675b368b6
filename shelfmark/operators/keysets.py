"""A set of keys as one bitmap, small enough to be sent everywhere, that leaves out rows before they move."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap, eight megabytes: of up to some ten million keys, most others are left out.
BITS = 1 << 26


def _spot(cols: Sequence[str], bits: int, lead: int | None) -> tuple[Column, Column]:
    """A byte, by a hash of the key, and the bit in it, by one of its first `lead` columns, or of all.

    Never null, and known not to be: a join would ask each row for that, down at the scan, hashes and all.
    """
    byte = F.pmod(F.xxhash64(*cols), F.lit(max(1, bits // 8)))
    bit = F.pmod(F.xxhash64(F.lit(1), *cols[:lead]), F.lit(min(8, bits)))
    return F.coalesce(byte, F.lit(0).cast("long")), F.coalesce(bit, F.lit(0).cast("long"))


def _place(cols: Sequence[str], bits: int, lead: int | None) -> tuple[Column, Column]:
    byte, bit = _spot(cols, bits, lead)
    spot = F.shiftleft(byte, 3) + bit + 1
    return tuple(F.coalesce(place(spot), F.lit(0).cast("long")) for place in (F.bitmap_bucket_number, F.bitmap_bit_position))


def key_bitmap(keys: DataFrame, cols: Sequence[str], bits: int = BITS, lead: int | None = None) -> DataFrame:
    """`(_bucket, _bits)`: which of `bits` hashes the keys have, in pieces of 32,768.

    Hashes are dealt out by piece, so a piece is put together by one task, and no task sends bitmaps of its own. The
    table has at most bits / 32768 rows of 4 KB, whatever the number of keys. `lead` must be that of the lookup.
    """
    bucket, position = _place(cols, bits, lead)
    placed = keys.select(bucket.alias("_bucket"), position.alias("_position"))
    dealt = placed.repartition("_bucket")
    return dealt.groupBy("_bucket").agg(F.bitmap_construct_agg("_position").alias("_bits"))


def _is_set(bits: Column, byte: Column, bit: Column) -> Column:
    value = F.ascii(F.decode(F.substring(bits, byte + 1, F.lit(1)), "ISO-8859-1"))
    return F.call_function("getbit", value, bit) == 1


def maybe_among(rows: DataFrame, bitmap: DataFrame, cols: Sequence[str], bits: int = BITS) -> DataFrame:
    """Rows whose key may be in the bitmap: all that are, and few others. Nothing is shuffled."""
    bucket, position = _place(cols, bits, None)
    held = rows.withColumns({"_bucket": bucket, "_position": position})
    byte, bit = F.shiftright("_position", 3).cast("int"), F.col("_position").bitwiseAND(F.lit(7)).cast("int")
    met = held.join(F.broadcast(bitmap), "_bucket").where(_is_set(F.col("_bits"), byte, bit))
    return met.select(*rows.columns)


def maybe_among_first(
    rows: DataFrame, bitmap: DataFrame, cols: Sequence[str], bits: int = BITS, lead: int | None = None
) -> DataFrame:
    """The same rows by a filter, which Spark moves below the joins, unions and distincts the rows are made of.

    So the others are left out where the columns of the key come from, before anything else is done with them. The
    bitmap is one value there, as in Spark's own runtime filters: a subquery puts its pieces together. The filter
    writes out the expressions behind its columns; with `lead`, only the first so many are written out twice.
    """
    pieces = rows.sparkSession.range(1, (bits - 1) // 32768 + 2).select(
        F.col("id").alias("_bucket"), F.unhex(F.lit("00" * 4096)).alias("_bits")
    )
    pieces = pieces.unionByName(bitmap).groupBy("_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))
    whole = pieces.agg(F.expr("listagg(_bits) WITHIN GROUP (ORDER BY _bucket)")).scalar()
    byte, bit = _spot(cols, bits, lead)
    return rows.where(_is_set(whole, byte.cast("int"), bit.cast("int")))
