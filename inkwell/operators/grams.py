"""Which texts hold which literal patterns, without trying every pattern on every text.

Every pattern is filed under one of its grams of three characters (of two or one, if
it is shorter; the one that the fewest patterns hold), and a text meets the patterns filed under its own distinct
grams: an equi-join on the gram.  A pattern that occurs in a text has all of its
grams in it, so none is missed; what meets is only a candidate and is verified
literally by the caller.  The work follows texts' grams and candidates, not texts
times patterns, and no table of patterns is held by the driver or repeated per row.

Long texts against many patterns take grams of six characters, too, and only send the
grams that patterns may be filed under: a filter of a fixed size says which
(``gram_filter``, ``passing_grams``).  A gram that passes by chance meets nothing in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

# Widths of grams, in characters: a pattern is filed under the widest that it has.
WIDTHS = (3, 2, 1)
# Those of long texts.
TEXT_WIDTHS = (6, 3, 2, 1)
# Slots of the filter of grams.
FILTER_BITS = 1 << 24
# Rows that a task holds before it sends them on.
HELD_ROWS = 200_000


def _coder(widths: tuple[int, ...], widest_only: bool = False):
    """Text -> the codes of its grams, an array per width; 21 bits hold a character, so three fill one number exactly.

    Six are a hash, which may be that of other grams: what meets is only a candidate.
    """
    def codes(text):
        import numpy as np

        c = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        fits = [w for w in widths if len(c) >= w]
        three = c[:-2] << 42 | c[1:-1] << 21 | c[2:] if len(c) >= 3 else None
        found = []
        for w in fits[:1] if widest_only else fits:
            if w == 6:
                x = three.view(np.uint64)
                x = x[:-3] * np.uint64(0x9E3779B97F4A7C15) + x[3:] * np.uint64(0xC2B2AE3D27D4EB4F)
                found.append((x ^ x >> np.uint64(32)).view(np.int64))
            elif w == 3:
                found.append(three)
            elif w == 2:
                found.append(-(1 << 43) - (c[:-1] << 21 | c[1:]))
            else:
                found.append(-1 - c)
        return found

    return codes


def _slots(n_bits: int):
    """Codes -> their slots in the filter: the highest bits of a product."""
    def slots(codes):
        import numpy as np
        return (codes.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(65 - n_bits.bit_length())).view(np.int64)

    return slots


def _gram_codes(widths: tuple[int, ...], widest_only: bool):
    """Texts -> their distinct grams as numbers.

    Array functions of Spark are interpreted and take about a hundred times as long.
    """
    of = _coder(widths, widest_only)

    def codes(texts):
        import numpy as np
        import pandas as pd
        return pd.Series([np.unique(np.concatenate(found)) if (found := of(t)) else np.zeros(0, np.int64) for t in texts])

    codes.__annotations__ = {}
    return F.pandas_udf(codes, "array<long>", F.PandasUDFType.SCALAR)


def with_grams(texts: DataFrame, text: Column, widths: tuple[int, ...] = WIDTHS, widest_only: bool = False) -> DataFrame:
    """One row per row and distinct ``gram`` of the text, of the given widths or of the widest that it has."""
    return texts.withColumn("_grams", _gram_codes(widths, widest_only)(text)).withColumn("gram", F.explode("_grams")).drop("_grams")


def anchored(patterns: DataFrame, pattern: str, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """``gram, pattern``: every distinct pattern of at least the least width under its rarest gram."""
    distinct = patterns.select(pattern).filter(F.length(pattern) > 0).distinct()
    listed = with_grams(distinct, F.col(pattern), widths, widest_only=True)
    rarity = listed.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return listed.join(rarity, "gram").groupBy(pattern).agg(F.min(F.struct("n", "gram")).alias("a")).select(F.col("a.gram").alias("gram"), pattern)


def meeting(texts: DataFrame, text: Column, patterns: DataFrame, pattern: str, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """The rows of ``texts`` beside every pattern that may occur in ``text``.

    Neither side is broadcast: the planner does not see how many grams a text has, and
    the exploded texts would pass as a small table.
    """
    return with_grams(texts, text, widths).join(anchored(patterns, pattern, widths).hint("shuffle_hash"), "gram").drop("gram")


def gram_filter(filed: DataFrame) -> bytes:
    """A bit per slot that one of the column ``gram`` falls in: 2 MB, whatever the number of grams."""
    import numpy as np
    slots = _slots(FILTER_BITS)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(slots(batch.column("gram").to_numpy(zero_copy_only=False)))], names=["slot"])

    rows = (filed.select("gram").mapInArrow(run, "slot long").groupBy(F.shiftright("slot", 5).cast("int").alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 as int))")).alias("bits")).toArrow())
    words = np.zeros(FILTER_BITS // 32, "<u4")
    words[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return words.tobytes()


def passing_grams(texts: DataFrame, key: str, text: str, bits: bytes, widths: tuple[int, ...] = TEXT_WIDTHS) -> DataFrame:
    """``key, gram``: a row per row and distinct gram of the text that passes the filter.  A task holds one text's grams and
    ``HELD_ROWS`` rows at a time."""
    codes, slots, held_rows = _coder(widths), _slots(FILTER_BITS), HELD_ROWS

    def run(batches):
        import numpy as np
        import pyarrow as pa

        filled = np.frombuffer(bits, np.uint8)

        def passing(value):
            found = []
            for c in codes(value):
                slot = slots(c)
                found.append(c[(filled[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)])
            return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

        for batch in batches:
            keys, values = batch.column(key), batch.column(text)
            rows, grams, held = [], [], 0
            for i in range(len(values)):
                grams.append(passing(values[i].as_py()))
                rows.append(i)
                held += len(grams[-1])
                if held >= held_rows or i == len(values) - 1:
                    at = np.repeat(np.array(rows, np.int64), [len(g) for g in grams])
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(at)), pa.array(np.concatenate(grams))], names=[key, "gram"])
                    rows, grams, held = [], [], 0

    return texts.select(key, text).mapInArrow(run, StructType([texts.schema[key], StructField("gram", LongType())]))
