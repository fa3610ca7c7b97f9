"""Word k-grams as JVM expressions, shared by the native text scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower

# Characters between words: ASCII other than letters and digits. Lower-cased
# text has no A-Z, so the word class is [^\x00-\x2F\x3A-\x60\x7B-\x7F].
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"          # on text of any case


def words(text: Column) -> Column:
    """Array of the lower-cased words of a text (null: no words)."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS), "")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_grams(df: DataFrame, k: int, out: str, word_col: str = "w") -> DataFrame:
    """``df`` with a column ``out``: 64-bit hashes of all runs of ``k`` words of
    the array ``word_col``, in order (none if there are fewer words).

    Built by doubling, in about 2 log2 k passes over two arrays side by side,
    never looking up by index; each step is a column of its own, so that no
    array is computed twice. Half-length hashes stay in ``out`` + their length."""
    w = F.col(word_col)
    if k == 1:
        return df.withColumn(out, F.transform(w, lambda x: F.xxhash64(x)))

    def joined(df, left, right, shift, have, to):
        n = F.greatest(F.lit(0), F.size(w) - have + 1)
        return df.withColumn(to, F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(shift + 1), n),
                                            lambda x, y: F.xxhash64(x, y)))

    half, name = k // 2, f"{out}{k // 2}"
    left = w
    if half > 1:
        if name not in df.columns:
            df = with_grams(df, half, name, word_col)
        left = F.col(name)
    if k % 2 == 0:
        return joined(df, left, left, half, k, out)
    even = f"{out}{2 * half}"
    df = joined(df, left, left, half, 2 * half, even)
    return joined(df, F.col(even), w, 2 * half, k, out)
