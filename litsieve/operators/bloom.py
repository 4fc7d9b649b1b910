"""A Bloom filter of keys as rows of an aggregate, applied where a table is scanned.

The filter is an array of 64-bit words; a key sets four bits of one word. Words are combined by
a bitwise OR before their shuffle and packed into chunks, one row each. A scan looks its keys
up by a broadcast join with the chunks: 12 bits a key, where the keys themselves would be a
hundred and more. About one key in thirty that was not put in passes, none that was is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.session import materialise

BITS_PER_KEY = 12
#: Bytes of a filter, at most; beyond it a join has to do without.
LIMIT = 64 << 20
_CHUNK = 1024
_BITS = 4


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """(word, bits within it) of a key."""
    word = F.pmod(F.xxhash64(key), F.lit(words))
    digest = F.xxhash64(key, F.lit("bits"))
    bits = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    for i in range(_BITS):
        at = F.shiftrightunsigned(digest, 6 * i).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", one, at))
    return word, bits


@dataclass(frozen=True)
class Bloom:
    chunks: DataFrame  # chunk, words
    words: int

    def keep(self, df: DataFrame, key: str) -> DataFrame:
        """The rows whose key may be in the filter; columns unchanged, NULL keys dropped."""
        word, bits = _place(F.col(key), self.words)
        rows = df.filter(F.col(key).isNotNull()).withColumns(
            {"_chunk": F.floor(word / _CHUNK), "_at": (word % _CHUNK).cast("int"), "_bits": bits}
        )
        # at most LIMIT bytes, by construction
        found = rows.join(F.broadcast(self.chunks.toDF("_chunk", "_words")), "_chunk")
        there = F.get("_words", F.col("_at")).bitwiseAND(F.col("_bits")) == F.col("_bits")
        return found.filter(there).select(*df.columns)


def bloom_filter(keys: DataFrame, key: str, bits_per_key: int = BITS_PER_KEY, limit: int = LIMIT) -> Bloom | None:
    """A stored filter of the keys, or None where it would be larger than ``limit`` bytes.

    ``keys`` should be stored: they are counted first.
    """
    n = keys.count()
    words = -(-max(n * bits_per_key // 64, 1) // _CHUNK) * _CHUNK
    if words * 8 > limit:
        return None
    word, bits = _place(F.col(key), words)
    rows = keys.filter(F.col(key).isNotNull()).select(word.alias("word"), bits.alias("bits"))
    empty = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    filled = rows.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    packed = filled.groupBy(F.floor(F.col("word") / _CHUNK).alias("chunk")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words")
    )
    return Bloom(materialise(packed, "bloom"), words)
