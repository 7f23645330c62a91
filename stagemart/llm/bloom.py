"""Bloom filters built and probed by DataFrame functions alone."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bloom:
    """A filter as a frame of one array of 64-bit words; ``seed`` sets its hash functions apart."""

    frame: DataFrame
    bits: int
    hashes: int
    seed: int

    def passes(self, key: Column) -> Column:
        """False for keys that are surely absent. The words reach the rows as a constant."""
        filled = self.frame.scalar()
        found = F.lit(True)
        for position in positions(key, self.seed, self.bits, self.hashes):
            word = F.get(filled, F.floor(position / 64).cast("int"))
            found = found & (F.getbit(word, (position % 64).cast("int")) == 1)
        return found


def positions(key: Column, seed: int, bits: int, hashes: int) -> list[Column]:
    """Bits of a key; each seed hashes the key anew, so no two keys agree under all of them."""
    seeded = F.xxhash64(F.lit(seed), key)
    return [F.pmod(F.xxhash64(seeded, F.lit(number)), F.lit(bits)) for number in range(hashes)]


def bloom_size(count: int, share: float) -> tuple[int, int]:
    """Bits and hash functions that let ``share`` of absent keys pass, of ``count`` keys."""
    hashes = max(1, round(math.log2(1 / share)))
    return 64 * max(1, math.ceil(count * hashes / math.log(2) / 64)), hashes


def bloom_of(keys: DataFrame, key: Column, bits: int, hashes: int, seed: int = 0) -> Bloom:
    places = keys.select(F.explode(F.array(*positions(key, seed, bits, hashes))).alias("position"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("position") % 64).cast("int"))
    filled = places.groupBy(F.floor(F.col("position") / 64).alias("word")).agg(F.bit_or(bit).alias("bits"))
    whole = keys.sparkSession.range(0, bits // 64, 1, 1).withColumnRenamed("id", "word").join(filled, "word", "left")
    held = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return Bloom(whole.agg(F.transform(held, lambda word: word["bits"]).alias("words")), bits, hashes, seed)
