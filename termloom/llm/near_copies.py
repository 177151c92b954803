"""Groups of near-equal texts, so that statistics over texts count a page once however often it was copied.

Texts are compared by the words they hold in threes, through signatures of
minimal hashes: texts that agree in a band of a signature meet the least text of
that band, and are linked if their signatures agree in enough places.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom import runtime
from termloom.operators import resolve

#: Places of a signature, in bands of so many; places in which near copies agree (of similarity 0.58, about).
BANDS, BAND, ALIKE = 8, 3, 14
#: Words that are hashed at once.
CHUNK = 20_000

_RNG = np.random.default_rng(5)
_MIX = _RNG.integers(1, 2**63, BANDS * BAND, dtype=np.uint64) | np.uint64(1)
_STEP = _RNG.integers(1, 2**63, 3, dtype=np.uint64) | np.uint64(1)


def signature(words: list[str], known: dict[str, int]) -> list[int]:
    """The signature of a text; ``known`` keeps the hashes of words between calls. A text without words has an empty one."""
    import xxhash

    for w in words:
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w)
    if not words:
        return []
    h = np.asarray([known[w] for w in words], dtype=np.uint64)
    h = np.concatenate([h, np.zeros(max(0, 3 - len(h)), dtype=np.uint64)])
    threes = h[:-2] * _STEP[0] + h[1:-1] * _STEP[1] + h[2:] * _STEP[2]
    threes ^= threes >> np.uint64(29)
    least = np.full(len(_MIX), np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(threes), CHUNK):
        least = np.minimum(least, (threes[None, low : low + CHUNK] * _MIX[:, None]).min(axis=1))
    return least.view(np.int64).tolist()


def groups(signed: DataFrame) -> DataFrame:
    """``mark, root``: the texts that have a near copy, and the least text of their group.

    ``signed`` has ``mark, sig``. Near copies of near copies are of one group;
    texts with an empty signature are in none; repeated rows change nothing.
    """
    signed = runtime.durable(signed.select("mark", "sig").where(F.size("sig") > 0).dropDuplicates(["mark"]))
    bands = F.array(*[F.xxhash64(F.lit(b), *[F.col("sig")[b * BAND + k] for k in range(BAND)]) for b in range(BANDS)])
    keyed = runtime.durable(signed.select("mark", F.explode(bands).alias("band")))
    heads = keyed.groupBy("band").agg(F.min("mark").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("band", "head")
    met = runtime.lookup(keyed, heads, "band", F.col("mark"), runtime.hot_keys(keyed, "band"), "inner")
    met = runtime.durable(met.where("mark <> head").select("mark", "head").distinct())
    met = met.join(signed, "mark")
    met = runtime.lookup(met, signed.select(F.col("mark").alias("head"), F.col("sig").alias("other")), "head", F.col("mark"), runtime.hot_keys(met, "head"), "inner")
    agree = F.size(F.filter(F.zip_with("sig", "other", lambda x, y: x == y), lambda x: x))
    links = runtime.durable(met.where(agree >= ALIKE).select(F.col("mark").alias("i"), F.col("head").alias("j")))
    return runtime.durable(resolve.components(links).select(F.col("v").alias("mark"), "root"))
