"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Weight of a source is its number of documents to this power; 1 keeps the mix, 0 makes sources equal.
POWER = 0.5
#: A Poisson draw has a rate of at most this; a larger rate is the sum of several draws.
RATE_PER_DRAW = 32
SEED = 17

_BITS = 52


def target_weights(docs: DataFrame, power: float = POWER) -> DataFrame:
    """(source, weight) from the sizes of the sources."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    return sizes.select("source", F.pow(F.col("n").cast("double"), F.lit(power)).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, epochs: float = 1.0) -> DataFrame:
    """Per source, the mean number of times that each of its documents is repeated.

    Rates give a source its share of ``epochs`` times the documents. A source
    without a weight has rate 0. ``cdf`` tabulates the Poisson distribution of
    one of ``draws`` equal draws, as far as a hash of 52 bits reaches.
    """
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    weights = weights.select(F.col("source").alias("_source"), "weight")
    known = sizes.join(weights, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight")
    )
    whole = known.agg(F.sum("n").alias("docs"), F.sum("weight").alias("weights")).first()
    share = f"{float(epochs)} * {whole.docs or 0} * weight / {whole.weights or 1.0!r}D / n"
    shared = known.select("source", F.expr(f"CASE WHEN weight > 0 THEN {share} ELSE 0D END").alias("rate"))
    parts = shared.select("source", "rate", F.expr(f"greatest(1, CAST(ceil(rate / {RATE_PER_DRAW}) AS INT))").alias("draws"))
    cdf = (
        "aggregate(sequence(1, CAST(ceil(rate / draws + 12 * sqrt(rate / draws)) AS INT) + 30), "
        "struct(array(exp(-rate / draws)) AS cdf, exp(-rate / draws) AS p), "
        "(s, k) -> struct(array_append(s.cdf, element_at(s.cdf, -1) + s.p * (rate / draws) / k) AS cdf, "
        "s.p * (rate / draws) / k AS p), s -> s.cdf)"
    )
    return parts.select("source", "rate", "draws", F.expr(cdf).alias("cdf"))


def drawn_copies(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """(row, copy, shuffle_key): each document, whole, as often as its Poisson draw says, in a global shuffle.

    The draw inverts the distribution at a number hashed from seed and id, so a
    rerun or another table with the same rates repeats the same documents.
    ``copy`` counts from 1; a document drawn 0 times is left out, which is how a
    source shrinks. Null sources are one source, a null id counts
    as the empty key, and repeated rows are drawn alike.

    Rows are dealt by ``shuffle_key``, a hash of seed, id and copy, and ordered
    by it inside each partition: neighbours in the result are unrelated.
    """
    weights = target_weights(docs) if weights is None else weights
    known = rates(docs, weights, epochs).withColumnRenamed("source", "_source")
    key = F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = docs.select(F.struct("*").alias("row"), "source", key.alias("_key")).join(known, F.col("source").eqNullSafe(F.col("_source")))
    number = f"CAST(conv(substring(md5(concat(_key, '/draw/', j)), 1, {_BITS // 4}), 16, 10) AS DOUBLE) / {float(1 << _BITS)}D"
    copies = f"aggregate(sequence(1, draws), 0, (n, j) -> n + size(filter(cdf, c -> c <= {number})))"
    drawn = drawn.withColumn("_copies", F.expr(copies)).where("_copies > 0")
    copied = drawn.select("row", "_key", F.expr("explode(sequence(1, _copies)) AS copy"))
    keyed = copied.select("row", "copy", F.expr("md5(concat(_key, '/copy/', copy))").alias("shuffle_key"))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mixed_copies(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """``drawn_copies`` with the documents' columns beside ``copy`` and ``shuffle_key``, which replace columns so named."""
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("copy", "shuffle_key")]
    return drawn_copies(docs, weights, epochs, seed).select(*own, "copy", "shuffle_key")
