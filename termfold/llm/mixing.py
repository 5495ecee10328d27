"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted by cell, a combination of source, language and topic. The cells' token weights are raked: scaled to
the target share of each source, then of each language, then of each topic, again and again until every marginal is
met. The fitted share of a cell over its tokens is how much more or less it should count; documents are then
sampled with a probability in proportion to it, scaled so that the expected tokens are ``keep`` of all. Probabilities that
would pass 1 stay at 1, and the others take up what those cannot give.

A document's draw is a keyed hash of its id and text, so the sample is the same in every run. Cells are a small table
next to the documents, but nothing depends on that: all sums are Spark aggregates and joins by key.

Targets that are not given are the shares of tokens, evened out by ``temperature`` (share ** temperature, normalised).
Given targets are taken of the values that occur; values without a target share get none.

Defined results: a null source, language or topic is a value of its own. A null or empty text has no tokens: it moves
no weight and takes the probability of its cell, ``keep`` if the whole cell has no tokens. A value whose target is 0
has probability 0. If targets contradict the cells that exist, the fit ends after ``sweeps`` sweeps at the last marginal.
Repeated rows are drawn alike, a null id counts as 0. Other columns are kept; ``topic``, ``tokens``, ``weight``,
``probability`` and ``kept`` are added or replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfold.session import stored

KEEP = 0.5
TEMPERATURE = 0.7
SWEEPS = 30
TOLERANCE = 1e-6
SEED = 20
MARGINALS = ("source", "lang", "topic")
_ADDED = ("topic", "tokens", "weight", "probability", "kept")


def tokens(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """A topic by the form of the text: table, licence, code, loud or prose."""
    text = F.coalesce(text, F.lit(""))
    lines = F.greatest(F.lit(1), F.regexp_count(text, F.lit("\n")) + 1)
    return (
        F.when(F.regexp_count(text, F.lit(r" \| ")) >= 2 * lines, "table")
        .when(F.lower(text).contains("license"), "licence")
        .when(F.regexp_count(text, F.lit(r"[{};=]")) >= 2 * lines, "code")
        .when(F.regexp_count(text, F.lit(r"!!")) >= 2 * lines, "loud")
        .otherwise("prose")
    )


def _targets(cells: DataFrame, name: str, given: Mapping | None, temperature: float) -> DataFrame:
    """``name, target``: shares that sum to 1, of the values with tokens."""
    sums = cells.groupBy(name).agg(F.sum("tokens").alias("t")).where("t > 0")
    if given is None:
        wish = F.pow("t", F.lit(temperature))
    else:
        if not given:
            raise ValueError(f"no targets for {name}")
        pairs = [x for value, share in given.items() for x in (F.lit(value), F.lit(float(share)))]
        wish = F.coalesce(F.create_map(*pairs)[F.col(name)], F.lit(0.0))
    wished = stored(sums.select(name, wish.alias("w")), "wished_shares")
    total = wished.agg(F.sum("w").alias("all")).first()["all"]
    return wished.select(name, (F.col("w") / F.lit(total or None)).alias("target"))


def fit(
    cells: DataFrame,
    targets: Mapping[str, Mapping] | None = None,
    marginals: Sequence[str] = MARGINALS,
    temperature: float = TEMPERATURE,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """``cells`` (marginals and ``tokens``) with ``weight``: fitted shares of all tokens, by raking.

    Only the factors of the marginals' values change from step to step; each step sums the cells under the latest ones.
    """
    cells = stored(cells, "cells")
    factors = {}
    for name in marginals:
        wanted = _targets(cells, name, (targets or {}).get(name), temperature)
        values = cells.select(name).distinct()
        factor = values.join(wanted, values[name].eqNullSafe(wanted[name]), "left").select(
            values[name].alias(f"_{name}"), F.lit(1.0).alias("f"), F.coalesce("target", F.lit(0.0)).alias("target"), F.lit(0.0).alias("off")
        )
        factors[name] = stored(factor, "factors")
    for _ in range(sweeps):
        for name in marginals:
            have = _weighted(cells, factors).groupBy(F.col(name).alias("_v")).agg(F.sum("weight").alias("have"))
            old = factors[name]
            step = F.when(F.col("have") > 0, F.col("target") / F.col("have")).otherwise(F.lit(0.0))
            new = old.join(have, old[f"_{name}"].eqNullSafe(have["_v"])).select(
                f"_{name}", (F.col("f") * step).alias("f"), "target", F.abs(F.col("have") - F.col("target")).alias("off")
            )
            factors[name] = stored(new, "factors")
        offs = [factors[name].agg(F.max("off").alias("off")) for name in marginals]
        every = offs[0]
        for more in offs[1:]:
            every = every.unionByName(more)
        if all((row.off or 0.0) <= TOLERANCE for row in every.collect()):
            break
    return _weighted(cells, factors)


def _weighted(cells: DataFrame, factors: Mapping[str, DataFrame]) -> DataFrame:
    """Cells with the product of their tokens and factors."""
    weight = F.col("tokens").cast("double")
    out = cells
    for i, (name, factor) in enumerate(factors.items()):
        factor = factor.select(f"_{name}", F.col("f").alias(f"f{i}"))
        out = out.join(factor, out[name].eqNullSafe(factor[f"_{name}"]))
        weight = weight * F.col(f"f{i}")
    return out.select(*cells.columns, weight.alias("weight"))


def with_probabilities(cells: DataFrame, keep: float = KEEP) -> DataFrame:
    """Fitted cells with the probability of their documents, for expected tokens of ``keep`` of all."""
    total = cells.agg(F.sum("tokens").alias("t")).first().t or 0
    if not total:
        return cells.withColumn("probability", F.lit(float(keep)))
    ratio = F.col("weight") * total / F.col("tokens")
    room, scale = float(keep) * total, 0.0
    # Cells at 1 give all they have; the rest is scaled to the room that is left. Each round can only add cells at 1.
    full = -1
    while True:
        state = cells.where("tokens > 0").agg(
            F.sum(F.when(ratio * scale >= 1, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(ratio * scale < 1, F.col("weight") * total).otherwise(0.0)).alias("open"),
            F.count(F.when(ratio * scale >= 1, 1)).alias("n"),
        ).first()
        if state.n == full or not state.open:
            break
        full, scale = state.n, max(scale, (room - state.full) / state.open)
    return cells.withColumn(
        "probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), ratio * F.lit(scale))).otherwise(F.lit(float(keep)))
    )


def draw(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the seed, the id and the text."""
    mixed = F.xxhash64(F.lit(seed), F.coalesce(doc_id.cast("long"), F.lit(0)), F.coalesce(text, F.lit("")))
    return F.shiftrightunsigned(mixed, 11).cast("double") / float(1 << 53)


def mix(
    docs: DataFrame,
    targets: Mapping[str, Mapping] | None = None,
    keep: float = KEEP,
    temperature: float = TEMPERATURE,
    seed: int = SEED,
) -> DataFrame:
    """Every document with its topic, tokens, weight of its cell, probability, and whether the sample keeps it."""
    names = [c for c in docs.columns if c.lower() not in _ADDED]
    dealt = docs.select(*names, topic(F.col("text")).alias("topic"), tokens(F.col("text")).alias("tokens"))
    cells = dealt.groupBy(*MARGINALS).agg(F.sum("tokens").alias("tokens"))
    fitted = stored(fit(cells, targets, temperature=temperature), "weighted_cells")
    fitted = stored(with_probabilities(fitted, keep), "fitted_cells")
    fitted = fitted.select(*[F.col(m).alias(f"_{m}") for m in MARGINALS], "weight", "probability")
    same = [dealt[m].eqNullSafe(fitted[f"_{m}"]) for m in MARGINALS]
    joined = dealt.join(fitted, same[0] & same[1] & same[2])
    kept = draw(F.col("doc_id"), F.col("text"), seed) < F.col("probability")
    return joined.select(*names, "topic", "tokens", "weight", "probability", kept.alias("kept"))


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", *MARGINALS, "tokens", "weight", "probability", "kept")
