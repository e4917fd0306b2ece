"""Mixing of sources to target weights by iterative proportional fitting."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored


def uniform(columns: list[Column], seed: int) -> Column:
    """A number in [0, 1) for a row: the first 52 bits of an MD5, alike in every engine."""
    key = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def topic_of(text: Column, topics: int = 8) -> Column:
    """A topic by content: the class that the longest word of a text (of seven letters or
    more; of equals the last in order) hashes to; 0 for texts without one.

    A stand-in where a corpus has no topics of its own, computed from the whole text.
    """
    words = F.regexp_extract_all(text, F.lit(r"(\p{L}{7,})"), F.lit(1))
    longest = F.array_max(F.transform(words, lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w"))))
    number = F.conv(F.substring(F.md5(longest["w"]), 1, 4), 16, 10).cast("int")
    return F.coalesce(F.pmod(number, F.lit(topics)), F.lit(0))


def rake(
    cells: DataFrame,
    targets: Mapping[str, DataFrame],
    weight: str = "tokens",
    rounds: int = 25,
    tolerance: float = 1e-6,
) -> DataFrame:
    """``cells`` with ``fitted``: shares of the whole that meet the targets of each margin.

    ``targets`` has for a column of ``cells`` a table ``value, target``. A value without a
    target gets nothing; targets of values without weight are left out, the others are
    scaled to sum to 1. In turn the cells of every margin are scaled to its targets, until
    no share is off by more than ``tolerance`` or ``rounds`` are over; with targets that
    contradict each other the last margin fits best. The cells stay a table: sums of a
    margin are aggregated before the shuffle and joined back, each step is written to the shared folder.
    """
    fitted = cells
    for column, wanted in targets.items():
        sums = cells.groupBy(column).agg(F.sum(weight).alias("_sum")).filter("_sum > 0")
        kept = sums.join(wanted, F.col(column).eqNullSafe(F.col("value")))
        kept = stored(kept.select("value", "target"))
        total = kept.agg(F.sum("target")).first()[0] or 1.0
        share = F.coalesce(F.col("target") / total, F.lit(0.0)).alias(f"_s_{column}")
        joined = fitted.join(kept, F.col(column).eqNullSafe(F.col("value")), "left")
        fitted = stored(joined.select(*fitted.columns, share))
    fitted = fitted.withColumn("fitted", F.col(weight).cast("double"))

    def sums_of(column: str) -> DataFrame:
        return fitted.groupBy(F.col(column).alias("_v")).agg(
            F.sum("fitted").alias("_sum"), F.first(f"_s_{column}").alias("_share")
        )

    for _ in range(rounds):
        for column in targets:
            factor = F.when(F.col("_sum") > 0, F.col("_share") / F.col("_sum")).otherwise(0.0)
            fitted = stored(
                fitted.join(sums_of(column), F.col(column).eqNullSafe(F.col("_v")))
                .withColumn("fitted", F.col("fitted") * factor)
                .drop("_v", "_sum", "_share")
            )
        if tolerance > 0:
            off = [sums_of(c).select(F.abs(F.col("_sum") - F.col("_share")).alias("off")) for c in targets]
            if (reduce(DataFrame.unionByName, off).agg(F.max("off")).first()[0] or 0.0) <= tolerance:
                break
    return fitted.drop(*(f"_s_{c}" for c in targets))


def flattened(cells: DataFrame, column: str, power: float, weight: str = "tokens") -> DataFrame:
    """Targets of a margin: its sums raised to ``power`` (1: as they are, 0: even)."""
    sums = cells.groupBy(F.col(column).alias("value")).agg(F.sum(weight).alias("_w"))
    return sums.filter("_w > 0").select("value", F.pow("_w", F.lit(power)).alias("target"))


def sample_mix(
    documents: DataFrame,
    margins: Mapping[str, float | DataFrame],
    tokens: Column,
    topic: Column | None = None,
    share: float = 0.5,
    seed: int = 17,
    id_column: str = "doc_id",
    rounds: int = 25,
    tolerance: float = 1e-6,
) -> DataFrame:
    """``documents`` with ``mixing``: ``tokens, topic, weight, probability, sampled``.

    ``margins`` gives for ``source``, ``lang``, ``topic`` (or other columns) a table of
    targets, or the power by which the present shares are flattened. ``weight`` is the
    calibrated weight of a document's cell, its fitted over its present tokens. Documents
    are sampled with probability ``weight * scale``, at most 1, each on its own by a hash
    of its id. ``scale`` is such that ``share`` of all tokens are expected: what a cell lacks
    that is taken whole is made up for by the others, in the ratio of their weights. The columns of ``documents`` are kept; a column named ``mixing`` is replaced.

    Rows with null values form cells of their own; rows without tokens have weight 0 and
    are never sampled; repeated rows share their fate. Only sums of cells are shuffled;
    the table of cells, joined back, has a row for each combination of margin values.
    """
    names = [c for c in documents.columns if c != "mixing"]
    values = {c: F.col(f"`{c}`") for c in margins if c != "topic"}
    if "topic" in margins:
        values["topic"] = topic if topic is not None else F.col("topic")
    # The caller's columns are one from here on, so that any may be called as those here.
    keyed = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
        F.coalesce(tokens.cast("long"), F.lit(0)).alias("own_tokens"),
        *(value.alias(f"_m_{c}") for c, value in values.items()),
        uniform([F.col(f"`{id_column}`")], seed).alias("draw"),
    )
    keys = [f"_m_{c}" for c in values]
    cells = stored(keyed.groupBy(*keys).agg(F.sum("own_tokens").alias("tokens")))
    targets = {
        f"_m_{c}": flattened(cells, f"_m_{c}", t) if isinstance(t, (int, float)) else t
        for c, t in margins.items()
    }
    fitted = rake(cells, targets, rounds=rounds, tolerance=tolerance)
    weight = F.when(F.col("tokens") > 0, F.col("fitted") / F.col("tokens")).otherwise(0.0)
    weights = stored(
        fitted.select(*(F.col(k).alias(f"{k}_") for k in keys), weight.alias("weight"), "tokens")
    )
    scale = _scale(weights, share)
    matches = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    condition = matches[0]
    for match in matches[1:]:
        condition = condition & match
    calibrated = F.coalesce("weight", F.lit(0.0))
    probability = F.least(calibrated * scale, F.lit(1.0))
    topic_name = F.col("_m_topic") if "topic" in values else F.lit(None).cast("string")
    return keyed.join(weights, condition, "left").select(
        *(F.col("row").getField(c).alias(c) for c in names),
        F.struct(
            F.col("own_tokens").alias("tokens"),
            topic_name.alias("topic"),
            calibrated.alias("weight"),
            probability.alias("probability"),
            ((F.col("own_tokens") > 0) & (F.col("draw") < probability)).alias("sampled"),
        ).alias("mixing"),
    )


def _scale(weights: DataFrame, share: float) -> float:
    """What weights are multiplied by to expect ``share`` of all tokens.

    Where that takes a cell beyond 1, all of it is taken and the others are scaled up for
    what is missing, until no more cells are full or all are. Reads the table of cells.
    """
    total = weights.agg(F.sum("tokens")).first()[0] or 0
    scale, full = share * total, None
    while True:
        is_full = F.col("weight") * scale >= 1
        sums = weights.filter("weight > 0").agg(
            F.count_if(is_full).alias("n"),
            F.sum(F.when(is_full, F.col("tokens"))).alias("taken"),
            F.sum(F.when(~is_full, F.col("weight") * F.col("tokens"))).alias("left"),
        ).first()
        if sums["n"] in (0, full) or not sums["left"]:
            return scale
        full = sums["n"]
        scale = max(scale, (share * total - sums["taken"]) / sums["left"])


def _cte(margin: str, before: str, name: str) -> str:
    return (
        f"{name} as (select * replace (case when sum(fitted) over (partition by {margin}) > 0 "
        f"then fitted * s_{margin} / sum(fitted) over (partition by {margin}) else 0 end as fitted) from {before})"
    )


def check_sql(powers: Mapping[str, float], share: float, seed: int, rounds: int) -> str:
    """DuckDB SQL for ``sample_mix`` of ``documents`` with flattened margins."""
    shares = [
        f"t_{c} as (select {c}, pow(sum(tokens), {p}) / sum(pow(sum(tokens), {p})) over () as s_{c} "
        f"from cells group by {c} having sum(tokens) > 0)"
        for c, p in powers.items()
    ]
    joins = " ".join(f"left join t_{c} using ({c})" for c in powers)
    steps, last = [], "r"
    for n in range(rounds):
        for c in powers:
            steps.append(_cte(c, last, f"r{n}_{c}"))
            last = f"r{n}_{c}"
    columns = ", ".join(powers)
    return rf"""
with words as (
  select doc_id, source, lang, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as tokens,
    list_max(list_transform(regexp_extract_all(text, '\p{{L}}{{7,}}'), lambda x: {{'n': length(x), 'w': x}})) as longest
  from documents),
keyed as (
  select doc_id, source, lang, tokens,
    coalesce(cast('0x' || substr(md5(longest.w), 1, 4) as bigint) % 8, 0) as topic from words),
cells as (select {columns}, sum(tokens) as tokens from keyed group by {columns}),
{", ".join(shares)},
r as (select cells.*, {", ".join(f"coalesce(s_{c}, 0) as s_{c}" for c in powers)},
  cast(tokens as double) as fitted from cells {joins}),
{", ".join(steps)},
weights as (
  select {columns}, case when tokens > 0 then fitted / tokens else 0 end as weight from {last}),
drawn as (
  select doc_id, source, lang, tokens, topic, weight,
    least(weight * {share} * (select sum(tokens) from keyed), 1.0) as probability,
    cast('0x' || substr(md5('{seed}|' || doc_id), 1, 13) as bigint) / 4503599627370496.0 as u
  from keyed join weights using ({columns}))
select doc_id, source, lang, cast(topic as integer) as topic, cast(tokens as bigint) as tokens,
  round(probability, 6) as probability, tokens > 0 and u < probability as sampled from drawn
"""
