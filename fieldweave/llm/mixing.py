"""Mixing sources to target weights over a curriculum that changes with time."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldweave.llm.common import WORD, fresh, partitions, text_or_empty
from fieldweave.session import settle

Knots = tuple[tuple[float, float], ...]


@dataclass(frozen=True)
class Settings:
    #: Words of the mix for each word of the documents, and of a source at most.
    total: float = 1.5
    cap: float = 2.0
    #: Documents of a source are dealt into ranges of an even order, each of about so many rows.
    range_rows: int = 10_000
    seed: str = "mix"


#: Weight of a source over the time of training (0 to 1), straight between the knots; only its shape counts.
EARLY: Knots = ((0.0, 1.5), (0.5, 1.25), (1.0, 0.25))
LATE: Knots = ((0.0, 0.25), (0.5, 0.75), (1.0, 2.25))
EVEN: Knots = ((0.0, 1.0), (1.0, 1.0))


def targets(sizes: Mapping[str | None, int], weights: Mapping[str | None, float], settings: Settings = Settings()) -> dict[str | None, float]:
    """Words to take of each source: shares of the total by weight, none above ``cap`` times its size; what a source
    can't give goes to the others by weight."""
    open_ = sorted(sizes, key=lambda s: settings.cap * sizes[s] / weights[s])
    left, weight = settings.total * sum(sizes.values()), float(sum(weights[s] for s in open_))
    out: dict[str | None, float] = {}
    while open_ and settings.cap * sizes[open_[0]] < weights[open_[0]] * left / weight:
        source = open_.pop(0)
        out[source] = settings.cap * sizes[source]
        left, weight = left - out[source], weight - weights[source]
    return out | {s: weights[s] * left / weight for s in open_}


def _cumulated(knots: Knots) -> tuple[list[float], float]:
    """The integral of the weights up to each knot, and the whole."""
    areas = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        areas.append(areas[-1] + (t1 - t0) * (w0 + w1) / 2)
    if knots[0][0] != 0 or knots[-1][0] != 1 or areas[-1] <= 0 or any(w < 0 for _, w in knots):
        raise ValueError("a schedule goes from time 0 to 1 with weights of 0 or more, not all 0")
    return areas, areas[-1]


def _position(share: Column, knots: Column) -> Column:
    """The time at which ``share`` (0 to 1) of a source's demand is used up: the knot before it, then the root of the
    quadratic that its linear weight integrates to. knots: array of (at, area, weight, slope), area in shares."""
    last = F.element_at(F.filter(knots, lambda k: k["area"] <= share), -1)
    rest = share - last["area"]
    root = F.sqrt(F.greatest(F.lit(0.0), last["weight"] * last["weight"] + 2 * last["slope"] * rest))
    return F.least(F.lit(1.0), last["at"] + F.coalesce(2 * rest / F.nullif(last["weight"] + root, F.lit(0.0)), F.lit(0.0)))


_TARGETS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()),
        T.StructField(
            "knots",
            T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in ("at", "area", "weight", "slope")])),
        ),
    ]
)


def cyclic(values: Sequence, names: Sequence[str | None]) -> dict:
    """Values for sources in order of code points (null last), from the first again after the last."""
    ordered = sorted((n for n in names if n is not None), key=lambda n: n.encode("utf-8")) + [None] * (None in names)
    return {name: values[i % len(values)] for i, name in enumerate(ordered)}


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] | Mapping[str | None, float],
    schedules: Sequence[Knots] | Mapping[str | None, Knots] = (EVEN,),
    settings: Settings = Settings(),
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row per document: doc_id (and ``keys``), size, source, source_size, target, taken, positions.

    Documents of a source stand in an order by hash; their sizes, added up in that order, are offsets, and once more
    for each further epoch. A document is taken in each epoch in which its middle lies before the source's target, at
    the position (0 to 1) where the source's cumulative demand reaches it. So whole documents are taken, a source's
    words differ from its target by half a document at most, and no document is taken more than ``cap`` times, rounded up.

    Null texts have size 0; the null source is a source; null and repeated ids are rows of their own. Weights and
    schedules are given by source or repeat over the sources in order. There is one row for each source in the driver,
    as there is in the parameters. No rows give no rows.
    """
    h, bucket = "h", "bucket"
    sized = docs.select(
        "doc_id", *keys, F.col("source").cast("string").alias("source"), F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("long").alias("size")
    )
    sized = settle(sized, "mix-sizes")
    found = {r["source"]: (r["size"], r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    sizes = {s: v[0] for s, v in found.items()}
    weights = dict(weights) if isinstance(weights, Mapping) else cyclic(weights, list(sizes))
    schedules = dict(schedules) if isinstance(schedules, Mapping) else cyclic(schedules, list(sizes))
    wanted = targets(sizes, weights, settings) if sizes else {}
    rows = []
    for source, target in wanted.items():
        knots = schedules[source]
        areas, whole = _cumulated(knots)
        pieces = [
            (t0, area / whole, w0 / whole, (w1 - w0) / (t1 - t0) / whole)
            for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas)
        ]
        rows.append((source, sizes[source], float(target), pieces))
    known = docs.sparkSession.createDataFrame(rows, _TARGETS)
    digits = max(2, math.ceil(math.log(max(1, sum(v[1] for v in found.values()) / settings.range_rows), 16)))
    order = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"|{settings.seed}")))
    sized = sized.withColumn(h, order).withColumn(bucket, F.substring(order, 1, digits))
    ranges = sized.groupBy("source", bucket).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("source").alias("of"), F.col(bucket).alias("range"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    inner = Window.partitionBy("source", bucket).orderBy(h, "doc_id", "size", *keys).rowsBetween(Window.unboundedPreceding, -1)
    sized = sized.withColumn("offset", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    sized = sized.join(ranges, F.col("source").eqNullSafe(F.col("of")) & (F.col(bucket) == F.col("range")))
    sized = sized.join(F.broadcast(known.withColumnRenamed("source", "known")), F.col("source").eqNullSafe(F.col("known")))
    middle = F.col("start") + F.col("offset") + F.col("size") / 2
    epochs = F.array(*[middle + F.lit(e) * F.col("source_size") for e in range(math.ceil(settings.cap))])
    taken = F.filter(epochs, lambda at: at < F.col("target"))
    positions = F.transform(taken, lambda at: _position(at / F.col("target"), F.col("knots")))
    return sized.select(
        "doc_id", *keys, "size", "source", "source_size", "target", (F.size(taken) * F.col("size")).cast("long").alias("taken"), positions.alias("positions")
    )


def curriculum(
    docs: DataFrame, weights, schedules=(EVEN,), settings: Settings = Settings(), position: str | None = None
) -> DataFrame:
    """The documents of the mix in training order, with all their columns: a row for each time a document is taken,
    sorted by position over range partitions. Rows alike in all columns share their places. With ``position`` the rows
    have their position in a column of that name, for tables that are written and read again lose the order of rows."""
    columns = docs.columns
    extra = [] if position is None else [position]
    if extra != fresh(docs, *extra):
        raise ValueError(f"the documents have a column {position}")
    k1, k2, at, alike, spots = fresh(docs, "k1", "k2", "position", "alike", "spots")
    plain = [F.col(f.name) for f in docs.schema if not isinstance(f.dataType, T.MapType)]
    keyed = docs.withColumn(k1, F.xxhash64(*plain)).withColumn(k2, F.xxhash64(F.lit("row"), *reversed(plain)))
    own = [n for n in ("doc_id", "text", "source")]
    planned = plan_mix(keyed.select(*own, k1, k2), weights, schedules, settings, keys=(k1, k2))
    places = planned.where(F.size("positions") > 0).groupBy(k1, k2)
    places = places.agg(F.count("*").alias(alike), F.flatten(F.collect_list("positions")).alias(spots))
    joined = keyed.join(places, [k1, k2])
    # Of rows that are alike each has all their places: one of them is enough.
    many = joined.where(F.col(alike) > 1).dropDuplicates([k1, k2])
    rows = joined.where(F.col(alike) == 1).unionByName(many)
    rows = rows.withColumn(at, F.explode(spots)).select(*columns, at)
    rows = rows.repartitionByRange(partitions(docs.sparkSession), at).sortWithinPartitions(at)
    return rows.select(*columns, *[F.col(at).alias(name) for name in extra])


MIX_SQL = r"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents
),
sources as (
    select source, sum(size)::bigint as source_size,
        [3, 1, 2][1 + ((row_number() over (order by source is null, encode(source)) - 1) % 3)::int]::double as weight
    from sized group by source
),
filled as (
    select *, 1.5::double * sum(source_size) over () as total, 2.0::double * source_size as cap,
        row_number() over w as k, coalesce(sum(2.0::double * source_size) over (w rows between unbounded preceding and 1 preceding), 0) as given,
        sum(weight) over (w rows between current row and unbounded following) as weights
    from sources window w as (order by 2.0::double * source_size / weight)
),
last as (select min(k) as k from filled where not cap < weight * (total - given) / weights),
level as (select f.total - f.given as remaining, f.weights, f.k from filled f join last using (k)),
wanted as (
    select f.source, f.source_size,
        case when l.k is null or f.k < l.k then f.cap else f.weight * l.remaining / l.weights end as target
    from filled f left join level l on true
),
placed as (
    select s.doc_id, s.size, w.source_size, w.target, s.size / 2.0::double + coalesce(sum(s.size) over (
        partition by s.source order by md5(concat(s.doc_id::varchar, '|mix')), s.doc_id rows between unbounded preceding and 1 preceding), 0) as middle
    from sized s join wanted w on s.source is not distinct from w.source
)
select doc_id, size, source_size, target,
    (size * ((middle < target)::int + (middle + source_size < target)::int))::bigint as taken
from placed
"""

#: The mix with the positions at which a document is taken: what MIX_SQL has, and the schedules.
PLACES_SQL = (
    MIX_SQL.partition("placed as (")[0]
    + r"""schedules(k, t0, t1, w0, w1) as (
    values (0, 0.0::double, 0.5::double, 1.5::double, 1.25::double), (0, 0.5, 1.0, 1.25, 0.25),
        (1, 0.0, 0.5, 0.25, 0.75), (1, 0.5, 1.0, 0.75, 2.25), (2, 0.0, 1.0, 1.0, 1.0)
),
areas as (select *, sum((t1 - t0) * (w0 + w1) / 2) over (partition by k order by t0) as until, sum((t1 - t0) * (w0 + w1) / 2) over (partition by k) as whole from schedules),
pieces as (
    select k, t0, w0 / whole as weight, (w1 - w0) / (t1 - t0) / whole as slope,
        coalesce(lag(until) over w / whole, 0) as low, case when lead(t0) over w is null then 2 else until / whole end as high
    from areas window w as (partition by k order by t0)
),
numbered as (select source, (row_number() over (order by source is null, encode(source)) - 1) % 3 as k from sources),
placed as (
    select s.doc_id, s.size, w.source_size, w.target, n.k, s.size / 2.0::double + coalesce(sum(s.size) over (
        partition by s.source order by md5(concat(s.doc_id::varchar, '|mix')), s.doc_id rows between unbounded preceding and 1 preceding), 0) as middle
    from sized s join wanted w on s.source is not distinct from w.source join numbered n on s.source is not distinct from n.source
)
select doc_id, size, source_size, target,
    (size * ((middle < target)::int + (middle + source_size < target)::int))::bigint as taken,
    case when middle < target then least(1, a.t0 + 2 * (middle / target - a.low) / (a.weight + sqrt(a.weight * a.weight + 2 * a.slope * (middle / target - a.low)))) end as first_position,
    case when middle + source_size < target then least(1, b.t0 + 2 * ((middle + source_size) / target - b.low)
        / (b.weight + sqrt(b.weight * b.weight + 2 * b.slope * ((middle + source_size) / target - b.low)))) end as second_position
from placed p
left join pieces a on a.k = p.k and middle < target and middle / target >= a.low and middle / target < a.high
left join pieces b on b.k = p.k and middle + source_size < target and (middle + source_size) / target >= b.low and (middle + source_size) / target < b.high
"""
)
