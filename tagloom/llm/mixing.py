"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions alone.

Target weights are fractions, so over whole numbers w that are in proportion to them, and add up to W, the schedule
repeats after W slots: block j of a source is released at slot floor(j W / w) and due by slot ceil((j + 1) W / w).
Earliest deadline first, over released blocks, meets every deadline. So after any number of slots, in any number of
periods, a source is less than one block away from its target. One period is folded by a SQL aggregate; a document's
place in the output is then closed arithmetic.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .ranks import rank_within

#: Numbers in a schedule up to which it is broadcast; a larger one is joined by a shuffle.
SMALL_PLAN = 2_000_000
ADDED = ("source_rank", "block", "slot", "position")


def default_weights(counts: list[int], about: int = 1000) -> list[int]:
    """Whole numbers, one at least, near the square roots of the sources' sizes and adding up to about `about`."""
    total = sum(n**0.5 for n in counts)
    return [max(1, int(about * n**0.5 / total + 0.5)) for n in counts]


def whole_weights(weights: list) -> list[int]:
    """The least whole numbers in exactly the proportions of some weights; a float is the decimal that it prints as."""
    exact = [Fraction(str(w)) if isinstance(w, float) else Fraction(w) for w in weights]
    if min(exact) < 0:
        raise ValueError("a weight is negative")
    scale = math.lcm(*(x.denominator for x in exact))
    whole = [int(x * scale) for x in exact]
    return [x // (math.gcd(*whole) or 1) for x in whole]


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _longs(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def schedule(spark: SparkSession, weights: list[int], slots: int | None = None, chunk: int = 256) -> DataFrame:
    """The first slots of a period: rows (slot, source_no, block_no, before), before being the blocks of each source in
    earlier slots. The fold takes a step for each slot and source; slots are gathered by chunks, so none is copied often."""
    total, quota = F.lit(sum(weights)), _longs(weights)
    n = F.lit(sum(weights) if slots is None else slots)
    kind = "array<struct<source_no:int,block_no:bigint,before:array<bigint>>>"

    def pick(done: Column, t: Column) -> Column:
        """The released block of the earliest deadline; of equal ones that of the first source."""
        w = lambda i: F.get(quota, i)
        released = lambda d, i: (d < w(i)) & (F.floor(d * total / w(i)) <= t)
        return F.array_min(F.transform(done, lambda d, i: F.when(released(d, i), F.struct(F.ceil((d + 1) * total / w(i)).alias("due"), i.alias("i")))))["i"]

    def step(acc: Column, t: Column) -> Column:
        return _let(
            pick(acc["done"], t),
            lambda p: F.struct(
                F.transform(acc["done"], lambda d, i: F.when(i == p, d + 1).otherwise(d)).alias("done"),
                F.concat(acc["out"], F.array(F.struct(p.alias("source_no"), F.get(acc["done"], p).alias("block_no"), acc["done"].alias("before")))).alias("out"),
            ),
        )

    def some(done: Column, first: Column) -> Column:
        start = F.struct(done.alias("done"), F.expr(f"cast(array() as {kind})").alias("out"))
        return F.aggregate(F.sequence(first, F.least(first + chunk, n) - 1), start, step)

    start = F.struct(F.array_repeat(F.lit(0).cast("long"), len(weights)).alias("done"), F.expr(f"cast(array() as array<{kind}>)").alias("out"))
    chunks = F.aggregate(
        F.sequence(F.lit(0), n - 1, F.lit(chunk)), start, lambda acc, c: _let(some(acc["done"], c), lambda r: F.struct(r["done"].alias("done"), F.concat(acc["out"], F.array(r["out"])).alias("out")))
    )
    return spark.range(1).select(F.posexplode(F.flatten(chunks["out"])).alias("slot", "x")).select(F.col("slot").cast("long"), "x.*")


def _places(spark: SparkSession, ranked: DataFrame, sources: list[tuple[str | None, int, int]], block_rows: int, first_slot: int, first_position: int) -> tuple[DataFrame, int, int]:
    """Rows of some sources (name, rows, weight) with _slot and _position, and the first slot and position after them."""
    counts, w = [n for _, n, _ in sources], [x for _, _, x in sources]
    blocks, period = [-(-n // block_rows) for n in counts], sum(w)
    # No block is due later, so a longer period is not folded to its end.
    slots = min(period, max(-(-min(b, x) * period // x) for b, x in zip(blocks, w, strict=True)))
    names = spark.createDataFrame([(s, i, x) for i, (s, _, x) in enumerate(sources)], "_s string, source_no int, _w long")
    plan = schedule(spark, w, slots).withColumnRenamed("slot", "_at").withColumnRenamed("block_no", "_b")
    if slots * len(w) <= SMALL_PLAN:
        names, plan = F.broadcast(names), F.broadcast(plan)
    d = ranked.join(names, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_block", F.floor(F.col("_rank") / block_rows))
    d = d.withColumns({"_b": F.col("_block") % F.col("_w"), "_round": F.floor(F.col("_block") / F.col("_w"))}).join(plan, ["source_no", "_b"])
    had = F.zip_with(F.zip_with("before", _longs(w), lambda b, x: (F.col("_round") * x + b) * block_rows), _longs(counts), lambda a, c: F.least(a, c))
    earlier = F.aggregate(had, F.lit(0).cast("long"), lambda a, x: a + x)
    d = d.withColumn("_slot", F.lit(first_slot) + F.col("_round") * period + F.col("_at"))
    d = d.withColumn("_position", F.lit(first_position) + earlier + F.col("_rank") % block_rows)
    return d, first_slot + period * max(-(-b // x) for b, x in zip(blocks, w, strict=True)), first_position + sum(counts)


def mix(spark: SparkSession, docs: DataFrame, weights: dict | None = None, block_rows: int = 16, about: int = 1000, added: tuple[str, str, str, str] = ADDED) -> DataFrame:
    """Add source_rank, block, slot and position (or other names, `added`) to docs, which has doc_id, text and source.

    Within a source, documents come in the order of an md5 of doc_id and text, cut into blocks of block_rows.
    slot is the block's slot in the schedule; position (0-based, without gaps) is the document's place when the
    blocks are read by slot. All rows are kept: when a source has run out, its slots stay empty and the others
    go on at their relative weights. `weights` gives the target of each source, taken exactly; sources of weight 0 or
    not in it come after all others, among themselves by default_weights(), which is what all sources have when no
    weights are given. A schedule has as many slots as the weights in whole numbers add up to, or as the documents
    need if these are fewer. The driver holds a name and two numbers for each source. A null source is a source; null
    ids and texts count as empty in the order; very long texts travel whole, once; repeated rows get places of their
    own; an empty table gives none. Input columns named like those added are replaced; others may have any name.
    """
    docs = docs.drop(*added)
    # Numbered columns cannot clash with those made here, and those that nobody reads are not shuffled.
    inner = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    d = docs.toDF(*inner.values()).withColumn("source", F.col(inner["source"]))
    counted = [(r["source"], r["count"]) for r in d.groupBy("source").count().orderBy("source").collect()]
    given = [(s, n, 0 if weights is None else weights.get(s, 0)) for s, n in counted]
    exact = whole_weights([w for *_, w in given]) if given else []
    first = [(s, n, w) for (s, n, _), w in zip(given, exact, strict=True) if w]
    rest = [(s, n) for (s, n, _), w in zip(given, exact, strict=True) if not w]
    if rest:
        usual = whole_weights(default_weights([n for _, n in rest], about))
        rest = [(s, n, w) for (s, n), w in zip(rest, usual, strict=True)]
    key = F.md5(F.concat_ws("|", F.col(inner["doc_id"]).cast("string"), F.col(inner["text"])))
    ranked = rank_within(d, ["source"], key, sum(n for _, n in counted), "_rank")
    out, slot, position = None, 0, 0
    for part in (first, rest):
        if part:
            placed, slot, position = _places(spark, ranked, part, block_rows, slot, position)
            made = dict(zip(added, ("_rank", "_block", "_slot", "_position"), strict=True))
            placed = placed.select(*[F.col(v).alias(k) for k, v in inner.items()], *[F.col(v).cast("long").alias(k) for k, v in made.items()])
            out = placed if out is None else out.unionAll(placed)
    return docs.withColumns({c: F.lit(None).cast("long") for c in added}) if out is None else out


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(spark, docs).select("doc_id", "source", "block", "slot", "position")


#: DuckDB SQL for op1_mixing: the schedule slot by slot, then positions by a plain running number.
OP1_SQL = """
with recursive c as (select source, count(*) as n from documents group by source),
q as (select source, n, greatest(1, floor(1000 * sqrt(n) / (select sum(sqrt(n)) from c) + 0.5)::bigint) as quota,
  row_number() over (order by source nulls first) - 1 as no from c),
a as (select list(quota order by no) as quota, sum(quota)::bigint as d from q),
s as (select 0::bigint as t, list_transform(quota, lambda x: 0::bigint) as done, -1::bigint as pick, -1::bigint as block from a
  union all
  select t + 1, list_transform(done, lambda x, i: case when i = p then x + 1 else x end), p - 1, done[p]
  from (select s.t, s.done, a.d, list_min(list_filter(list_transform(range(1, len(s.done) + 1), lambda i:
      case when s.done[i] < a.quota[i] and (s.done[i] * a.d) // a.quota[i] <= s.t
      then {'due': -((-(s.done[i] + 1) * a.d) // a.quota[i] - case when ((s.done[i] + 1) * a.d) % a.quota[i] = 0 then 0 else 1 end), 'i': i} end), lambda x: x is not null)).i as p
    from s, a where s.t < a.d)),
r as (select doc_id, source, row_number() over (partition by source order by md5(concat_ws('|', doc_id::varchar, text))) - 1 as k from documents),
b as (select r.doc_id, r.source, r.k // 16 as block, r.k % 16 as w, q.quota, q.no from r join q on r.source is not distinct from q.source),
p as (select b.doc_id, b.source, b.block, b.w, (b.block // b.quota) * (select d from a) + s.t - 1 as slot from b join s on s.pick = b.no and s.block = b.block % b.quota)
select doc_id, source, block::bigint as block, slot::bigint as slot, (row_number() over (order by slot, w) - 1)::bigint as position from p
"""
