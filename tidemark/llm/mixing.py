"""Mixing sources to target weights (operator 1): Poisson replication.

A source's mean repetition rate is its target share of the output over its share of the input (sizes in code
points), times ``epochs``. Every document draws its count from the Poisson distribution of that rate, by inversion of a
number hashed from seed and id (above ``MOST``, as the sum of counts of equal parts of the rate, each from a number of its own); it is exploded by its count, and all copies are shuffled by a hash.

Without weights, a source's weight is the ``temperature`` power of its size. A null source is a source of its own;
null and empty texts have no size, and sources without size get the rate ``epochs``; sources without a weight get none.
Rows with equal ids draw alike; a row without id draws by its text. The shuffle spreads rows of equal ids by
their texts, so no id is a hot key. An empty table gives an empty table. All columns pass through; the
new ones are ``copy`` (from 1) and ``shuffle_key``, and input columns of these names are replaced. Epochs above 700 raise an error, rates of single sources don't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh

#: Sources whose table of rates is sent to every task, at most; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000
#: Rate up to which a count is drawn at once; exp(-rate) must not vanish.
MOST = 700
_BITS = 52


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of an MD5 digest."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << _BITS))


def identity(doc_id: Column, text: Column) -> Column:
    """What a row draws by: its id, or a digest of its text where it has none."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("null "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))


def poisson(u: Column, rate: Column) -> Column:
    """The count at ``u`` of the Poisson distribution function of ``rate``."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.lit(0).alias("k"), F.exp(-rate).alias("p"), F.exp(-rate).alias("cdf"))

    def step(s: Column, j: Column) -> Column:
        p = s["p"] * rate / j
        return F.struct(
            F.when(u >= s["cdf"], j).otherwise(s["k"]).cast("int").alias("k"), p.alias("p"), (s["cdf"] + p).alias("cdf")
        )

    count = F.aggregate(F.sequence(F.lit(1), top), start, step, lambda s: s["k"])
    return count


def repetitions(seed: int, doc_id: Column, rate: Column) -> Column:
    """A document's count. The sum of Poisson counts is Poisson of the sum of their rates."""
    parts = F.ceil(rate / MOST).cast("int")

    def add(total: Column, part: Column) -> Column:
        return total + poisson(uniform(seed, doc_id, part), rate / parts)

    several = F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), add)
    return F.when(rate > MOST, several).otherwise(poisson(uniform(seed, doc_id), rate))


def rates(docs: DataFrame, weights: DataFrame | None, epochs: float, temperature: float) -> DataFrame:
    """(source, rate) with sources as text, null written out."""
    size = F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("bigint"))
    sizes = docs.groupBy(F.coalesce("source", F.lit("\0null")).alias("source")).agg(size.alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        own = weights.select(F.coalesce("source", F.lit("\0null")).alias("source"), F.col("weight").cast("double").alias("weight"))
        sizes = sizes.join(own, "source", "left").fillna(0.0, ["weight"])
    all_ = sizes.agg(F.sum("size").alias("all_size"), F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("all_weight"))
    rate = F.lit(float(epochs)) * (F.col("weight") / F.col("all_weight")) / (F.col("size") / F.col("all_size"))
    return sizes.join(F.broadcast(all_)).select(  # all_ is one row
        "source", F.when(F.col("size") > 0, rate).otherwise(F.lit(float(epochs))).alias("rate")
    )


def mix(
    docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, temperature: float = 0.7, seed: int = 17
) -> DataFrame:
    """``docs`` repeated to the target weights (source, weight), in shuffled order."""
    if epochs > MOST:
        raise ValueError(f"epochs, the repetition rate of the whole, is above {MOST}")
    docs = docs.drop("copy", "shuffle_key")
    source, rate, times = (fresh(docs, c) for c in ("_source", "_rate", "_times"))
    found = rates(docs, weights, epochs, temperature).toDF(source, rate)
    if found.count() <= BROADCAST_SOURCES:
        found = F.broadcast(found)
    keyed = docs.withColumn(source, F.coalesce("source", F.lit("\0null"))).join(found, source)
    drawn = keyed.withColumn(times, repetitions(seed, identity(F.col("doc_id"), F.col("text")), F.col(rate))).filter(F.col(times) > 0)
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(times))))
    key = F.md5(F.concat_ws("|", F.lit(f"order {seed}"), identity(F.col("doc_id"), F.col("text")), F.col("copy").cast("string")))
    tie = F.xxhash64("text")
    return (
        copies.withColumn("shuffle_key", key).select(*docs.columns, "copy", "shuffle_key")
        .repartition("shuffle_key", tie).sortWithinPartitions("shuffle_key", tie)
    )


#: The rows of ``mix`` with its defaults, in DuckDB's SQL.
ORACLE = r"""
with s as (
  select coalesce(source, chr(1) || 'null') as source, sum(coalesce(length(text), 0))::bigint as size from documents group by 1
), t as (
  select *, pow(size::double, 0.7) as weight from s
), a as (
  select sum(size)::double as all_size, sum(case when size > 0 then weight end) as all_weight from t
), r as (
  select source, case when size > 0 then (weight / all_weight) / (size / all_size) else 1.0 end as rate from t, a
), c as (
  select source, rate, list_transform(range(0, cast(ceil(rate + 12 * sqrt(rate) + 20) as bigint)),
    lambda j: list_sum(list_transform(range(0, j + 1), lambda i: exp(-rate) * pow(rate, i) / gamma(i + 1)))) as cdf from r
), d as (
  select d.*, c.cdf, cast('0x' || substr(md5('17|' || coalesce(doc_id::varchar, 'null ' || md5(coalesce(text, '')))), 1, 13) as bigint) / 4503599627370496.0 as u
  from documents d join c on c.source = coalesce(d.source, chr(1) || 'null')
), n as (
  select *, len(list_filter(cdf, lambda x: x <= u)) as times from d
)
select doc_id, text, lang, source, n_chars, copy::int as copy,
  md5('order 17|' || coalesce(doc_id::varchar, 'null ' || md5(coalesce(text, ''))) || '|' || copy::varchar) as shuffle_key
from (select *, unnest(range(1, times + 1)) as copy from n where times > 0)
"""
