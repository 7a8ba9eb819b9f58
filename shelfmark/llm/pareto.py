"""Mixing sources to target weights by Pareto order sampling.

A source's target divided by its size is the expected number of copies of each of its documents.
The whole part is allocated to every document; the fraction is an inclusion probability.  For it,
documents are ranked by random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)), and the
lowest are taken until the words taken come nearest to what the target still lacks: a sample whose
size is fixed in words.  ``u`` is a digest of the document's key, so reruns agree.

No sort or window spans a source.  Ranks are first summed in 65,536 cells per source; only the one
cell in which the target falls is ranked row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, id_text, number_repeated, position52, small, word_count

CELLS = 65536
SEED = "mix"
MAX_SOURCES = 100_000  # rules of so many sources (counted) are broadcast; more are joined by shuffling


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Target per source from (source, source_size).

    ``weights`` repeat over the sources in code point order, null last.  Targets are proportional
    to the weights and sum to ``share`` of all sizes; none exceeds ``cap`` times its source, what
    is over going to the others by weight until none is above.  With c = cap * size and sources
    ordered by c / weight, the capped ones are a prefix, so one running sum gives the level.
    One row per source goes through one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    weighed = sizes.withColumn("w", weight).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    level = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    rest = total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weight_left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    levels = weighed.withColumn("lambda", rest / weight_left)
    # Of the sources that are not capped, the first gives the level of all.
    free = F.when(F.col("lambda") * F.col("w") < F.col("limit"), F.struct("limit_rank", "lambda"))
    ranked = levels.withColumn("limit_rank", F.row_number().over(level))
    chosen = ranked.withColumn("level", F.min(free).over(everything)["lambda"])
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("w"), F.col("limit")))
    return chosen.select("source", "source_size", target.alias("target"))


def _rank(seed: str) -> Column:
    u = (position52(F.lit(seed), F.col("key")) + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.when(F.col("chance") > 0, (u / (1 - u)) / (F.col("chance") / (1 - F.col("chance"))))


def _cell() -> Column:
    return F.floor(F.col("rank") / (1 + F.col("rank")) * CELLS)


def mixing_rules(
    sized: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = SEED,
) -> DataFrame:
    """One row per source that says which documents get how many copies.

    ``sized`` has (source, key, size); it is read three times and should be materialised.  Returns
    source, source_size, target, whole (copies all get), chance, and the cut: documents in a cell
    below ``cut_cell``, or in it with (rank, key) up to (``cut_rank``, ``cut_key``), get one more.
    """
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = cut(
        targets.withColumn("whole", F.floor(ratio))
        .withColumn("chance", ratio - F.col("whole"))
        .withColumn("lacking", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    drawn = small(plan.where("chance > 0").select(F.col("source").alias("s"), "chance", "lacking"), MAX_SOURCES)
    ranked = (
        sized.where("size > 0")
        .join(drawn, F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("rank", _rank(seed))
        .withColumn("cell", _cell())
    )
    per_source = Window.partitionBy("source")
    cells = ranked.groupBy("source", "lacking", "cell").agg(F.sum("size").alias("words"))
    until = F.sum("words").over(per_source.orderBy("cell"))
    edge = (
        cells.withColumn("before", until - F.col("words"))
        .where((F.col("before") <= F.col("lacking")) & (F.col("lacking") < F.col("before") + F.col("words")))
        .select(F.col("source").alias("s"), F.col("cell").alias("cut_cell"), "before")
    )
    inside = ranked.join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("cut_cell")))
    units = inside.groupBy("source", "lacking", "cut_cell", "before", "rank", "key").agg(F.sum("size").alias("words"))
    reached = F.col("before") + F.sum("words").over(per_source.orderBy("rank", "key"))
    cuts = (
        units.withColumn("reached", reached)
        .withColumn("nearer", F.col("reached") + F.col("reached") - F.col("words") <= 2 * F.col("lacking"))
        .groupBy("source", "cut_cell")
        .agg(F.max(F.when(F.col("nearer"), F.struct("rank", "key"))).alias("last"))
        .select(F.col("source").alias("s"), "cut_cell", F.col("last.rank").alias("cut_rank"), F.col("last.key").alias("cut_key"))
    )
    return plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "lacking")


def _copies(seed: str) -> Column:
    """Copies of a document, from its key and the rule of its source."""
    rank, cell = _rank(seed), F.floor(_rank(seed) / (1 + _rank(seed)) * CELLS)
    at_edge = (cell == F.col("cut_cell")) & (
        (rank < F.col("cut_rank")) | ((rank == F.col("cut_rank")) & (F.col("key") <= F.col("cut_key")))
    )
    one_more = (F.col("chance") > 0) & ((cell < F.col("cut_cell")) | F.coalesce(at_edge, F.lit(False)))
    return (F.col("whole") + F.when(one_more, 1).otherwise(0)).cast("long")


def _own_keys(sized: DataFrame) -> DataFrame:
    """Rows of a source that share a doc_id, or have none, with a key of their own each."""
    own = F.concat_ws("|", "key", "size", "number")
    numbered = number_repeated(sized, ["source", "key"], ["size"])
    return numbered.withColumn("key", F.when(F.col("number").isNull(), F.col("key")).otherwise(own)).drop("number")


def pareto_mix(docs: DataFrame, *, seed: str = SEED, **options) -> DataFrame:
    """The mix of (doc_id, text, source): doc_id, source, size, source_size, target, copies, taken.

    Size is the number of words; a null text has none, and a null source is a source of its own,
    last in order.  Rows of a source that share a doc_id, or have none, are drawn one by one; which
    of equal rows is taken is open, how many are is not.  Without words there are no targets
    to reach: whole copies are 0 then.  An empty table gives an empty result.
    """
    sized = cut(docs.select("doc_id", F.col("source").cast("string").alias("source"), id_text().alias("key"), word_count().alias("size")))
    sized = cut(_own_keys(sized))
    rules = small(cut(mixing_rules(sized, seed=seed, **options)).withColumnRenamed("source", "s"), MAX_SOURCES)
    mixed = sized.join(rules, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", _copies(seed))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", taken)


def mixed_documents(docs: DataFrame, *, seed: str = SEED, **options) -> DataFrame:
    """The documents of the mix themselves, whole rows, each as often as the mix takes it.

    Documents without words are kept once, as they cost the mix nothing.  Texts are not shuffled
    unless there are more than ``MAX_SOURCES`` sources, but for rows that share a doc_id.
    """
    columns = docs.columns
    source = F.col("source").cast("string")
    row = F.struct(*[docs[c] for c in columns]).alias("row")
    whole = docs.select(row, source.alias("source"), id_text().alias("key"), word_count().alias("size"))
    whole = _own_keys(whole)
    sized = cut(whole.select("source", "key", "size"))
    rules = cut(mixing_rules(sized, seed=seed, **options))
    rule = rules.select(F.col("source").alias("s"), "whole", "chance", "cut_cell", "cut_rank", "cut_key")
    joined = whole.join(small(rule, MAX_SOURCES), F.col("source").eqNullSafe(F.col("s")), "left")
    copies = F.when(F.col("size") == 0, 1).otherwise(_copies(seed))
    repeated = joined.select(F.explode(F.array_repeat("row", copies.cast("int"))).alias("row"))
    return repeated.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


SQL = f"""
WITH counted AS (
  SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size
  FROM documents),
sized AS (
  SELECT *, CASE WHEN count(*) OVER (PARTITION BY source, id) = 1 THEN id
            ELSE id || '|' || size || '|' || (row_number() OVER (PARTITION BY source, id, size) - 1) END AS key
  FROM counted),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST(source_size AS DOUBLE) * 2.0 AS lim,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sizes),
levels AS (
  SELECT *, row_number() OVER o AS k,
         ((SELECT sum(source_size) FROM sizes) * 1.5::DOUBLE
           - coalesce(sum(lim) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / ((SELECT sum(w) FROM weighed)
           - coalesce(sum(w) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lam
  FROM weighed WINDOW o AS (ORDER BY lim / w, source NULLS LAST)),
level AS (SELECT arg_min(lam, k) AS lam FROM levels WHERE lam * w < lim),
targets AS (
  SELECT source, source_size, least(lim, coalesce((SELECT lam FROM level) * w, lim)) AS target FROM weighed),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio FROM targets),
ranked AS (
  SELECT d.*, p.source_size, p.target, floor(ratio) AS whole, ratio - floor(ratio) AS chance,
         target - floor(ratio) * source_size AS lacking,
         (CAST('0x' || substr(md5('{SEED}|' || key), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {float(1 << 52)!r}::DOUBLE AS u
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
odds AS (
  SELECT *, CASE WHEN chance > 0 THEN (u / (1 - u)) / (chance / (1 - chance)) END AS q FROM ranked),
reached AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, key) AS until,
         sum(size) OVER (PARTITION BY source, q, key) AS unit
  FROM odds)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN chance > 0 AND until + until - unit <= 2 * lacking THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM reached
"""
