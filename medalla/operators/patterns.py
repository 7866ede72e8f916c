"""Patterns: attribute values that occur together, and rules between them.

Rows with the same values are one transaction with a count, so what is mined
grows with the combinations present, not with the rows, and no rows are
cached. Frequent sets grow by one value a level: the sets of a transaction
that were frequent are extended by its later values and counted in one
aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalla.session import materialize, release

ATTRIBUTES = ("tipo_entidad_desc", "producto", "motivo", "estado")


def transactions(df: DataFrame, columns: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """``(items, n)``: ``column=value`` of every column that is not null, and
    the number of rows of ``df`` with just these values."""
    rows = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    items = [F.when(F.col(f"c{i}").isNotNull(), F.concat(F.lit(f"{c}="), F.col(f"c{i}"))) for i, c in enumerate(columns)]
    return rows.select(F.array_compact(F.array(*items)).alias("items"), "n")


def _mine(df: DataFrame, columns: Sequence[str], support: float) -> tuple[DataFrame, int]:
    """``(items, freq)`` of the sets, sorted, that at least ``support`` of the
    rows hold, and the number of rows."""
    rows = materialize(transactions(df, columns).withColumn("id", F.monotonically_increasing_id()), "pattern-rows")
    total = rows.agg(F.sum("n")).first()[0] or 0
    least = math.ceil(support * total)
    one = rows.select("id", "n", F.explode("items").alias("item"))
    single = materialize(one.groupBy("item").agg(F.sum("n").alias("freq")).where(F.col("freq") >= least), "frequent-values")
    # without the rare values many transactions become equal
    bags = one.join(single, "item", "left_semi").groupBy("id").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("item")).alias("all"))
    live = materialize(bags.groupBy("all").agg(F.sum("n").alias("n")).select("all", "n", F.explode("all").alias("item"))
                       .select("all", "n", F.array("item").alias("items")), "pattern-sets")
    found = [single.select(F.array("item").alias("items"), "freq")]
    release(rows)
    for _ in columns[1:]:
        later = F.filter("all", lambda x: x > F.element_at("items", -1))
        grown = live.select("all", "n", F.explode(F.transform(later, lambda x: F.concat("items", F.array(x)))).alias("items"))
        grown = materialize(grown, "pattern-candidates")
        freq = materialize(grown.groupBy("items").agg(F.sum("n").alias("freq")).where(F.col("freq") >= least), "frequent-sets")
        found.append(freq)
        release(live)
        live = materialize(grown.join(freq, "items", "left_semi"), "pattern-sets")
        release(grown)
    release(live)
    return reduce(DataFrame.unionByName, found), total


def _set(c: str) -> Column:
    return F.array_join(c, " & ")


def frequent_sets(df: DataFrame, columns: Sequence[str] = ATTRIBUTES, support: float = 0.05) -> DataFrame:
    """``(conjunto, elementos, quejas)``: the sets of values that at least
    ``support`` of the rows hold. An empty table has none."""
    sets, _ = _mine(df, columns, support)
    return sets.select(_set("items").alias("conjunto"), F.size("items").alias("elementos"), F.col("freq").alias("quejas"))


def association_rules(df: DataFrame, columns: Sequence[str] = ATTRIBUTES, support: float = 0.05, confidence: float = 0.3,
                      scale: int = 6) -> DataFrame:
    """``(antecedente, consecuente, soporte, confianza, lift)``: rules from a
    frequent set to one more value, at least ``confidence`` of whose rows hold
    it. Support is that of both sides together."""
    sets, total = _mine(df, columns, support)
    total = F.lit(total).cast("double")
    both = sets.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("to"))
    both = both.select("to", F.col("freq").alias("both"), F.filter("items", lambda x: x != F.col("to")).alias("items"))
    rules = both.join(sets, "items").withColumn("confidence", F.col("both") / F.col("freq")).where(F.col("confidence") >= confidence)
    to = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("to"), (F.col("freq") / total).alias("_to"))
    rules = rules.join(to, "to").withColumns({"support": F.col("both") / total, "lift": F.col("confidence") / F.col("_to")})
    return rules.select(_set("items").alias("antecedente"), F.col("to").alias("consecuente"), *[
        F.round(a, scale).alias(b) for a, b in (("support", "soporte"), ("confidence", "confianza"), ("lift", "lift"))])
