"""Raw complaint rows shaped from the star-schema test tables.

The test tables are TPC-H-like (lineitem, orders, supplier, part). The adapter
maps one line item to one raw complaint and injects every dirty case the
conform step has to handle: thousands-dotted years, 'NA' markers, NULLs,
padding and legal-name suffixes.

    entity  <- supplier      (name, code = suppkey, type = nation); a third of
               the orders go to supplier 1, the others are spread so that the
               first suppliers have thousands of rows and the last a handful,
               with years, products and reasons missing
    product <- part brand    (size 1 -> ' na ', size 2 -> NULL)
    reason  <- return flag + order priority
    state   <- order status
    period  <- ship date; one order in 211 has an impossible year, every third
               line number a month written '3.0', every fourth such a type
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalla.schema import RAW_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table, its schema taken from the files as they are now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` on ``key`` when its scan has fewer partitions
    than the cluster has cores (a small file with few row groups), so the
    per-row work after it uses every core. A large table already has many
    more splits than cores and is returned untouched (no extra shuffle)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(cores, key) if splits < cores else df


def raw_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped complaint rows (all text columns) from the star tables.

    Join plan: supplier and part are dimension tables; Spark broadcasts them
    only while their size estimate is under ``autoBroadcastJoinThreshold``
    and otherwise shuffles, with AQE splitting a skewed supplier. orders is
    a fact-sized table joined on its unique key (at most seven line items per
    order), so its sort-merge join cannot skew; when lineitem needs
    spreading it is hash-partitioned on l_orderkey, the key that join
    shuffles on anyway.
    """
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"), "l_orderkey")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")

    li = li.withColumn("l_suppkey", F.expr(
        "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 1 + ((l_suppkey - 1) * (l_orderkey % 97)) DIV 97 END"))
    j = (li.join(su, li.l_suppkey == su.s_suppkey)
           .join(pa, li.l_partkey == pa.p_partkey)
           .join(od, li.l_orderkey == od.o_orderkey))

    year = F.year("l_shipdate").cast("string")
    out = j.select(
        F.when(F.col("s_nationkey") == 0, F.lit("NA"))
         .otherwise(F.concat(F.col("s_nationkey").cast("string"), F.when(F.col("l_linenumber") == 4, ".0").otherwise("")))
         .alias("TIPO_ENTIDAD"),
        F.when(F.col("l_suppkey") % 20 == 19, F.lit("NA"))
         .otherwise(F.col("l_suppkey").cast("string")).alias("CODIGO_ENTIDAD"),
        F.concat(F.col("s_name"),
                 F.when(F.col("l_suppkey") % 3 == 0, F.lit(" S.A."))
                  .when(F.col("l_suppkey") % 3 == 1, F.lit(" Ltda."))
                  .otherwise(F.lit(""))).alias("NOMBRE_ENTIDAD"),
        F.when(F.col("p_size") == 1, F.lit(" na "))
         .when(F.col("p_size") == 2, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), F.col("p_brand"), F.lit(" "))).alias("PRODUCTO"),
        F.when((F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "N"), F.lit("NA"))
         .otherwise(F.concat(F.col("l_returnflag"), F.lit("-"), F.col("o_orderpriority")))
         .alias("MOTIVO"),
        F.when(F.col("o_orderstatus") == "O", F.lit("Vigentes"))
         .when(F.col("o_orderstatus") == "F", F.lit(" Recibidos "))
         .otherwise(F.lit("Cerrados")).alias("ESTADO"),
        F.when(F.col("l_orderkey") % 211 == 0, F.lit("16"))
         .otherwise(F.concat(F.substring(year, 1, 1), F.lit("."), F.substr(year, F.lit(2)))).alias("ANIO"),
        F.concat(F.month("l_shipdate").cast("string"), F.when(F.col("l_linenumber") == 3, ".0").otherwise("")).alias("MES"),
    )
    return out.select(*RAW_COLUMNS)
