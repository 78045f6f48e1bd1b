"""History and changeset tables derived from the TPC-H-like test tables.

The reference ships no inputs, so tests and the benchmark derive them from
whole tables, every row kept: object = order, version = the n-th of its
lineitems by ship date, editor = supplier, changeset = the part shipped; the
changeset table is the whole ``part`` table. Objects get 1 to ~13 versions
from the data itself. The same rows come out of the SQL text in
``tools/oracle.py`` (DuckDB), the independent formulation the driver compares
against.

Scale: numbering versions is one window partitioned by order key, which the
lineitem table bounds (an order has a handful of lines), so no task holds a
hot group; the per-object count reuses the same partitioning and sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _tag_keys_expr(p: Column) -> Column:
    # The nine tag-key sets of the fixture (FIXTURES.md §2).
    return (F.when(p % 9 == 0, "name,amenity,source")
             .when(p % 9 == 1, "name:es,ref,source")
             .when(p % 9 == 2, "building,height,fixme")
             .when(p % 9 == 3, "highway,surface")
             .when(p % 9 == 4, "ref,source,layer")
             .when(p % 9 == 5, "historic:civilization,start_date,wikidata")
             .when(p % 9 == 6, "was:shop,addr:street,addr:city")
             .when(p % 9 == 7, "building,name,building:levels")
             .otherwise("name,shop,FIXME"))


# The comments of the changeset fixture (FIXTURES.md §2); None is a missing tag.
COMMENTS = [
    "building demolished", "reverted vandalism", "update", None, "edificio derribado", "mass import of shops",
    "", "torn down, was a test", "abgerissen", "fix import error", "снесли", "survey",
    "prédio derrubado", "bâtiment supprimé", "edificio abbattuto", "budynek zburzony", "gebouw gesloopt",
    "bygning fjernet", "budova zbourana", "bina yıkıldı", "κατεδαφίστηκε", "המבנה הוסר", "أزيل المبنى",
    "تخریب شد", "भवन ध्वस्त", "建筑拆除", "建物を撤去", "건물 철거",
    "duplicado por error", "duplicado por erro", "doublon annulé", "doppelt, aus versehen",
    "vandalismo, duplicato", "откат правок", "撤回", "edificio ya no existe",
]


def history_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Version history (schema ``strata.schema.HISTORY``) from ``lineitem``."""
    li = lineitem.select(
        F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"), F.col("l_linenumber").alias("ln"),
        F.col("l_shipdate").alias("ts"),
    )
    # ties left by this order are rows equal in every derived column
    by_object = Window.partitionBy("o").orderBy("ts", "ln", "p", "s")
    whole = by_object.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (   # one Window operator: same partitioning and order, two frames
        li.withColumn("v", F.row_number().over(by_object).cast("long"))
          .withColumn("n", F.count(F.lit(1)).over(whole))
    )
    o, p, v, n, s = F.col("o"), F.col("p"), F.col("v"), F.col("n"), F.col("s")
    typ = (F.when(o % 10 == 0, "relation")
            .when((o % 10).isin(1, 2, 3), "way")
            .otherwise("node"))
    visible = (F.when(o % 13 == 0, False)
                .when((v == n) & (o % 4 != 0), False)
                .when((v == 3) & (o % 5 == 0), False)
                .otherwise(True))
    uid = (F.when((o % 7 == 0) & ((v == 1) | (v == n)), F.lit(1).cast("long"))
            .when(o % 11 == 0, 1 + v % 2)
            .when(s % 23 == 0, F.lit(None).cast("long"))
            .otherwise(s))
    # every 50th object was edited in changesets absent from the changeset
    # table (a negative id never matches a part key): the missing-lookup case
    changeset = F.when(o % 50 == 0, -1 - p).otherwise(p)
    h = ranked.select(o, v, s, F.col("ln"), F.col("ts"), typ.alias("type"),
                      visible.alias("visible"), uid.alias("uid"), changeset.alias("cs"))
    node_vis = (F.col("type") == "node") & F.col("visible")
    keys = F.when(F.col("visible"), _tag_keys_expr(o + (v / 2).cast("long"))).otherwise(F.lit(""))
    key_arr = F.filter(F.split(keys, ","), lambda k: k != "")
    return h.select(
        F.col("type"),
        o.alias("id"),
        v.alias("version"),
        F.col("visible"),
        F.col("uid"),
        # a time of day that grows with the version, so versions of one day keep their order
        (F.col("ts") + F.make_dt_interval(secs=v * 600 + o % 600)).alias("timestamp"),
        F.col("cs").alias("changeset"),
        F.map_from_arrays(key_arr, F.transform(key_arr, lambda k: F.concat(k, F.lit("-"), v.cast("string")))).alias("tags"),
        # double arithmetic (DuckDB's reading of the SQL text), for identical bits
        F.when(node_vis, F.lit(-90.0) + ((o * 37 + v * 11) % 18000).cast("double") / F.lit(100.0)).alias("lat"),
        F.when(node_vis, F.lit(-180.0) + ((o * 61 + v * 17) % 36000).cast("double") / F.lit(100.0)).alias("lon"),
        # way node refs: ln of them, each a node-typed id of the same decade
        # (o - o%10 + 4 .. +9), so way geometry can be resolved against history
        F.when((F.col("type") == "way") & F.col("visible"),
               F.transform(F.sequence(F.lit(1), F.col("ln")),
                           lambda i: F.struct((o - o % 10 + 4 + (o + i + v) % 6).cast("long").alias("ref"))))
         .otherwise(F.array().cast("array<struct<ref:bigint>>")).alias("nds"),
    )


def changesets_from_part(part: DataFrame) -> DataFrame:
    """Changeset table (schema ``strata.schema.CHANGESETS``) from the whole ``part`` table."""
    k = F.col("p_partkey")
    comment = F.element_at(F.array(*map(F.lit, COMMENTS)), (k % len(COMMENTS) + 1).cast("int"))
    created_by = (F.when(k % 5 == 0, "iD 2.20").when(k % 5 == 1, "JOSM/1.5")
                   .when(k % 5 == 2, "Potlatch 2").when(k % 5 == 3, "Vespucci"))
    source = F.when(k % 3 == 0, "survey")
    entries = F.array(
        F.struct(F.lit("comment").alias("key"), comment.alias("value")),
        F.struct(F.lit("created_by").alias("key"), created_by.alias("value")),
        F.struct(F.lit("source").alias("key"), source.alias("value")),
    )
    # absent tag = absent key, as in the real changeset table
    tags = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    uid = F.col("p_size").cast("long")
    return part.select(k.alias("id"),
                       F.concat(F.lit("user_"), uid.cast("string")).alias("user"),
                       uid.alias("uid"),
                       tags.alias("tags"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_from_lineitem(read_table(spark, sf_dir, "lineitem"))


def fixture_changesets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changesets_from_part(read_table(spark, sf_dir, "part"))
