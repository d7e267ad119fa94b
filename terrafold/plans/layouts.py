"""Layout, its proof, and what it saves."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrafold.functions.hilbert import with_hilbert_key
from terrafold.operators import digest, layout, spatial
from terrafold.plans import inputs as I
from terrafold.plans.aggregates import laid_groups_twin
from terrafold.plans.oracle import hilbert
from terrafold.plans.registry import query
from terrafold.sources import footer
from terrafold.workspace import new_path

X1, Y1, X2, Y2 = I.BOX


def _position(df, spark, path):
    """Rows in table order: files by name, rows by index; one offset per file."""
    files = footer.files(footer.chunks(spark, path)).orderBy("path").collect()  # one entry a file
    start, offsets = 0, []
    for f in files:
        offsets.append((f["path"].rsplit("/", 1)[-1], start))
        start += f["num_rows"]
    starts = spark.createDataFrame(offsets, "file string, start bigint")
    return df.join(F.broadcast(starts), "file").withColumn("pos", F.col("start") + F.col("row")).drop(
        "file", "row", "start")


def _physical(spark, path, *columns):
    return spark.read.parquet(path).select(
        *columns, F.substring_index("_metadata.file_path", "/", -1).alias("file"),
        F.col("_metadata.row_index").alias("row"))


@query("hilbert_sort", I.with_inputs("points") + ", " + hilbert("points", "xi", "yi", "osm_id")
       + " SELECT osm_id, hkey, row_number() OVER (ORDER BY hkey, osm_id) - 1 AS pos FROM curve")
def hilbert_sort(spark, sf):
    """Where each row of the laid-out table really is."""
    path = I.staged(spark, sf, "points")[1]
    rows = with_hilbert_key(_physical(spark, path, "osm_id", "bbox"), "hkey").drop("bbox")
    return _position(rows, spark, path)


@query("ordered_limit", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS pos
FROM orders QUALIFY pos <= 20""")
def ordered_limit(spark, sf):
    """The twenty dearest orders with their place; a bounded top-k, so one task numbers it."""
    from pyspark.sql import Window

    top = I.table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
    w = Window.orderBy(F.desc("o_totalprice"), "o_orderkey")
    return top.select("o_orderkey", "o_totalprice", F.row_number().over(w).cast("bigint").alias("pos"))


@query("order_violations", I.with_inputs("points") + """
SELECT 'laid out' AS layout, 0 AS violations UNION ALL SELECT 'backwards', count(*) - 1 FROM points""")
def order_violations(spark, sf):
    """Order breaks in the laid-out points: none; written backwards: at every row but the first."""
    _, laid = I.staged(spark, sf, "points")
    back = new_path(spark, "backwards")
    partitions = max(3, layout.partitions_for(footer.chunks(spark, laid)))
    layout.write_ordered(spark.read.parquet(laid), back, "{}", I.ROWS_PER_GROUP, partitions,
                         reverse=True)

    def of(path, name):
        return layout.order_violations(spark, path).select(F.lit(name).alias("layout"), "violations")
    return of(laid, "laid out").union(of(back, "backwards"))


@query("except_all_both", I.with_inputs("parts") + """
SELECT CASE WHEN side = 1 THEN 'left' ELSE 'right' END AS only_in, 1 AS copies, part_no,
  CASE WHEN side = 1 THEN 'minus' ELSE 'plain' END AS zero
FROM parts, (VALUES (1), (2)) v(side) WHERE cast(way_area AS varchar) = '-0.0'""")
def except_all_both(spark, sf):
    """A relayout that lost the sign of zero differs in just those rows, both ways."""
    plain, laid = I.staged(spark, sf, "parts")
    old = spark.read.parquet(plain)
    new = spark.read.parquet(laid).select(*old.columns).withColumn("way_area", F.abs("way_area"))
    return digest.except_both(old, new).select(
        "only_in", F.col("copies").cast("int").alias("copies"), "part_no",
        F.when(F.col("way_area") == "-0.0", "minus").otherwise("plain").alias("zero"))


@query("relayout_roundtrip", I.with_inputs("points") + """
SELECT osm_id, name, amenity, tags, xi::double AS xmin, yi::double AS ymin, xi::double AS xmax,
       yi::double AS ymax FROM points""")
def relayout_roundtrip(spark, sf):
    """A table laid out with row groups sized from its own bytes, read back whole."""
    plain, _ = I.staged(spark, sf, "points")
    dst = new_path(spark, "roundtrip")
    layout.relayout(spark, plain, dst)
    return spark.read.parquet(dst).select("osm_id", "name", "amenity", "tags", "bbox.*")


@query("verify_clean", I.with_inputs("points", "parts") + """
SELECT 'points' AS "table", count(*) AS n_rows, 0 AS findings FROM points
UNION ALL SELECT 'parts', count(*), 0 FROM parts""")
def verify_clean(spark, sf):
    """Rows of each laid-out table, and what the proof found wrong with them: nothing."""
    out = None
    for name in ("points", "parts"):
        plain, laid = I.staged(spark, sf, name)
        found = layout.verify(spark, plain, laid, rows_per_group=I.ROWS_PER_GROUP)
        rows = spark.read.parquet(laid).agg(F.count("*").alias("n_rows"))
        row = rows.crossJoin(found.agg(F.count("*").alias("findings"))).select(
            F.lit(name).alias("table"), "n_rows", "findings")
        out = row if out is None else out.union(row)
    return out


@query("relayout_twice", I.with_inputs("points") + "SELECT osm_id, name, amenity FROM points")
def relayout_twice(spark, sf):
    """A table laid out again over itself: the same rows, once."""
    plain, _ = I.staged(spark, sf, "points")
    dst = new_path(spark, "twice")
    for _ in range(2):
        layout.relayout(spark, plain, dst, replace=True)
    return spark.read.parquet(dst).select("osm_id", "name", "amenity")


@query("verify_tampered", I.with_inputs("parts") + """,
n AS (SELECT count(*) AS n, count(*) FILTER (WHERE cast(way_area AS varchar) = '-0.0') AS zeros FROM parts)
SELECT 'area sign lost' AS change, 'floats' AS "check", zeros AS n FROM n
UNION ALL SELECT 'area sign lost', 'multiset', 1 FROM n WHERE zeros > 0
UNION ALL SELECT 'box shifted', 'covering', n FROM n
UNION ALL SELECT 'rows reversed', 'order', n - 1 FROM n""")
def verify_tampered(spark, sf):
    """Which checks notice which change to the laid-out parts, and in how many rows."""
    plain, laid = I.staged(spark, sf, "parts")
    geo = layout.read_geo(spark, laid).agg(F.max("geo")).first()[0]
    partitions = layout.partitions_for(footer.chunks(spark, laid))
    base = spark.read.parquet(laid)
    box = F.col("bbox")
    shifted = F.struct((box["xmin"] + 1).alias("xmin"), box["ymin"].alias("ymin"),
                       box["xmax"].alias("xmax"), box["ymax"].alias("ymax"))
    changes = {
        "as laid out": base,
        "area sign lost": base.withColumn("way_area", F.abs("way_area")),
        "box shifted": base.withColumn("bbox", shifted),
        "rows reversed": base,
    }
    out = None
    for name, df in changes.items():
        path = new_path(spark, "tampered")
        layout.write_ordered(df, path, geo, I.ROWS_PER_GROUP, partitions,
                             reverse=name == "rows reversed")
        found = layout.verify(spark, plain, path, rows_per_group=I.ROWS_PER_GROUP)
        row = found.groupBy("check").agg(F.sum("n").alias("n")).select(
            F.lit(name).alias("change"), "check", "n")
        out = row if out is None else out.union(row)
    return out


@query("covering_mismatch", I.with_inputs("parts") + """
SELECT part_no FROM parts WHERE part_no % 11 = 4""")
def covering_mismatch(spark, sf):
    """Boxes made wrong in every eleventh row, by value or by NULL, are all found."""
    df = I.laid_out(spark, sf, "parts")
    b = F.col("bbox")
    wrong = F.when(F.col("part_no") % 2 == 0, F.struct(
        (b["xmin"] + 1).alias("xmin"), b["ymin"].alias("ymin"), b["xmax"].alias("xmax"),
        b["ymax"].alias("ymax")))
    df = df.withColumn("bbox", F.when(F.col("part_no") % 11 == 4, wrong).otherwise(b))
    return layout.covering_mismatch(df).select("part_no")


@query("row_groups_hit", laid_groups_twin() + f"""
SELECT count(*) FILTER (WHERE xmin <= {X2} AND xmax >= {X1} AND ymin <= {Y2} AND ymax >= {Y1}) AS row_groups,
       count(*) AS total_row_groups, true AS less FROM grp""")
def row_groups_hit(spark, sf):
    hit = footer.row_groups_hit(footer.chunks(spark, I.staged(spark, sf, "points")[1]), box=I.BOX)
    return hit.select("row_groups", "total_row_groups",
                      (F.col("bytes") <= F.col("total_bytes")).alias("less"))


@query("equals_prune", laid_groups_twin() + """
SELECT v AS amenity, count(*) FILTER (WHERE NOT (v < lo OR v > hi)) AS row_groups, count(*) AS total_row_groups
FROM grp, (VALUES ('airport'), ('cafe'), ('zoo')) t(v) GROUP BY v""")
def equals_prune(spark, sf):
    """Groups left for a value by its column's minimum and maximum."""
    chunks = footer.chunks(spark, I.staged(spark, sf, "points")[1])
    out = None
    for v in ("airport", "cafe", "zoo"):
        hit = footer.row_groups_hit(chunks, equals=("amenity", v)).select(
            F.lit(v).alias("amenity"), "row_groups", "total_row_groups")
        out = hit if out is None else out.union(hit)
    return out


@query("layout_sweep")
def layout_sweep(spark, sf):
    """Target group size against groups and bytes read for one box."""
    plain, _ = I.staged(spark, sf, "points")
    return layout.sweep(spark, plain, lambda n: new_path(spark, n),
                        [64 * 1024, 256 * 1024, 1024 * 1024], I.BOX)


@query("prune_before_after")
def prune_before_after(spark, sf):
    """Groups and bytes per query in plain order with boxes, and laid out: points, lines, areas."""
    x, y, _, _ = I.BOX5
    small = (15545000, 4230000, 15546000, 4231000)
    asked = {"points": ({"box": I.BOX, "small box": small}, {"cafe": ("amenity", "cafe")}),
             "lines": ({"box": I.BOX5, "small box": (x, y, x + 1000, y + 1000)}, None),
             "areas": ({"box": I.BOX, "small box": small}, {"cafe": ("amenity", "cafe")})}
    out = None
    for name, (boxes, equals) in asked.items():
        plain, laid = I.staged(spark, sf, name)
        before = new_path(spark, "before")
        boxed = spatial.append_bbox(spark.read.parquet(plain))
        (boxed.write.option("parquet.block.row.count.limit", str(I.ROWS_PER_GROUP))
         .option("compression", "zstd").parquet(before))
        table = layout.prune_table(spark, {"before": before, "after": laid}, boxes, equals)
        table = table.select(F.lit(name).alias("table"), "*")
        out = table if out is None else out.union(table)
    return out
