"""Image geometry over the order tables (as sizes) and box suppression over embeddings (as boxes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import geometry as G
from taxaloom.session import table


def _sizes(spark, sf):
    d = table(spark, sf, "lineitem")
    w, h = (F.col("l_partkey") % 900 + 100), (F.col("l_suppkey") * 7 % 700 + 100)
    return d.select("l_orderkey", "l_linenumber", w.cast("bigint").alias("w"), h.cast("bigint").alias("h"), (F.col("l_linenumber") % 9 + 1).alias("a"))


def crop_center(spark, sf):
    c = G.center_crop(F.col("w"), F.col("h"), 1.5)
    return _sizes(spark, sf).select("l_orderkey", "l_linenumber", c.alias("c")).select("l_orderkey", "l_linenumber", "c.*")


def crop_anchor(spark, sf):
    c = G.anchor_crop(F.col("w"), F.col("h"), 1.5, F.col("a"))
    return _sizes(spark, sf).select("l_orderkey", "l_linenumber", c.alias("c")).select("l_orderkey", "l_linenumber", "c.*")


def crop_subject(spark, sf):
    w, h = F.col("w"), F.col("h")
    c = G.subject_crop(w, h, 1.5, w / 4, h / 8, w / 2, h * 7 / 8)
    return _sizes(spark, sf).select("l_orderkey", "l_linenumber", c.alias("c")).select("l_orderkey", "l_linenumber", "c.*")


def letterbox(spark, sf):
    c = G.letterbox(F.col("w"), F.col("h"))
    return _sizes(spark, sf).select("l_orderkey", "l_linenumber", c.alias("c")).select("l_orderkey", "l_linenumber", "c.width", "c.height", "c.pad_x", "c.pad_y")


def boxes_kept(spark, sf):
    """Boxes made of embeddings, suppressed within each label's image."""
    e = lambda i: F.get("embedding", F.lit(i)).cast("double")
    d = table(spark, sf, "embeddings").select(F.col("label").alias("image"), "vec_id", (100 * F.abs(e(0))).alias("x1"), (100 * F.abs(e(1))).alias("y1"), (100 * F.abs(e(0)) + 40).alias("x2"), (100 * F.abs(e(1)) + 40).alias("y2"), (0.3 + F.abs(e(2)) / 10).alias("score"))
    return G.suppress(d, "image", "vec_id")


QUERIES = {f.__name__: f for f in (crop_center, crop_anchor, crop_subject, letterbox, boxes_kept)}

_S = "(select l_orderkey, l_linenumber, l_partkey % 900 + 100 as w, l_suppkey * 7 % 700 + 100 as h, l_linenumber % 9 + 1 as a, floor((l_suppkey * 7 % 700 + 100) * 1.5)::bigint as cw, floor((l_partkey % 900 + 100) / 1.5)::bigint as ch from lineitem)"
ORACLE = {
    "crop_center": f'select l_orderkey, l_linenumber, case when w / h > 1.5 then (w - cw) // 2 else 0 end as "left", case when w / h > 1.5 then 0 else (h - ch) // 2 end as top, case when w / h > 1.5 then (w - cw) // 2 + cw else w end as "right", case when w / h > 1.5 then h else (h - ch) // 2 + ch end as bottom from {_S}',
    "crop_anchor": f"""with p as (select *, greatest(0, case (a - 1) % 3 when 0 then 0 when 1 then (w - cw) // 2 else w - cw end) as l, greatest(0, case (a - 1) // 3 when 0 then 0 when 1 then (h - ch) // 2 else h - ch end) as t, abs(w / h - 1.5) < 0.01 as same, w / h > 1.5 as wide from {_S})
        select l_orderkey, l_linenumber, case when same or not wide then 0 else l end as "left", case when same or wide then 0 else t end as top, case when same or not wide then w else l + cw end as "right", case when same or wide then h else t + ch end as bottom from p""",
    "crop_subject": f"""with p as (select *, greatest(0, least(trunc((w / 4 + w / 2) / 2 - cw / 2)::bigint, w - cw)) as l, greatest(0, least(case when h * 7 / 8 - h / 8 > ch then trunc(h / 8)::bigint else trunc((h / 8 + h * 7 / 8) / 2 - ch / 2)::bigint end, h - ch)) as t, abs(w / h - 1.5) < 0.01 as same, w / h > 1.5 as wide from {_S})
        select l_orderkey, l_linenumber, case when same or not wide then 0 else l end as "left", case when same or wide then 0 else t end as top, case when same or not wide then w else l + cw end as "right", case when same or wide then h else t + ch end as bottom from p""",
    "letterbox": f"""with p as (select *, least(640.0::double / w, 640.0::double / h) as s from {_S}), q as (select *, floor(w * s)::bigint as width, floor(h * s)::bigint as height from p)
        select l_orderkey, l_linenumber, width, height, (640 - width) // 2 as pad_x, (640 - height) // 2 as pad_y from q""",
    # Box by box, best first, with the list of those kept so far.
    "boxes_kept": """with recursive b as (select label as image, vec_id, 100 * abs(embedding[1]::double) as x1, 100 * abs(embedding[2]::double) as y1, 100 * abs(embedding[1]::double) + 40 as x2, 100 * abs(embedding[2]::double) + 40 as y2, 0.3::double + abs(embedding[3]::double) / 10 as score from embeddings),
        o as (select *, row_number() over (partition by image order by score desc, vec_id) as i from b where score > 0.25::double),
        s as (select image, i, vec_id, true as kept, 1 as rank, [struct_pack(x1 := x1, y1 := y1, x2 := x2, y2 := y2)] as boxes from o where i = 1
          union all select o.image, o.i, o.vec_id, t.good, s.rank + case when t.good then 1 else 0 end, case when t.good then list_append(s.boxes, struct_pack(x1 := o.x1, y1 := o.y1, x2 := o.x2, y2 := o.y2)) else s.boxes end
          from s join o on o.image = s.image and o.i = s.i + 1, lateral (select len([k for k in s.boxes if greatest(0, least(o.x2, k.x2) - greatest(o.x1, k.x1)) * greatest(0, least(o.y2, k.y2) - greatest(o.y1, k.y1))
            / ((o.x2 - o.x1) * (o.y2 - o.y1) + (k.x2 - k.x1) * (k.y2 - k.y1) - greatest(0, least(o.x2, k.x2) - greatest(o.x1, k.x1)) * greatest(0, least(o.y2, k.y2) - greatest(o.y1, k.y1)) + 1e-6) > 0.45]) = 0 as good) t)
        select image, vec_id, rank from s where kept""",
}
