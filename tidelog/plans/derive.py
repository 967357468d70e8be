"""Operator inputs derived from the driver's tables.

The tables hold no access logs, SQL dumps, coordinates or geocoder replies.
These functions build them from whole tables with column arithmetic only, so
their size follows the data; ``tidelog.plans.oracles`` repeats each formula in
SQL. Coordinates are dyadic fractions, exact in binary floating point, so the
same point (and geohash) comes out of both engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.dates import ntz_to_millis
from tidelog.plans.tables import table
from tidelog.session import scratch_path
from tidelog.sources.readers import read_lines


def _as_file(lines: DataFrame, name: str) -> DataFrame:
    """Write derived text lines to the shared folder, as the dump file that they
    stand for, and read them from there: parsing starts from stored lines, whose
    size the planner knows."""
    spark = lines.sparkSession
    path = scratch_path(spark, name)
    lines.write.text(path)
    return read_lines(spark, path)


def point(u: Column, e: Column) -> tuple[Column, Column]:
    """(lng, lat) on a quarter-degree grid with a dyadic offset."""
    lng = F.lit(100.0) + (u % 40).cast("double") * F.lit(0.25) + (e % 16).cast("double") / F.lit(64.0)
    lat = F.lit(20.0) + (u % 20).cast("double") * F.lit(0.25) + (e % 8).cast("double") / F.lit(32.0)
    return lng, lat


def pages_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title")
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events (+ page url/title by ``props.k``) -> ``<ts> --> <json>`` lines.

    Error events with value < 10 carry no usable identifier, in each blank form;
    error and signup events with value >= 150 are damaged (cut off / no
    separator). The longitude is written as a quoted number, the latitude as a
    bare one. Every eleventh line repeats an event key; the last one counts.
    """
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    ev = ev.withColumn("_k", k).withColumn("_kid", k.try_cast("long"))
    pg = pages_lookup(spark, sf_dir)
    ev = ev.join(pg, ev["_kid"] == pg["page_id"], "left")
    uid, eid = F.col("user_id"), F.col("event_id")
    anon = (F.col("event_type") == "error") & (F.col("value") < 10)
    lng, lat = point(uid, eid)
    uid_s = uid.cast("string")
    url = F.when(F.col("value") >= 100, F.concat(F.lit("https://cdn.example.org/"), F.col("_k"))).otherwise(F.col("url"))
    doc = F.struct(
        F.struct(
            F.when(~F.coalesce(anon, F.lit(False)), F.concat(F.lit("ck"), uid_s))
            .when(eid % 4 == 1, F.lit(""))
            .when(eid % 4 == 2, F.lit(" "))
            .when(eid % 4 == 3, F.lit("null"))
            .alias("cookieid"),
            F.when(anon, F.lit("null")).otherwise(F.concat(F.lit("acct"), uid_s)).alias("account"),
            F.when(anon, F.lit(" ")).otherwise(F.concat(uid_s, F.lit("-"), F.to_date("ts").cast("string"))).alias("sessionId"),
            F.struct(
                F.when(anon, F.lit(None).cast("string")).otherwise(F.concat(F.lit("im"), uid_s)).alias("imei"),
                F.when(uid % 2 == 0, F.lit("android")).otherwise(F.lit("ios")).alias("osName"),
                F.concat((uid % 5 + 8).cast("string"), F.lit(".0")).alias("osVer"),
                F.lit("1080*1920").alias("resolution"),
                F.when(anon, F.lit("null")).otherwise(F.concat(F.lit("ad"), uid_s)).alias("androidId"),
                F.concat(F.lit("mf"), (uid % 7).cast("string")).alias("manufacture"),
                F.when(anon, F.lit("")).otherwise(F.concat(F.lit("dv"), uid_s)).alias("deviceId"),
            ).alias("phone"),
            F.struct(
                F.lit("app.shop").alias("appid"),
                F.concat(F.lit("2."), (uid % 4).cast("string")).alias("appVer"),
                F.concat(F.lit("ch"), (uid % 3).cast("string")).alias("release_ch"),
                F.concat(F.lit("pr"), (eid % 5).cast("string")).alias("promotion_ch"),
            ).alias("app"),
            F.struct(
                (uid % 100 + 110000).cast("string").alias("areacode"),
                lng.cast("string").alias("longtitude"),
                lat.alias("latitude"),
                F.when(eid % 2 == 0, F.lit("cm")).otherwise(F.lit("cu")).alias("carrier"),
                F.when(uid % 3 == 0, F.lit("wifi")).otherwise(F.lit("4g")).alias("netType"),
            ).alias("loc"),
        ).alias("u"),
        F.when(F.col("event_type") == "view", F.lit("pg_view")).otherwise(F.col("event_type")).alias("logType"),
        ntz_to_millis("ts").alias("commit_time"),
        F.create_map(
            F.lit("k"), F.col("_k"), F.lit("url"), url, F.lit("title"), F.col("title"),
            F.lit("value"), F.when(eid % 3 == 0, (eid * 7).cast("string")), F.concat(F.lit("x"), (eid % 13).cast("string")), F.col("event_type"),
        ).alias("event"),
    )
    js = F.to_json(doc)
    repeated = (eid % 11 == 0) & F.col("_k").isNotNull()
    js = F.when(repeated, F.replace(js, F.lit('"event":{'), F.lit('"event":{"k":"first",'))).otherwise(js)
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    broken = (F.col("event_type") == "error") & (F.col("value") >= 150)
    nosep = (F.col("event_type") == "signup") & (F.col("value") >= 150)
    line = (
        F.when(broken, F.concat(stamp, F.lit(' --> {"u":{"cookieid":"ck'), uid_s))
        .when(nosep, F.concat(stamp, F.lit(' {"u":{"cookieid":"ck'), uid_s, F.lit('"}}')))
        .otherwise(F.concat(stamp, F.lit(" --> "), js))
    )
    return ev.select(line.alias("value"))


def _supplier_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])


def area_name(name: Column, key: Column) -> Column:
    """Names that a dump line must quote: separators, brackets, quotes, backslashes."""
    return F.when(key % 6 == 1, F.concat(name, F.lit(", Nord (old)"))).when(key % 6 == 2, F.concat(name, F.lit(", 'O\\Quay'"))).otherwise(name)


def quoted(name: Column, key: Column) -> Column:
    """As an SQL literal; quotes are doubled or escaped by turns."""
    escaped = F.replace(name, F.lit("\\"), F.lit("\\\\"))
    return F.concat(F.lit("'"), F.when(key % 12 < 6, F.replace(escaped, F.lit("'"), F.lit("''"))).otherwise(F.replace(escaped, F.lit("'"), F.lit("\\'"))), F.lit("'"))


def biz_dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quoted 7-tuple per supplier: district = its nation, business area =
    its name; suppliers with a negative balance have no province, and the
    longitude of every fifth is no number."""
    g = _supplier_geo(spark, sf_dir)
    lng, lat = point(F.col("s_suppkey"), F.col("s_suppkey"))
    province = F.when(F.col("s_acctbal") < 0, F.lit("")).otherwise(F.col("r_name"))
    q = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    line = F.concat(
        F.lit("("),
        F.concat_ws(
            ", ",
            q(F.col("s_suppkey").cast("string")),
            q(province),
            q(F.col("n_name")),
            q(F.concat(F.col("n_name"), F.lit("-d"), (F.col("s_suppkey") % 3).cast("string"))),
            quoted(area_name(F.col("s_name"), F.col("s_suppkey")), F.col("s_suppkey")),
            q(F.when(F.col("s_suppkey") % 5 == 2, F.lit("n/a")).otherwise(lng.cast("string"))),
            q(lat.cast("string")),
        ),
        F.lit(");"),
    )
    return _as_file(g.select(line.alias("value")), "districts")


def area_dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-level area table as SQL insert lines: regions (level 1, in one
    statement), nations (level 2), suppliers (level 3, at the point next to their business area; the
    longitude of every fourth is no number), and remarks that are no rows."""
    def row(code, name, parent, level, lng, lat):
        return F.concat(
            F.lit("("),
            F.concat_ws(
                ", ",
                code.cast("string"),
                quoted(name, code),
                parent.cast("string"),
                F.lit("''"),
                F.lit(level).cast("string"),
                F.lit("1"),
                F.lit("0.0"),
                F.lit("0.0"),
                F.lit("0.0"),
                F.lit("0.0"),
                lng,
                lat,
            ),
            F.lit(")"),
        )

    def ins(*values):
        return F.concat(F.lit("INSERT INTO `areas` VALUES "), row(*values), F.lit(";"))

    r = table(spark, sf_dir, "region")
    n = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier")
    lng, lat = point(F.col("s_suppkey") + 1, F.col("s_suppkey"))
    # The five regions are one statement, with its columns named.
    region = row(F.col("r_regionkey") + 100000, F.col("r_name"), F.lit(0), 1, F.lit("0.0"), F.lit("0.0"))
    named = F.lit("INSERT INTO `areas` (code, name, parent, note, level, a, b, c, d, e, lng, lat) VALUES ")
    regions = r.agg(F.sort_array(F.collect_list(region)).alias("rows")).select(F.concat(named, F.array_join("rows", ", "), F.lit(";")).alias("value"))
    nations = n.select(
        ins(F.col("n_nationkey") + 200000, F.col("n_name"), F.col("n_regionkey") + 100000, 2, F.lit("0.0"), F.lit("0.0")).alias("value")
    )
    suppliers = s.select(
        ins(
            F.col("s_suppkey") + 300000,
            area_name(F.concat(F.lit("area-"), F.col("s_suppkey").cast("string")), F.col("s_suppkey")),
            F.col("s_nationkey") + 200000,
            3,
            F.when(F.col("s_suppkey") % 4 == 3, F.lit("n/a")).otherwise(lng.cast("string")),
            lat.cast("string"),
        ).alias("value")
    )
    remarks = r.select(F.concat(F.lit("-- region, "), F.col("r_name")).alias("value"))
    return _as_file(regions.unionByName(remarks).unionByName(nations).unionByName(suppliers), "areas")


def url_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested URL prefixes from the pages: site (scheme + host) and site +
    language; a site gets several candidate categories (A9 keeps one)."""
    p = table(spark, sf_dir, "pages")
    site = F.regexp_extract("url", "^(https?://[^/?#]+)", 1)
    lang = F.regexp_extract("url", "^https?://[^/?#]+/([a-z]{2})/", 1)
    sites = p.select(site.alias("prefix"), F.concat(F.lit("site"), (F.col("page_id") % 3).cast("string")).alias("category"))
    langs = p.where(lang != "").select(
        F.concat(site, F.lit("/"), lang).alias("prefix"), F.concat(lang, F.lit("专栏")).alias("category")
    )
    return sites.unionByName(langs).where(F.col("prefix") != "")


def geocode_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reverse-geocode reply per supplier: status 0 for every tenth
    supplier, otherwise its region/nation and ``s_suppkey % 4`` areas."""
    g = _supplier_geo(spark, sf_dir)
    sk = F.col("s_suppkey")
    p_lng, p_lat = point(sk, sk + 1)
    areas = F.transform(
        F.sequence(F.lit(1), (sk % 4).cast("int") + 1),
        lambda i: F.struct(
            F.concat_ws(",", point(sk + i, sk * i)[0].cast("string"), point(sk + i, sk * i)[1].cast("string")).alias("location"),
            F.concat(F.col("s_name"), F.lit("-"), i.cast("string")).alias("name"),
        ),
    )
    areas = F.slice(areas, 1, (sk % 4).cast("int"))
    reply = F.struct(
        F.when(sk % 10 == 0, F.lit("0")).otherwise(F.lit("1")).alias("status"),
        F.struct(
            F.struct(
                F.col("r_name").alias("province"),
                F.col("n_name").alias("city"),
                F.concat(F.col("n_name"), F.lit("-d")).alias("district"),
                areas.alias("businessAreas"),
            ).alias("addressComponent")
        ).alias("regeocode"),
    )
    return g.select(
        sk.alias("s_suppkey"),
        F.concat_ws(",", p_lng.cast("string"), p_lat.cast("string")).alias("location"),
        F.to_json(reply).alias("response"),
    )


def backfill_responses(points: DataFrame) -> DataFrame:
    """A reply for each unplaced ``lng,lat``: a province named by its latitude, or, for
    every fourth row of the grid, no answer."""
    lat = F.get(F.split("value", ","), 1).cast("double")
    part = F.struct(
        F.concat(F.lit("B"), F.floor(lat).cast("string")).alias("province"), F.lit("C").alias("city"), F.lit("D").alias("district"),
        F.array().cast("array<struct<location:string,name:string>>").alias("businessAreas"),
    )
    status = F.when(F.floor(lat * 32) % 4 == 0, F.lit("0")).otherwise(F.lit("1"))
    reply = F.struct(status.alias("status"), F.struct(part.alias("addressComponent")).alias("regeocode"))
    return points.select(F.col("value").alias("location"), F.to_json(reply).alias("response"))


def identity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows as identity observations: the order and the supplier's
    offer of a part are two identifiers seen together; a third one, the part, is
    there, blank or null by turns."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("ps"), F.col("l_suppkey").cast("string"), F.lit("-"), F.col("l_partkey").cast("string")).alias("offer_id"),
        F.when(F.col("l_linenumber") % 4 == 0, F.concat(F.lit("pt"), F.col("l_partkey").cast("string")))
        .when(F.col("l_linenumber") % 4 == 1, F.lit(" "))
        .alias("part_id"),
        "l_shipdate",
    )
