"""The registered queries of the register operators on the driver tables, each with its SQL.

Roles: register = customer, lookup = nation and region, account extracts = orders, points = embeddings.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiscope.functions import exprs as x
from regiscope.operators import accounts, agg, factindex, geo, link, predicates, stats
from regiscope.plans import pipelines
from regiscope.sources import io, zips
from regiscope.sources.io import scratch
from regiscope.streaming import incremental
from regiscope.streaming.incremental import new_inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of a table reader under its name."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r4(c, name: str):
    return F.round(c, 4).alias(name)


# ---------------------------------------------------------------- flagship and projections


@query("""SELECT r_name AS region, c_mktsegment AS sector, round(sum(c_acctbal), 4) AS total_last, round(sum(o_totalprice), 4) AS total_this, count(*) AS n,
 round((sum(o_totalprice) - sum(c_acctbal)) / sum(c_acctbal) * 100, 4) AS pct_change
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
 WHERE c_acctbal > 0 AND o_totalprice > 0 GROUP BY 1, 2 HAVING count(*) >= 5""")
def region_sector_growth(t):
    firms = link.lookup(link.lookup(t("customer"), t("nation"), "c_nationkey", "n_nationkey"), t("region"), "n_regionkey", "r_regionkey")
    both = link.lookup(t("orders"), firms, "o_custkey", "c_custkey", "inner")
    g = pipelines.region_growth(both, ["r_name", "c_mktsegment"], "c_acctbal", "o_totalprice", 5)
    return g.select(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("sector"), r4("total_last", "total_last"), r4("total_this", "total_this"), "n", r4("pct_change", "pct_change"))


@query("SELECT p_partkey, p_size, p_name AS title, p_brand, p_type, round(p_retailprice * 2, 2) AS doubled FROM part")
def prune_range_rename_relocate(t):
    p = t("part")
    out = p.select(*predicates.column_range(p, "p_partkey", "p_size"), F.round(F.col("p_retailprice") * 2, 2).alias("doubled")).withColumnRenamed("p_name", "title")
    return predicates.relocate(out, "p_size", "p_partkey")


@query("""SELECT p_partkey, 'Median age: ' || regexp_replace(CAST(round_even(p_size / 4.0, 1) AS DECIMAL(9,1))::VARCHAR, '\\.0$', '') || ' yrs, firm count: ' || p_size AS label FROM part""")
def hover_label(t):
    return t("part").select("p_partkey", F.concat(F.lit("Median age: "), x.label_number((F.col("p_size") / F.lit(4.0)).cast("decimal(9,3)")), F.lit(" yrs, firm count: "), F.col("p_size").cast("string")).alias("label"))


@query("""SELECT p_partkey, CASE WHEN p_size > 40 THEN 4 WHEN p_size > 30 THEN 3 WHEN p_size > 20 THEN 2 ELSE 1 END AS labels,
 (CASE WHEN p_size > 20 THEN 1 ELSE 0 END) + (CASE WHEN p_size > 30 THEN 1 ELSE 0 END) + (CASE WHEN p_size > 40 THEN 1 ELSE 0 END) AS filled FROM part""")
def sic_label_count(t):
    p = t("part").select("p_partkey", *(F.when(F.col("p_size") > k * 10, F.col("p_type")).alias(f"sic{k}") for k in (2, 3, 4)))
    first = F.when(F.col("sic4").isNotNull(), 4).when(F.col("sic3").isNotNull(), 3).when(F.col("sic2").isNotNull(), 2).otherwise(1)
    return p.select("p_partkey", first.alias("labels"), x.filled("sic2", "sic3", "sic4").alias("filled"))


# ---------------------------------------------------------------- filters


@query("""WITH p AS (SELECT p_partkey, nullif(p_type, (SELECT min(p_type) FROM part)) AS kind FROM part)
 SELECT p_partkey, kind, coalesce(regexp_matches(kind, '(?i)brass|steel'), false) AS metal, coalesce(regexp_matches(kind, 'STEEL'), false) AS steel
 FROM p WHERE kind IS NULL OR NOT regexp_matches(kind, '(?i)tin')""")
def filter_regex_nullsafe(t):
    p = t("part")
    low = p.agg(F.min("p_type").alias("low"))
    p = p.crossJoin(F.broadcast(low)).select("p_partkey", F.nullif("p_type", "low").alias("kind"))
    kept = predicates.drop_matching(p, "kind", "tin")
    return kept.select("p_partkey", "kind", x.matches(F.col("kind"), "brass|steel").alias("metal"), x.matches(F.col("kind"), "STEEL", False).alias("steel"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 10 AND l_quantity < 40 AND l_discount > 0 AND l_tax > 0
 AND l_returnflag = 'N' AND l_linestatus <> 'F' AND l_extendedprice IS NOT NULL AND l_quantity <> 25""")
def filter_bands(t):
    kept = t("lineitem").where(predicates.within("l_quantity", 10, 40) & predicates.both_positive("l_discount", "l_tax")).where("l_returnflag = 'N'")
    return kept.where("l_linestatus <> 'F' AND l_extendedprice IS NOT NULL AND l_quantity <> 25").select("l_orderkey", "l_linenumber", "l_quantity")


@query("""SELECT page_id, coalesce(string_split(url, '/')[4], '') AS code FROM pages WHERE coalesce(string_split(url, '/')[4], '') <> ''""")
def token_filter(t):
    return t("pages").select("page_id", x.token(F.col("url"), 4, "/").alias("code")).where(predicates.has_token("code"))


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 50")
def dev_subset(t):
    return t("part").select("p_partkey", "p_name").orderBy("p_partkey").limit(50)


# ---------------------------------------------------------------- joins


@query("""SELECT c_custkey, upper(replace(n_name, ' ', '')) AS place, CAST(n_nationkey * 1000 AS DOUBLE) AS easting, CAST(n_regionkey * 1000 AS DOUBLE) AS northing
 FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 5 <> 0""")
def geocode_register(t):
    lookup = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), x.normalise_postcode(F.col("n_name")).alias("place"), F.when(F.col("n_nationkey") % 5 != 0, F.col("n_nationkey") * 1000.0).alias("easting"), (F.col("n_regionkey") * 1000.0).alias("northing"))
    return link.located(t("customer"), lookup, "c_nationkey", "easting", "northing").select("c_custkey", "place", "easting", "northing")


@query("""SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CompanyNumber, 'S' || c_nationkey || 'AB' AS postcode, n_name AS localauthority_name, CAST(n_nationkey * 1000 AS DOUBLE) AS easting, CAST(n_regionkey * 1000 AS DOUBLE) AS northing
 FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 5 <> 0""")
def geocoded_register(t):
    """The register located by a postcode lookup read from CSV; a fifth of its postcodes have no coordinates."""
    spark, path = t("nation").sparkSession, scratch(t("nation").sparkSession)
    known = F.col("n_nationkey") % 5 != 0
    t("nation").select(F.concat(F.lit("S"), "n_nationkey", F.lit(" AB")).alias("Postcode"), F.lit("E0").alias("localauthority_code"), F.col("n_name").alias("localauthority_name"), F.lit("T").alias("ITL221CD"), F.lit("N").alias("ITL221NM"),
                       F.when(known, F.col("n_nationkey") * 1000).alias("Eastings"), F.when(known, F.col("n_regionkey") * 1000).alias("Northings")).write.option("header", True).csv(path)
    firms = t("customer").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("CompanyNumber"), F.concat(F.lit("s"), "c_nationkey", F.lit("a b")).alias("RegAddress_PostCode"))
    return pipelines.geocoded(firms, io.read_lookup(spark, path, io.POSTCODES)).select("CompanyNumber", "postcode", "localauthority_name", "easting", "northing")


_LATEST = """WITH e AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders),
 w AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n, max(d) OVER (PARTITION BY o_custkey) AS m, count_if(d IS NULL) OVER (PARTITION BY o_custkey) AS z FROM e)"""


def _extracts(t, null_every: int | None = None):
    d = F.col("o_orderdate").cast("date")
    d = d if null_every is None else F.when(F.col("o_orderkey") % null_every != 0, d)
    return t("orders").select("o_custkey", "o_orderkey", d.alias("d"))


@query("""SELECT c_custkey, c_name, o_orderkey, CAST(o_orderdate AS DATE) AS enddate FROM customer JOIN
 (SELECT *, max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS m FROM orders) o ON o_custkey = c_custkey WHERE CAST(o_orderdate AS DATE) = m AND c_mktsegment <> 'BUILDING'""")
def link_latest_accounts(t):
    e = _extracts(t).withColumn("enddate", F.date_format("d", "d MMMM yyyy")).unionByName(_extracts(t).where("o_orderkey % 3 = 0").withColumn("enddate", F.date_format("d", "dd/MM/yyyy")))
    last = pipelines.latest_accounts(e, [F.col("enddate")], "o_custkey", "o_orderkey", "enddate")
    return pipelines.linked(t("customer"), last, "c_custkey", "o_custkey", F.col("c_mktsegment") != "BUILDING").select("c_custkey", "c_name", "o_orderkey", "enddate")


@query("""SELECT c_custkey, c_name, o_orderkey, CAST(o_orderdate AS DATE) AS enddate FROM customer JOIN
 (SELECT *, max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS m FROM orders) o ON o_custkey = c_custkey WHERE CAST(o_orderdate AS DATE) = m AND c_mktsegment <> 'BUILDING'""")
def link_bucketed_accounts(t):
    """link_latest_accounts of stored tables in buckets of companies, with month-first dates: no exchange after they are written."""
    spark = t("nation").sparkSession
    e = _extracts(t).withColumn("enddate", F.date_format("d", "MM/dd/yyyy"))
    formats = x.date_orders(e, "enddate")
    stored = [io.write_bucketed(df, f"regiscope_{uuid.uuid4().hex}", key, 8, scratch(spark)) for df, key in ((t("customer"), "c_custkey"), (e, "o_custkey"))]
    last = pipelines.latest_accounts(stored[1], [F.col("enddate")], "o_custkey", "o_orderkey", "enddate", formats, bucketed=True)
    return pipelines.linked(stored[0], last, "c_custkey", "o_custkey", F.col("c_mktsegment") != "BUILDING").select("c_custkey", "c_name", "o_orderkey", "enddate")


@query(_LATEST + " SELECT o_custkey, o_orderkey, d FROM w WHERE n = 1 OR (z = 0 AND d = m)")
def latest_null_date_group(t):
    return agg.latest(_extracts(t, 17), "o_custkey", "d")


@query("""SELECT c_custkey, o_orderkey, c_name FROM orders RIGHT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""")
def right_join_accounts(t):
    out = link.lookup(t("orders").select("o_orderkey", "o_custkey"), t("customer").where("c_acctbal > 0"), "o_custkey", "c_custkey", "right")
    return out.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def semi_register(t):
    return link.members(t("customer").select("c_custkey", "c_name"), t("orders"), "c_custkey", "o_custkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def anti_register(t):
    return link.members(t("customer").select("c_custkey", "c_name"), t("orders").where("o_totalprice > 300000"), "c_custkey", "o_custkey", inside=False)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) = 9)")
def repeated_accounts(t):
    return agg.repeated(t("orders").select("o_orderkey", "o_custkey"), ["o_custkey"], 9)


@query("""SELECT matched, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM customer), 4) AS pct
 FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) AS matched FROM customer) GROUP BY matched""")
def match_report(t):
    return link.match_report(t("customer"), t("orders").where("o_totalprice > 200000"), "c_custkey", "o_custkey").select("matched", "n", r4("pct", "pct"))


@query("""SELECT in_a, in_b, count(*) AS n FROM (SELECT c_mktsegment = 'BUILDING' AS in_a, c_acctbal > 5000 AS in_b FROM customer) WHERE in_a OR in_b GROUP BY ALL""")
def method_overlap(t):
    return link.overlap_report(t("customer").where("c_mktsegment = 'BUILDING'"), t("customer").where("c_acctbal > 5000"), "c_custkey")


# ---------------------------------------------------------------- counts and shares


@query("SELECT rows_per_key, count(*) AS keys FROM (SELECT o_custkey, count(*) AS rows_per_key FROM orders GROUP BY 1) GROUP BY 1")
def multi_account_rows(t):
    return agg.count_histogram(t("orders"), "o_custkey")


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def freq_1way(t):
    return agg.frequency(t("orders"), "o_orderpriority")


@query("""SELECT o_orderstatus, count_if(o_orderpriority = '1-URGENT') AS urgent, count_if(o_orderpriority = '5-LOW') AS low FROM orders GROUP BY 1""")
def freq_2way(t):
    wide = t("orders").groupBy("o_orderstatus").pivot("o_orderpriority", ["1-URGENT", "5-LOW"]).agg(F.count(F.lit(1))).fillna(0)
    return wide.withColumnsRenamed({"1-URGENT": "urgent", "5-LOW": "low"})


@query("SELECT o_orderstatus, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct FROM orders GROUP BY 1")
def prop_overall(t):
    return agg.proportions(t("orders"), "o_orderstatus").select("o_orderstatus", "n", r4("pct", "pct"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY o_orderstatus), 4) AS pct FROM orders GROUP BY 1, 2")
def prop_row(t):
    return agg.proportions(t("orders"), "o_orderstatus", "o_orderpriority", within=["o_orderstatus"]).select("o_orderstatus", "o_orderpriority", "n", r4("pct", "pct"))


@query("""WITH l AS (SELECT nullif(l_quantity, 10) AS q, l_discount AS d FROM lineitem) SELECT round(avg(CAST(q > 20 AS INT)) * 100, 4) AS over_20, count(q) AS present,
 count_if(d > 0.05) AS discounted, round(count_if(d > 0.05) * 100.0 / count(*), 4) AS ratio FROM l""")
def coverage_measures(t):
    li = t("lineitem").select(F.nullif("l_quantity", F.lit(10.0)).alias("q"), F.col("l_discount").alias("d"))
    return li.agg(r4(agg.share_true(F.col("q") > 20), "over_20"), F.count("q").alias("present"), F.count_if(F.col("d") > 0.05).alias("discounted"), r4(F.count_if(F.col("d") > 0.05) * 100.0 / F.count("*"), "ratio"))


@query("""SELECT count(DISTINCT user_id) AS users, count(DISTINCT nullif(event_type, (SELECT min(event_type) FROM events))) + 1 AS types FROM events""")
def distinct_counts(t):
    e = t("events")
    low = e.agg(F.min("event_type").alias("low"))
    e = e.crossJoin(F.broadcast(low)).select("user_id", F.nullif("event_type", "low").alias("kind"))
    return e.agg(agg.distinct_with_null("user_id").alias("users"), agg.distinct_with_null("kind").alias("types"))


@query("SELECT DISTINCT event_type FROM events")
def distinct_values(t):
    return t("events").select("event_type").distinct()


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS total, count(*) AS n FROM lineitem GROUP BY 1, 2")
def sum_by_two_keys(t):
    return t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("total"), F.count("*").alias("n"))


@query("SELECT l_returnflag, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY 1")
def mean_by_key(t):
    return t("lineitem").groupBy("l_returnflag").agg(r4(F.avg("l_extendedprice"), "mean"))


@query("SELECT round(avg(l_quantity), 4) AS mean, round(stddev_samp(l_quantity), 4) AS sd, min(CAST(l_shipdate AS DATE)) AS first, max(CAST(l_shipdate AS DATE)) AS last FROM lineitem")
def global_stats(t):
    return t("lineitem").agg(r4(F.avg("l_quantity"), "mean"), r4(F.stddev_samp("l_quantity"), "sd"), F.min(F.col("l_shipdate").cast("date")).alias("first"), F.max(F.col("l_shipdate").cast("date")).alias("last"))


@query("SELECT round(min(s), 4) AS least FROM (SELECT sum(l_quantity) AS s FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) >= 50)")
def min_of_sums(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("s")).where("s >= 50").agg(r4(F.min("s"), "least"))


@query("""WITH o AS (SELECT o_orderpriority, o_orderstatus, CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN NULL ELSE o_totalprice END AS v FROM orders)
 SELECT o_orderpriority, o_orderstatus, CASE WHEN count_if(v IS NULL) = 0 THEN round(median(v), 4) END AS mid, count(*) AS n FROM o GROUP BY 1, 2 HAVING count(*) >= 10""")
def median_by_group(t):
    o = t("orders")
    first = o.agg(F.min("o_orderkey").alias("low"))
    o = o.crossJoin(F.broadcast(first)).withColumn("v", F.when(F.col("o_orderkey") != F.col("low"), F.col("o_totalprice")))
    return o.groupBy("o_orderpriority", "o_orderstatus").agg(F.round(agg.strict(agg.median("v"), "v"), 4).alias("mid"), F.count("*").alias("n")).where("n >= 10")


# ---------------------------------------------------------------- windows, order, sets


@query("SELECT l_orderkey, l_linenumber, round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey) * 100, 4) AS pct, count(*) OVER (PARTITION BY l_orderkey) AS group_count FROM lineitem")
def share_of_group(t):
    return agg.share_of_group(t("lineitem"), ["l_orderkey"], "l_quantity", few=True).select("l_orderkey", "l_linenumber", r4("pct", "pct"), "group_count")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT *, max(l_quantity) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) WHERE l_quantity = m")
def largest_share(t):
    return agg.at_group_max(t("lineitem"), ["l_orderkey"], "l_quantity").select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def topk(t):
    return t("part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(25)


@query("SELECT p_partkey FROM part ORDER BY md5(p_partkey || ':7'), p_partkey LIMIT 100")
def seeded_sample(t):
    return agg.seeded_sample(t("part").select("p_partkey"), "p_partkey", 100, 7)


@query("SELECT p_brand, round(median(p_retailprice), 4) AS stat, CAST(row_number() OVER (ORDER BY median(p_retailprice), p_brand) AS INT) AS rank FROM part GROUP BY p_brand")
def category_rank(t):
    return agg.category_rank(t("part"), "p_brand", agg.median("p_retailprice")).select("p_brand", r4("stat", "stat"), "rank")


@query("SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS o_orderpriority FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'O'")
def union_by_name(t):
    o = t("orders")
    return o.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice").unionByName(o.where("o_orderstatus = 'O'").select("o_orderkey", "o_orderpriority"), allowMissingColumns=True)


@query("SELECT l_orderkey, l_linenumber, year, employees FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem) UNPIVOT INCLUDE NULLS (employees FOR year IN (l_quantity, l_tax))")
def unpivot_years(t):
    return agg.to_long(t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"], "year", "employees")


@query("SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber) AS lines, round(sum(l_quantity), 4) AS total FROM lineitem GROUP BY 1")
def nested_groups(t):
    nested = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("rows"))
    return nested.select("l_orderkey", F.transform("rows", lambda r: r["l_linenumber"]).alias("lines"), r4(F.aggregate("rows", F.lit(0.0), lambda a, r: a + r["l_quantity"]), "total"))


@query("SELECT 'status' AS name, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'flag', l_returnflag, count(*) FROM lineitem GROUP BY 2")
def facts_union(t):
    rows = t("orders").select(F.lit("status").alias("name"), F.col("o_orderstatus").alias("value")).union(t("lineitem").select(F.lit("flag"), "l_returnflag"))
    return rows.groupBy("name", "value").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- text, dates, scalars


@query("SELECT page_id, url FROM pages WHERE string_split(url, '/')[-1] NOT IN (SELECT string_split(url, '/')[-1] FROM pages WHERE page_id % 3 = 0)")
def incremental_new(t):
    p = t("pages").select("page_id", "url")
    return new_inputs(p, p.where("page_id % 3 = 0"), "url")


@query("""WITH h AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS a FROM pages), u AS (SELECT page_id, unnest(a) AS href, unnest(range(len(a))) AS pos FROM h)
 SELECT page_id, CAST(pos AS INT) AS pos, 'http://base' || href AS link FROM u WHERE contains(href, 'th') AND contains(href, '/')""")
def page_links(t):
    return io.links(t("pages"), "html", "page_id", "th", "/", base="http://base")


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN 'S' || event_id END AS postcode FROM events")
def json_reply(t):
    part = lambda v, kind: F.struct(v.alias("longText"), v.alias("shortText"), F.array(F.lit(kind)).alias("types"))
    code, town = part(F.concat(F.lit("S"), F.col("event_id").cast("string")), "postal_code"), part(F.col("event_type"), "locality")
    parts = F.when(F.col("event_id") % 3 == 0, F.array(town)).when(F.col("event_id") % 3 == 1, F.array(town, code)).otherwise(F.array(code, town))
    reply = F.to_json(F.struct(F.array(F.struct(parts.alias("addressComponents"))).alias("places")))
    return t("events").select("event_id", reply.alias("reply")).select("event_id", io.reply_postcode("reply").alias("postcode"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN 'S' || (c_custkey % 10) || ' ' || (c_nationkey % 10) || 'AB' END AS postcode FROM customer")
def postcode_from_text(t):
    code = F.concat(F.lit("s"), (F.col("c_custkey") % 10).cast("string"), F.lit(" "), (F.col("c_nationkey") % 10).cast("string"), F.lit("ab"))
    text = F.concat(F.lit("1 High Street, "), F.when(F.col("c_custkey") % 4 != 0, code).otherwise(F.lit("no code")), F.lit(", England"))
    return t("customer").select("c_custkey", x.postcode_in(text).alias("postcode"))


@query("SELECT page_id, coalesce(string_split(url, '/')[3], '') AS host, coalesce(string_split(url, '/')[7], '') AS absent FROM pages")
def split_tokens(t):
    return t("pages").select("page_id", x.token(F.col("url"), 3, "/").alias("host"), x.token(F.col("url"), 7, "/").alias("absent"))


@query("SELECT page_id, string_split(url, '/')[-1] AS file FROM pages")
def basename_strip(t):
    return t("pages").select("page_id", x.strip_suffix(x.base_name(F.concat("url", F.lit(".html"))), ".html").alias("file"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders")
def parse_mixed_dates(t):
    d = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, F.date_format(d, "d MMMM yyyy")).when(k == 1, F.date_format(d, "yyyy-MM-dd")).when(k == 2, F.date_format(d, "dd/MM/yyyy")).when(k == 3, F.date_format(d, "MMMM d, yyyy")).otherwise(F.lit("no date"))
    return t("orders").select("o_orderkey", x.parse_date(text).alias("d"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS month_first, CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_orderdate AS DATE) END AS day_first FROM orders")
def dates_in_trained_orders(t):
    """One column has its months first, the other its days: each is read in its own order."""
    d = F.col("o_orderdate").cast("date")
    texts = t("orders").select("o_orderkey", F.date_format(d, "M/d/yyyy").alias("month_first"), F.when(F.col("o_orderkey") % 9 > 0, F.date_format(d, "dd.MM.yyyy")).otherwise(F.lit("none")).alias("day_first"))
    return x.with_trained_dates(x.with_trained_dates(texts, "month_first"), "day_first")


@query("SELECT o_orderkey, round(datediff('day', CAST(o_orderdate AS DATE), DATE '2025-03-01') / 365.0, 4) AS age FROM orders")
def age_years(t):
    return t("orders").select("o_orderkey", r4(x.age_in_years(F.col("o_orderdate").cast("date"), F.lit("2025-03-01").cast("date")), "age"))


@query("""WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders WHERE month(o_orderdate) <> 2 GROUP BY 1),
 s AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM m)::TIMESTAMP, (SELECT max(month) FROM m)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS month)
 SELECT s.month, coalesce(n, 0) AS n FROM s LEFT JOIN m USING (month)""")
def month_histogram(t):
    return stats.month_counts(t("orders").where("month(o_orderdate) <> 2"), "o_orderdate")


@query("""SELECT p_partkey, p_type[1:5] AS code, upper(p_name) AS name, TRY_CAST(CASE p_partkey % 3 WHEN 0 THEN '1034' WHEN 1 THEN NULL ELSE NULL END AS DOUBLE) AS value,
 CASE WHEN p_size > 10 THEN round(log10(p_size - 10), 4) END AS lg, p_partkey % 3 = 1 AS missing, round((p_retailprice - (p_size - 1)) / nullif(p_size - 1, 0) * 100, 4) AS safe FROM part""")
def scalar_exprs(t):
    text = F.when(F.col("p_partkey") % 3 == 0, "1034").when(F.col("p_partkey") % 3 == 1, F.lit(None)).otherwise("1,034")
    p = t("part").withColumn("text", text)
    return p.select("p_partkey", F.substring("p_type", 1, 5).alias("code"), F.upper("p_name").alias("name"), x.to_number(F.col("text")).alias("value"), r4(x.log10(F.col("p_size") - 10.0), "lg"), F.col("text").isNull().alias("missing"),
                    r4(x.percent_change(F.col("p_size") - F.lit(1.0), F.col("p_retailprice")), "safe"))


# ---------------------------------------------------------------- grids and distances

_PTS = "p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)"
_SQ = _PTS + """, b AS (SELECT min(x) AS x0, min(y) AS y0, greatest(1, ceil((max(x) - min(x)) / 0.05)) AS nx, greatest(1, ceil((max(y) - min(y)) / 0.05)) AS ny FROM p),
 g AS (SELECT p.*, CAST(least(floor((x - x0) / 0.05), nx - 1) AS BIGINT) AS ix, CAST(least(floor((y - y0) / 0.05), ny - 1) AS BIGINT) AS iy, CAST(nx AS BIGINT) AS nx FROM p, b)"""
_HEX = _PTS + """, b AS (SELECT min(x) AS x0, min(y) AS y0 FROM p),
 f AS (SELECT p.*, ((x - x0) * (sqrt(3.0) / 3) - (y - y0) / 3) / (0.1 / sqrt(3.0)) AS fq, (y - y0) * (2.0 / 3) / (0.1 / sqrt(3.0)) AS fr FROM p, b),
 c AS (SELECT *, floor(fq + 0.5) AS rq, floor(fr + 0.5) AS rr, floor(-fq - fr + 0.5) AS rs FROM f),
 e AS (SELECT *, abs(rq - fq) AS eq, abs(rr - fr) AS er, abs(rs + fq + fr) AS es FROM c),
 h AS (SELECT vec_id, label, x, y, CAST(CASE WHEN eq > er AND eq > es THEN -rr - rs ELSE rq END AS BIGINT) AS q, CAST(CASE WHEN eq > er AND eq > es THEN rr WHEN er > es THEN -rq - rs ELSE rr END AS BIGINT) AS r FROM e)"""


def points(t):
    return t("embeddings").select("vec_id", "label", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))


@query(f"WITH {_SQ} SELECT vec_id, ix, iy, iy * nx + ix + 1 AS cell FROM g")
def grid_square(t):
    return geo.square_cells(points(t), "x", "y", 0.05).select("vec_id", F.col("ix").cast("long").alias("ix"), F.col("iy").cast("long").alias("iy"), F.col("cell").cast("long").alias("cell"))


@query(f"WITH {_HEX} SELECT vec_id, q, r FROM h")
def grid_hex(t):
    return geo.hex_cells(points(t), "x", "y", 0.1).select("vec_id", F.col("q").cast("long").alias("q"), F.col("r").cast("long").alias("r"))


@query(f"WITH {_HEX.replace('FROM embeddings)', 'FROM embeddings WHERE label IN (1, 2))')} SELECT q, r, count(*) AS n FROM h GROUP BY 1, 2")
def local_grid(t):
    cells = geo.hex_cells(points(t).where("label IN (1, 2)"), "x", "y", 0.1)
    return cells.groupBy(F.col("q").cast("long").alias("q"), F.col("r").cast("long").alias("r")).agg(F.count("*").alias("n"))


@query(f"WITH {_SQ}, s AS (SELECT ix, iy, label, count(*) AS total FROM g GROUP BY ALL), w AS (SELECT *, row_number() OVER (PARTITION BY ix, iy ORDER BY total DESC, label) AS k FROM s) SELECT ix, iy, label, total FROM w WHERE k = 1")
def modal_category(t):
    cells = geo.square_cells(points(t), "x", "y", 0.05).groupBy(F.col("ix").cast("long").alias("ix"), F.col("iy").cast("long").alias("iy"), "label").agg(F.count("*").alias("total"))
    return agg.arg_max(cells, ["ix", "iy"], "total", "label")


@query(f"WITH {_SQ}, s AS (SELECT iy * nx + ix + 1 AS cell, label, count(*) AS total FROM g GROUP BY ALL) SELECT cell, label, total FROM (SELECT *, sum(total) OVER (PARTITION BY cell) AS t FROM s) WHERE t >= 5")
def having_rollup(t):
    cells = geo.square_cells(points(t), "x", "y", 0.05).groupBy(F.col("cell").cast("long").alias("cell"), "label").agg(F.count("*").alias("total"))
    return agg.having_total(cells, ["cell"], "total", 5)


@query(f"WITH {_HEX} SELECT q, r, round(median(label), 4) AS mid, count(*) AS n FROM h GROUP BY 1, 2 HAVING count(*) >= 3")
def cell_median(t):
    cells = geo.hex_cells(points(t), "x", "y", 0.1).groupBy(F.col("q").cast("long").alias("q"), F.col("r").cast("long").alias("r"))
    return cells.agg(F.round(agg.strict(agg.median("label"), "label"), 4).alias("mid"), F.count("*").alias("n")).where("n >= 3")


@query(f"WITH {_HEX.replace('FROM embeddings)', 'FROM embeddings WHERE vec_id % 7 > 0)')}, s AS (SELECT q, r, label, sum(vec_id % 7) AS total FROM h WHERE label <> 3 GROUP BY ALL), w AS (SELECT *, sum(total) OVER (PARTITION BY q, r) AS t, row_number() OVER (PARTITION BY q, r ORDER BY total DESC, 'sector' || label) AS k FROM s) SELECT q, r, 'sector' || label AS sector, total FROM w WHERE k = 1 AND t >= 10")
def modal_sector(t):
    p = points(t).select("x", "y", F.concat(F.lit("sector"), "label").alias("sector"), (F.col("vec_id") % 7).alias("staff"))
    out = pipelines.modal_sector(p, "x", "y", 0.1, "sector", "staff", 10, "SECTOR3")
    return out.select(F.col("q").cast("long").alias("q"), F.col("r").cast("long").alias("r"), "sector", "total")


@query(f"WITH {_HEX} SELECT q, r, round(median(datediff('day', DATE '2000-01-01' + CAST(vec_id % 5000 AS INT), DATE '2025-03-01') / 365.0), 4) AS median_age, count(*) AS firms FROM h GROUP BY 1, 2 HAVING count(*) >= 3")
def median_age(t):
    p = points(t).withColumn("since", F.date_add(F.lit("2000-01-01").cast("date"), (F.col("vec_id") % 5000).cast("int")))
    out = pipelines.median_age(p, "x", "y", 0.1, "since", F.lit("2025-03-01").cast("date"), 3)
    return out.where(F.col("label").startswith("Median age: ")).select(F.col("q").cast("long").alias("q"), F.col("r").cast("long").alias("r"), r4("median_age", "median_age"), "firms")


@query(f"WITH {_SQ}, c AS (SELECT DISTINCT ix, iy FROM g) SELECT ix, iy, round(0.05 * ix, 6) AS west, round(0.05 * (iy + 1), 6) AS north, 5 AS corners, true AS closed FROM c")
def square_geometry(t):
    cells = geo.square_cells(points(t), "x", "y", 0.05).select(F.col("ix").cast("long").alias("ix"), F.col("iy").cast("long").alias("iy")).distinct()
    return _geometry(cells, geo.square_corners(F.col("ix"), F.col("iy"), 0.05))


@query(f"WITH {_HEX} SELECT DISTINCT q, r, round(0.1 * (q + r / 2.0) - 0.05, 6) AS west, round(0.1 / sqrt(3.0) * (1.5 * r + 1), 6) AS north, 7 AS corners, true AS closed FROM h")
def hexagon_geometry(t):
    cells = geo.hex_cells(points(t), "x", "y", 0.1).select(F.col("q").cast("long").alias("q"), F.col("r").cast("long").alias("r")).distinct()
    return _geometry(cells, geo.hex_corners(F.col("q"), F.col("r"), 0.1))


def _geometry(cells: DataFrame, ring: F.Column) -> DataFrame:
    """West and north ends of rings, their number of corners, and whether they are closed."""
    near = F.abs(F.col("ring")[0][0] - F.element_at("ring", -1)[0]) + F.abs(F.col("ring")[0][1] - F.element_at("ring", -1)[1]) < 1e-9
    end = lambda f, k: F.round(f(F.transform("ring", lambda p: p[k])), 6)
    return cells.withColumn("ring", ring).select(*cells.columns, end(F.array_min, 0).alias("west"), end(F.array_max, 1).alias("north"), F.size("ring").alias("corners"), near.alias("closed"))


@query(f"WITH {_HEX} SELECT q, r, sum(label + 1) AS total_last, sum(vec_id + 1) AS total_this, count(*) AS n, round((sum(vec_id + 1) - sum(label + 1)) / sum(label + 1) * 100, 4) AS pct_change FROM h GROUP BY 1, 2 HAVING count(*) >= 3")
def cell_growth(t):
    cells = geo.hex_cells(points(t), "x", "y", 0.1).select(F.col("q").cast("long").alias("q"), F.col("r").cast("long").alias("r"), (F.col("label") + 1).alias("a"), (F.col("vec_id") + 1).alias("b"))
    return pipelines.region_growth(cells, ["q", "r"], "a", "b", 3).withColumn("pct_change", F.round("pct_change", 4))


@query(f"WITH {_PTS} SELECT round(avg(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))), 6) AS mean_distance FROM p a, p b WHERE a.label = 1 AND b.label = 2")
def pair_distance(t):
    p = points(t)
    return stats.mean_distance(p.where("label = 1").select("x", "y"), p.where("label = 2").select("x", "y")).select(F.round("mean_distance", 6).alias("mean_distance"))


@query(f"""WITH {_PTS}, n AS (SELECT count_if(label = 1) AS n1, count_if(label = 2) AS n2 FROM p), r AS (SELECT p.*, rep FROM p, range(20) t(rep)),
 k AS (SELECT *, row_number() OVER (PARTITION BY rep ORDER BY md5(vec_id || ':' || rep || ':x'), vec_id) AS kx, row_number() OVER (PARTITION BY rep ORDER BY md5(vec_id || ':' || rep || ':y'), vec_id) AS ky FROM r),
 m AS (SELECT a.rep, avg(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS d FROM k a JOIN k b ON a.rep = b.rep, n WHERE a.kx <= n1 AND b.ky <= n2 GROUP BY 1),
 o AS (SELECT avg(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS d FROM p a, p b WHERE a.label = 1 AND b.label = 2)
 SELECT round(o.d, 6) AS observed, round(avg(m.d), 6) AS expected, round(stddev_samp(m.d), 6) AS sd, round((o.d - avg(m.d)) / stddev_samp(m.d), 4) AS z FROM m, o GROUP BY o.d""")
def permutation_z(t):
    out = stats.colocation(points(t).withColumnRenamed("vec_id", "id"), "label", 1, 2, reps=20, peaks=False)
    return out.select(F.round("observed", 6).alias("observed"), F.round("expected", 6).alias("expected"), F.round("sd", 6).alias("sd"), r4("z", "z"))


@query(f"""WITH {_PTS}, n AS (SELECT count_if(label = 1) AS n1, count_if(label = 2) AS n2 FROM p), r AS (SELECT p.*, rep FROM p, range(20) t(rep)),
 k AS (SELECT *, row_number() OVER (PARTITION BY rep ORDER BY md5(vec_id || ':' || rep || ':x'), vec_id) AS kx, row_number() OVER (PARTITION BY rep ORDER BY md5(vec_id || ':' || rep || ':y'), vec_id) AS ky FROM r),
 d AS (SELECT a.rep, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM k a JOIN k b ON a.rep = b.rep, n WHERE a.kx <= n1 AND b.ky <= n2
  UNION ALL SELECT -1, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) FROM p a, p b WHERE a.label = 1 AND b.label = 2),
 s AS (SELECT rep, count(*) AS n, min(d) AS lo, max(d) AS hi, stddev_samp(d) AS sd, greatest((max(d) - min(d)) / 4096, 1e-300) AS step FROM d GROUP BY rep),
 b AS (SELECT d.rep, floor((d - lo) / step) AS b, count(*) AS w, avg(d) AS m FROM d JOIN s USING (rep) GROUP BY ALL),
 q AS (SELECT rep, min(m) FILTER (upto >= 0.25 * n) AS q1, min(m) FILTER (upto >= 0.75 * n) AS q3 FROM (SELECT *, sum(w) OVER (PARTITION BY rep ORDER BY b) AS upto FROM b) JOIN s USING (rep) GROUP BY rep),
 h AS (SELECT rep, lo, hi, 0.9 * CASE WHEN least(sd, (q3 - q1) / 1.34) > 0 THEN least(sd, (q3 - q1) / 1.34) WHEN sd > 0 THEN sd ELSE 1 END * pow(n, -0.2) AS h FROM s JOIN q USING (rep)),
 g AS (SELECT h.rep, lo - 3 * h + k * (hi - lo + 6 * h) / 511 AS x, sum(w * exp(-0.5 * pow((lo - 3 * h + k * (hi - lo + 6 * h) / 511 - m) / h, 2))) AS high FROM h JOIN b USING (rep), range(512) t(k) GROUP BY ALL),
 m AS (SELECT rep, arg_max(x, (high, -x)) AS peak FROM g GROUP BY rep)
 SELECT round(max(peak) FILTER (rep = -1), 6) AS observed_peak, round(avg(peak) FILTER (rep >= 0), 6) AS expected_peak, round(stddev_samp(peak) FILTER (rep >= 0), 6) AS sd_peak,
  round((max(peak) FILTER (rep = -1) - avg(peak) FILTER (rep >= 0)) / stddev_samp(peak) FILTER (rep >= 0), 4) AS z_peak FROM m""")
def permutation_peak_z(t):
    """permutation_z of the density peak."""
    out = stats.colocation(points(t).withColumnRenamed("vec_id", "id"), "label", 1, 2, reps=20)
    return out.select(*(F.round(c, 6).alias(c) for c in ("observed_peak", "expected_peak", "sd_peak")), r4("z_peak", "z_peak"))


@query()
def colocation_z(t):
    """All repetitions, of means and density peaks, by a grid; drawn with a seed, which SQL can't follow."""
    out = stats.colocation_by_grid(points(t), "label", 1, 2)
    return out.select(*(F.round(c, 6).alias(c) for c in ("observed", "expected", "sd", "observed_peak", "expected_peak", "sd_peak", "within")), r4("z", "z"), r4("z_peak", "z_peak"))


# ---------------------------------------------------------------- statistics


@query("""SELECT l_returnflag, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
 round(sqrt((regr_syy(l_extendedprice, l_quantity) - pow(regr_sxy(l_extendedprice, l_quantity), 2) / regr_sxx(l_extendedprice, l_quantity)) / (count(*) - 2) / regr_sxx(l_extendedprice, l_quantity)), 4) AS se FROM lineitem GROUP BY 1""")
def grouped_ols(t):
    return stats.ols_by_group(t("lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity").select("l_returnflag", "n", r4("slope", "slope"), r4("se", "se"))


_KDE = """WITH v AS (SELECT event_type AS g, value AS v FROM events WHERE value IS NOT NULL),
 s0 AS (SELECT g, count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) AS sd, (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / 1.34 AS iq FROM v GROUP BY g),
 s AS (SELECT *, 0.9 * (CASE WHEN least(sd, iq) > 0 THEN least(sd, iq) WHEN sd > 0 THEN sd ELSE 1 END) * pow(n, -0.2) AS bw, greatest((hi - lo) / 2048, 1e-300) AS step FROM s0),
 b AS (SELECT v.g, floor((v - lo) / step) AS k, count(*) AS w, avg(v) AS m FROM v JOIN s USING (g) GROUP BY 1, 2),
 x AS (SELECT g, n, bw, lo - 3 * bw + k * (hi - lo + 6 * bw) / 511 AS x FROM s, range(512) t(k)),
 d AS (SELECT x.g, x.x, sum(w * exp(-0.5 * pow((x.x - m) / bw, 2))) / (n * bw * sqrt(2 * pi())) AS d FROM x JOIN b ON x.g = b.g GROUP BY x.g, x.x, n, bw),
 r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY d DESC, x) AS k FROM d)"""


@query(_KDE + " SELECT g AS event_type, round(x, 4) AS peak FROM r WHERE k = 1")
def kde_peak(t):
    return stats.density_peak(t("events"), "event_type", "value").select("event_type", r4("peak", "peak"))


@query("""WITH b AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM events), c AS (SELECT event_type, CAST(least(29, floor((value - lo) / w)) AS INT) AS bin, w, count(*) AS n FROM events, b GROUP BY ALL)
 SELECT event_type, bin, n, round(n / (sum(n) OVER (PARTITION BY event_type) * w), 8) AS density FROM c""")
def histogram_bins(t):
    return stats.histogram(t("events"), "value", 30, ["event_type"]).withColumn("density", F.round("density", 8))


@query("""WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
 w AS (SELECT event_type, q1, median, q3, min(value) FILTER (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS low, max(value) FILTER (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS high FROM events JOIN q USING (event_type) GROUP BY ALL)
 SELECT event_type, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(low, 4) AS low, round(high, 4) AS high, CAST(row_number() OVER (ORDER BY w.median, event_type) AS INT) AS rank FROM w""")
def boxplot_stats(t):
    b = stats.box_plot(t("events"), "event_type", "value")
    return b.select("event_type", *(r4(c, c) for c in ("q1", "median", "q3", "low", "high")), "rank")


def _breaks_sql(source: str, classes: int) -> str:
    """The dynamic program over all distinct values, a step for each class."""
    steps = [f"""WITH v AS ({source}), m AS (SELECT avg(v) AS m FROM v), l AS (SELECT v, count(*) AS w FROM v GROUP BY v),
 c AS (SELECT v, row_number() OVER (ORDER BY v) AS i, sum(w) OVER (ORDER BY v) AS n, sum((v - m) * w) OVER (ORDER BY v) AS s, sum((v - m) * (v - m) * w) OVER (ORDER BY v) AS ss FROM l, m),
 b1 AS (SELECT i, ss - s * s / n AS cost, [v] AS breaks FROM c)"""]
    for k in range(2, classes + 1):
        steps.append(f"""b{k} AS (SELECT i, min(total) AS cost, arg_min(list_append(breaks, v), (total, j)) AS breaks FROM (SELECT x.i, x.v, b.i AS j, b.breaks,
 b.cost + x.ss - y.ss - (x.s - y.s) * (x.s - y.s) / (x.n - y.n) AS total FROM b{k - 1} b JOIN c y ON y.i = b.i JOIN c x ON x.i > b.i) GROUP BY i)""")
    return ", ".join(steps) + f" SELECT CAST(unnest(range(len(breaks))) AS INT) AS class, unnest(breaks) AS upper FROM b{classes} WHERE i = (SELECT max(i) FROM c)"


@query(_breaks_sql("SELECT CAST(p_size AS DOUBLE) AS v FROM part", 5))
def natural_breaks(t):
    return stats.natural_breaks(t("part"), "p_size", 5)


@query(_breaks_sql("SELECT CAST(round(c_acctbal) AS DOUBLE) AS v FROM customer", 4))
def natural_breaks_of_many_levels(t):
    """Over 512 levels, skewed to none."""
    return stats.natural_breaks(t("customer").select(F.round("c_acctbal").alias("v")), "v", 4)


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(quantile_cont(l_extendedprice, 0.1), 4) AS p10, round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.999), 4) AS p999 FROM lineitem GROUP BY ALL""")
def quantiles_by_refinement(t):
    out = agg.quantiles(t("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", [0.1, 0.5, 0.999])
    return out.select("l_returnflag", "l_linestatus", "n", *(F.round(F.col("quantiles")[k], 4).alias(name) for k, name in enumerate(("p10", "median", "p999"))))


@query(SQL["boxplot_stats"])
def boxplot_of_large_groups(t):
    b = stats.box_plot(t("events"), "event_type", "value", large=True)
    return b.select("event_type", *(r4(c, c) for c in ("q1", "median", "q3", "low", "high")), "rank")


@query(SQL["kde_peak"])
def kde_peak_of_large_groups(t):
    return stats.density_peak(t("events"), "event_type", "value", large=True).select("event_type", r4("peak", "peak"))


@query(_KDE.replace("SELECT event_type AS g, value AS v FROM events WHERE value IS NOT NULL", "SELECT event_type AS g, log10(value) AS v FROM events WHERE value > 0") + " SELECT g AS event_type, round(x, 4) AS x, round(d, 4) AS density FROM r")
def density_curve(t):
    return stats.log_density(t("events"), "event_type", "value").select("event_type", r4("x", "x"), r4("density", "density"))


# ---------------------------------------------------------------- documents, polygons, files


def _documents(t):
    """An account document for each customer, from its columns: every seventh dormant, every fifth without last year's value, every sixth with one that is no plain number, every thirteenth cut short."""
    tag = lambda kind, name, value: F.concat(F.lit(f'<ix:{kind} name="bus:{name}" contextRef="c1"><span>'), value, F.lit(f"</span></ix:{kind}>"))
    k = F.col("c_custkey")
    last = F.when(k % 6 == 0, F.concat(F.lit("1,"), F.lpad((k % 40).cast("string"), 3, "0"))).otherwise((k % 40).cast("string"))
    body = F.concat(F.lit("<html><body>"), tag("nonNumeric", accounts.COMPANY, F.col("c_name")), F.lit("<p>text</p>"), tag("nonNumeric", accounts.END_DATE, F.lit("31 March 2024")),
                    tag("nonNumeric", accounts.DORMANT, F.when(k % 7 == 0, "true").otherwise("false")), tag("nonFraction", accounts.EMPLOYEES, (k % 50).cast("string")),
                    F.when(k % 5 != 0, tag("nonFraction", accounts.EMPLOYEES, last)).otherwise(""), F.when(k % 13 == 0, F.lit('<ix:nonNumeric name="bus:Rest">cut')).otherwise("</body></html>"))
    entry = F.concat(F.lit("Prod1_2_"), F.lpad(k.cast("string"), 8, "0"), F.lit("_"), F.when(k % 11 != 0, "20240331").otherwise(""), F.lit(".html"))
    return t("customer").select(F.concat(F.lit("Accounts-"), (k % 4).cast("string"), F.lit(".zip")).alias("archive"), entry.alias("entry"), body.alias("content"))


_LAST = "CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 6 <> 0 THEN CAST(c_custkey % 40 AS DOUBLE) END AS employees_lastyear"


@query(f"""SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS companynumber, '20240331' AS accountcode, c_name AS company, '31 March 2024' AS enddate, CASE WHEN c_custkey % 7 = 0 THEN 'true' ELSE 'false' END AS dormantstatus,
 CAST(c_custkey % 50 AS DOUBLE) AS employees_thisyear, {_LAST}, c_custkey % 13 <> 0 AS whole FROM customer WHERE c_custkey % 11 <> 0""")
def ixbrl_accounts(t):
    return accounts.accounts(accounts.file_keys(_documents(t)), ["companynumber", "accountcode"])


@query("""SELECT 'bus:' || name AS name, count(*) AS documents, count(*) + count_if(name LIKE 'Average%' AND c_custkey % 5 <> 0) AS facts FROM customer,
 (VALUES ('EntityCurrentLegalOrRegisteredName'), ('EndDateForPeriodCoveredByReport'), ('EntityDormantTruefalse'), ('AverageNumberEmployeesDuringPeriod'), ('Rest')) v(name) WHERE c_custkey % 11 <> 0 AND (name <> 'Rest' OR c_custkey % 13 = 0) GROUP BY name""")
def ixbrl_tags(t):
    return accounts.tag_frequency(accounts.shred(accounts.file_keys(_documents(t)), ["entry"]), "entry")


@query("""SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS companynumber, 'bus:EntityDormantTruefalse' AS name, 'true' AS value FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 7 = 0""")
def ixbrl_search(t):
    facts = accounts.shred(accounts.file_keys(_documents(t)), ["companynumber"])
    return accounts.search(facts, "dormant.* true").select("companynumber", "name", "value")


@query(SQL["ixbrl_search"])
def ixbrl_indexed_search(t):
    """ixbrl_search by an index to which archives are added one after the other."""
    path = scratch(t("nation").sparkSession)
    for some in (("Accounts-0.zip", "Accounts-3.zip"), ("Accounts-1.zip",), ("Accounts-2.zip", "Accounts-3.zip")):
        documents = _documents(t).where(F.col("archive").isin(*some))  # others are not shredded
        factindex.add(accounts.shred(accounts.file_keys(documents), ["archive", "companynumber"]), path)
    return factindex.search(t("nation").sparkSession, path, "dormant.* true").select("companynumber", "name", "value")


def _archives(t, folder: str, rows: str = "true") -> DataFrame:
    """The documents as zip archives in a folder; a listing of it."""
    zips.write_archives(_documents(t).where(rows), folder).collect()  # a row an archive
    return io.list_archives(t("nation").sparkSession, folder)


@query("""SELECT 'Accounts-' || (c_custkey % 4) || '.zip' AS archive, 'Prod1_2_' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || '_' || CASE WHEN c_custkey % 11 <> 0 THEN '20240331' ELSE '' END || '.html' AS entry FROM customer""")
def archive_listing(t):
    listed = zips.Archives(_archives(t, scratch(t("nation").sparkSession))).entries()
    return listed.where("size > 0").select(x.base_name(F.col("archive")).alias("archive"), "entry")


def _extracts_of_archives(t) -> str:
    """Two runs over a folder that grows, for known companies only; the second one meets the first one's archives again."""
    spark = t("nation").sparkSession
    folder, out = scratch(spark), scratch(spark)
    known = t("customer").where("c_custkey % 3 <> 0").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("companynumber"))
    for rows in ("c_custkey % 4 < 2", "c_custkey % 4 >= 2"):
        pipelines.account_extracts(_archives(lambda name: t(name).where(rows) if name == "customer" else t(name), folder), out, known)
    return out


@query(f"""SELECT 'Accounts-' || (c_custkey % 4) || '.zip' AS archive, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS companynumber, '20240331' AS accountcode, c_name AS company, '31 March 2024' AS enddate,
 CASE WHEN c_custkey % 7 = 0 THEN 'true' ELSE 'false' END AS dormantstatus, CAST(c_custkey % 50 AS DOUBLE) AS employees_thisyear, {_LAST} FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 3 <> 0 AND c_custkey % 13 <> 0""")
def account_extracts(t):
    return pipelines.extracted(t("nation").sparkSession, _extracts_of_archives(t)).drop("entry").withColumn("archive", x.base_name(F.col("archive")))


@query("""SELECT 'Accounts-' || (c_custkey % 4) || '.zip' AS archive, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS companynumber, 'a fact tag does not close' AS problem FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 3 <> 0 AND c_custkey % 13 = 0""")
def account_problems(t):
    return pipelines.extracted(t("nation").sparkSession, _extracts_of_archives(t), problems=True).select(x.base_name(F.col("archive")).alias("archive"), "companynumber", "problem")


@query("""SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CompanyNumber, 'Smith, ' || chr(10) || c_name AS CompanyName, CASE WHEN c_custkey % 9 <> 0 THEN c_address_line END AS RegAddress_AddressLine1, c_mktsegment AS CompanyStatus, DATE '2025-03-01' AS snapshot_date
 FROM (SELECT *, 'Road ' || c_nationkey AS c_address_line FROM customer)""")
def register_snapshot(t):
    """The register as published: CSV in zip archives."""
    c = t("customer")
    spark = c.sparkSession
    files, folder, out = scratch(spark), scratch(spark), scratch(spark)
    c.select(F.concat(F.lit("Smith, \n"), "c_name").alias("CompanyName"), F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias(" CompanyNumber"), F.when(F.col("c_custkey") % 9 != 0, F.concat(F.lit("Road "), "c_nationkey")).alias("RegAddress.AddressLine1"),
             F.col("c_mktsegment").alias("CompanyStatus"), F.lit("x").alias("Dropped")).write.option("header", True).option("maxRecordsPerFile", 100_000).csv(files)
    csv = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(files)
    zips.write_archives(csv.select(F.concat(x.base_name(F.col("path")), F.lit(".zip")).alias("archive"), F.lit("BasicCompanyData.csv").alias("entry"), "content"), folder).collect()  # a row a file
    pipelines.register_snapshot(spark, folder, out, "2025-03-01")
    return io.read_snapshots(spark, out).select("CompanyNumber", "CompanyName", "RegAddress_AddressLine1", "CompanyStatus", F.col("snapshot_date").cast("date").alias("snapshot_date"))


@query("SELECT n_name AS name, 'Nation ' || n_name || chr(10) AS content FROM nation")
def loose_documents(t):
    path = scratch(t("nation").sparkSession)
    t("nation").select(F.col("n_name").alias("name"), F.concat(F.lit("Nation "), "n_name").alias("value")).write.partitionBy("name").text(path)
    found = io.read_documents(t("nation").sparkSession, f"{path}/*", "*.txt")
    return found.select(F.replace(F.regexp_extract("filelocation", "name=([^/]*)/", 1), F.lit("%20"), F.lit(" ")).alias("name"), "content")


def _rings(*rings: list[tuple]) -> F.Column:
    """A polygon of rings of points of columns or numbers."""
    number = lambda v: (v if isinstance(v, F.Column) else F.lit(v)).cast("double")
    return F.array(*(F.array(*(F.struct(number(a).alias("x"), number(b).alias("y")) for a, b in ring)) for ring in rings))


_ZONES = """WITH z AS (SELECT p_partkey AS small, p_partkey % 97 AS x0, p_size AS y0 FROM part),
 zb AS (SELECT small, x0, y0, x0 + 4 AS x1, y0 + 1 AS y1 FROM z UNION ALL SELECT small, x0, y0 + 1, x0 + 1, y0 + 3 FROM z),
 l AS (SELECT a * 10 + b AS large, a * 10.0 AS x0, b * 10.0 AS y0 FROM range(11) t(a), range(7) u(b)),
 lb AS (SELECT large, x0, y0, x0 + 10 AS x1, y0 + 10 AS y1, 1 AS s FROM l UNION ALL SELECT large, x0 + 3, y0 + 3, x0 + 6, y0 + 5, -1 FROM l WHERE large % 2 = 0
  UNION ALL SELECT large, x0 + 3, y0 + 3, x0 + 6, y0 + 5, 1 FROM l WHERE large % 6 = 0),
 o AS (SELECT small, large, sum(s * (least(zb.x1, lb.x1) - greatest(zb.x0, lb.x0)) * (least(zb.y1, lb.y1) - greatest(zb.y0, lb.y0))) AS area FROM zb JOIN lb ON zb.x0 < lb.x1 AND lb.x0 < zb.x1 AND zb.y0 < lb.y1 AND lb.y0 < zb.y1 GROUP BY ALL HAVING area > 1e-9),
 s AS (SELECT *, round(area / sum(area) OVER (PARTITION BY small) * 100, 6) AS pct, count(*) OVER (PARTITION BY small) AS group_count FROM o),
 k AS (SELECT small, large, round(area, 4) AS area, pct, group_count FROM (SELECT *, max(pct) OVER (PARTITION BY small) AS m FROM s) WHERE pct = m)"""


def _zones(t):
    """L-shaped small zones over large ones of squares, every second with a hole, every sixth with an island in it."""
    p = t("part")
    a, b = (F.col("p_partkey") % 97).cast("double"), F.col("p_size").cast("double")
    ell = _rings([(a, b), (a + 4, b), (a + 4, b + 1), (a + 1, b + 1), (a + 1, b + 3), (a, b + 3)])
    small = p.select(F.col("p_partkey").alias("small_id"), F.array(ell).alias("parts"))
    i, j = F.floor(F.col("id") / 7) * 10.0, (F.col("id") % 7) * 10.0
    outer, inner = [(i, j), (i + 10, j), (i + 10, j + 10), (i, j + 10), (i, j)], [(i + 3, j + 3), (i + 6, j + 3), (i + 6, j + 5), (i + 3, j + 5)]
    large_id = F.floor(F.col("id") / 7) * 10 + F.col("id") % 7
    parts = F.when(large_id % 6 == 0, F.array(_rings(outer, inner), _rings(inner))).when(large_id % 2 == 0, F.array(_rings(outer, inner))).otherwise(F.array(_rings(outer)))
    large = p.sparkSession.range(11 * 7).select(large_id.alias("large_id"), parts.alias("parts"))
    return geo.largest_overlap(large, small, "large_id", "small_id", 10.0)


@query(_ZONES + " SELECT * FROM k")
def zone_overlap_lookup(t):
    return _zones(t).select("small", "large", r4("area", "area"), "pct", "group_count")


@query(_ZONES + " SELECT round(avg(CAST(pct = 100 AS INT)) * 100, 4) AS fully_inside FROM k")
def zones_fully_inside(t):
    return geo.share_inside(_zones(t)).select(r4("fully_inside", "fully_inside"))


@query("""SELECT o_custkey AS a, o_orderkey AS b, round(0.5 * (4 - (o_orderkey % 5) * 0.5) * (4 - (o_orderkey % 5) * 0.5), 6) AS area FROM orders""")
def triangle_overlap(t):
    """A right triangle of legs 4 at each firm, and a square that covers it from k / 2 on: what both share is a triangle of legs 4 - k / 2."""
    o = t("orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") * 10.0).alias("x"), (F.col("o_orderkey") % 5 * 0.5).alias("k"))
    x0, k = F.col("x"), F.col("k")
    large = o.select("o_orderkey", F.array(_rings([(x0, 0), (x0, 4), (x0 + 4, 0)])).alias("parts"))
    small = o.select("o_orderkey", F.array(_rings([(x0 + k, -1), (x0 + k + 5, -1), (x0 + k + 5, 5), (x0 + k, 5)])).alias("parts"))
    found = geo.overlaps(large, small, "o_orderkey", "o_orderkey", 100.0)
    return link.lookup(found, t("orders"), "large", "o_orderkey").select(F.col("o_custkey").alias("a"), F.col("small").alias("b"), F.round("area", 6).alias("area"))


@query("SELECT n_name AS name, CAST(CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END AS INT) AS parts, CAST(n_nationkey AS DOUBLE) AS x0, CAST(n_nationkey + CASE WHEN n_nationkey % 2 = 0 THEN 30 ELSE 2 END AS DOUBLE) AS x1 FROM nation")
def polygon_layer(t):
    """Boundaries of a GeoJSON collection for each region: nations with an island are multi-polygons."""
    n, spark = F.col("n_nationkey"), t("nation").sparkSession
    ring = lambda a, b: F.array(*(F.array(F.lit(x).cast("double") if isinstance(x, int) else x.cast("double"), F.lit(y).cast("double")) for x, y in ((a, 0), (b, 0), (b, 3), (a, 3), (a, 0))))
    one, two = F.to_json(F.array(ring(n, n + 2))), F.to_json(F.array(F.array(ring(n, n + 2)), F.array(ring(n + 20, n + 30))))
    shape = F.concat(F.lit('{"type":"Feature","properties":{"name":"'), "n_name", F.lit('"},"geometry":{"type":"'), F.when(n % 2 == 0, "MultiPolygon").otherwise("Polygon"), F.lit('","coordinates":'), F.when(n % 2 == 0, two).otherwise(one), F.lit("}}"))
    files = t("nation").groupBy("n_regionkey").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(shape), ","), F.lit("]}")).alias("value"))  # a region's nations are few
    path = scratch(spark)
    files.write.partitionBy("n_regionkey").text(path)
    found = geo.boxed(io.read_polygons(spark, path, "name:string"))
    return found.select("name", F.size("parts").alias("parts"), "x0", "x1")


@query("SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings")
def geojson_features(t):
    p = points(t)
    path = scratch(p.sparkSession)
    io.write_features(p, path, "x", "y", ["vec_id", "label"])
    return io.read_points(p.sparkSession, path, "vec_id:bigint,label:int")


@query("SELECT c_custkey, c_name, c_mktsegment, c_custkey % 2 AS half FROM customer")
def snapshot_roundtrip(t):
    c = t("customer")
    path = scratch(c.sparkSession)
    for k in (0, 1):
        c.where(f"c_custkey % 2 = {k}").select("c_custkey", "c_name", "c_mktsegment", (F.col("c_custkey") % 2).alias("half")).write.mode("overwrite").parquet(f"{path}/part={k}")
    return io.read_snapshots(c.sparkSession, path).drop("source_file", "part")


@query("SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CompanyNumber, 'Smith, ' || c_name AS CompanyName, c_mktsegment AS CompanyStatus FROM customer")
def csv_roundtrip(t):
    c = t("customer")
    path = scratch(c.sparkSession)
    c.select(F.concat(F.lit("Smith, "), "c_name").alias("CompanyName"), F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("CompanyNumber"), F.col("c_mktsegment").alias("CompanyStatus"), F.lit("x").alias("Dropped")).write.option("header", True).csv(path)
    return io.read_register(c.sparkSession, path)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus AS archive FROM orders")
def partitioned_extracts(t):
    o = t("orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("archive"))
    path = scratch(o.sparkSession)
    io.write_partitioned(o, path)
    io.write_partitioned(o.where("archive = 'F'"), path)  # a rerun of one archive leaves the others
    return o.sparkSession.read.parquet(path)


# ---------------------------------------------------------------- pipelines


@query("SELECT n_name, r_name, r_name = 'EUROPE' AS highlighted FROM nation JOIN region ON n_regionkey = r_regionkey")
def region_flag(t):
    return link.lookup(t("nation"), t("region"), "n_regionkey", "r_regionkey", "inner").select("n_name", "r_name", (F.col("r_name") == "EUROPE").alias("highlighted"))


@query("""SELECT c_custkey, n_name, o_orderkey, d FROM (SELECT *, max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS m, CAST(o_orderdate AS DATE) AS d FROM orders) JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 WHERE d = m AND c_acctbal > 0""")
def pipe_linked(t):
    firms = link.lookup(t("customer"), t("nation"), "c_nationkey", "n_nationkey", "inner")
    return pipelines.linked(firms, agg.latest(_extracts(t), "o_custkey", "d"), "c_custkey", "o_custkey", F.col("c_acctbal") > 0).select("c_custkey", "n_name", "o_orderkey", "d")


def _sectors(t):
    """A sector lookup read from CSV: a code for each size of a part but the largest, and the dormant one."""
    spark, path = t("part").sparkSession, scratch(t("part").sparkSession)
    codes = t("part").where("p_size < 50").select((10000 + F.col("p_size")).cast("string").alias("code")).distinct().union(spark.range(1).select(F.lit("99999")))
    codes.select(F.col("code").alias("SIC_5DIGIT_CODE"), F.concat(F.lit("Sector "), "code").alias("SIC_5DIGIT_NAME"), F.lit("").alias("SIC_3DIGIT_NAME"), F.substring("code", 1, 2).alias("SIC_2DIGIT_CODE"), F.substring("code", 1, 2).alias("SIC_2DIGIT_CODE_NUMERIC"), F.lit("two").alias("SIC_2DIGIT_NAME"), F.lit("A").alias("SIC_SECTION_NAME")).write.option("header", True).csv(path)
    return io.read_lookup(spark, path, io.SIC)


def _with_sic(t):
    """Parts with a sector text; every seventh is dormant, every ninth has none."""
    k = F.col("p_partkey")
    return t("part").withColumn("sic_text", F.when(k % 9 == 0, None).when(k % 7 == 0, "99999 - Dormant Company").otherwise(F.concat((10000 + F.col("p_size")).cast("string"), F.lit(" - text"))))


@query("""SELECT p_partkey, CAST(10000 + p_size AS VARCHAR) AS sic5, CASE WHEN p_size < 50 THEN 'Sector ' || (10000 + p_size) END AS SIC_5DIGIT_NAME, CASE WHEN p_size < 50 THEN 10.0::DOUBLE END AS SIC_2DIGIT_CODE_NUMERIC FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 7 <> 0""")
def pipe_enriched(t):
    return pipelines.with_sectors(_with_sic(t), _sectors(t), "sic_text").select("p_partkey", "sic5", "SIC_5DIGIT_NAME", "SIC_2DIGIT_CODE_NUMERIC")


@query("""WITH l AS (SELECT nullif(l_quantity, 10) AS b, nullif(l_linenumber, 3) - 1 AS a FROM lineitem) SELECT round(avg(CAST(b IS NOT NULL AS INT)) * 100, 4) AS this_present, round(avg(CAST(a IS NOT NULL AND b IS NOT NULL AS INT)) * 100, 4) AS both_present,
 round(avg(CAST(b > 0 AS INT)) * 100, 4) AS this_positive, round(avg(CAST(a > 0 OR b > 0 AS INT)) * 100, 4) AS either_positive, round(avg(CAST(a <> 0 AND b <> 0 AS INT)) * 100, 4) AS both_nonzero, round(avg(CAST(a > 0 AND b > 0 AS INT)) * 100, 4) AS both_positive FROM l""")
def pipe_coverage(t):
    li = t("lineitem").select(F.nullif("l_quantity", F.lit(10.0)).alias("b"), (F.nullif("l_linenumber", F.lit(3)) - 1).alias("a"))
    out = pipelines.coverage(li, "a", "b")
    return out.select(*(r4(c, c) for c in out.columns))


@query("SELECT o_orderkey, 'o_totalprice' AS year, o_totalprice AS employees FROM orders WHERE o_totalprice > 300000 UNION ALL SELECT o_orderkey, 'half', o_totalprice / 2 FROM orders WHERE o_totalprice / 2 > 300000")
def pipe_outliers(t):
    return pipelines.outliers(t("orders").withColumn("half", F.col("o_totalprice") / 2), ["o_orderkey"], ["o_totalprice", "half"], 300000)


@query("""SELECT in_a, in_b, count(*) AS n FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders) AS in_a, regexp_matches(c_mktsegment, '(?i)auto') AS in_b FROM customer) WHERE in_a OR in_b GROUP BY ALL""")
def pipe_region_subset(t):
    return pipelines.region_subset(t("customer"), t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "c_mktsegment", "auto")


@query("""WITH k AS (SELECT p_brand, (p_retailprice - p_size) / p_size * 100 AS c FROM part WHERE p_size >= 10 AND p_retailprice > 0)
 SELECT p_brand, round(avg(c), 4) AS stat, CAST(row_number() OVER (ORDER BY avg(c), p_brand) AS INT) AS rank FROM k GROUP BY 1""")
def pipe_sector_change(t):
    return pipelines.sector_change(t("part"), "p_brand", "p_size", "p_retailprice", 10).select("p_brand", r4("stat", "stat"), "rank")


@query("""WITH c AS (SELECT c_mktsegment AS status, c_custkey % 4 <> 0 AS hit, c_custkey % 3 = 0 AS bare, c_custkey % 5 = 0 AS dormant FROM customer), o AS (SELECT o_custkey, o_totalprice > 50000 AS has FROM orders)
 SELECT 'no match' AS measure, NULL AS category, NULL AS other, round(count_if(NOT hit) * 100.0 / count(*), 4) AS value FROM c UNION ALL SELECT 'no match but address', NULL, NULL, round(count_if(NOT hit AND bare) * 100.0 / count(*), 4) FROM c
 UNION ALL SELECT 'status', status, NULL, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) FROM c GROUP BY status UNION ALL SELECT 'dormant within status', status, CAST(dormant AS VARCHAR), round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY status), 4) FROM c GROUP BY status, dormant
 UNION ALL SELECT 'accounts per company', CAST(n AS VARCHAR), NULL, count(*) FROM (SELECT count(*) AS n FROM o GROUP BY o_custkey) GROUP BY n UNION ALL SELECT 'has employees', CAST(has AS VARCHAR), NULL, count(*) FROM o GROUP BY has""")
def pipe_quality(t):
    k = F.col("c_custkey")
    register = t("customer").select("c_custkey", F.col("c_mktsegment").alias("status"), F.when(k % 3 != 0, "S1 2AB").alias("postcode"), F.lit("1 High Street").alias("address"), F.when(k % 5 == 0, "99999 - Dormant Company").otherwise("10001 - text").alias("sic"))
    extracts = t("orders").select("o_custkey", F.when(F.col("o_totalprice") > 50000, 1.0).alias("staff"))
    report = pipelines.quality_report(register, register.where("c_custkey % 4 <> 0"), extracts, "c_custkey", "postcode", "address", "status", "sic", "o_custkey", "staff")
    return report.withColumn("value", F.round("value", 4))


@query("SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings WHERE label = 3 AND vec_id % 2 = 0")
def pipe_layers(t):
    p, path = points(t), scratch(t("nation").sparkSession)
    pipelines.sector_layers(p, path, (F.col("label") == 3) & (F.col("vec_id") % 2 == 0), "x", "y", ["vec_id"])
    return io.read_points(p.sparkSession, path, "vec_id:bigint")


@query("""SELECT l_partkey AS p_partkey, l_orderkey, l_linenumber, p_name, CASE WHEN p_partkey % 9 = 0 OR (p_size = 50 AND p_partkey % 7 <> 0) THEN NULL WHEN p_partkey % 7 = 0 THEN 'Sector 99999' ELSE 'Sector ' || (10000 + p_size) END AS SIC_5DIGIT_NAME
 FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey WHERE l_quantity > 10""")
def pipe_app(t):
    lines = t("lineitem").select("l_partkey", "l_orderkey", "l_linenumber", F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("staff"))
    out = pipelines.app_extract(_with_sic(t).where("p_size > 10"), lines, _sectors(t), "p_partkey", "l_partkey", "sic_text", "staff")
    return out.select("p_partkey", "l_orderkey", "l_linenumber", "p_name", "SIC_5DIGIT_NAME")


@query("""WITH e AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders), w AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n, max(d) OVER (PARTITION BY o_custkey) AS m, count_if(d IS NULL) OVER (PARTITION BY o_custkey) AS z FROM e)
 SELECT o_custkey, o_orderkey, d FROM w WHERE n = 1 OR (z = 0 AND d = m)""")
def stream_latest(t):
    """Accounts that arrive in three parts, each taken in by a run of a stream: the latest of each company as of the last one."""
    spark = incremental.stateful_session(t("nation").sparkSession, 8)
    source, checkpoint = scratch(spark), scratch(spark)
    rows = _extracts(t, 17)
    for k in range(3):
        rows.where(f"o_orderkey % 3 = {k}").write.mode("append").parquet(source)
        incremental.keep_latest(spark.readStream.schema(rows.schema).parquet(source), "o_custkey", "d", checkpoint)
    return incremental.latest_rows(t("nation").sparkSession, checkpoint)
