"""Projections, filters, sorts and reshaping: PRJ*, FLT*, SRT*, SET*."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import dates, text, values
from ..operators import ranking, reshape
from ..sinks.merge import retry_only
from .registry import query
from .roles import HOME_MALL, QUALITY_TYPES, SPECIAL_CAT4, Roles, _list, money

PART_LABELS = {"p_partkey": "商品id", "p_name": "商品名称", "p_brand": "四级类目名称"}


@query("prj01", 'SELECT p_partkey AS "商品id", p_name AS "商品名称", p_brand AS "四级类目名称" FROM part')
def prj01(r: Roles) -> DataFrame:
    return reshape.relabel_columns(r.table("part"), PART_LABELS)


@query("prj02", "SELECT p_brand, p_partkey FROM part")
def prj02(r: Roles) -> DataFrame:
    return reshape.select_existing(r.table("part"), ["p_brand", "no_such_column", "p_partkey"])


@query("prj03", "SELECT c_custkey, c_acctbal FROM customer")
def prj03(r: Roles) -> DataFrame:
    df = r.table("customer").select("c_custkey", "c_acctbal")
    return reshape.drop_internal(df.withColumn("_work", F.col("c_acctbal") * 2))


@query("prj04", "SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS rating, CAST(NULL AS VARCHAR) AS remark FROM supplier")
def prj04(r: Roles) -> DataFrame:
    wanted = T.StructType.fromDDL("s_suppkey bigint, s_name string, rating double, remark string")
    return reshape.pad_columns(r.table("supplier").select("s_suppkey", "s_name"), wanted)


@query(
    "prj05",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'small'
    WHEN c_mktsegment = 'BUILDING' THEN 'builder' END AS label FROM customer""",
)
def prj05(r: Roles) -> DataFrame:
    balance = F.col("c_acctbal")
    label = values.first_match(
        [(balance < 0, "debt"), (balance < 5000, "small"), (F.col("c_mktsegment") == "BUILDING", "builder")]
    )
    return r.table("customer").select("c_custkey", label.alias("label"))


@query(
    "prj06",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '已完成' WHEN 'O' THEN '进行中' ELSE o_orderstatus END AS status
    FROM orders""",
)
def prj06(r: Roles) -> DataFrame:
    status = values.relabel("o_orderstatus", {"F": "已完成", "O": "进行中"})
    return r.table("orders").select("o_orderkey", status.alias("status"))


@query(
    "prj07",
    f"""SELECT p_partkey, CASE WHEN p_brand IN ({_list(SPECIAL_CAT4)}) THEN 1 ELSE 0 END AS is_special,
    CASE WHEN NULLIF(p_brand, 'Brand#1') IN ({_list(SPECIAL_CAT4)}) THEN 1 ELSE 0 END AS is_special_or_unknown FROM part""",
)
def prj07(r: Roles) -> DataFrame:
    special = values.flag(values.is_one_of("p_brand", SPECIAL_CAT4))
    holed = F.nullif(F.col("p_brand"), F.lit("Brand#1"))
    return r.table("part").select(
        "p_partkey",
        special.alias("is_special"),
        values.flag(values.is_one_of(holed, SPECIAL_CAT4)).alias("is_special_or_unknown"),
    )


@query(
    "prj08",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'labelled' ELSE 'open' END AS state
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def prj08(r: Roles) -> DataFrame:
    labels = r.table("labels").select("doc_id", F.lit(1).alias("hit"))
    docs = r.table("documents").select("doc_id").join(labels, "doc_id", "left")
    return docs.select("doc_id", values.presence("hit", "labelled", "open").alias("state"))


@query(
    "prj09",
    """SELECT user_id || '_' || strftime(dt, '%Y-%m-%d') AS row_key, n FROM (
    SELECT user_id, CAST(ts AS DATE) AS dt, COUNT(*) AS n FROM events GROUP BY 1, 2)""",
)
def prj09(r: Roles) -> DataFrame:
    daily = r.table("events").groupBy("user_id", F.to_date("ts").alias("dt")).agg(F.count(F.lit(1)).alias("n"))
    return reshape.with_row_key(daily, ["user_id", "dt"]).select("row_key", "n")


@query(
    "prj10",
    """SELECT d.doc_id, l.quality, COALESCE(CAST(l.quality AS VARCHAR), '') AS quality_bak
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def prj10(r: Roles) -> DataFrame:
    docs = r.table("documents").select("doc_id").join(r.table("labels").select("doc_id", "quality"), "doc_id", "left")
    return reshape.backup_columns(docs, ["quality"])


@query("prj11", "SELECT l_orderkey, l_linenumber, l_discount * 100 AS l_discount, l_tax * 100 AS l_tax FROM lineitem")
def prj11(r: Roles) -> DataFrame:
    df = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return reshape.scale_columns(df, ["l_discount", "l_tax", "absent"])


@query(
    "flt01",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 200000 AND o_orderstatus <> 'P' AND o_custkey > 0",
)
def flt01(r: Roles) -> DataFrame:
    big = (F.col("o_totalprice") >= 200000) & (F.col("o_orderstatus") != "P") & (F.col("o_custkey") > 0)
    return r.table("orders").where(big).select("o_orderkey", "o_totalprice")


@query(
    "flt02",
    f"""SELECT o_orderkey, 'in' AS side FROM orders WHERE o_orderpriority IN ({_list(QUALITY_TYPES)})
    UNION ALL SELECT o_orderkey, 'not in' FROM orders
    WHERE CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END NOT IN ({_list(QUALITY_TYPES)})""",
)
def flt02(r: Roles) -> DataFrame:
    """A null is in neither list."""
    kind = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    orders = r.table("orders")
    inside = orders.where(values.is_one_of("o_orderpriority", QUALITY_TYPES)).select("o_orderkey", F.lit("in").alias("side"))
    outside = orders.where(~values.is_one_of(kind, QUALITY_TYPES)).select("o_orderkey", F.lit("not in").alias("side"))
    return inside.unionByName(outside)


@query(
    "flt03",
    """SELECT d.doc_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    WHERE COALESCE(l.quality, 0) + COALESCE(l.toxic, 0) > 0""",
)
def flt03(r: Roles) -> DataFrame:
    docs = r.table("documents").select("doc_id").join(r.table("labels"), "doc_id", "left")
    return docs.where(values.any_positive("quality", "toxic")).select("doc_id")


@query(
    "flt04",
    """SELECT l_discount, COUNT(*) AS n FROM lineitem WHERE l_discount BETWEEN 0.03 AND 0.07 AND l_discount <> 0.07
    GROUP BY l_discount""",
)
def flt04(r: Roles) -> DataFrame:
    rows = r.table("lineitem").where(values.half_open("l_discount", 0.03, 0.07))
    return rows.groupBy("l_discount").agg(F.count(F.lit(1)).alias("n"))


@query("flt05", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'red|blue|ring')")
def flt05(r: Roles) -> DataFrame:
    return r.table("part").where(text.matches_any("p_name", ["red", "blue", "ring"])).select("p_partkey", "p_name")


@query(
    "flt06",
    """SELECT doc_id, CASE WHEN instr(text, 'the') > 0 THEN 1 ELSE 0 END AS has_the FROM documents
    WHERE instr(text, 'license') = 0""",
)
def flt06(r: Roles) -> DataFrame:
    docs = r.table("documents").where(~text.has("text", "license"))
    return docs.select("doc_id", values.flag(text.has("text", "the")).alias("has_the"))


@query(
    "flt07",
    """SELECT o_custkey, COUNT(DISTINCT CASE WHEN o_totalprice > 300000 THEN o_orderkey END) AS n_big
    FROM orders GROUP BY o_custkey HAVING n_big > 0""",
)
def flt07(r: Roles) -> DataFrame:
    from ..operators.metrics import Metrics, aggregate

    big = Metrics(distincts={"n_big": ("o_orderkey", F.col("o_totalprice") > 300000)})
    return aggregate(r.table("orders"), ["o_custkey"], big).where(F.col("n_big") > 0)


@query(
    "flt08",
    f"""SELECT dt, cat1, cat4, mall_id, ROW_NUMBER() OVER (PARTITION BY dt, cat1, cat4
      ORDER BY COALESCE(delivered_amt, 0) DESC, mall_id) AS amt_rank FROM mall_cat4 QUALIFY mall_id = {HOME_MALL}""",
)
def flt08(r: Roles) -> DataFrame:
    ranked = ranking.rank_then_keep(
        r.mall_cat4_with("delivered_amt"), ["dt", "cat1", "cat4"], {"amt_rank": "delivered_amt"}, ["mall_id"], F.col("mall_id") == HOME_MALL
    )
    return ranked.select("dt", "cat1", "cat4", "mall_id", F.col("amt_rank").cast("bigint").alias("amt_rank"))


@query(
    "flt09",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE CAST(o_orderdate AS DATE) <= DATE '1998-06-15' AND CAST(l_shipdate AS DATE) >= DATE '1998-06-15'""",
)
def flt09(r: Roles) -> DataFrame:
    """Lines under way on a day: ordered on or before it, shipped on or after it."""
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = r.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    both = lines.join(orders, "l_orderkey")
    return both.where(dates.covers("o_orderdate", "l_shipdate", date(1998, 6, 15))).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query("flt10", "SELECT p_partkey, p_size FROM part WHERE p_size > 20 AND p_type IN ('PROMO', 'LARGE') OR p_brand = 'Brand#3'")
def flt10(r: Roles) -> DataFrame:
    expression = "p_size > 20 and p_type in ('PROMO', 'LARGE') or p_brand = 'Brand#3'"
    return r.table("part").where(expression).select("p_partkey", "p_size")


@query(
    "flt11",
    """SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
    WHERE quality IS NOT NULL OR toxic IS NOT NULL""",
)
def flt11(r: Roles) -> DataFrame:
    docs = r.table("documents").select("doc_id").join(r.table("labels"), "doc_id", "left")
    return docs.dropna(how="all", subset=["quality", "toxic"])


LAST_EVENT = """(SELECT user_id, event_type FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"""


@query(
    "flt12",
    f"""SELECT c_custkey, c_name FROM customer WHERE c_custkey IN
    (SELECT user_id FROM {LAST_EVENT} WHERE event_type = 'error')""",
)
def flt12(r: Roles) -> DataFrame:
    """Stores whose last event failed."""
    from ..operators.events import current_failures

    failed = current_failures(r.table("events"), ["user_id"], ["ts", "event_id"], "event_type", "error")
    stores = r.table("customer").select("c_custkey", "c_name")
    return retry_only(stores, failed.select(F.col("user_id").alias("c_custkey")), "c_custkey")


@query(
    "srt01",
    """SELECT o_custkey, status, amt, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY COALESCE(amt, 0) DESC, status) AS pos
    FROM (SELECT o_custkey, o_orderstatus AS status, CAST(SUM(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(12,2)) END) AS DOUBLE) AS amt
      FROM orders GROUP BY 1, 2)""",
)
def srt01(r: Roles) -> DataFrame:
    """Descending window order in which null counts as 0."""
    amount = F.sum(F.when(F.col("o_orderstatus") != "P", money("o_totalprice"))).cast("double")
    per = r.table("orders").groupBy("o_custkey", F.col("o_orderstatus").alias("status")).agg(amount.alias("amt"))
    return per.withColumn("pos", ranking.rank_desc(["o_custkey"], "amt", ["status"]).cast("bigint"))


@query(
    "srt02",
    """SELECT o_custkey, o_orderkey, o_totalprice, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
    FROM orders QUALIFY rank <= 3""",
)
def srt02(r: Roles) -> DataFrame:
    orders = r.table("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    top = ranking.top_k(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 3)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "srt03",
    """SELECT 'customer' AS report, c_custkey AS id FROM (SELECT c_custkey FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 20)
    UNION ALL SELECT 'supplier', s_suppkey FROM (SELECT s_suppkey FROM supplier ORDER BY s_suppkey LIMIT 50)""",
)
def srt03(r: Roles) -> DataFrame:
    """Bounded extracts for a report: the first 20 and 50 rows in key order."""
    debtors = r.table("customer").where("c_acctbal < 0").orderBy("c_custkey").limit(20)
    suppliers = r.table("supplier").orderBy("s_suppkey").limit(50)
    return debtors.select(F.lit("customer").alias("report"), F.col("c_custkey").alias("id")).unionByName(
        suppliers.select(F.lit("supplier").alias("report"), F.col("s_suppkey").alias("id"))
    )


@query(
    "set01",
    """SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""",
)
def set01(r: Roles) -> DataFrame:
    customer = r.table("customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")
    )
    supplier = r.table("supplier").select(
        F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id")
    )
    return reshape.union_all([customer, supplier])


@query(
    "set02",
    """SELECT DISTINCT CAST(ts AS DATE) AS dt, user_id, CASE event_type WHEN 'purchase' THEN 'bought' ELSE 'joined' END AS label, 1 AS mark
    FROM events WHERE event_type IN ('purchase', 'signup')""",
)
def set02(r: Roles) -> DataFrame:
    """Wide flags, one as text and one as a number, to rows."""
    kind = F.col("event_type")
    wide = r.table("events").groupBy(F.to_date("ts").alias("dt"), "user_id").agg(
        F.when(F.max(values.flag(kind == "purchase")) == 1, " 是").otherwise("否").alias("has_purchase"),
        F.max(values.flag(kind == "signup")).alias("has_signup"),
    )
    return reshape.unpivot_flags(
        wide, ["dt", "user_id"], {"has_purchase": "bought", "has_signup": "joined", "absent": "x"}, "label", "mark"
    )


@query("set03", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def set03(r: Roles) -> DataFrame:
    return ranking.one_per_key_any(r.table("lineitem"), ["l_partkey", "l_suppkey"])

