"""Scalar functions: SCL01–SCL31."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import adjust, coerce, dates, text, values
from ..functions.coerce import FieldType
from .registry import query
from .roles import Roles, _list, money

DAY_SQL = "CAST(o_orderdate AS DATE)"


def _docs(r: Roles) -> DataFrame:
    return r.table("documents").select("doc_id", "lang", "source").join(r.table("labels"), "doc_id", "left")


@query(
    "scl01",
    """SELECT doc_id, COALESCE(quality, -1) AS quality, COALESCE(toxic, quality, 7) AS first_known
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def scl01(r: Roles) -> DataFrame:
    return _docs(r).select(
        "doc_id", values.nz("quality", -1).alias("quality"), F.coalesce("toxic", "quality", F.lit(7)).alias("first_known")
    )


@query(
    "scl02",
    """SELECT doc_id, CASE WHEN quality > 0 THEN 'good' ELSE 'rest' END AS mark,
    CASE WHEN toxic IS NULL THEN 1 ELSE 0 END AS unknown, CASE WHEN toxic IS NOT NULL THEN 1 ELSE 0 END AS known
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def scl02(r: Roles) -> DataFrame:
    return _docs(r).select(
        "doc_id",
        F.when(F.col("quality") > 0, "good").otherwise("rest").alias("mark"),
        values.flag(F.col("toxic").isNull()).alias("unknown"),
        values.flag(F.col("toxic").isNotNull()).alias("known"),
    )


@query(
    "scl03",
    """SELECT l_orderkey, l_linenumber, CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS refund
    FROM lineitem""",
)
def scl03(r: Roles) -> DataFrame:
    """Half-up rounding, exact on decimals."""
    refund = money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")
    return r.table("lineitem").select("l_orderkey", "l_linenumber", F.round(refund, 2).cast("double").alias("refund"))


@query("scl04", f"SELECT o_orderkey, {DAY_SQL} - 30 AS before, {DAY_SQL} + 7 AS after FROM orders")
def scl04(r: Roles) -> DataFrame:
    day = F.to_date("o_orderdate")
    return r.table("orders").select("o_orderkey", F.date_add(day, -30).alias("before"), F.date_add(day, 7).alias("after"))


@query("scl05", f"SELECT o_orderkey, {DAY_SQL} AS day, {DAY_SQL} AS parsed FROM orders")
def scl05(r: Roles) -> DataFrame:
    printed = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return r.table("orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.to_date(printed, "yyyy-MM-dd HH:mm:ss").alias("parsed")
    )


@query("scl06", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-01') AS month FROM orders")
def scl06(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", dates.month_key("o_orderdate").alias("month"))


@query("scl07", f"SELECT o_orderkey, CASE WHEN last_day({DAY_SQL}) = {DAY_SQL} THEN 1 ELSE 0 END AS is_last FROM orders")
def scl07(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", dates.is_month_end("o_orderdate").alias("is_last"))


@query("scl08", "SELECT page_id, CAST(instr(url, 'example') AS INTEGER) AS pos FROM pages")
def scl08(r: Roles) -> DataFrame:
    return r.table("pages").select("page_id", F.instr("url", "example").alias("pos"))


@query(
    "scl09",
    r"""SELECT page_id, regexp_replace(url, '[0-9]', '', 'g') AS no_digits,
    regexp_replace('["' || url || '"]', '\[|\]', '', 'g') AS no_brackets,
    regexp_replace('"' || url || '"', '\?page[^"]*', '', 'g') AS no_query FROM pages""",
)
def scl09(r: Roles) -> DataFrame:
    quoted = F.concat(F.lit('"'), "url", F.lit('"'))
    return r.table("pages").select(
        "page_id",
        text.strip_digits("url").alias("no_digits"),
        text.strip_brackets(F.concat(F.lit("["), quoted, F.lit("]"))).alias("no_brackets"),
        text.strip_query(quoted, "page").alias("no_query"),
    )


@query("scl10", "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS code FROM orders")
def scl10(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", text.first_part("o_orderpriority").alias("code"))


@query(
    "scl11",
    """SELECT doc_id, '"' || lang || '"|"' || source || '"' AS items FROM documents""",
)
def scl11(r: Roles) -> DataFrame:
    """Every item of a list quoted."""
    listed = F.concat(F.lit("["), "lang", F.lit(","), "source", F.lit("]"))
    return r.table("documents").select("doc_id", F.array_join(text.quoted_list(listed), "|").alias("items"))


@query(
    "scl12",
    """SELECT page_id, 'https://cdn.example.com' || regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1) AS link FROM pages""",
)
def scl12(r: Roles) -> DataFrame:
    """Host in front of a relative link."""
    relative = F.regexp_extract("url", "^[a-z]+://[^/]*(.*)$", 1)
    return r.table("pages").select("page_id", F.concat(F.lit("https://cdn.example.com"), relative).alias("link"))


@query(
    "scl13",
    """SELECT p_partkey, CASE WHEN instr(p_name, 'ring') > 0 THEN 'Rings' WHEN instr(p_name, 'red') > 0 THEN 'Red goods'
    ELSE p_name END AS name FROM part""",
)
def scl13(r: Roles) -> DataFrame:
    name = text.canonical_name("p_name", [("ring", "Rings"), ("red", "Red goods")])
    return r.table("part").select("p_partkey", name.alias("name"))


@query(
    "scl14",
    """SELECT event_id, CASE WHEN event_type <> 'click' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
    CAST(NULL AS DOUBLE) AS absent FROM events""",
)
def scl14(r: Roles) -> DataFrame:
    """A malformed map has no entries."""
    cell = F.when(F.col("event_type") == "click", F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    parsed = F.from_json(cell, "map<string,double>")
    return r.table("events").select(
        "event_id", F.try_element_at(parsed, F.lit("k")).alias("k"), F.try_element_at(parsed, F.lit("z")).alias("absent")
    )


@query(
    "scl15",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE CAST(CAST(value AS VARCHAR) AS DOUBLE) END AS number FROM events",
)
def scl15(r: Roles) -> DataFrame:
    """Text to number; bad text is 0."""
    raw = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return r.table("events").select("event_id", values.to_number(raw, 0.0).alias("number"))


@query(
    "scl16",
    f"""SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN {DAY_SQL} END AS from_text, {DAY_SQL} AS from_serial,
    CAST(NULL AS DATE) AS out_of_range FROM orders""",
)
def scl16(r: Roles) -> DataFrame:
    """Five text layouts and spreadsheet serials to one date; the rest is null."""
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    printed = values.first_match(
        [
            (priority == "1-URGENT", F.date_format(day, "yyyy-MM-dd HH:mm:ss")),
            (priority == "2-HIGH", F.date_format(day, "yyyy/MM/dd")),
            (priority == "3-MEDIUM", F.date_format(day, "yyyy-MM-dd HH:mm")),
            (priority == "5-LOW", F.lit("next week")),
        ],
        F.date_format(day, "yyyy-MM-dd"),
    )
    serial = dates.day_to_serial("o_orderdate")
    return r.table("orders").select(
        "o_orderkey",
        dates.normalise_day(printed, T.StringType()).alias("from_text"),
        dates.normalise_day(serial, T.IntegerType()).alias("from_serial"),
        dates.serial_to_day(serial + 3_000_000).alias("out_of_range"),
    )


@query("scl17", "SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M') AS printed FROM events")
def scl17(r: Roles) -> DataFrame:
    shown = dates.reformat("ts", T.TimestampNTZType(), "yyyy/MM/dd HH:mm")
    return r.table("events").select("event_id", shown.alias("printed"))


@query(
    "scl18",
    f"""SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', {DAY_SQL}) AS BIGINT) * 86400000 AS from_day,
    CAST(date_diff('day', DATE '1970-01-01', {DAY_SQL}) AS BIGINT) * 86400000 AS from_text,
    CAST(date_diff('day', DATE '1970-01-01', {DAY_SQL}) AS BIGINT) * 86400000 AS from_seconds FROM orders""",
)
def scl18(r: Roles) -> DataFrame:
    """Dates, text and epoch seconds to the milliseconds of UTC midnight."""
    day = F.to_date("o_orderdate")
    seconds = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
    return r.table("orders").select(
        "o_orderkey",
        dates.value_to_millis(day, T.DateType()).alias("from_day"),
        dates.value_to_millis(F.date_format(day, "yyyy/MM/dd"), T.StringType()).alias("from_text"),
        dates.value_to_millis(seconds, T.LongType()).alias("from_seconds"),
    )


@query("scl19", "SELECT event_id, CAST(ts + INTERVAL 8 HOUR AS DATE) AS local_day, CAST(ts AS DATE) AS utc_day FROM events")
def scl19(r: Roles) -> DataFrame:
    """Epoch milliseconds to the day eight hours east, and to the UTC day."""
    ms = F.unix_millis(F.to_timestamp(F.col("ts").cast("timestamp")))
    return r.table("events").select(
        "event_id", dates.millis_to_day(ms, 8).alias("local_day"), dates.millis_to_day(ms).alias("utc_day")
    )


@query("scl20", f"SELECT o_orderkey, CAST(date_diff('day', DATE '1899-12-30', {DAY_SQL}) AS INTEGER) AS serial FROM orders")
def scl20(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", dates.day_to_serial("o_orderdate").alias("serial"))


WRITE_TYPES = {
    "c_name": ("name", FieldType.TEXT),
    "balance": ("balance", FieldType.NUMBER),
    "c_mktsegment": ("segment", FieldType.SINGLE_SELECT),
    "tags": ("tags", FieldType.MULTI_SELECT),
    "day": ("day", FieldType.DATE),
    "ticked": ("ticked", FieldType.CHECKBOX),
    "owner": ("owner", FieldType.PERSON),
    "link": ("link", FieldType.URL),
    "files": ("files", FieldType.ATTACHMENT),
}


@query(
    "scl21",
    """SELECT c_custkey, 'name' AS field, c_name AS value FROM customer
    UNION ALL SELECT c_custkey, 'balance', CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal * 2 = c_acctbal + c_acctbal AS VARCHAR) END FROM customer
    UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer
    UNION ALL SELECT c_custkey, 'tags', CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment || '|' || c_nationkey END FROM customer
    UNION ALL SELECT c_custkey, 'day', CAST((9000 + c_nationkey) * CAST(86400000 AS BIGINT) AS VARCHAR) FROM customer
    UNION ALL SELECT c_custkey, 'ticked', CASE WHEN c_nationkey < 10 THEN 'true' ELSE 'false' END FROM customer
    UNION ALL SELECT c_custkey, 'owner', c_name FROM customer
    UNION ALL SELECT c_custkey, 'link', 'http://x.example.com/' || c_custkey FROM customer
    UNION ALL SELECT c_custkey, 'files', CASE WHEN c_nationkey < 5 THEN 'http://x.example.com/' || c_custkey ELSE '' END FROM customer""",
)
def scl21(r: Roles) -> DataFrame:
    """Write shapes of every field type, one row per value."""
    nation = F.col("c_nationkey")
    link = F.concat(F.lit("http://x.example.com/"), F.col("c_custkey").cast("string"))
    rows = r.table("customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment",
        F.when(F.col("c_acctbal") < 0, "owes").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit(" "), "c_mktsegment", F.lit(", ,"), nation.cast("string"))).alias("tags"),
        F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), nation + 9000), "yyyy-MM-dd HH:mm").alias("day"),
        F.when(nation < 5, "Yes").when(nation < 10, "是").otherwise("no").alias("ticked"),
        F.col("c_name").alias("owner"),
        link.alias("link"),
        F.when(nation < 5, F.concat(F.lit("['"), link, F.lit("', 'ftp://no']"))).otherwise("[broken]").alias("files"),
    )
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    out = {t: coerce.coerce_for_write(c, kinds[c], k) for c, (t, k) in WRITE_TYPES.items()}
    balance_ok = out["balance"] == F.col("c_acctbal")
    shown: dict[str, Column] = {
        "name": out["name"],
        "balance": balance_ok.cast("string"),
        "segment": out["segment"]["text"],
        "tags": F.array_join(F.transform(out["tags"], lambda x: x["text"]), "|"),
        "day": out["day"].cast("string"),
        "ticked": out["ticked"].cast("string"),
        "owner": out["owner"][0]["id"],
        "link": out["link"]["link"],
        "files": F.array_join(F.transform(out["files"], lambda x: x["url"]), "|"),
    }
    cells = F.array(*[F.struct(F.lit(n).alias("field"), c.alias("value")) for n, c in shown.items()])
    return rows.select("c_custkey", F.inline(cells))


@query(
    "scl22",
    """SELECT 'single' AS shape, page_id, url AS urls FROM pages
    UNION ALL SELECT 'json list', page_id, url || '|' || url FROM pages
    UNION ALL SELECT 'quoted list', page_id, url FROM pages
    UNION ALL SELECT 'malformed', page_id, '' FROM pages UNION ALL SELECT 'no host', page_id, '' FROM pages""",
)
def scl22(r: Roles) -> DataFrame:
    """Attachment cells in five shapes."""
    url = F.col("url")
    shapes = {
        "single": F.concat(F.lit("  "), url, F.lit(" )")),
        "json list": F.to_json(F.array(url, F.lit("file://x"), url)),
        "quoted list": F.concat(F.lit("['"), url, F.lit("']")),
        "malformed": F.concat(F.lit("["), url, F.lit("}]")),
        "no host": F.lit("http://"),
    }
    cells = F.array(*[F.struct(F.lit(n).alias("shape"), c.alias("cell")) for n, c in shapes.items()])
    rows = r.table("pages").select("page_id", F.inline(cells))
    return rows.select("shape", "page_id", F.array_join(text.attachment_urls("cell"), "|").alias("urls"))


@query(
    "scl23",
    """SELECT page_id, 'https://files.example.com/img/' || page_id || '|https://cdn.example.com/x|plain' AS links FROM pages""",
)
def scl23(r: Roles) -> DataFrame:
    """Separated values with prefixes mapped to links."""
    cell = F.concat(F.lit("/data/img/"), F.col("page_id").cast("string"), F.lit(" ; //cdn.example.com/x;; plain"))
    links = text.with_url_prefix(text.split_multi(cell, ";"), {"/data/": "https://files.example.com/"})
    return r.table("pages").select("page_id", F.array_join(links, "|").alias("links"))


def _suffixes(kind: str) -> str:
    fixed = text.IMAGE_SUFFIXES if kind == "image" else text.VIDEO_SUFFIXES
    return _list(fixed)


@query(
    "scl24",
    f"""SELECT page_id, link, CASE WHEN suffix IN ({_suffixes('image')}) THEN 'image' WHEN suffix IN ({_suffixes('video')}) THEN 'video'
      ELSE 'unknown' END AS media, 'attachment_' || substr(sha1(link), 1, 12) ||
      CASE WHEN suffix IN ({_suffixes('image')}, {_suffixes('video')}) THEN '.' || ext ELSE '.bin' END AS file_name
    FROM (SELECT page_id, link, lower(ext) AS suffix, ext FROM (SELECT page_id, x.ext, 'http://h.example.com/a/' || page_id || '.' || x.ext || '?v=1.mp4' AS link
      FROM pages, (VALUES ('jpg'), ('PNG'), ('mp4'), ('html'), ('svg')) AS x(ext)))""",
)
def scl24(r: Roles) -> DataFrame:
    """Media type and stable file name of links."""
    ext = F.explode(F.array(*map(F.lit, ("jpg", "PNG", "mp4", "html", "svg"))))
    rows = r.table("pages").select("page_id", ext.alias("ext"))
    link = F.concat(F.lit("http://h.example.com/a/"), F.col("page_id").cast("string"), F.lit("."), "ext", F.lit("?v=1.mp4"))
    return rows.select("page_id", link.alias("link")).select(
        "page_id", "link", text.media_type("link").alias("media"), text.attachment_name("link").alias("file_name")
    )


@query("scl25", "SELECT s_suppkey, 0.25::DOUBLE AS fixed, CAST(NULL AS DOUBLE) AS refused FROM supplier")
def scl25(r: Roles) -> DataFrame:
    return r.table("supplier").select(
        "s_suppkey", adjust.fixed_rate(0.25).alias("fixed"), adjust.fixed_rate(1.5).alias("refused")
    )


@query(
    "scl26",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount - 0.05::DOUBLE BETWEEN 0 AND 1 THEN l_discount - 0.05::DOUBLE END AS rate,
    CASE WHEN l_discount - 0.05::DOUBLE BETWEEN 0 AND 1 THEN 1 ELSE 0 END AS ok FROM lineitem""",
)
def scl26(r: Roles) -> DataFrame:
    moved = adjust.shifted_rate("l_discount", -0.05)
    return r.table("lineitem").select(
        "l_orderkey", "l_linenumber", moved.alias("rate"), values.flag(adjust.is_rate(moved)).alias("ok")
    )


_MOVED = "0.086::DOUBLE + (0.086::DOUBLE - 0.07::DOUBLE) / 0.086::DOUBLE * (l_discount - 0.086::DOUBLE)"


@query(
    "scl27",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN {_MOVED} BETWEEN 0 AND 1 THEN {_MOVED} END AS moved,
    CASE WHEN l_discount >= 0.086::DOUBLE THEN l_discount ELSE {_MOVED} END AS kept FROM lineitem""",
)
def scl27(r: Roles) -> DataFrame:
    return r.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        adjust.offset_rate("l_discount", 0.07, 0.086).alias("moved"),
        adjust.offset_rate("l_discount", 0.07, 0.086, keep_above=True).alias("kept"),
    )


@query(
    "scl28",
    """SELECT p_partkey, CASE WHEN p_size <= 10 THEN 0.1 WHEN p_size <= 30 THEN 0.2 ELSE 0.3 END::DOUBLE AS capped,
    CASE WHEN p_size <= 10 THEN 0.1 WHEN p_size <= 30 THEN 0.2 ELSE 0.3 END::DOUBLE AS with_hat FROM part""",
)
def scl28(r: Roles) -> DataFrame:
    """Both ladder shapes: as many values as steps, and one more."""
    return r.table("part").select(
        "p_partkey",
        adjust.ladder_rate("p_size", [10, 30, 40], [0.1, 0.2, 0.3]).alias("capped"),
        adjust.ladder_rate("p_size", [10, 30], [0.1, 0.2, 0.3]).alias("with_hat"),
    )


@query(
    "scl29",
    "SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice / (1.0::DOUBLE + l_tax), 2) AS net FROM lineitem",
)
def scl29(r: Roles) -> DataFrame:
    net = values.price_net_of_rate("l_extendedprice", "l_tax")
    return r.table("lineitem").select("l_orderkey", "l_linenumber", net.alias("net"))


@query(
    "scl30",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN 'up' WHEN l_discount < l_tax THEN 'down'
    WHEN l_discount = l_tax THEN 'same' ELSE 'up' END AS direction, abs(l_discount - l_tax) AS size FROM lineitem""",
)
def scl30(r: Roles) -> DataFrame:
    diff = F.col("l_discount") - F.col("l_tax")
    direction = adjust.adjustment_direction(F.col("l_returnflag") == "R", diff, "down", "same", "up")
    return r.table("lineitem").select(
        "l_orderkey", "l_linenumber", direction.alias("direction"), F.abs(diff).alias("size")
    )


@query(
    "scl31",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 1 ELSE 0 END AS ticked FROM events""",
)
def scl31(r: Roles) -> DataFrame:
    """Words that tick a checkbox, in any case."""
    kind = F.col("event_type")
    cell = values.first_match([(kind == "click", "TRUE"), (kind == "view", "是"), (kind == "purchase", "1")], "nope")
    return r.table("events").select("event_id", values.flag(text.is_truthy(cell)).alias("ticked"))
