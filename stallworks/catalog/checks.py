"""Data quality and routing: DQ01–DQ11, RT01–RT06."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.coerce import FieldType, coerce_frame, coercion_issues
from ..functions.text import attachment_urls, split_multi
from ..operators import quality
from ..operators.quality import FieldCheck
from ..operators.reshape import with_row_key
from ..params import DateWindow
from ..plans import routing
from ..plans.routing import Route
from ..session import scratch_path
from ..sinks.merge import delete_where
from ..functions.predicates import Condition
from .registry import query
from .roles import Roles


def labelled_docs(r: Roles) -> DataFrame:
    """Documents with labels where there are some, and cells of every kind made dirty."""
    docs = r.table("documents").select("doc_id", "text", "lang", "source", "n_chars")
    quality_text = F.when(F.col("lang") == "en", F.col("quality").cast("string")).when(
        F.col("quality").isNotNull(), F.concat(F.lit("q"), F.col("quality").cast("string"))
    )
    return docs.join(r.table("labels"), "doc_id", "left").withColumns(
        {
            "quality_text": quality_text,
            "ticked": F.when(F.col("toxic") == 1, "yes").when(F.col("toxic") == 0, "maybe"),
            "share": F.col("n_chars").cast("double") / F.lit(1000.0),
        }
    )


DOCS_SQL = """docs AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, quality, toxic,
    CASE WHEN lang = 'en' THEN CAST(quality AS VARCHAR) WHEN quality IS NOT NULL THEN 'q' || quality END AS quality_text,
    CASE WHEN toxic = 1 THEN 'yes' WHEN toxic = 0 THEN 'maybe' END AS ticked, CAST(n_chars AS DOUBLE) / 1000 AS share
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
NO_VALUE = "CAST(NULL AS DOUBLE) AS value"


def _issue(field: str, check: str, level: str, n: str, raised: str, table: str, value: str = "CAST(NULL AS DOUBLE)") -> str:
    return (
        f"SELECT * FROM (SELECT '{field}' AS field, '{check}' AS check, '{level}' AS level, "
        f"CAST({n} AS BIGINT) AS n, {value} AS value, {raised} AS raised FROM {table}) WHERE raised"
    )


def _without_raised(parts: list[str], ctes: str = "") -> str:
    return f"{ctes} SELECT field, \"check\", level, n, value FROM ({' UNION ALL '.join(parts)})"


@query(
    "dq01",
    """SELECT 'price' AS field, 'missing_column' AS "check", 'CRITICAL' AS level, CAST(1 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS value
    UNION ALL SELECT 'p_name', 'max_length', 'INFO', COUNT(p_name), CAST(MAX(length(p_name)) AS DOUBLE) FROM part
    UNION ALL SELECT 'p_name', 'mean_length', 'INFO', COUNT(p_name), ROUND(CAST(SUM(length(p_name)) AS DOUBLE) / COUNT(p_name), 4) FROM part""",
)
def dq01(r: Roles) -> DataFrame:
    """A mapped column the data lacks, next to the checks of one it has."""
    checks = [FieldCheck("p_name", FieldType.TEXT), FieldCheck("price", FieldType.NUMBER)]
    part = r.table("part")
    return quality.missing_columns(part, checks).unionByName(quality.check_columns(part, checks))


def dated_orders(r: Roles) -> DataFrame:
    """Order days as dates, as text of which some is unreadable, and an empty column."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return r.table("orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        F.when(F.col("o_orderpriority") == "5-LOW", "soon").when(F.col("o_orderpriority") != "2-HIGH", day).alias("day_text"),
        F.lit(None).cast("date").alias("day_empty"),
    )


@query(
    "dq02",
    _without_raised(
        [
            _issue("day", "kind_datetime", "INFO", "COUNT(o_orderdate)", "COUNT(o_orderdate) > 0", "orders"),
            _issue("day_text", "unparseable_date", "CRITICAL", "COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW')",
                   "COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') > 0", "orders"),
            _issue("day_text", "kind_string", "INFO", "COUNT(*) FILTER (WHERE o_orderpriority <> '2-HIGH')", "TRUE", "orders"),
            _issue("day_empty", "all_null", "WARNING", "COUNT(*)", "COUNT(*) > 0", "orders"),
        ]
    ),
)
def dq02(r: Roles) -> DataFrame:
    checks = [FieldCheck(c, FieldType.DATE) for c in ("day", "day_text", "day_empty")]
    return quality.check_columns(dated_orders(r), checks)


@query(
    "dq03",
    _without_raised(
        [
            _issue("quality", "null_share", "WARNING", "COUNT(*) - COUNT(quality)",
                   "(COUNT(*) - COUNT(quality)) * 2 > COUNT(*)", "docs",
                   "ROUND(CAST(COUNT(*) - COUNT(quality) AS DOUBLE) / COUNT(*), 5)"),
            _issue("quality_text", "not_numeric", "WARNING", "COUNT(*) FILTER (WHERE quality_text LIKE 'q%')",
                   "COUNT(*) FILTER (WHERE quality_text LIKE 'q%') > 0", "docs"),
            _issue("quality_text", "null_share", "WARNING", "COUNT(*) - COUNT(quality_text)",
                   "(COUNT(*) - COUNT(quality_text)) * 2 > COUNT(*)", "docs",
                   "ROUND(CAST(COUNT(*) - COUNT(quality_text) AS DOUBLE) / COUNT(*), 5)"),
            _issue("share", "outside_unit_range", "WARNING", "COUNT(*) FILTER (WHERE share > 1)",
                   "COUNT(*) FILTER (WHERE share > 1) > 0", "docs"),
        ],
        f"WITH {DOCS_SQL}",
    ),
)
def dq03(r: Roles) -> DataFrame:
    """Not a number, mostly missing, or outside the range of a percent."""
    checks = [
        FieldCheck("quality", FieldType.NUMBER),
        FieldCheck("quality_text", FieldType.NUMBER),
        FieldCheck("share", FieldType.NUMBER, display="Percent"),
        FieldCheck("n_chars", FieldType.NUMBER),
    ]
    return quality.check_columns(labelled_docs(r), checks)


@query(
    "dq04",
    """SELECT 'text' AS field, 'max_length' AS "check", 'INFO' AS level, COUNT(text) AS n, CAST(MAX(length(text)) AS DOUBLE) AS value FROM documents
    UNION ALL SELECT 'text', 'mean_length', 'INFO', COUNT(text), ROUND(CAST(SUM(length(text)) AS DOUBLE) / COUNT(text), 4) FROM documents""",
)
def dq04(r: Roles) -> DataFrame:
    return quality.check_columns(r.table("documents"), [FieldCheck("text", FieldType.TEXT)])


@query(
    "dq05",
    _without_raised(
        [_issue("ticked", "checkbox_domain", "WARNING", "COUNT(*) FILTER (WHERE ticked = 'maybe')",
                "COUNT(*) FILTER (WHERE ticked = 'maybe') > 0", "docs")],
        f"WITH {DOCS_SQL}",
    ),
)
def dq05(r: Roles) -> DataFrame:
    return quality.check_columns(labelled_docs(r), [FieldCheck("ticked", FieldType.CHECKBOX)])


SELECTS = ["source", "lang", "doc_id"]


@query(
    "dq06",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS field, (SELECT COUNT(DISTINCT {c}) FROM documents) AS n_distinct, string_agg(v, ',' ORDER BY v) AS first_values
        FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM documents ORDER BY v LIMIT 20)"""
        for c in SELECTS
    ),
)
def dq06(r: Roles) -> DataFrame:
    """Distinct values per select column, the first 20 shown."""
    found = quality.select_values(r.table("documents"), SELECTS)
    return found.withColumn("first_values", F.array_join("first_values", ","))


@query(
    "dq07",
    f"""WITH {DOCS_SQL}, issues AS (
      {_issue('day_text', 'unparseable_date', 'CRITICAL', "COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW')", "COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') > 0", 'orders')})
    SELECT gate, CASE WHEN gate = 'strict' AND (SELECT COUNT(*) FROM issues) > 0 THEN 0 ELSE 1 END AS success,
      CASE WHEN gate = 'skip' THEN 0 ELSE (SELECT COUNT(*) FROM issues) END AS n_critical
    FROM (VALUES ('strict'), ('warn'), ('skip')) AS g(gate)""",
)
def dq07(r: Roles) -> DataFrame:
    """The severity gate on the same data: strict stops, warn records, skip does not look."""
    mapping = {"o_orderkey": ("id", FieldType.NUMBER), "day_text": ("day", FieldType.DATE)}
    routes = [
        Route(gate, "orders", write=lambda df: df.count(), mapping=mapping, level=gate)
        for gate in ("strict", "warn", "skip")
    ]
    results = routing.run_routes({"orders": dated_orders(r)}, routes, fail=False)
    status = routing.route_status(r.spark, results)
    return status.select(F.col("route").alias("gate"), "success", F.col("n_critical").cast("bigint").alias("n_critical"))


@query(
    "dq08",
    """SELECT 'event_id' AS field, 'NUMBER' AS field_type, 0::BIGINT AS n_failed UNION ALL SELECT 'ts', 'DATE', 0
    UNION ALL SELECT 'user_id', 'NUMBER', 0 UNION ALL SELECT 'event_type', 'DATE', COUNT(event_type) FROM events
    UNION ALL SELECT 'value', 'NUMBER', 0 UNION ALL SELECT 'props', 'ATTACHMENT', 0""",
)
def dq08(r: Roles) -> DataFrame:
    """Types inferred from the schema, and how many values do not fit them."""
    events = r.table("events")
    kinds = quality.infer_field_types(events, attachments=["props"], day_field="event_type")
    failed = coercion_issues(events, {c: (c, k) for c, k in kinds.items()})
    names = F.create_map(*[F.lit(x) for c, k in kinds.items() for x in (c, k.name)])
    return failed.select("field", names[F.col("field")].alias("field_type"), "n_failed")


TARGET = {"c_custkey": FieldType.NUMBER, "c_name": FieldType.TEXT, "c_acctbal": FieldType.NUMBER, "segment": FieldType.SINGLE_SELECT}


@query(
    "dq09",
    f"""WITH cols AS (SELECT column_name FROM (DESCRIBE customer)), target AS (SELECT * FROM (VALUES {', '.join(f"('{c}')" for c in TARGET)}) AS t(name))
    SELECT COUNT(*) AS n_columns, COUNT(*) FILTER (WHERE column_name IN (SELECT name FROM target)) AS n_same_name,
      CAST(COUNT(*) FILTER (WHERE column_name IN (SELECT name FROM target)) AS DOUBLE) / COUNT(*) AS coverage,
      0 AS accepted, string_agg(column_name, ',') FILTER (WHERE column_name NOT IN (SELECT name FROM target) AND column_name <> 'c_mktsegment') AS unmatched,
      (SELECT COUNT(*) FROM customer) AS n_rows, (SELECT COUNT(DISTINCT c_mktsegment) FROM customer) AS n_segments
    FROM cols""",
)
def dq09(r: Roles) -> DataFrame:
    """Name coverage against a target, with one override, and what the mapping yields."""
    customer = r.table("customer")
    found = quality.map_to_target(customer, TARGET, overrides=["c_mktsegment:segment:SINGLE_SELECT"])
    mapped = coerce_frame(customer, found.mapping)
    return mapped.groupBy(F.col("segment.text").alias("s")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.lit(found.n_columns).cast("bigint").alias("n_columns"),
        F.lit(found.n_same_name).cast("bigint").alias("n_same_name"),
        F.lit(found.coverage).alias("coverage"),
        F.lit(int(found.accept())).alias("accepted"),
        F.lit(",".join(found.unmatched)).alias("unmatched"),
        F.sum("n").alias("n_rows"),
        F.count("s").alias("n_segments"),
    )


@query(
    "dq10",
    r"""SELECT 'url' AS field, COUNT(*) AS n_links, 1 AS is_link_like FROM pages
    UNION ALL SELECT 'html', COUNT(*) FILTER (WHERE regexp_matches(lower(trim(html)), '^(https?://|//|/|\./|\.\./|~)')),
      CASE WHEN COUNT(*) FILTER (WHERE regexp_matches(lower(trim(html)), '^(https?://|//|/|\./|\.\./|~)')) > 0 THEN 1 ELSE 0 END FROM pages""",
)
def dq10(r: Roles) -> DataFrame:
    return quality.link_like_columns(r.table("pages"), ["url", "html"])


@query(
    "dq11",
    """SELECT 'links' AS field, COUNT(*) AS n_rows, COUNT(*) AS n_items FROM pages
    UNION ALL SELECT 'parts', COUNT(*), CAST(SUM(len(list_filter(string_split(url, '/'), lambda x: length(trim(x)) > 0))) AS BIGINT) FROM pages
    UNION ALL SELECT 'nothing', 0, 0 FROM pages WHERE page_id = (SELECT MIN(page_id) FROM pages)""",
)
def dq11(r: Roles) -> DataFrame:
    """Filled rows and items of array columns."""
    pages = r.table("pages").select(
        attachment_urls("url").alias("links"),
        split_multi("url", "/").alias("parts"),
        attachment_urls(F.concat(F.lit("no link "), "url")).alias("nothing"),
    )
    return quality.array_statistics(pages, ["links", "parts", "nothing"])


def _daily(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("ts").alias("dt"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rt01",
    """SELECT 'daily' AS route, 1 AS success, (SELECT COUNT(*) FROM (SELECT DISTINCT CAST(ts AS DATE), event_type FROM events)) AS n_written
    UNION ALL SELECT 'errors', 1, COUNT(*) FILTER (WHERE event_type = 'error') FROM events
    UNION ALL SELECT 'mapped', 1, COUNT(DISTINCT (CAST(ts AS DATE), event_type)) FROM events
    UNION ALL SELECT 'broken', 0, 0 FROM (VALUES (1)) UNION ALL SELECT 'unknown', 0, 0 FROM (VALUES (1))""",
)
def rt01(r: Roles) -> DataFrame:
    """Five routes from one pool; two fail and the others still write.

    One maps: its target has other names and the types of its fields.
    """
    base = scratch_path(r.spark, "rt01")
    sink = lambda name: lambda df: df.write.parquet(f"{base}/{name}")
    routes = [
        Route("daily", "result", sink("daily"), steps=[("daily", _daily)]),
        Route("broken", "result", sink("broken"), steps=[("row key", lambda df: with_row_key(df, ["shop_id"]))]),
        Route("errors", "result", sink("errors"), steps=[("errors", lambda df: df.where("event_type = 'error'"))]),
        Route("unknown", "warehouse:absent", sink("unknown")),
        Route("mapped", "result", sink("mapped"), steps=[("daily", _daily)], mapping={
            "dt": ("day", FieldType.DATE), "event_type": ("kind", FieldType.SINGLE_SELECT), "n": ("events", FieldType.NUMBER),
        }),
        Route("off", "result", sink("off"), enabled=False),
    ]
    results = routing.run_routes({"result": r.table("events")}, routes, fail=False)
    out = None
    for result in results:
        done = r.spark.read.parquet(f"{base}/{result.route}") if result.success else r.table("events").where(F.lit(False))
        if result.route == "mapped":
            done = done.where("day > 0 AND kind.text IS NOT NULL AND events > 0")
        row = done.agg(F.count(F.lit(1)).alias("n_written")).select(
            F.lit(result.route).alias("route"), F.lit(int(result.success)).alias("success"), "n_written"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "rt02",
    """SELECT CAST(ts AS DATE) AS dt, event_type, COUNT(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1, 2 HAVING COUNT(*) > 50""",
)
def rt02(r: Roles) -> DataFrame:
    steps = [
        ("drop errors", lambda df: delete_where(df, [Condition("event_type", "is", "error")])),
        ("daily", _daily),
        ("large", lambda df: df.where("n > 50")),
    ]
    return routing.run_steps(r.table("events"), steps)


RUN = DateWindow(date(2000, 6, 30), -365, 0)


@query(
    "rt03",
    f"""SELECT o_orderpriority, COUNT(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{RUN.first}' AND DATE '{RUN.last}'
    AND o_orderstatus <> 'P' GROUP BY o_orderpriority""",
)
def rt03(r: Roles) -> DataFrame:
    """SQL text with bound parameters."""
    text = """SELECT o_orderpriority, count(*) AS n FROM {orders}
    WHERE o_orderdate >= :first AND o_orderdate < date_add(:last, 1) AND o_orderstatus <> :cancelled
    GROUP BY o_orderpriority"""
    args = {"first": RUN.first, "last": RUN.last, "cancelled": "P"}
    return routing.run_sql(r.spark, text, args, {"orders": r.table("orders")})


@query(
    "rt04",
    """SELECT event_type, COUNT(*) AS n_days, CAST(SUM(n) AS BIGINT) AS n FROM (
      SELECT CAST(ts AS DATE) AS dt, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2) GROUP BY event_type""",
)
def rt04(r: Roles) -> DataFrame:
    """A named query that later SQL reads. The name is the run's own."""
    name = f"rt04_daily_{uuid.uuid4().hex[:8]}"
    routing.materialise(_daily(r.table("events")), name)
    return r.spark.sql(f"SELECT event_type, count(*) AS n_days, sum(n) AS n FROM {name} GROUP BY event_type")


@query(
    "rt05",
    f"""SELECT 'valid' AS case_name, COUNT(*) AS n FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
    UNION ALL SELECT 'refused', 0 FROM events WHERE event_id = (SELECT MIN(event_id) FROM events)""",
)
def rt05(r: Roles) -> DataFrame:
    """A window whose start is after its end is refused before anything is read."""
    from ..sources.tables import scan_window

    out = None
    for name, start, end in (("valid", -2, 0), ("refused", 0, -2)):
        try:
            rows = scan_window(r.table("events"), "ts", DateWindow(date(2024, 1, 12), start, end))
        except ValueError:
            rows = r.table("events").where(F.lit(False))
        row = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("case_name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "rt06",
    """SELECT 'customers' AS route, 'file:customer' AS source,
      CASE WHEN column_type IN ('BIGINT', 'DOUBLE', 'INTEGER') THEN 'NUMBER' ELSE 'TEXT' END AS field_type, COUNT(*) AS n_fields,
      COUNT(*) * (SELECT COUNT(*) FROM customer) AS n_values FROM (DESCRIBE customer) GROUP BY ALL""",
)
def rt06(r: Roles) -> DataFrame:
    """Mapped fields of a route by type, and the values its source holds for them."""
    customer = r.table("customer")
    kinds = quality.infer_field_types(customer)
    route = Route("customers", "file:customer", write=lambda df: None, mapping={c: (c, k) for c, k in kinds.items()})
    filled = [F.struct(F.lit(k.name).alias("field_type"), F.count(c).alias("n")) for c, k in kinds.items()]
    values = customer.agg(F.array(*filled).alias("x")).select(F.inline("x")).groupBy("field_type").agg(
        F.sum("n").alias("n_values")
    )
    return routing.route_summary(r.spark, [route]).join(values, "field_type")


