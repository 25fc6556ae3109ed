"""Fan-out of named inputs to targets, step chains and parameterised SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from contextlib import ExitStack

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.coerce import FieldType, coerce_frame
from ..operators.quality import FieldCheck, check_columns, missing_columns
from ..session import scratch_path
from ..sinks.merge import staged

Step = Callable[[DataFrame], DataFrame]


def run_steps(df: DataFrame, steps: Sequence[tuple[str, Step]]) -> DataFrame:
    """Named steps in order. Lazy; a step that fails names itself."""
    for name, step in steps:
        try:
            df = df.transform(step)
        except Exception as error:
            raise RuntimeError(f"step {name!r} failed: {error}") from error
    return df


@dataclass(frozen=True)
class StepShape:
    """Columns a step left, and the observation that has its row count after an action."""

    step: str
    columns: tuple[str, ...]
    seen: Observation

    @property
    def rows(self) -> int:
        return self.seen.get["rows"]


def run_steps_logged(df: DataFrame, steps: Sequence[tuple[str, Step]]) -> tuple[DataFrame, list[StepShape]]:
    """``run_steps`` with the shape behind every step, counted while the result is computed."""
    shapes = []
    for name, step in steps:
        df = run_steps(df, [(name, step)])
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        shapes.append(StepShape(name, tuple(df.columns), seen))
    return df, shapes


def run_sql(spark: SparkSession, text: str, params: dict[str, object], tables: dict[str, DataFrame]) -> DataFrame:
    """SQL text with ``:name`` parameters bound as values, never spliced into the text."""
    return spark.sql(text, args=params, **tables)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Compute a named query once, as a table in the shared folder, for later SQL."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.createOrReplaceTempView(name)
    return table


@dataclass(frozen=True)
class Route:
    """One input to one target.

    mapping: ``{source column: (target field, type)}``. With one, the target gets its
    fields alone, coerced to their types; without, the columns as they are.
    level: 'strict' stops the route on a CRITICAL issue, 'warn' records it, 'skip'
    does not check.
    """

    name: str
    source: str
    write: Callable[[DataFrame], object]
    steps: Sequence[tuple[str, Step]] = ()
    mapping: dict[str, tuple[str, FieldType]] = field(default_factory=dict)
    level: str = "strict"
    enabled: bool = True


@dataclass(frozen=True)
class RouteResult:
    route: str
    source: str
    success: bool
    n_critical: int
    error: str | None


class RoutesFailed(RuntimeError):
    def __init__(self, results: list[RouteResult]):
        self.results = results
        bad = [r.route for r in results if not r.success]
        super().__init__(f"{len(bad)}/{len(results)} route(s) failed: {', '.join(bad)}")


def _run_one(route: Route, pool: dict[str, DataFrame]) -> RouteResult:
    n_critical = 0
    stack = ExitStack()
    try:
        if route.source not in pool:
            raise KeyError(f"{route.source!r} not found, available: {sorted(pool)}")
        df = run_steps(pool[route.source], route.steps)
        if route.mapping and route.level != "skip":
            # what is checked is what is written, and is computed once
            df = stack.enter_context(staged(df, "route"))
        if route.mapping:
            checks = [FieldCheck(c, kind) for c, (_, kind) in route.mapping.items()]
            if route.level != "skip":
                issues = missing_columns(df, checks).unionByName(check_columns(df, checks))
                n_critical = issues.where(F.col("level") == "CRITICAL").count()
                if n_critical and route.level == "strict":
                    raise ValueError(f"{n_critical} critical issue(s)")
            absent = {c: "string" for c in route.mapping if c not in df.columns}
            df = coerce_frame(df.withColumns({c: F.lit(None).cast(t) for c, t in absent.items()}), route.mapping)
        route.write(df)
        return RouteResult(route.name, route.source, True, n_critical, None)
    except Exception as error:
        text = str(error).splitlines()[0] if str(error) else type(error).__name__
        return RouteResult(route.name, route.source, False, n_critical, text)
    finally:
        stack.close()


def run_routes(pool: dict[str, DataFrame], routes: Sequence[Route], fail: bool = True) -> list[RouteResult]:
    """Run every route; one that fails does not stop the others.

    An input that several routes read is staged in the shared folder while they run, so it
    is computed once, whatever happens to executors.
    """
    active = [r for r in routes if r.enabled]
    uses: dict[str, int] = {}
    for r in active:
        uses[r.source] = uses.get(r.source, 0) + 1
    with ExitStack() as stack:
        shared = {s: stack.enter_context(staged(pool[s], "input")) for s, n in uses.items() if n > 1 and s in pool}
        results = [_run_one(r, {**pool, **shared}) for r in active]
    if fail and any(not r.success for r in results):
        raise RoutesFailed(results)
    return results


def route_status(spark: SparkSession, results: Sequence[RouteResult]) -> DataFrame:
    rows = [(r.route, r.source, int(r.success), r.n_critical, r.error) for r in results]
    return spark.createDataFrame(
        rows, "route string, source string, success int, n_critical int, error string"
    )


def route_fields(spark: SparkSession, routes: Sequence[Route]) -> DataFrame:
    """Mapped fields of every route, with their types."""
    rows = [
        (r.name, r.source, column, target, kind.name)
        for r in routes
        for column, (target, kind) in r.mapping.items()
    ]
    return spark.createDataFrame(
        rows, "route string, source string, column string, field string, field_type string"
    )


def route_summary(spark: SparkSession, routes: Sequence[Route]) -> DataFrame:
    """Number of mapped fields per route and type."""
    return route_fields(spark, routes).groupBy("route", "source", "field_type").agg(
        F.count(F.lit(1)).alias("n_fields")
    )

