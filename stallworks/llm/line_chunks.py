"""Line dedup by content-defined chunks, in DataFrame functions alone.

A text's lines are hashed, and the hashes are rolled over ``ROLL`` neighbouring lines. Each
rolled hash depends on its own lines alone, so text put in or taken out elsewhere moves no
boundary. A divisor above 1 (a boundary after some rolled hashes only) would miss most
passages of two or three lines, as their edges would have to be boundaries by chance: so every
rolled hash bounds a chunk, the ``ROLL`` lines that it covers, and chunks overlap. Chunks
that hold a word and whose bytes equal those of an earlier occurrence, in the order of
``doc_id`` and place, are joined line by line to maximal repeated runs. Runs of at least
``LEAST_WORDS`` words go. The first occurrence of every line stays.

Only 128-bit hashes are shuffled to find candidates, counted in the map tasks first. Texts
meet their candidates by ``doc_id``; of a candidate's bytes the map tasks keep the least
and the greatest text under its hash, and only if they are equal is anything removed. No
task gathers the copies of a chunk: joins by hash have both sides shuffled as they are, so
that Spark splits a hot hash.

Defined results: null text is empty; rows of the same ``doc_id`` and text are treated
alike, so none of them removes the other's chunks; rows with a null ``doc_id`` are
returned whole; an empty table gives no row; columns named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallworks.llm.common import let

ROLL = 2
LEAST_WORDS = 10
WORD = r"[^\x20\x09-\x0D]+"


def chunks(text: Column) -> Column:
    """``at, h, g`` of every chunk that holds a word; lines count from 1."""

    def rolled(lines: Column) -> Column:
        hashes = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g"), x.rlike(WORD).alias("word")))
        return let(hashes, over)

    def over(h: Column) -> Column:
        def chunk(first: Column, i: Column) -> Column:
            covered = [first] + [F.get(h, i + k) for k in range(1, ROLL)]
            word = covered[0]["word"]
            for x in covered[1:]:
                word = word | x["word"]
            return F.struct(
                (i + 1).alias("at"),
                F.xxhash64(*(x["h"] for x in covered)).alias("h"),
                F.xxhash64(*(x["g"] for x in covered)).alias("g"),
                word.alias("word"),
            )

        starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - (ROLL - 1), F.lit(0)))
        return F.filter(F.transform(starts, chunk), lambda c: c["word"])

    return let(F.split(text, "\n", -1), rolled)


def chunk_text(lines: Column, start: Column, count: Column) -> Column:
    return F.array_join(F.slice(lines, start, count), "\n")


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a ``doc_id`` and the hash of their text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.where("doc_id IS NOT NULL").withColumn("_key", F.xxhash64(text))


def _runs(starts: Column) -> Column:
    """``start, lines`` of the stretches that sorted chunk starts cover."""

    def joined(s: Column) -> Column:
        begins = F.filter(s, lambda x, k: (k == 0) | (x > F.get(s, k - 1) + ROLL))
        ends = F.filter(s, lambda x, k: (k == F.size(s) - 1) | (F.get(s, k + 1) > x + ROLL))
        return F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("start"), (b + ROLL - a).alias("lines")))

    return let(starts, joined)


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, _key, runs`` of texts with repeated chunks; ``runs`` of any number of words."""
    rows = _keyed(docs.select("doc_id", "text"))
    text = F.col("text").cast("string")
    each = rows.select("doc_id", "_key", F.explode(chunks(text)).alias("c")).select("doc_id", "_key", "c.at", "c.h", "c.g")
    place = F.struct("doc_id", "_key", "at")
    many = each.groupBy("h", "g").count().where("count > 1").select("h", "g").repartition("h", "g")
    found = each.join(many, ["h", "g"], "left_semi")
    listed = found.groupBy("doc_id", "_key").agg(F.collect_set(F.struct("at", "h", "g")).alias("found"))
    held = rows.join(listed, ["doc_id", "_key"]).select("doc_id", "_key", F.split(text, "\n", -1).alias("all"), "found")
    pieces = held.select("doc_id", "_key", "all", F.explode("found").alias("c")).select(
        "doc_id", "_key", "c.*", chunk_text(F.col("all"), F.col("c.at"), F.lit(ROLL)).alias("chunk")
    )
    compared = pieces.groupBy("h", "g").agg(
        F.min("chunk").alias("least"), F.max("chunk").alias("greatest"), F.min(place).alias("first")
    )
    same = compared.where("least = greatest").select("h", "g", "first").repartition("h", "g")
    later = each.join(same, ["h", "g"]).where(place != F.col("first"))
    return later.groupBy("doc_id", "_key").agg(_runs(F.sort_array(F.collect_set("at"))).alias("_runs"))


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the text that is left, ``n_lines``, ``n_removed_chunks`` (runs) and ``n_removed_lines``."""
    names = ("n_lines", "n_removed_chunks", "n_removed_lines")
    kept = [c for c in docs.columns if c not in names]
    docs = docs.select(*kept)
    rows = _keyed(docs).join(repeated_runs(docs), ["doc_id", "_key"], "left")
    unnamed = docs.where("doc_id IS NULL").withColumn("_key", F.lit(0).cast("long"))
    rows = rows.unionByName(unnamed, allowMissingColumns=True)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def left(lines: Column, removed: Column) -> Column:
        # what stands before each removed run, and what stands after the last
        bounds = F.concat(F.array(F.struct(F.lit(1).alias("start"), F.lit(0).alias("lines"))), removed)

        def after(x: Column, i: Column) -> Column:
            begin = x["start"] + x["lines"]
            end = F.coalesce(F.get(removed, i)["start"], F.size(lines) + 1)
            return F.slice(lines, begin, F.greatest(end - begin, F.lit(0)))

        return F.array_join(F.flatten(F.transform(bounds, after)), "\n")

    def judged(lines: Column) -> Column:
        def heavy(x: Column) -> Column:
            return F.regexp_count(chunk_text(lines, x["start"], x["lines"]), F.lit(WORD)) >= LEAST_WORDS

        return let(
            F.filter(F.col("_runs"), heavy),
            lambda removed: F.struct(
                left(lines, removed).alias("rest"),
                F.size(removed).alias("runs"),
                F.aggregate(removed, F.lit(0), lambda a, x: a + x["lines"]).alias("lines"),
            ),
        )

    rows = rows.withColumn("_judged", F.when(F.col("_runs").isNotNull(), let(F.split(text, "\n", -1), judged)))
    rest = F.when(F.col("_judged.runs") > 0, F.col("_judged.rest")).otherwise(F.col("text"))
    return rows.select(
        *(rest.alias("text") if c == "text" else F.col(c) for c in kept),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("_judged.runs", F.lit(0)).cast("long").alias("n_removed_chunks"),
        F.coalesce("_judged.lines", F.lit(0)).cast("long").alias("n_removed_lines"),
    )


#: The same rows in DuckDB: chunks are compared by their whole text.
SQL = f"""
WITH lines AS (
    SELECT doc_id, u.i AS i, u.line AS line
    FROM (
        SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)),
            lambda x, k: {{'i': k, 'line': x}})) AS u
        FROM documents WHERE doc_id IS NOT NULL
    )
), paired AS (
    SELECT *, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS body FROM lines
), marked AS (
    SELECT doc_id, i, line, body IS NOT NULL AND regexp_matches(body, '[^ \\t-\\r]')
        AND row_number() OVER (PARTITION BY body ORDER BY doc_id, i) > 1 AS later
    FROM paired
), covered AS (
    SELECT doc_id, i, line, later OR coalesce(lag(later) OVER (PARTITION BY doc_id ORDER BY i), false) AS hit
    FROM marked
), runs AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, hit ORDER BY i) AS run,
        len(regexp_extract_all(line, '[^ \\t-\\r]+')) AS words
    FROM covered
), judged AS (
    SELECT *, hit AND sum(words) OVER (PARTITION BY doc_id, hit, run) >= {LEAST_WORDS} AS gone FROM runs
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(DISTINCT run) FILTER (gone)::BIGINT AS n_removed_chunks,
    count(*) FILTER (gone)::BIGINT AS n_removed_lines,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
