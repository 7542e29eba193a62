"""URL filters: every capture is judged by the list entries that were active when it was fetched.

A list's log holds dated entries (``list``, ``verdict`` block or allow, ``kind`` domain or path, ``pattern``, ``action``
add or remove, ``dated``: a day or a moment). One list has one state of a pattern a day, that of the day's last entry; of entries
of one moment an add counts. The log becomes validity intervals [valid_from, valid_to); an entry added twice opens one interval, one never
removed has no end. A domain entry matches that host and all hosts below it; a path entry (host/path, no scheme, query,
fragment or last slash) matches that path and all below it.

The as-of join: each pattern's intervals become steps, the numbers of block and allow entries from a day on; each
(pattern, day) that captures ask for takes the last step up to that day. So a pattern's group holds a row for each day at
most, however many captures or entries it has, and the captures meet only the states of their own day. The most specific
active pattern decides (paths before domains, then more segments or labels); block wins a tie.

A null or unparsable URL and a null day match nothing and get the verdict none. Entries with a null field are not dated
entries and are left out. Captures are judged by (URL, day), so repeated rows get the same verdict and all rows stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import boxed

ENTRY = ("list", "verdict", "kind", "pattern")
# A path entry is more specific than any domain entry: hosts have fewer labels than this.
PATH_LEVEL = 100_000


def host_of(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), r"\.$", "")


def path_of(url: Column) -> Column:
    """The path without its last slash; empty for none."""
    return F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1), "/+$", "")


def validity_intervals(log: DataFrame) -> DataFrame:
    """``list, verdict, kind, pattern, valid_from, valid_to`` (null: still active) from a log of dated entries."""
    columns = [F.col(c) for c in ENTRY]
    entries = log.select(*columns, F.col("dated").cast("timestamp").alias("at"), (F.col("action") == "add").alias("on")).dropna()
    days = entries.groupBy(*ENTRY, F.to_date("at").alias("day")).agg(F.max(F.struct("at", "on"))["on"].alias("on"))
    by_day = Window.partitionBy(*ENTRY).orderBy("day")  # a row for each day at most
    turns = days.withColumn("before", F.lag("on", 1, False).over(by_day)).where("on != before")
    return turns.withColumn("valid_to", F.lead("day").over(by_day)).where("on").select(
        *ENTRY, F.col("day").alias("valid_from"), "valid_to")


def steps(intervals: DataFrame) -> DataFrame:
    """``kind, pattern, day, blocks, allows``: active entries from that day on."""
    ends = intervals.select("kind", "pattern", "verdict", F.inline(F.expr(
        "array(struct(valid_from as day, 1 as d), struct(valid_to as day, -1 as d))"))).where("day is not null")
    turns = ends.groupBy("kind", "pattern", "day").agg(
        *(F.sum(F.when(F.col("verdict") == v, F.col("d")).otherwise(0)).alias(v) for v in ("block", "allow")))
    so_far = Window.partitionBy("kind", "pattern").orderBy("day")
    return turns.select("kind", "pattern", "day", F.sum("block").over(so_far).alias("blocks"), F.sum("allow").over(so_far).alias("allows"))


def patterns(captures: DataFrame, labels: int, segments: int) -> DataFrame:
    """``url, day, kind, pattern, level``: what entries of at most so many labels and segments could match a URL."""
    parts = captures.select("url", "day", F.split(host_of(F.col("url")), r"\.").alias("host"), F.split(path_of(F.col("url")), "/").alias("path"))
    domains = f"""transform(sequence(1, least(size(host), {labels})), n -> struct(
        'domain' as kind, array_join(slice(host, size(host) - n + 1, n), '.') as pattern, n as level))"""
    paths = f"""transform(sequence(1, least(size(path), {segments + 1})), n -> struct(
        'path' as kind, concat(array_join(host, '.'), array_join(slice(path, 1, n), '/')) as pattern, {PATH_LEVEL} + n as level))"""
    wanted = [x for x, n in ((domains, labels), (paths, segments + 1)) if n > 0]
    if not wanted:
        return parts.select("url", "day", F.lit("").alias("kind"), F.lit("").alias("pattern"), F.lit(0).alias("level")).where("false")
    found = parts.select("url", "day", F.inline_outer(F.expr(wanted[0] if len(wanted) == 1 else f"concat({', '.join(wanted)})")))
    return found.where("pattern != ''")


def judge(captures: DataFrame, log: DataFrame, *, url_col: str = "url", fetched_col: str = "fetched") -> DataFrame:
    """The captures as ``row`` with ``verdict`` (block, allow, none), the ``pattern`` that decided and ``n_active`` matching entries."""
    intervals = validity_intervals(log)
    # The widest entries bound what is asked of a long URL; one row.
    widest = intervals.agg(
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\.")))).alias("labels"),
        F.max(F.when(F.col("kind") == "path", F.size(F.split("pattern", "/")) - 1)).alias("segments")).first()
    asked = captures.select(F.col(url_col).alias("url"), F.to_date(F.col(fetched_col)).alias("day")).dropna().distinct()
    wanted = patterns(asked, widest.labels or 0, -1 if widest.segments is None else widest.segments)
    changes = steps(intervals)
    as_of = Window.partitionBy("kind", "pattern").orderBy("day", "asks").rowsBetween(Window.unboundedPreceding, 0)
    active = (
        changes.withColumn("asks", F.lit(False))
        .unionByName(wanted.select("kind", "pattern", "day").distinct().withColumn("asks", F.lit(True)), allowMissingColumns=True)
        .select("kind", "pattern", "day", "asks", *(F.last(c, ignorenulls=True).over(as_of).alias(c) for c in ("blocks", "allows")))
        .where("asks and blocks + allows > 0").drop("asks"))
    best = F.max(F.struct("level", (F.col("blocks") > 0).alias("blocked"), "pattern"))
    verdicts = wanted.join(active, ["kind", "pattern", "day"]).groupBy("url", "day").agg(
        best.alias("best"), F.sum(F.col("blocks") + F.col("allows")).alias("n_active"))
    rows = boxed(captures, F.col(url_col).alias("url"), F.to_date(F.col(fetched_col)).alias("day"))
    out = rows.join(verdicts, (rows["url"] == verdicts["url"]) & (rows["day"] == verdicts["day"]), "left")
    verdict = F.when(F.col("best").isNull(), "none").when(F.col("best.blocked"), "block").otherwise("allow")
    return out.select("row", verdict.alias("verdict"), F.col("best.pattern").alias("pattern"), F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"))


# The pages table has neither fetch days nor lists. A page is taken as fetched (page_id * 7919) mod 30 days after
# FIRST_DAY. The log is what all events report, each about the page whose number is the event's modulo the number after the
# last page's: on its host, host/first segment or URL path. Every second round over the pages, purchases end their takedowns.
FIRST_DAY, DAYS = "2024-01-01", 30
# event type -> (list, verdict, kind, action); without an action it depends on the round
REPORTS = {
    "error": ("reports", "block", "domain", "add"),
    "signup": ("reports", "block", "domain", "remove"),
    "click": ("partners", "allow", "path", "add"),
    "view": ("partners", "allow", "path", "remove"),
    "purchase": ("takedowns", "block", "path", None),
}


def page_captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.date_add(F.to_date(F.lit(FIRST_DAY)), (F.pmod(F.col("page_id") * 7919, F.lit(DAYS))).cast("int")).alias("fetched"))


def report_log(pages: DataFrame, events: DataFrame) -> DataFrame:
    """The dated entries that the events stand for; an empty table of pages gives none."""
    names = ("list", "verdict", "kind", "action")
    reports = F.create_map(*(x for k, v in REPORTS.items() for x in (F.lit(k), F.struct(*(F.lit(s).cast("string").alias(n) for s, n in zip(v, names))))))
    round_ = F.when(F.floor(F.col("event_id") / F.col("n")) % 2 == 0, "add").otherwise("remove")
    asked = events.select("event_id", "ts", reports[F.col("event_type")].alias("r")).where("r is not null").crossJoin(
        F.broadcast(pages.agg((F.max("page_id") + 1).alias("n"))))  # one row
    entries = asked.select(
        F.pmod("event_id", "n").alias("page_id"), "r.list", "r.verdict", "r.kind", F.coalesce("r.action", round_).alias("action"), F.col("ts").alias("dated"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    places = pages.select("page_id", host.alias("host"), F.concat(host, F.regexp_extract(path, "^(/[^/]*)", 1)).alias("first"), F.concat(host, path).alias("whole"))
    pattern = F.when(F.col("kind") == "domain", F.col("host")).when(F.col("list") == "partners", F.col("first")).otherwise(F.col("whole"))
    return entries.join(places, "page_id").select("list", "verdict", "kind", pattern.alias("pattern"), "action", "dated")


def oracle() -> str:
    """The query's rows as DuckDB SQL: each capture against each interval of its patterns."""
    reports = ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" for x in (k, *v)) + ")" for k, v in REPORTS.items())
    return rf"""
WITH page AS (
  SELECT page_id, url, CAST(DATE '{FIRST_DAY}' + CAST(((page_id * 7919) % {DAYS}) AS INTEGER) AS DATE) AS fetched,
    regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '\.$', '') AS host,
    regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/+$', '') AS path
  FROM pages),
n AS (SELECT max(page_id) + 1 AS n FROM pages),
log AS (
  SELECT r.list, r.verdict, r.kind, coalesce(r.action, CASE WHEN (e.event_id // n) % 2 = 0 THEN 'add' ELSE 'remove' END) = 'add' AS adds, e.ts,
    CASE WHEN r.kind = 'domain' THEN host WHEN r.list = 'partners' THEN host || regexp_extract(path, '^(/[^/]*)', 1) ELSE host || path END AS pattern
  FROM events e, n JOIN page p ON p.page_id = e.event_id % n
  JOIN (VALUES {reports}) r(event_type, list, verdict, kind, action) ON r.event_type = e.event_type),
days AS (
  SELECT list, verdict, kind, pattern, CAST(ts AS DATE) AS dated, arg_max(adds, struct_pack(at := ts, adds := adds)) AS is_on
  FROM log GROUP BY list, verdict, kind, pattern, CAST(ts AS DATE)),
turns AS (
  SELECT * FROM (SELECT *, lag(is_on, 1, false) OVER (PARTITION BY list, verdict, kind, pattern ORDER BY dated) AS was FROM days) WHERE is_on <> was),
intervals AS (
  SELECT * FROM (SELECT *, dated AS valid_from, lead(dated) OVER (PARTITION BY list, verdict, kind, pattern ORDER BY dated) AS valid_to FROM turns) WHERE is_on),
wanted AS (
  SELECT page_id, fetched, 'domain' AS kind, n AS level, array_to_string(h[len(h) - n + 1:], '.') AS pattern
  FROM (SELECT *, unnest(range(1, len(h) + 1)) AS n FROM (SELECT *, string_split(host, '.') AS h FROM page))
  UNION ALL
  SELECT page_id, fetched, 'path', {PATH_LEVEL} + n, host || array_to_string(s[1:n], '/')
  FROM (SELECT *, unnest(range(1, len(s) + 1)) AS n FROM (SELECT *, string_split(path, '/') AS s FROM page))),
hits AS (
  SELECT w.page_id, w.level, w.pattern, count(*) AS n, max(i.verdict = 'block') AS blocked
  FROM wanted w JOIN intervals i ON i.kind = w.kind AND i.pattern = w.pattern AND i.valid_from <= w.fetched
    AND (i.valid_to IS NULL OR w.fetched < i.valid_to)
  GROUP BY ALL),
best AS (SELECT page_id, sum(n) AS n, max(struct_pack(level := level, blocked := blocked, pattern := pattern)) AS b FROM hits GROUP BY page_id)
SELECT p.page_id, p.url, CAST(p.fetched AS VARCHAR) AS fetched, CASE WHEN b.b IS NULL THEN 'none' WHEN b.b.blocked THEN 'block' ELSE 'allow' END AS verdict,
  b.b.pattern AS pattern, CAST(coalesce(b.n, 0) AS BIGINT) AS n_active
FROM page p LEFT JOIN best b USING (page_id)"""
