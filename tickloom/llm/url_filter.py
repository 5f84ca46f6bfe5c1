"""URL filters: fixed rules, and a path-template tree per host for what no rule decides.

Every path becomes a template: digits turn into `*`, and below a parent with many children that come less than
three times each, the children turn into `*` too. Sibling templates whose share of bad labels does not differ from
that of all siblings (two-sided test at 5 %) are merged. A template is rejected if its smoothed share of bad labels
reaches one half. Everything is DataFrame functions; the tree works on counts per host and path shape.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialize

#: The contract's rules.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Levels that the SQL spells out; the tree of judge() is as deep as the paths.
DEPTH = 6
FANOUT, REPEATS = 12, 3
SIMILAR, PRIOR, REJECT = 1.96, 5.0, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null and without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        site, slash, rest = rule.partition("/")
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def shape(path: Column) -> Column:
    """The path's segments, their digits generalised."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.regexp_replace(s, r"[0-9]+", "*"))


def templates(shapes: DataFrame) -> DataFrame:
    """shapes (host, shape, n, m, bad) with their template and its parent.

    n counts pages, m the labelled ones, bad those labelled bad. The tree grows by a level a round until every
    shape has ended; a shape that is alone below its template takes all its segments at once.
    """
    rows, ended, i = shapes.withColumn("template", F.lit("")).withColumn("parent", F.lit("")).withColumn("at", F.lit(0)), [], 0
    while True:
        ended.append(rows.where(F.col("at") == F.size("shape")).drop("at"))
        rows = rows.where(F.col("at") < F.size("shape"))
        if rows.isEmpty():
            break
        nodes = rows.groupBy("host", F.col("template").alias("above"), F.get("shape", F.lit(i)).alias("child")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("shapes"))
        wide = nodes.groupBy("host", "above").agg(((F.count(F.lit(1)) > FANOUT) & (F.count(F.lit(1)) * REPEATS > F.sum("n"))).alias("wide"), (F.sum("shapes") == 1).alias("alone")).select(F.col("host").alias("h"), "above", "wide", "alone")
        rows = rows.join(wide, (F.col("host") == F.col("h")) & (F.col("template") == F.col("above")))
        until = F.when(F.col("alone"), F.size("shape")).otherwise(i + 1)
        between = F.concat_ws("/", "template", F.slice("shape", F.lit(i + 1), until - i - 1))
        parent = F.when(until > i + 1, between).otherwise(F.col("template"))
        grown = F.concat(parent, F.lit("/"), F.when(F.col("wide"), "*").otherwise(F.get("shape", until - 1)))
        rows = rows.select("host", "shape", "n", "m", "bad", grown.alias("template"), parent.alias("parent"), until.alias("at"))
        rows = materialize(rows)  # else every level would compute all levels above it twice
        i += 1
    return reduce(DataFrame.union, ended)


def rejected(rows: DataFrame) -> DataFrame:
    """(host, shape, template, reject) from rows with templates."""
    nodes = rows.groupBy("host", "parent", "template").agg(F.sum("m").alias("m"), F.sum("bad").alias("bad"))
    siblings = nodes.groupBy("host", "parent").agg(F.sum("m").alias("all_m"), F.sum("bad").alias("all_bad"))
    nodes = nodes.join(siblings, ["host", "parent"])
    q = (F.col("all_bad") + 1) / (F.col("all_m") + 2)
    apart = F.abs(F.col("bad") / F.col("m") - F.col("all_bad") / F.col("all_m")) > SIMILAR * F.sqrt(q * (1 - q) / F.col("m"))
    nodes = nodes.withColumn("own", F.when(F.col("m") > 0, apart).otherwise(F.lit(False)))
    merged = nodes.where("not own").groupBy("host", "parent").agg(F.sum("m").alias("pool_m"), F.sum("bad").alias("pool_bad"))
    nodes = nodes.join(merged, ["host", "parent"], "left")
    base = rows.agg(F.coalesce(F.sum("bad") / F.when(F.sum("m") > 0, F.sum("m")), F.lit(0.0)).alias("base"))
    nodes = nodes.join(F.broadcast(base))  # one row
    m, bad = F.when(F.col("own"), F.col("m")).otherwise(F.col("pool_m")), F.when(F.col("own"), F.col("bad")).otherwise(F.col("pool_bad"))
    nodes = nodes.select("host", "template", ((bad + PRIOR * F.col("base")) / (m + PRIOR) >= REJECT).alias("reject"))
    return rows.select("host", "shape", "template").join(nodes, ["host", "template"])


def judge(pages: DataFrame, labelled: DataFrame, key: str = "page_id", url: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, template), one for every row of pages.

    labelled has rows (page_id, bad) with bad 0 or 1; other values and repeated keys count once, as bad if one row
    says so. Null urls and urls without `://` have empty host and path and are judged as that host's root. Repeated
    rows get equal answers; an empty table or one without labels rejects nothing beyond the rules. Urls of any length
    are read whole; other columns of any name are ignored.
    """
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path")).withColumn("shape", shape(F.col("path")))
    known = labelled.where("bad in (0, 1)").groupBy(F.col("page_id").alias("k")).agg(F.max("bad").alias("bad"))
    counted = rows.join(known, F.col("page_id") == F.col("k"), "left")
    shapes = counted.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("m"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    found = rejected(templates(materialize(shapes))).select(F.col("host").alias("h"), F.col("shape").alias("s"), "template", "reject")
    rows = rows.join(found, (F.col("host") == F.col("h")) & (F.col("shape") == F.col("s")), "left").withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("ruled.verdict"), F.when(F.col("reject"), "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", F.col("ruled.rule").alias("rule"), verdict.alias("verdict"), "template")


def judge_sql(pages: str, labelled: str) -> str:
    """DuckDB SQL of judge() with RULES, over a relation (page_id, url) and one (page_id, bad)."""
    ordered = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))

    def fits(rule: str) -> str:
        site, slash, rest = rule.partition("/")
        return f"(host = '{site}' OR ends_with(host, '.{site}')) AND starts_with(path, '{slash + rest}')"

    case = {what: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{v if what == 'verdict' else r}'" for v, r in ordered) + " END" for what in ("rule", "verdict")}
    ctes = f"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM {pages}),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(rest, '') AS rest FROM cut)),
segments AS (SELECT *, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: regexp_replace(s, '[0-9]+', '*', 'g')) AS parts FROM parsed),
shaped AS (SELECT page_id, host, path, CASE WHEN len(parts) > {DEPTH} THEN list_append(parts[1:{DEPTH - 1}], '**') ELSE parts END AS shape FROM segments),
known AS (SELECT page_id, max(bad) AS bad FROM {labelled} WHERE bad IN (0, 1) GROUP BY page_id),
t0 AS (
  SELECT host, shape, count(*) AS n, count(bad) AS m, coalesce(sum(bad), 0) AS bad, '' AS template, '' AS parent
  FROM shaped LEFT JOIN known USING (page_id) GROUP BY host, shape)"""
    for i in range(1, DEPTH + 1):
        ctes += f""",
w{i} AS (
  SELECT host, template, count(*) > {FANOUT} AND count(*) * {REPEATS} > sum(n) AS wide
  FROM (SELECT host, template, shape[{i}] AS child, sum(n) AS n FROM t{i - 1} WHERE shape[{i}] IS NOT NULL GROUP BY ALL) GROUP BY host, template),
t{i} AS (
  SELECT t.host, shape, n, m, bad,
         CASE WHEN shape[{i}] IS NULL THEN t.template ELSE t.template || '/' || CASE WHEN wide THEN '*' ELSE shape[{i}] END END AS template,
         CASE WHEN shape[{i}] IS NULL THEN parent ELSE t.template END AS parent
  FROM t{i - 1} t LEFT JOIN w{i} w ON t.host = w.host AND t.template = w.template)"""
    return ctes + f""",
nodes AS (SELECT host, parent, template, sum(m) AS m, sum(bad) AS bad FROM t{DEPTH} GROUP BY ALL),
tested AS (
  SELECT *, sum(m) OVER s AS all_m, sum(bad) OVER s AS all_bad FROM nodes WINDOW s AS (PARTITION BY host, parent)),
marked AS (
  SELECT *, CASE WHEN m > 0 THEN abs(bad::DOUBLE / m - all_bad::DOUBLE / all_m) > {SIMILAR}::DOUBLE * sqrt((all_bad + 1)::DOUBLE / (all_m + 2) * (1 - (all_bad + 1)::DOUBLE / (all_m + 2)) / m) ELSE false END AS own FROM tested),
pooled AS (
  SELECT *, sum(CASE WHEN own THEN 0 ELSE m END) OVER s AS pool_m, sum(CASE WHEN own THEN 0 ELSE bad END) OVER s AS pool_bad FROM marked WINDOW s AS (PARTITION BY host, parent)),
base AS (SELECT coalesce(sum(bad)::DOUBLE / nullif(sum(m), 0), 0.0) AS base FROM t{DEPTH}),
decided AS (
  SELECT host, template, (CASE WHEN own THEN bad ELSE pool_bad END + {PRIOR}::DOUBLE * base) / (CASE WHEN own THEN m ELSE pool_m END + {PRIOR}::DOUBLE) >= {REJECT} AS reject FROM pooled, base)
SELECT page_id, p.host, path, {case['rule'].replace('host', 'p.host')} AS rule, coalesce({case['verdict'].replace('host', 'p.host')}, CASE WHEN reject THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM shaped p JOIN t{DEPTH} t ON p.host = t.host AND p.shape = t.shape JOIN decided d ON t.host = d.host AND t.template = d.template
"""
