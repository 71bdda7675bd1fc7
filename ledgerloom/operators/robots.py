"""Robots rules as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parse_robots(texts: DataFrame, key: str = "host", text: str = "robots") -> DataFrame:
    """host, grp, agent, allow, pattern, pos: a row per agent and rule of each group; agents of groups without rules have a null pattern.

    Neighbouring user-agent lines share a group; an empty disallow ends the
    list of agents and makes no rule; an empty agent is ignored.
    """
    lines = texts.select(F.col(key).alias("host"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\r?\n")).alias("pos", "raw"))
    line = lines.withColumn("line", F.trim(F.regexp_replace("raw", r"\s*#.*$", ""))).filter(F.col("line").contains(":"))
    parsed = line.select("host", "pos", F.lower(F.trim(F.split_part("line", F.lit(":"), F.lit(1)))).alias("field"), F.trim(F.substr("line", F.instr("line", ":") + 1)).alias("value"))
    used = parsed.filter(F.col("field").isin("user-agent", "allow", "disallow"))
    order = Window.partitionBy("host").orderBy("pos")
    starts = (F.col("field") == "user-agent") & (F.coalesce(F.lag("field").over(order), F.lit("")) != "user-agent")
    grouped = used.withColumn("_start", starts.cast("int")).withColumn("grp", F.sum("_start").over(order)).filter("grp > 0")
    agents = grouped.filter("field = 'user-agent' and value != ''").select("host", "grp", F.lower("value").alias("agent")).distinct()
    rules = grouped.filter("field != 'user-agent' and not (field = 'disallow' and value = '')").select("host", "grp", (F.col("field") == "allow").alias("allow"), F.col("value").alias("pattern"), "pos")
    return agents.join(rules, ["host", "grp"], "left")


def pattern_regex(pattern: Column) -> Column:
    """a robots pattern as a regular expression: * for anything, a final $ for the end, else a prefix; an empty one matches nothing."""
    end = pattern.endswith("$")
    body = F.when(end, F.substr(pattern, F.lit(1), F.length(pattern) - 1)).otherwise(pattern)
    quoted = F.regexp_replace(body, r"([|\\{}()\[\]^$+?.])", r"\\$1")
    return F.when(pattern != "", F.concat(F.lit("^"), F.replace(quoted, F.lit("*"), F.lit(".*")), F.when(end, "$").otherwise("")))


def allowed(pages: DataFrame, rules: DataFrame, agent: str) -> DataFrame:
    """pages with a column allowed, by the rules of their host (J10 is bounded by the host, then W4).

    Groups that name the agent count, else those of *; of the matching rules
    the longest pattern decides, allow on ties; without one a page is allowed.
    """
    name = F.lit(agent.lower())
    named = rules.filter((F.col("agent") != "*") & name.contains(F.col("agent")))
    starred = rules.filter(F.col("agent") == "*").join(named.select("host").distinct(), "host", "left_anti")
    used = named.unionByName(starred).filter("pattern is not null").select("host", "allow", "pattern").distinct()
    path = F.regexp_extract("url", r"^[^/]*//[^/?#]*([^#]*)", 1)
    keyed = pages.withColumn("_path", F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)))
    sized = used.withColumns({"_rx": pattern_regex(F.col("pattern")), "_size": F.length(F.regexp_replace("pattern", "[*$]", ""))})
    met = keyed.select("host", "_path").distinct().join(sized, "host").filter(F.regexp_like("_path", F.col("_rx")))
    best = met.groupBy("host", "_path").agg(F.max(F.struct("_size", "allow")).alias("b")).select("host", "_path", F.col("b.allow").alias("_allow"))
    return keyed.join(best, ["host", "_path"], "left").withColumn("allowed", F.coalesce("_allow", F.lit(True))).drop("_allow", "_path")
