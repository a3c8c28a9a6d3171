"""URL filters: a sorted sweep of canonical keys past nested intervals of rules.

Reversed hosts ("com.example.www.") sort so that a host and all its subdomains
are one interval, and intervals of rules nest. In a sorted sweep the active
rules are a stack. Level by level: hosts of d labels are disjoint intervals, so
the only one of them that can be active is the one opened last, and the stack
is one running "last opened" per level. The sweep runs over slices of the
sorted keys; the last opening of the earlier slices (one row per slice) is
carried in. Hosts are swept past the hosts of rules; then paths, below the
hosts found active, past the paths of their rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsflow.session import materialise

MAX_LABELS = 127  # of a host name
ALLOW, BLOCK = "allow", "block"


def lower_ascii(column: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, upper, upper.lower())


def host_of(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; '' without it."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end; '' if there is no host part. No later "://" is tried."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^(?>.*?://)[^/?#]*(/[^?#]*)", 1), F.lit(""))


def _without_marks(part: Column) -> Column:
    """A text without U+0000, which then can close it; different texts stay different."""
    return F.replace(F.replace(part, F.lit("\x01"), F.lit("\x01\x02")), F.lit("\x00"), F.lit("\x01\x01"))


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, each closed by a mark that no label holds."""
    return F.concat(F.array_join(F.reverse(F.split(_without_marks(host), r"\.")), "\x00"), F.lit("\x00"))


def _last_opened(marks: DataFrame, keys: DataFrame, levels: int) -> DataFrame:
    """Sweep ``keys`` (key, others) past ``marks`` (key, level, value) in sorted order.

    Adds to ``keys`` the array ``stack``: by level, the value opened last at or
    before the key. Both sides meet in slices of the sorted order; windows run
    within a slice and the last openings of earlier slices are carried in.
    """
    rest = [c for c in keys.columns if c != "key"]
    both = marks.select("key", "level", "value", *(F.lit(None).cast(keys.schema[c].dataType).alias(c) for c in rest)).unionByName(
        keys.select("key", F.lit(None).cast("int").alias("level"), F.lit(None).cast(marks.schema["value"].dataType).alias("value"), *rest)
    )
    slices = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialise(both.repartitionByRange(slices, "key").withColumn("_slice", F.spark_partition_id()))
    opened = [F.when(F.col("level") == n, F.struct("key", "value")) for n in range(1, levels + 1)]
    ends = sliced.groupBy("_slice").agg(*(F.max(o).alias(f"_end{n}") for n, o in enumerate(opened, 1)))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_slice", *(F.last(f"_end{n}", ignorenulls=True).over(earlier).alias(f"_before{n}") for n in range(1, levels + 1)))
    # A rule opens before the keys that equal its own.
    within = Window.partitionBy("_slice").orderBy("key", F.col("level").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    swept = sliced.join(F.broadcast(carried), "_slice").select(
        "key",
        "level",
        *rest,
        *(F.coalesce(F.last(o, ignorenulls=True).over(within), F.col(f"_before{n}")).alias(f"_open{n}") for n, o in enumerate(opened, 1)),
    )
    return swept.where("level IS NULL").select("key", *rest, F.array(*(f"_open{n}" for n in range(1, levels + 1))).alias("stack"))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Find the rule of every distinct (host, path).

    ``urls`` has host and path, ``rules`` host, path and verdict. A rule fits
    its host and all subdomains if the path starts with the rule's. The longest
    rule (host and path together) wins; of equally long ones that with the
    longer host, and of repeated ones the smaller verdict. Returns host, path,
    rule (host and path) and verdict for the pairs that a rule fits.
    """
    listed = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    listed = materialise(listed)
    if listed.isEmpty():
        return urls.select("host", "path", F.lit("").alias("rule"), F.lit("").alias("verdict")).where("false")
    pairs = materialise(urls.select("host", "path").distinct())

    # Hosts: levels are numbers of labels.
    named = listed.select("host").distinct().withColumn("level", F.size(F.split("host", r"\.")))
    deepest = named.agg(F.max("level")).first()[0]  # a single number, bounded by the labels of a host
    marks = named.select(reversed_host(F.col("host")).alias("key"), "level", F.col("host").alias("value"))
    hosts = pairs.select("host").distinct().select(reversed_host(F.col("host")).alias("key"), F.col("host").alias("url_host"))
    stacks = _last_opened(marks, hosts, deepest)
    active = stacks.select("url_host", "key", F.explode("stack").alias("open")).where(F.col("key").startswith(F.col("open.key")))
    active = active.select("url_host", F.col("open.value").alias("rule_host"))

    # Paths: the level of a rule is how many paths of its host's rules are prefixes of its path.
    prefixes = listed.select("host", "path", F.explode(F.sequence(F.lit(0), F.length("path"))).alias("_n")).select(
        "host", "path", F.expr("substring(path, 1, _n)").alias("_prefix")
    )
    shorter = listed.select("host", F.col("path").alias("_prefix"))
    nested = materialise(prefixes.join(shorter, ["host", "_prefix"]).groupBy("host", "path").agg(F.count("*").cast("int").alias("level")))
    deepest = nested.agg(F.max("level")).first()[0]
    path_key = lambda host, path: F.concat(_without_marks(F.col(host)), F.lit("\x00"), F.col(path))
    marks = nested.join(listed, ["host", "path"]).select(
        path_key("host", "path").alias("key"), "level", F.struct("host", "path", "verdict").alias("value")
    )
    below = pairs.join(active, F.col("host") == F.col("url_host")).select(
        path_key("rule_host", "path").alias("key"), F.col("host").alias("url_host"), F.col("path").alias("url_path")
    )
    found = _last_opened(marks, below, deepest)
    fitting = F.filter("stack", lambda o: F.col("key").startswith(o["key"]))
    best = F.array_max(
        F.transform(
            fitting,
            lambda o: F.struct(
                (F.length(o["value"]["host"]) + F.length(o["value"]["path"])).alias("n"),
                F.length(o["value"]["host"]).alias("h"),
                F.concat(o["value"]["host"], o["value"]["path"]).alias("rule"),
                o["value"]["verdict"].alias("verdict"),
            ),
        )
    )
    return (
        found.select("url_host", "url_path", best.alias("best"))
        .groupBy("url_host", "url_path")
        .agg(F.max("best").alias("best"))
        .where("best IS NOT NULL")
        .select(F.col("url_host").alias("host"), F.col("url_path").alias("path"), "best.rule", "best.verdict")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """Per row: id, host, path, rule (null if none fits) and verdict (``default`` if none fits).

    Null urls and urls without "://" have an empty host and path, which no
    rule of a host fits. Hosts and paths may hold any characters. Repeated rows and null ids give a row each; an empty
    table gives none; other columns are not read. Each distinct host and each
    distinct pair is swept once, so a host may hold most of the rows.
    """
    parsed = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    ruled = match_rules(parsed, rules)
    return parsed.join(ruled, ["host", "path"], "left").select(
        id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
