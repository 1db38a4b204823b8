"""URL filters by host and path rules, as a sort-merge join of keys with prefix intervals.

A rule's canonical key is its host with the labels reversed, then its path:
``com.example./en/``. All urls a rule fits on one host are an interval of keys
that begin with the rule's. A url is probed once for its host and once for each
parent domain, which puts the rules of all parent domains into intervals too.
Probes and rules are sorted together; the sweep carries the rule that began
last, with the stack of rules it is nested in, so the rules active at a probe
are read off that stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import fold

ALLOW, BLOCK = "allow", "block"
#: Probes of one host and salt; a host with more probes is spread, its rules repeated for each salt.
SALT_ROWS = 1_000_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = fold(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(F.substr(rest, F.char_length(F.regexp_extract(rest, r"^[^/?#]*", 0)) + 1), r"^[^?#]*", 0)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def parent_keys(host: Column, most: int) -> Column:
    """The reversed keys of the host and its parent domains that have at most ``most`` labels, the longest first."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.greatest(F.size(labels) - (most - 1), F.lit(1)), F.size(labels)),
        lambda i: reversed_host(F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )


def nested(rules: DataFrame) -> DataFrame:
    """``(host_key, path, stack)`` of each rule: itself and the rules of its host whose path begins its own.

    Paths of a host that begin a path are found by equality with its prefixes.
    A rule given twice counts once; of two verdicts for one rule, block wins.
    """
    once = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull()).groupBy(
        reversed_host(fold(F.col("host"))).alias("host_key"), "path"
    ).agg(F.min(fold(F.col("host"))).alias("host"), F.max("verdict").alias("verdict"))
    begins = once.select("host_key", "path", F.explode(
        F.transform(F.sequence(F.lit(0), F.char_length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n))
    ).alias("begin"))
    outer = once.select(
        "host_key", F.col("path").alias("begin"),
        F.struct(F.char_length("path").alias("path_size"), F.col("path").alias("rule_path"),
                 F.concat("host", "path").alias("rule"), "verdict").alias("entry"),
    )
    return begins.join(outer, ["host_key", "begin"]).groupBy("host_key", "path").agg(
        F.sort_array(F.collect_list("entry"), asc=False).alias("stack")
    )


def judged(
    pages: DataFrame, rules: DataFrame, *, key: str = "page_id", url: str = "url", default: str = ALLOW,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, a row for each row of ``pages``.

    ``rules`` has ``(host, path, verdict)``; a rule fits its host and every
    subdomain where the url's path begins with the rule's. The longest host
    plus path wins, the longer host among equals. Without a rule the verdict is
    ``default``. Null urls have no host and fit no rule, urls may be of any
    length and hosts of any number of labels; rows may repeat;
    other columns are not read. An empty ``rules`` leaves the default everywhere.
    """
    host, path = url_parts(F.col(url))
    urls = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url")).groupBy("page_id", "url").agg(
        F.count("*").alias("copies")
    ).select("page_id", "url", "copies", host.alias("host"), path.alias("path"))
    stacks = nested(rules)
    # Longer parents than the longest rule's host have no rule.
    most = rules.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 1
    probes = urls.filter("host <> ''").select(
        "page_id", "url", F.col("path").alias("at"), F.explode(parent_keys(F.col("host"), most)).alias("host_key")
    )
    ruled = stacks.groupBy("host_key").agg(F.count("*").alias("rules"))
    probes = probes.join(ruled.select("host_key"), "host_key", "left_semi")
    # A hot host, such as a top-level domain, is spread over salts; its few rules are repeated.
    load = probes.groupBy("host_key").agg(F.ceil(F.count("*") / salt_rows).cast("int").alias("parts"))
    salted = probes.join(load, "host_key").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.col("parts")))
    starts = stacks.join(load, "host_key").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))
    )
    events = starts.select("host_key", "salt", F.col("path").alias("at"), "stack").unionByName(
        salted.select("host_key", "salt", "at", "page_id", "url"), allowMissingColumns=True
    )
    # A rule sorts before the probes that are equal to its key.
    sweep = Window.partitionBy("host_key", "salt").orderBy("at", F.col("stack").isNull())
    carried = events.withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).filter("stack IS NULL")
    fits = F.filter("active", lambda e: F.col("at").startswith(e["rule_path"]))
    best = F.get(fits, F.lit(0))  # the stack is ordered: the longest path first
    found = carried.select("page_id", "url", best.alias("best")).filter("best IS NOT NULL")
    winner = found.groupBy("page_id", "url").agg(
        F.max(F.struct(
            F.char_length("best.rule").alias("size"), (-F.col("best.path_size")).alias("host_first"),
            F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"),
        )).alias("won")
    )
    joined = urls.join(
        winner.withColumnsRenamed({"page_id": "_id", "url": "_url"}),
        F.col("page_id").eqNullSafe(F.col("_id")) & F.col("url").eqNullSafe(F.col("_url")), "left",
    )
    whole = joined.select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", F.lit(default)).alias("verdict"), "copies",
    )
    repeats = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return whole.withColumn("_copy", repeats).drop("copies", "_copy")
