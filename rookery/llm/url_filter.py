"""URL filters as a sort-merge range join.

A url and a rule get a canonical key: the host's labels reversed, then the
path. A rule's prefix is an interval of such keys; the rules of one host nest.
Each url is looked up under every parent domain that a rule could name. Rules'
interval ends and urls are sorted together and swept once: the running sum of
starts and ends is the height of the stack of active rules, and each stack slot
holds the last rule opened at that height. The url's rule is the top.

DataFrame functions only. Only parent domains that have a rule are swept. How
many urls stand under each of them is counted first, and one of more than
``per_task`` is split by a salt of the url's row into so many parts as that takes;
its rules are repeated for each part. So no task's share grows with the input,
whatever domain holds most of it.

Defined results: a null url, or one without ``://``, has an empty host and path
and no rule; a url's path is '' if nothing follows the host; of two rules of
the same length the one with the longer host wins; of equal rules ``block``
wins; a rule with a null or empty host fits nothing, a null path counts as '';
repeated rows give a result each; an empty table gives an empty result. Only
the id and url columns are read, so other columns' names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rookery.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), path).cast("binary")


def _clean(rules: DataFrame) -> DataFrame:
    return (rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                         F.col("verdict").cast("string").alias("verdict"))
            .where(F.col("host") != "")
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
            .withColumn("key", canonical(F.col("host"), F.col("path"))))


def _ends(rules: DataFrame) -> list[DataFrame]:
    """Each rule's interval as an opening and a closing event."""
    rule = F.struct(F.char_length(F.concat("host", "path")).alias("size"), F.char_length("host").alias("host_size"),
                    F.concat("host", "path").alias("rule"), "verdict")
    return [rules.select("host", "key", F.lit(0).alias("kind"), F.lit(1).alias("step"), rule.alias("opened")),
            rules.select("host", F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(2).alias("kind"),
                         F.lit(-1).alias("step"), F.lit(None).cast("struct<size:int,host_size:int,rule:string,verdict:string>")
                         .alias("opened"))]


def parents_of(rows: DataFrame, labels_max: int) -> DataFrame:
    """``rows`` (with ``full_host``) under each parent domain of up to ``labels_max`` labels."""
    labels = F.split("full_host", r"\.")
    most = F.least(F.size(labels), F.lit(labels_max))
    return rows.withColumn("host", F.explode(F.transform(
        F.sequence(F.lit(1), most), lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))))


def parts_of(probes: DataFrame, hosts: DataFrame, per_task: int) -> DataFrame:
    """``host, parts``: into how many parts the urls under each rule's host fall."""
    return (probes.join(hosts, "host", "left_semi").groupBy("host").agg(F.count(F.lit(1)).alias("n"))
            .select("host", F.ceil(F.col("n") / per_task).cast("int").alias("parts")))


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", per_task: int = 100_000) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for each row of ``pages``.

    ``rules`` has ``host, path, verdict``. Its nesting height and its longest
    host are fetched first (two numbers)."""
    clean = _clean(rules)
    opening, closing = _ends(clean)
    height = Window.partitionBy("host").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    bounds = (opening.unionByName(closing).withColumn("height", F.sum("step").over(height))
              .agg(F.max("height").alias("h"), F.max(F.size(F.split("host", r"\."))).alias("n")).first())
    slots, labels_max = int(bounds["h"] or 0), int(bounds["n"] or 0)

    url = F.col(f"`{url_col}`").cast("string")
    rows = (pages.select(F.col(f"`{id_col}`").alias("__id"), host_of(url).alias("full_host"), path_of(url).alias("path"))
            .groupBy("__id", "full_host", "path").agg(F.count(F.lit(1)).alias("rows")))
    verdict = [F.col("__id").alias(id_col), F.col("full_host").alias("host"), "path"]
    if not slots:
        return (rows.select("*", F.explode(F.expr("array_repeat(0, int(rows))")))
                .select(*verdict, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")))

    probed = parents_of(rows, labels_max)
    parts = cut_lineage(parts_of(probed, clean.select("host").distinct(), per_task))
    probes = (probed.join(parts, "host").withColumn("salt", F.pmod(F.xxhash64("__id", "full_host", "path"), F.col("parts")).cast("int"))
              .select("host", "salt", canonical(F.col("host"), F.col("path")).alias("key"), F.lit(1).alias("kind"),
                      F.lit(0).alias("step"), "__id", "full_host", "path", "rows"))
    ends = opening.unionByName(closing).join(parts, "host").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    sweep = Window.partitionBy("host", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    events = (probes.unionByName(ends, allowMissingColumns=True).withColumn("height", F.sum("step").over(sweep)))
    stack = F.array(*[F.last(F.when((F.col("kind") == 0) & (F.col("height") == d), F.col("opened")), ignorenulls=True).over(sweep)
                      for d in range(1, slots + 1)])
    top = F.when(F.col("height") > 0, F.element_at("stack", F.col("height").cast("int")))
    swept = events.withColumn("stack", stack).where("kind = 1").select("__id", "full_host", "path", "rows", top.alias("top"))
    bare = rows.select("__id", "full_host", "path", "rows", F.lit(None).cast(swept.schema["top"].dataType).alias("top"))
    best = swept.unionByName(bare).groupBy("__id", "full_host", "path", "rows").agg(F.max("top").alias("best"))
    return (best.select("*", F.explode(F.expr("array_repeat(0, int(rows))")))
            .select(*verdict, F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
