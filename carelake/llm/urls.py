"""URL rules with redirect equivalence.

A rule names a host and a path prefix; it fits its host and all subdomains, and of
the fitting rules the longest wins (the smaller text on a tie).  URLs without a rule
take the verdict of their class: pages are linked to the canonical link and the
refresh target that their html names, classes are the connected components of these
links, a blocked member blocks its aliases, and an explicit allow in the class goes
before a block.  Without either the verdict is allow.

Targets are resolved as a browser does: against the page's url or its first ``base`` tag, also
those that are relative to its folder, start with ``..`` or are a query only.  A node
is a url with scheme and host in lower case, without ``.`` and ``..`` segments and without
fragment, blanks as ``%20``, so all spellings of a page's url share its class.  Tags in comments and in
script, style, title and textarea elements are not seen.

Defined cases: null url, or none with ``://``: empty host and path, no rule, allow
(such a row takes no part in links); null html has no links; targets of other schemes
(``mailto:``) are no links; an empty path and ``/`` are two nodes, as for rules; repeated urls are one
node; very long pages are read whole, each in one task; an empty table gives an empty result; further columns are kept, those called
host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import LOWER, UPPER, materialise, without
from .components import components

#: Rules of the registered query: (host and path, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
CANONICAL = (r"""(?i)<link\b[^>]*(?<![\w-])rel\s*=\s*(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|"""
             r"""'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'|canonical(?=[\s/>]))[^>]*>""")
#: What a page does not show as tags; a comment without end goes to the end of the page.
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\z)"
BASE = r"(?i)<base\b[^>]*(?<![\w-])href\s*=[^>]*>"
REFRESH = r"""(?i)<meta\b[^>]*(?<![\w-])http-equiv\s*=\s*["']?\s*refresh\b[^>]*>"""
#: A value in quotes goes up to its quote, another up to a blank.
VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>]+))"""
#: A refresh names its target after a number and a separator, with or without ``url=``.
TARGET = r"""(?is)^\s*[0-9.]*\s*(?:[;,]|\s)\s*(?:url\s*=\s*)?(?:"([^"]*)|'([^']*)|(.*))"""


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    rows = [(r.partition("/")[0], "/" + r.partition("/")[2], r, v) for r, v in rules]
    return spark.createDataFrame(rows, "rule_host string, rule_path string, rule string, verdict string")


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, _rules) for distinct hosts that some rule fits, through the host's suffixes."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = hosts.filter("host <> ''").select("host", F.explode(suffixes).alias("rule_host"))
    return (each.join(rules, "rule_host").groupBy("host")
            .agg(F.collect_set(F.struct("rule_path", "rule", "verdict")).alias("_rules")))


def longest_rule(path: Column, rules: Column) -> Column:
    """The (rule, verdict) struct of the longest rule whose path starts ``path``; null without one."""
    fitting = F.filter(rules, lambda r: F.startswith(path, r["rule_path"]))
    ranked = F.transform(fitting, lambda r: F.struct((-F.length(r["rule"])).alias("k"), r["rule"].alias("rule"),
                                                     r["verdict"].alias("verdict")))
    return F.array_min(ranked)


def _ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (url, ...) with host, path, rule and the rule's verdict."""
    split = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    by_host = materialise(rules_by_host(split.select("host").distinct(), rules), "url-rules")
    hit = split.join(by_host, "host", "left").withColumn("_hit", longest_rule(F.col("path"), F.col("_rules")))
    return hit.withColumns({"rule": F.col("_hit.rule"), "verdict": F.col("_hit.verdict")}).drop("_rules", "_hit")


def _without_dots(path: Column) -> Column:
    """``path`` less its ``.`` and ``..`` segments; empty stays empty."""
    segments = F.split(F.regexp_replace(path, r"/(\.\.?)$", "/$1/"), "/", -1)
    left = F.aggregate(F.slice(segments, 2, F.size(segments)), F.slice(segments, 1, 1), lambda done, x: (
        F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(x)))))
    return F.when(F.contains(path, F.lit("/.")), F.array_join(left, "/")).otherwise(path)


def node_of(url: Column) -> Column:
    """``url`` as a node: lower-case scheme and host, no dot segments, no fragment; null without ``://``."""
    scheme = F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)
    query = F.regexp_extract(_after_scheme(url), r"(?s)^[^?#]*(\?[^#]*)", 1)
    node = F.concat(scheme, F.lit("://"), host_of(url), _without_dots(path_of(url)), query)
    return F.when(F.contains(url, F.lit("://")), F.replace(node, F.lit(" "), F.lit("%20")))


def _once(value: Column, then) -> Column:
    """``then(value)`` with ``value`` bound to a variable, so that nested uses do not multiply the expression."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _absolute(target: Column, base: Column) -> Column:
    """The node that variable ``target`` names on a page or base tag at ``base``; null if empty or of a scheme without ``//``."""
    scheme = F.concat(F.substring_index(base, "://", 1), F.lit(":"))
    root = F.concat(scheme, F.lit("//"), host_of(base))
    folder = F.regexp_replace(path_of(base), r"(?s)[^/]*$", "")
    joined = (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
              .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (target == ""), F.lit(None))
              .when(F.startswith(target, F.lit("//")), F.concat(scheme, target))
              .when(F.startswith(target, F.lit("/")), F.concat(root, target))
              .when(F.startswith(target, F.lit("?")), F.concat(root, path_of(base), target))
              .when(F.startswith(target, F.lit("#")), base)
              .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), target)))
    return _once(joined, node_of)


def _any_group(text: Column, pattern: str) -> Column:
    """What the one of three groups that took part has matched, without white space around it."""
    return F.trim(F.regexp_replace(F.concat(*[F.regexp_extract(text, pattern, g) for g in (1, 2, 3)]), r"[\t\n\r]", ""))


def _attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute; empty without it."""
    return F.replace(_any_group(tag, rf"(?i)(?<![\w-]){name}" + VALUE), F.lit("&amp;"), F.lit("&"))


def _targets(html: Column, url: Column) -> Column:
    """The nodes that the tags of ``html`` (less what is not seen) name on the page ``url``."""
    tags = F.concat(F.transform(F.regexp_extract_all(html, F.lit(CANONICAL), F.lit(0)), lambda t: _attribute(t, "href")),
                    F.transform(F.regexp_extract_all(html, F.lit(REFRESH), F.lit(0)),
                                lambda t: _any_group(_attribute(t, "content"), TARGET)))
    base = _attribute(F.regexp_extract(html, BASE, 0), "href")
    own = _once(base, lambda t: F.coalesce(_absolute(t, url), url))
    return _once(own, lambda b: F.transform(tags, lambda t: _absolute(t, b)))


def alias_links(pages: DataFrame) -> DataFrame:
    """(u, v): the node of each page and of the canonical or refresh target that its html names."""
    # most pages have neither word, and nothing else is done with them
    able = pages.filter(F.contains("url", F.lit("://")) & F.col("html").rlike("(?i)canonical|refresh"))
    seen = F.regexp_replace("html", UNSEEN, " ")
    named = able.select("url", _once(seen, lambda h: _targets(h, F.col("url"))).alias("vs"))
    links = named.select("url", F.explode("vs").alias("v")).select(node_of(F.col("url")).alias("u"), "v")
    return links.filter("v is not null and u <> v").distinct()


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule and verdict."""
    rule_df = rule_table(pages.sparkSession, rules)
    links = materialise(alias_links(pages), "url-links")
    classes = materialise(components(links), "url-classes")
    nodes = _ruled(classes.withColumnRenamed("node", "url"), rule_df)
    class_verdict = materialise(
        nodes.groupBy("component").agg(F.max(F.col("verdict") == "block").alias("b"),
                                       F.max(F.col("verdict") == "allow").alias("a"))
        .filter("b and not coalesce(a, false)").select("component"), "url-blocked")
    blocked = materialise(classes.join(class_verdict, "component").select(F.col("node").alias("_url_node"),
                                                                          F.lit(True).alias("_blocked")), "url-aliases")
    ruled = _ruled(without(pages, "host", "path", "rule", "verdict"), rule_df)
    ruled = ruled.withColumn("_url_node", node_of(F.col("url"))).join(blocked, "_url_node", "left")
    verdict = F.coalesce("verdict", F.when(F.col("_blocked"), F.lit("block")).otherwise(F.lit("allow")))
    return ruled.withColumn("verdict", verdict).drop("_blocked", "_url_node")
