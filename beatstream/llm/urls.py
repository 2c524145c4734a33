"""URL filter with redirect equivalence.

Block and allow rules name a host and a path prefix; a rule fits its host and all
subdomains if the url's path starts with its path, and the longest fitting rule decides
(of equally long ones an allow, then the smaller text).  Urls without a rule take the
decision of their aliases: redirects (meta refresh), canonical and ``og:url`` links, and
removed tracking parameters are edges between urls, whose connected components are found
in Spark.  An explicit allow anywhere in a component outweighs its blocks.  Without any
decision the verdict is ``default``.

A page's rule comes from its whole url.  As an alias a url is known without its fragment, with
scheme and host in lower case.  All links of a page count; character references in them are
decoded, and targets without a scheme (``//host/path``, ``/path``, ``?query``, ``path``,
``../path``) are taken from the page's url.

Null urls and urls without ``://`` have empty host and path, no rule and the default (or
their aliases') verdict.  Urls and pages of any length are read whole.  Repeated rows are
judged once each; null html has no links.  Extra columns are ignored.  An empty table gives an
empty result, an empty rule table judges everything by default.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatstream.llm.common import connected_components, written

# fixed values: query parameters that only track a visit
TRACKING = ["utm_[a-z]+", "ref", "fbclid", "gclid", "mc_eid"]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lowered, path) as the rules see them; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    host = F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return host, path


def _lowered(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def _origin(url: Column) -> Column:
    """Scheme and host of a url; empty without ``://``."""
    return F.regexp_extract(url, "^[^:/?#]+://[^/?#]*", 0)


def _node(url: Column) -> Column:
    """A url as a graph node: without its fragment, scheme and host in lower case."""
    url = F.regexp_replace(url, "(?s)#.*$", "")
    origin = _origin(url)
    return F.concat(_lowered(origin), F.substring(url, F.length(origin) + 1, F.length(url)))


def _name(node: Column) -> Column:
    """A node's key: 16 bytes, so that no two of very many urls share one by chance."""
    return F.unhex(F.md5(node))


def _untracked(url: Column) -> Column:
    """The url without tracking parameters."""
    names = "|".join(TRACKING)
    out = F.regexp_replace(url, rf"(?<=[?&])(?:{names})=[^&]*(?:&|$)", "")
    return F.regexp_replace(out, "[?&]$", "")


def _attributes(html: Column, tag: str, wanted: str, attribute: str) -> Column:
    """Values of ``attribute`` in the ``tag``s whose text holds ``wanted`` (either order)."""
    return F.regexp_extract_all(
        html, F.lit(rf"(?is)<{tag}\b(?=[^>]*{wanted})[^>]*?\b{attribute}\s*=\s*[\"']?([^\"'>\s]+)"), 1)


# fixed values: the character references that urls in attributes hold
REFERENCES = [("&quot;|&#34;|&#[xX]22;", '"'), ("&apos;|&#39;|&#[xX]27;", "'"), ("&lt;|&#60;|&#[xX]3[cC];", "<"),
              ("&gt;|&#62;|&#[xX]3[eE];", ">"), ("&#47;|&#[xX]2[fF];", "/"), ("&amp;|&#38;|&#[xX]26;", "&")]


def _resolved(target: Column, url: Column) -> Column:
    """A link's target as an absolute url; null if it has another kind of scheme (``mailto:``) or is empty."""
    for pattern, char in REFERENCES:
        target = F.regexp_replace(target, pattern, char)
    origin = _origin(url)
    path = F.regexp_extract(F.substring(url, F.length(origin) + 1, F.length(url)), "^[^?#]*", 0)
    full = F.when(target.startswith("/"), target).otherwise(
        F.concat(F.when(path.contains("/"), F.regexp_extract(path, "(?s)^.*/", 0)).otherwise(F.lit("/")), target))
    tail = F.regexp_extract(full, r"(?s)\?.*$", 0)
    steps = F.split(F.regexp_replace(full, r"(?s)\?.*$", ""), "/")
    # "." stays where it is, ".." goes up; at the end both leave the folder's slash
    walked = F.aggregate(steps, F.array().cast("array<string>"), lambda done, x: (
        F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(x)))))
    last = F.element_at(steps, -1)
    joined = F.concat(F.array_join(walked, "/"), F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit("")), tail)
    return (F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | (target == "") | target.startswith("#") | (origin == ""),
                  F.lit(None).cast("string"))
            .when(target.startswith("//"), F.concat(F.regexp_extract(origin, "^[^:]+:", 0), target))
            .when(target.startswith("?"), F.concat(origin, path, target))
            .otherwise(F.concat(origin, joined)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(url, target) of every declared or implied alias, both as nodes."""
    url, html = F.col("url"), F.coalesce(F.col("html"), F.lit(""))
    refresh = r"(?is)<meta\b(?=[^>]*http-equiv\s*=\s*[\"']?refresh)[^>]*?url\s*=\s*([^\"'>\s]+)"
    targets = F.concat(
        _attributes(html, "link", r"rel\s*=\s*[\"']?canonical", "href"),
        _attributes(html, "meta", r"property\s*=\s*[\"']?og:url", "content"),
        F.regexp_extract_all(html, F.lit(refresh), 1))
    implied = F.struct(_untracked(_node(url)).alias("target"), F.lit(False).alias("declared"))
    declared = F.transform(targets, lambda t: F.struct(t.alias("target"), F.lit(True).alias("declared")))
    edges = (pages.where("url is not null").select("url", F.explode(F.concat(declared, F.array(implied))).alias("link"))
             .select("url", "link.*"))
    target = F.when(F.col("declared"), _node(_resolved(F.col("target"), url))).otherwise(F.col("target"))
    return (edges.select(_node(url).alias("url"), target.alias("target"))
            .where((F.col("target") != F.col("url")) & F.col("target").contains("://")))


def rule_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, rule, action): the longest fitting rule of each ``key`` with one; urls has (key, host, path).

    A url meets the rules by equality of (host suffix, path prefix); prefixes are cut at
    the lengths that rule paths have.
    """
    lengths = [r.n for r in rules.select(F.length("path").alias("n")).distinct().orderBy("n").collect()]
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    probes = (urls.where("host != ''").withColumn("suffix", F.explode(suffixes))
              .withColumn("cut", F.explode(cuts))
              .select("key", "suffix", F.expr("substring(path, 1, cut)").alias("prefix")))
    r = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "action")
    best = F.max(F.struct(F.length("suffix") + F.length("prefix"), (F.col("action") == "allow").cast("int"),
                          F.concat("suffix", "prefix").alias("rule"), "action")).alias("best")
    return (probes.join(r, ["suffix", "prefix"]).groupBy("key").agg(best)
            .select("key", "best.rule", "best.action"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, url, host, path, rule, verdict) of every page; rules has (action, host, path)."""
    host, path = url_parts(F.col("url"))
    rows = written(pages.select("page_id", "url", _name(_node(F.col("url"))).alias("key"),
                                host.alias("host"), path.alias("path")), "url-rows")
    edges = written(alias_edges(pages).distinct(), "url-edges")
    nodes = edges.select("url").union(edges.select("target")).distinct()
    n_host, n_path = url_parts(F.col("url"))
    nodes = written(nodes.select(_name(F.col("url")).alias("node_key"), n_host.alias("host"), n_path.alias("path")), "url-nodes")

    # every host and path once: that of a page from its whole url, that of an alias from the node
    place = F.struct("host", "path").alias("key")
    places = rows.select("host", "path").union(nodes.select("host", "path")).distinct()
    decided = written(rule_of(places.select(place, "host", "path"), rules)
                      .select(F.col("key.host").alias("r_host"), F.col("key.path").alias("r_path"), "rule", "action"), "url-rules")

    def with_rule(df: DataFrame, how: str) -> DataFrame:
        return df.join(decided, (df["host"] == F.col("r_host")) & (df["path"] == F.col("r_path")), how)

    # decisions of a component: an allow outweighs its blocks
    members = connected_components(edges.select(_name(F.col("url")).alias("src"), _name(F.col("target")).alias("dst")))
    votes = (members.join(with_rule(nodes, "inner"), F.col("node") == F.col("node_key"))
             .groupBy("component").agg(F.min("action").alias("alias_action")))  # 'allow' < 'block'
    by_alias = members.join(votes, "component").select(F.col("node").alias("member"), "alias_action")
    return (with_rule(rows, "left").join(by_alias, F.col("key") == F.col("member"), "left")
            .select("page_id", "url", "host", "path", "rule",
                    F.coalesce("action", "alias_action", F.lit(default)).alias("verdict")))
