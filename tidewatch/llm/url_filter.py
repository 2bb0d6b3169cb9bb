"""URL filter: rules by host and path, and for the rest personalised PageRank over
the host graph, from trusted hosts along links and from blocked hosts against
them, thresholded per host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage, sized

# (verdict, host, path): a rule fits its host and all subdomains of it where the
# url's path begins with the rule's. Fixed values of the query's contract.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
TOLERANCE = 1e-4        # share of all mass that a round may still move
ROUNDS = 64             # 2 * 0.85^63 < TOLERANCE: the rounds always suffice
BLOCK_SHARE = 0.75      # of a host's mass that is distrust, from which it is blocked

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a(?=[\s/])[^<>]*?[\s"'/]href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower
    case; empty for null and where ``://`` is missing."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty as ``host_of``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null. Host and path
    are compared as they are; of equally long rules the last holds."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        best = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def judged_pages(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and the rule's verdict (null without one)."""
    url = F.col("url").cast("string")
    return (pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
            .withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
            .select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict")))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts in the html of all pages, one
    row a pair of hosts. Relative links stay on their host and are left out.
    Counted in each task first: a host with most pages costs a row a task."""
    links = F.regexp_extract_all(F.col("html").cast("string"), F.lit(LINK), F.lit(1))
    found = pages.select(host_of(F.col("url").cast("string")).alias("src"), F.explode(links).alias("link"))
    dst = F.translate(F.regexp_extract("link", r"//([^/?#]*)", 1), UPPER, LOWER)
    return (found.select("src", dst.alias("dst")).where("src <> '' AND dst <> '' AND src <> dst")
            .groupBy("src", "dst").agg(F.count("*").alias("n")))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE,
              rounds: int = ROUNDS) -> DataFrame:
    """Personalised PageRank of several kinds at once: ``links(kind, src, dst, n)``
    and ``seeds(kind, host, mass)`` -> (kind, host, mass), the masses of a kind
    adding up to those of its seeds.

    A host passes ``damping`` of its mass along its links, by n; that of hosts
    without links, and the rest, go back to the seeds. Rounds end when less than
    ``tolerance`` of all mass has moved. A round is one join on the linking host
    and one sum, combined in each task, so a host with most links or most
    linkers is no group in one task; each round's table is saved. Only two
    numbers a kind and round reach the driver. Seeds without mass give no rows.
    """
    seeds = cut_lineage(seeds.where("mass > 0").groupBy("kind", "host").agg(F.sum("mass").alias("mass")), "seeds")
    total = {r["kind"]: r["mass"] for r in seeds.groupBy("kind").agg(F.sum("mass").alias("mass")).collect()}
    if not total:
        return seeds
    out = links.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    shares = links.join(sized(cut_lineage(out, "out"), 64), ["kind", "src"]).select(
        "kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("out")).alias("share"))
    shares = cut_lineage(shares, "shares")
    mass = seeds
    for _ in range(rounds):
        moved = shares.join(sized(mass, 64), ["kind", "host"]).groupBy("kind", F.col("dst").alias("host")).agg(
            F.sum(F.col("mass") * F.col("share") * damping).alias("mass"))
        moved = cut_lineage(moved, "moved")
        sent = {r["kind"]: r["mass"] for r in moved.groupBy("kind").agg(F.sum("mass").alias("mass")).collect()}
        back = F.create_map(*[v for k, t in total.items() for v in (F.lit(k), F.lit(1 - sent.get(k, 0.0) / t))])
        new = cut_lineage(moved.unionByName(seeds.select(
            "kind", "host", (F.col("mass") * back[F.col("kind")]).alias("mass")))
            .groupBy("kind", "host").agg(F.sum("mass").alias("mass")), "mass")
        old = mass.select("kind", "host", F.col("mass").alias("before"))
        change = new.join(old, ["kind", "host"], "full").agg(F.sum(F.abs(
            F.coalesce("mass", F.lit(0.0)) - F.coalesce("before", F.lit(0.0))))).first()[0]
        mass = new
        if change <= tolerance * sum(total.values()):
            break
    return mass


def host_scores(judged: DataFrame, links: DataFrame, **options) -> DataFrame:
    """(host, trust, distrust): each host's pages under an allow rule are its seed
    of trust, which follows links, those under a block rule its seed of distrust,
    which goes from a linked host to the linking one."""
    seeds = (judged.where("verdict IS NOT NULL AND host <> ''").groupBy("host", "verdict")
             .agg(F.count("*").cast("double").alias("mass"))
             .select(F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host", "mass"))
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    mass = propagate(cut_lineage(both, "links"), seeds, **options)
    return mass.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("mass")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("mass")).otherwise(0.0)).alias("distrust"))


def filter_urls(pages: DataFrame, rules=RULES, share: float = BLOCK_SHARE, **options) -> DataFrame:
    """``pages(page_id, url, html, ...)`` -> page_id, host, path, rule, verdict,
    trust, distrust, one row a page.

    The verdict is that of the longest rule that fits; else ``block`` where
    ``share`` or more of the host's mass is distrust, else ``allow`` (so also for
    hosts that no seed reaches, whose two masses are 0). A null url, or one without
    ``://``, has an empty host and path, no rule and no mass. Null html has no
    links. Repeated rows are judged alike and each returned; an empty table gives
    an empty table; other columns are dropped. The table of host masses is
    broadcast only under a counted size, else joined.
    """
    judged = judged_pages(pages, rules)
    scores = cut_lineage(host_scores(judged, cut_lineage(host_links(pages), "host_links"), **options), "hosts")
    known = scores.withColumnsRenamed({"trust": "t", "distrust": "d"})
    trust, distrust = F.coalesce("t", F.lit(0.0)), F.coalesce("d", F.lit(0.0))
    bad = (distrust > 0) & (distrust >= share * (trust + distrust))
    return judged.join(sized(known, 64), "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"))


def url_rows(pages: DataFrame) -> DataFrame:
    """One row per page, judged by the contract's rules."""
    return filter_urls(pages)
