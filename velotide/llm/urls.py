"""URL rules, indexed by their rarest literal token.

A rule matches by host and path prefix, or by a pattern in which ``*`` stands
for anything and ``^`` for a separator or an end.  Tokens are runs of letters
and digits, lower-cased.  The tokens that any matching URL must hold follow from
the rule's literal text; the rule is filed under the one that the fewest URLs
hold.  A URL's own tokens fetch the rules filed under them, and only those are
run, as regular expressions.  Rules without a sure token are filed under '',
which every URL fetches.

Up to PLAN_RULES rules are part of the plan: row-wise expressions, and no shuffle
but for the token counts, whose result is bounded by the tokens of the rules.  More
are a table by token, joined with the tokens of the URLs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import saved
from velotide.operators.sizing import broadcast_if_small

TOKEN = "[a-z0-9]+"
#: Separator of a pattern's ``^``: anything but letters, digits and ``_.%-``; or the end.
SEPARATOR = r"(?:[^a-z0-9_.%-]|$)"
#: More rules than this are a table in place of a part of the plan.
PLAN_RULES = 1_000


@dataclass(frozen=True)
class Rule:
    """``text``: ``host/path`` (``by_host``) or a pattern; ``action``: allow or block."""

    text: str
    action: str
    by_host: bool = True

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].lower()

    @property
    def path(self) -> str:
        slash = self.text.find("/")
        return self.text[slash:] if slash >= 0 else ""

    @property
    def regex(self) -> str:
        """Over the host, whatever it holds, or over the lower-cased URL."""
        if self.by_host:
            return rf"(?s)^(?:.*\.)?{literal(self.host)}\z"
        parts = re.split(r"([*^])", self.text.lower())
        return "".join(
            ".*" if p == "*" else SEPARATOR if p == "^" else literal(p) for p in parts
        )

    def tokens(self) -> list[str]:
        """Tokens that every matching URL holds whole."""
        if self.by_host:
            # The path may go on after the rule's own, so its last token may be longer.
            own = re.findall(TOKEN, self.host) + re.findall(TOKEN + "(?![a-z0-9]|$)", self.path.lower())
            return sorted(set(own))
        # A token at an end of the pattern or beside ``*`` may be part of a longer one.
        edged = f"*{self.text.lower()}*"
        return sorted(set(re.findall(rf"(?<![*a-z0-9])({TOKEN})(?![*a-z0-9])", edged)))


def literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/\n])", r"\\\1", text)


#: The rules that are given.
GIVEN = [
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
]

#: The method's own rules, for URLs that no given rule fits: any match blocks.
PATTERNS = [
    Rule(p, "block", by_host=False)
    for p in (
        "/ads-",
        ".ads-track.",
        "-track.",
        "/adserver^",
        ".doubleclick.",
        "/banner^",
        "/casino^",
        ".casino.",
        "-casino.",
        "/porn^",
        "/login^",
        "/wp-login.php",
        "/cart^",
        "/checkout^",
        "*.exe^",
        "/tracking/pixel^",
    )
]


def host_of(url: Column) -> Column:
    """After the first ``://``; '' without one."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)
    return F.coalesce(rest, F.lit(""))


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL; a NULL has none."""
    found = F.regexp_extract_all(lowered(F.coalesce(url, F.lit(""))), F.lit(f"({TOKEN})"), 1)
    return F.array_distinct(found)


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """URLs that hold each token of the rules: at most as many rows as those have tokens."""
    wanted = sorted({t for r in rules for t in r.tokens()})
    held = F.explode(F.array_intersect(url_tokens(F.col("url")), F.lit(wanted).cast("array<string>")))
    return dict(urls.select(held.alias("token")).groupBy("token").count().collect())


def index(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rule numbers by the rarest token of each."""
    filed: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        tokens = rule.tokens()
        key = min(tokens, key=lambda t: (counts.get(t, 0), t)) if tokens else ""
        filed.setdefault(key, []).append(i)
    return filed


def entry(rule: Rule) -> tuple[str, str, bool, str, str]:
    return rule.text, rule.action, rule.by_host, rule.regex, rule.path if rule.by_host else ""


ENTRY = "text string, action string, by_host boolean, regex string, prefix string"


def fits(r: Column) -> Column:
    """Whether a rule (as ENTRY) matches the row: host and path each by itself, or the whole URL."""
    by_host = F.regexp_like("host", r["regex"]) & F.startswith(F.col("path"), r["prefix"])
    by_url = F.regexp_like(lowered(F.coalesce("url", F.lit(""))), r["regex"])
    return F.when(r["by_host"], by_host).otherwise(by_url)


def matches_in_plan(rows: DataFrame, rules: list[Rule], filed: dict[str, list[int]]) -> DataFrame:
    """``rows`` with ``matches`` and ``n_candidates``, by a map of the plan."""

    def literals(rule: Rule) -> Column:
        names = [f.split()[0] for f in ENTRY.split(", ")]
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(names, entry(rule), strict=True)])

    table = F.create_map(
        *[x for key, own in filed.items() for x in (F.lit(key), F.array(*[literals(rules[i]) for i in own]))]
    )
    keys = F.array_union(url_tokens(F.col("url")), F.array(F.lit("")))
    known = F.array_intersect(keys, F.lit(sorted(filed)).cast("array<string>"))
    rows = rows.withColumn("candidates", F.flatten(F.transform(known, lambda t: table[t])))
    return rows.withColumns({"matches": F.filter("candidates", fits), "n_candidates": F.size("candidates")}).drop(
        "candidates"
    )


def matches_by_table(rows: DataFrame, rules: list[Rule], filed: dict[str, list[int]]) -> DataFrame:
    """The same by a join of the URLs' tokens with a table of rules by token.

    Rules are filed under rare tokens, so few rows meet any.  Of a URL's matches
    the longest rule and one pattern are kept, within tasks first, as no more decide.
    """
    spark = rows.sparkSession
    listed = [(key, *entry(rules[i])) for key, own in filed.items() for i in own if key]
    table = broadcast_if_small(spark.createDataFrame(listed, f"token string, {ENTRY}"))
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "url-rows")
    tokens = rows.select("*", F.explode(url_tokens(F.col("url"))).alias("token"))
    met = tokens.join(table, "token")
    rule = F.struct(*[f.split()[0] for f in ENTRY.split(", ")]).alias("rule")
    met = met.select("row", "host", "path", "url", rule).withColumn("fits", fits(F.col("rule")))
    best = F.struct(F.col("rule.by_host").alias("by_host"), F.length("rule.text").alias("n"), "rule")
    found = met.groupBy("row").agg(
        F.max(F.when(F.col("fits") & F.col("rule.by_host"), best))["rule"].alias("longest"),
        F.max(F.when(F.col("fits") & ~F.col("rule.by_host"), best))["rule"].alias("pattern"),
        F.count("*").cast("int").alias("n_met"),
    )
    rows = rows.join(found, "row", "left")
    always = matches_in_plan(rows, rules, {"": filed.get("", [])}) if "" in filed else rows.withColumns(
        {"matches": F.array().cast(f"array<struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>>"), "n_candidates": F.lit(0)}
    )
    every = F.array_compact(F.concat("matches", F.array("longest", "pattern")))
    return always.withColumns(
        {"matches": every, "n_candidates": F.col("n_candidates") + F.coalesce("n_met", F.lit(0))}
    )


def judge(
    pages: DataFrame, given: list[Rule] = GIVEN, patterns: list[Rule] = PATTERNS
) -> DataFrame:
    """Every row's page_id, host, path, rule, verdict and the number of rules run for it.

    The longest fitting rule of ``given`` decides; without one, a match of
    ``patterns`` blocks and all else is allowed.  A NULL URL and one without
    ``://`` have an empty host and path; patterns see the whole URL ('' for
    NULL).  Hosts and paths may hold any character, line breaks included.
    Repeated rows are each judged.
    """
    rules = [*given, *patterns]
    rows = pages.select("page_id", "url")
    filed = index(rules, token_counts(rows, rules))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    run = matches_in_plan if len(rules) <= PLAN_RULES else matches_by_table
    rows = run(rows, rules, filed)
    best = F.array_sort(
        F.transform(
            F.filter("matches", lambda r: r["by_host"]),
            lambda r: F.struct(
                (-F.length(r["text"])).alias("n"), r["text"].alias("rule"), r["action"].alias("action")
            ),
        )
    )
    rows = rows.withColumn("best", F.get(best, F.lit(0)))
    matched = F.exists("matches", lambda r: ~r["by_host"])
    return rows.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.when(matched, "block").otherwise("allow")).alias("verdict"),
        "n_candidates",
    )
