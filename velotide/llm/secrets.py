"""Secret scan with corpus-wide ownership frequency; DataFrame expressions only.

Patterns give candidate spans.  The hash of each candidate's value is counted by
distinct owners and distinct repositories, over the whole corpus; repositories
of equal text count as one.  A value that many owners hold in many repositories,
or few owners in very many, is a widely copied example; any other that mixes
letters and digits looks live.  Candidates of the given kinds are always
reported; those of the wide kind ``opaque`` only if live.

Positions count code points, the end is exclusive.  NULL and '' have no spans.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import saved

#: A value that more owners than MAX_OWNERS hold in more repositories than MAX_REPOS is an
#: example.  Fixed numbers: a value has one verdict, whatever else the corpus holds.
MAX_OWNERS, MAX_REPOS = 2, 10
#: A value in more repositories is an example, however few its owners: nobody pastes a live
#: credential into a thousand different texts, while a template's placeholder is in all of them.
MAX_REPOS_OF_FEW = 1000
#: Matches of a text whose lengths are added up one by one.
RUN = 128


@dataclass(frozen=True)
class Kind:
    """``group`` of ``pattern`` is the value.  ``needs``: one of these lower-case strings is
    in every text with a match ('' for no such test)."""

    name: str
    pattern: str
    group: int
    least: int
    given: bool
    needs: tuple[str, ...] = ()


#: The patterns of the given kinds.  Runs are taken whole either
#: way, so a least length may be part of a pattern that is one run.
KINDS = [
    Kind(
        "assign",
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
        r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        True,
        ("passw", "secret", "token", "api"),
    ),
    Kind("access", r"AKIA[A-Z0-9]{16,}", 0, 20, True, ("akia",)),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Kind("opaque", r"[A-Za-z0-9+/_-]{24,}", 0, 24, False),
]

SPAN = "struct<start:int,ord:int,kind:string,end:int,given:boolean,hash:string,mixed:boolean>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once; a lambda would do so for each element."""
    return F.transform(F.array(value), use)[0]


def before(lengths: Column) -> Column:
    """For each of an array of lengths, the sum of those before it.

    Sums of runs of RUN lengths come first, so that an array of n takes n times
    RUN and n / RUN steps, in place of n times n.
    """

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda a, y: a + y)

    def first(x: Column, n: Column) -> Column:
        return total(F.slice(x, F.lit(1), n))

    def cut(x: Column) -> Column:
        last = F.floor((F.size(x) - 1) / RUN).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(x, k * RUN + 1, F.lit(RUN)))

    def sums(runs: Column) -> Column:
        bases = let(F.transform(runs, total), lambda s: F.transform(s, lambda _, k: first(s, k)))
        each = F.zip_with(runs, bases, lambda own, base: F.transform(own, lambda _, i: base + first(own, i)))
        return F.flatten(each)

    none = F.array().cast("array<int>")
    return let(lengths, lambda x: F.when(F.size(x) > 0, let(cut(x), sums)).otherwise(none))


def spans_of(text: Column, order: int, kind: Kind) -> Column:
    """Spans of one kind: leftmost matches that don't overlap.

    A match starts after all gaps and matches before it, so the lengths of the
    pieces between matches and of the matches add up to the positions.
    """
    pattern = F.lit(kind.pattern)
    gaps = F.transform(F.split(text, kind.pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    values = F.regexp_extract_all(text, pattern, F.lit(kind.group))
    # The last gap has no match after it.
    found = F.filter(
        F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), values.alias("value")), lambda m: m["size"].isNotNull()
    )

    def span(m: Column, at: Column) -> Column:
        begin, value = at + m["gap"], m["value"]
        return F.struct(
            begin.alias("start"),
            F.lit(order).alias("ord"),
            F.lit(kind.name).alias("kind"),
            (begin + m["size"]).alias("end"),
            F.lit(kind.given).alias("given"),
            F.sha2(value, 256).alias("hash"),
            (F.regexp_like(value, F.lit("[0-9]")) & F.regexp_like(value, F.lit("[A-Za-z]"))).alias("mixed"),
        )

    def placed(matches: Column) -> Column:
        at = before(F.transform(matches, lambda m: m["gap"] + m["size"]))
        long = F.zip_with(matches, at, lambda m, at: F.when(F.length(m["value"]) >= kind.least, span(m, at)))
        return F.filter(long, lambda s: s.isNotNull())

    return let(found, placed).cast(f"array<{SPAN}>")


def candidates(text: Column) -> Column:
    """Spans of all kinds; a text that cannot match a kind isn't split for it."""
    text = F.coalesce(text, F.lit(""))
    low, none = F.lower(text), F.array().cast(f"array<{SPAN}>")
    parts = []
    for order, kind in enumerate(KINDS):
        may = F.regexp_like(text, F.lit(kind.pattern))
        if kind.needs:
            hint = F.lit(False)
            for s in kind.needs:
                hint = hint | F.contains(low, F.lit(s))
            may = hint & may
        parts.append(F.when(may, spans_of(text, order, kind)).otherwise(none))
    # An opaque run without digits or without letters is no candidate.
    return F.filter(F.concat(*parts), lambda s: s["given"] | s["mixed"])


def ownership(each: DataFrame) -> DataFrame:
    """Per hash the number of owners and of repositories, those of equal text counted once.

    Each step combines within tasks before its shuffle, so a value that a third
    of the corpus holds sends a row per owner and text.  NULL owners count as one.
    """
    owned = each.groupBy("hash", "owner").count()
    owners = owned.groupBy("hash").agg(F.count("*").alias("n_owners"))
    texts = each.groupBy("hash", "same").agg(F.min("repo").alias("repo"))
    held = texts.groupBy("hash", "repo").count()
    repos = held.groupBy("hash").agg(F.count("*").alias("n_repos"))
    return owners.join(repos, "hash")


def scan(docs: DataFrame, text: str = "text", repo: str = "doc_id", owner: str = "source") -> DataFrame:
    """Every row of ``docs`` as ``doc``, with ``spans``, by start and kind.

    A span has start, ord, kind, end, given, live, example, n_owners and n_repos.
    Rows are told apart by their place in the stored table of hits, not by their
    id, so repeated rows keep a result each.
    """
    found = docs.select(F.struct("*").alias("doc"), candidates(F.col(text)).alias("found"))
    # Told once, as every count of owners and repositories reads it.
    same = F.sha2(F.col("doc")[text], 256).alias("same")
    hits = found.where(F.size("found") > 0).select("*", F.monotonically_increasing_id().alias("row"), same)
    hits = saved(hits, "secret-hits")
    each = hits.select(
        "row",
        "same",
        F.col("doc")[repo].alias("repo"),
        F.col("doc")[owner].alias("owner"),
        F.inline("found"),
    )
    judged = each.join(ownership(each), "hash")
    example = ((F.col("n_owners") > MAX_OWNERS) & (F.col("n_repos") > MAX_REPOS)) | (F.col("n_repos") > MAX_REPOS_OF_FEW)
    live = F.col("mixed") & ~example
    span = F.struct(
        "start", "ord", "kind", "end", "given", live.alias("live"), example.alias("example"), "n_owners", "n_repos"
    )
    spans = (
        judged.where(F.col("given") | live)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(span)).alias("spans"))
    )
    none = F.array().cast(spans.schema["spans"].dataType)
    with_spans = hits.join(spans, "row", "left").select("doc", F.coalesce("spans", none).alias("spans"))
    return with_spans.unionByName(found.where(F.size("found") == 0).select("doc", none.alias("spans")))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def report(docs: DataFrame) -> DataFrame:
    """Per row doc_id, the counts by given kind, the digest of their spans, and all spans."""
    rows = scan(docs.select("doc_id", "text", "source"))
    given = F.filter("spans", lambda s: s["given"])

    def n(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "doc.doc_id",
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(listed(given), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: s["example"])).cast("long").alias("n_example"),
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The rows of ``docs`` with every live span, or run of overlapping ones, replaced by ``mark``.

    Widely copied examples stay.  A NULL text stays NULL.
    """
    rows = scan(docs)
    live = F.filter("spans", lambda s: s["live"])
    start = F.struct(
        F.lit(0).alias("at"), F.lit("").alias("out")
    )

    def step(done: Column, s: Column) -> Column:
        text = F.col("doc.text")
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        fresh = (s["start"] > done["at"]) | (done["at"] == 0)
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"),
        )

    cut = F.aggregate("live", start, step)
    rows = rows.withColumn("live", live).withColumn("cut", cut)
    text = F.concat("cut.out", F.expr("substring(doc.text, cut.at + 1)"))
    new = F.when(F.size("live") > 0, text).otherwise(F.col("doc.text"))
    kept = [new.alias("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns]
    return rows.select(*kept)
