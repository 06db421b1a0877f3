"""Quality rules under weak supervision.

Each rule votes 1 (good), 0 (bad) or abstains.  Most find one kind of defect and
abstain where they don't, which is weak evidence too.  Expectation-maximisation
over the counts of vote patterns estimates how often each rule votes what for
good and for bad documents, without labels; the posterior probability of "good"
given all votes decides.  The statistics are the counts of patterns over all documents: at most
3 ** (number of rules) rows whatever the corpus, made by one aggregation.

Texts: NULL and '' have no words; their rules that need words abstain.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import saved, text_function

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
UPPER = np.zeros(256, bool)
UPPER[list(range(65, 91))] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_lines bigint, n_upper bigint, n_letters bigint, "
    "n_end_lines bigint, n_distinct bigint"
)


def repeated_words(ids: np.ndarray, n_ids: int) -> int:
    """Words inside a window of three words that the text holds twice or more."""
    if len(ids) < 4:
        return 0
    pair = np.unique(ids[:-1] * n_ids + ids[1:], return_inverse=True)[1]
    _, back, count = np.unique(
        pair[:-1] * n_ids + ids[2:], return_inverse=True, return_counts=True
    )
    twice = count[back] > 1
    inside = np.zeros(len(ids), bool)
    for shift in range(3):
        inside[shift : shift + len(twice)] |= twice
    return int(inside.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The figures of FIELDS for one text."""
    raw = np.frombuffer(text, np.uint8)
    words = text.split()
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        int(np.count_nonzero(((raw & 0xC0) != 0x80) & ~BLANK[raw])),
        int(np.count_nonzero(SYMBOLS[raw])),
        len(lines) - len(set(lines)),
        repeated_words(at, len(ids)),
        len(lines),
        int(np.count_nonzero(UPPER[raw])),
        int(np.count_nonzero(LETTER[raw])),
        sum(x.rstrip()[-1:] in b'.!?"' for x in lines),
        len(ids),
    )


def measured(texts: list[bytes]) -> dict:
    names = [f.split()[0] for f in FIELDS.split(", ")]
    rows = [measure(t) for t in texts]
    return dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else dict.fromkeys(names, [])


def vote(good: Column | None, bad: Column | None) -> Column:
    """1, 0, or -1 to abstain.  A rule that finds a defect says nothing where it finds none."""
    out = F.when(good, 1) if good is not None else None
    if bad is not None:
        out = out.when(bad, 0) if out is not None else F.when(bad, 0)
    return out.otherwise(-1)


def votes() -> dict[str, Column]:
    """The rules, over the columns of FIELDS; a share of nothing is NULL, so its rule abstains."""
    c, share = F.col, F.try_divide
    words, lines = c("n_words"), c("n_lines")
    mean, symbols, upper = share("word_chars", words), share("n_symbols", words), share("n_upper", "n_letters")
    distinct, copies = share("n_distinct", words), share("n_dup_lines", lines)
    repeats, ended = share("n_repeat_words", words), share("n_end_lines", lines)
    prose = mean.between(3, 8) & (symbols <= 0.02) & (upper <= 0.1)
    return {
        "fragment": vote(None, words < 10),
        "word_length": vote(None, (mean < 2.5) | (mean > 12)),
        "symbols": vote(None, symbols > 0.1),
        "capitals": vote(None, upper > 0.4),
        "few_words": vote(None, (words >= 20) & (distinct < 0.25)),
        "line_copies": vote(None, (lines >= 4) & (copies > 0.3)),
        "repeats": vote((words >= 50) & (repeats <= 0.05), repeats > 0.3),
        "line_ends": vote(None, ended < 0.2),
        "prose": vote((words >= 20) & prose & (distinct >= 0.4), None),
    }


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> dict:
    """EM for a two-class model in which rules vote independently given the class.

    ``patterns``: votes in {-1, 0, 1}, a row per distinct pattern; ``counts``:
    documents with it.  For each class and rule it estimates how often the rule
    abstains, votes bad and votes good.  It starts from the votes, a bad one
    counting three times a good one; pseudo-votes keep every rate off 0 and 1
    and the classes from swapping.  Returns prior, rates[class, rule, 1 + vote]
    and the posterior per row.
    """
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    good, bad = (patterns == 1).sum(1), (patterns == 0).sum(1)
    q = (good + 1) / (good + 3 * bad + 1.2)
    prior, rates = 0.5, np.full((2, patterns.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([(1 - q) * counts, q * counts])
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        rates = np.einsum("cn,nrv->crv", weight, onehot) + 0.5
        rates[0, :, 1] += 1  # a bad document draws bad votes rather than good ones,
        rates[1, :, 2] += 1  # and a good one good votes
        rates /= rates.sum(2, keepdims=True)
        log = np.einsum("nrv,crv->cn", onehot, np.log(rates))
        new = 1 / (1 + np.exp(np.clip(log[0] + np.log(1 - prior) - log[1] - np.log(prior), -700, 700)))
        moved, q = np.abs(new - q).max(initial=0), new
        if moved < 1e-10:
            break
    return {"prior": prior, "rates": rates, "posterior": q}


def posterior(measured_docs: DataFrame) -> tuple[Column, dict]:
    """The posterior as a column over FIELDS, and the model."""
    rules = votes()
    seen = measured_docs.groupBy(*[v.alias(n) for n, v in rules.items()]).count().collect()
    patterns = np.array([r[:-1] for r in seen], int).reshape(len(seen), len(rules))
    model = fit(patterns, np.array([r[-1] for r in seen], float))
    logit = F.lit(float(np.log(model["prior"] / (1 - model["prior"]))))
    weights = np.log(model["rates"][1]) - np.log(model["rates"][0])
    for v, (none, bad, good) in zip(rules.values(), weights.tolist(), strict=True):
        logit = logit + F.when(v == 1, good).when(v == 0, bad).otherwise(none)
    return 1 / (1 + F.exp(-logit)), model


def judge(docs: DataFrame) -> DataFrame:
    """Every row's doc_id with FIELDS, base_failed, the posterior ``quality`` and kept.

    Repeated rows each get their own row.  The figures are stored once, so that
    the texts are read once for both the statistics and the verdicts.
    """
    run = text_function(FIELDS, measured)
    rows = saved(
        docs.select("doc_id", run(F.col("text")).alias("out")).select("doc_id", "out.*"),
        "rule-figures",
    )
    quality, _ = posterior(rows)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("quality", quality).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)
    )


def verdicts(docs: DataFrame) -> DataFrame:
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(docs).select(*chain(names, ["base_failed", "kept", "quality"]))
