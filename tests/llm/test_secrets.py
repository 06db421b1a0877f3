"""Secret spans against the patterns run by Python."""

import hashlib
import re
import time

import pytest

from velotide.llm import secrets

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)

TEXTS = [
    "",
    None,
    "password=abc secret: 'abcdef' TOKEN = \"zzzzzz1\" Api_Key:aaaaaa apikey==x",
    "é 日本 password=hunter2hunter token=token=token=abcdef",
    "password=token: abcdef password=token:abcdefg",
    "AKIA" + "Z" * 15 + " AKIA" + "Z" * 16 + " xAKIA" + "0" * 30 + "AKIA",
    "0123456789abcdef01234567 " + "f" * 23 + " " + "0a" * 40 + "G" + "1" * 24,
    "pass" * 10 + "secret" * 10 + "=" * 50 + "x" * 50,
    "token=" + "9f" * 20 + "\n" + "token=" + "9f" * 20,
    "s3cr3t " + "Ab1" * 10 + " plainwordplainwordplainwordplain 123456789012345678901234567890",
] + [f"doc {i} key AbCdEf0123456789AbCdEf0123456789 token=EXAMPLE{i // 5}0000" for i in range(20)]


def given_spans(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"owner{i % 7}" if i % 4 else None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_given_kinds(docs):
    for r in secrets.report(docs).collect():
        spans = given_spans(TEXTS[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(listed(spans).encode()).hexdigest()
        kinds = [s[2] for s in spans]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(map(kinds.count, ("assign", "access", "hex")))
        assert set(listed(spans).split(",")) - {""} <= set(r["spans"].split(","))


def test_ownership_tells_examples_from_live_ones(docs):
    rows = {r["doc_id"]: r for r in secrets.report(docs).collect()}
    # One value in the hands of all: never added; its own, in those of few, is.
    shared = TEXTS[10].index("AbCd")
    assert f"opaque:{shared}" not in rows[10]["spans"]
    assert f"opaque:{TEXTS[9].index('Ab1')}" in rows[9]["spans"]
    assert rows[9]["n_live"] == 1
    # Digits or letters alone don't look live.
    assert "opaque:" + str(TEXTS[9].index("plain")) not in rows[9]["spans"]


def test_odd_rows(spark, odd_docs, odd_rows):
    rows = secrets.report(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    assert sum(r["n_assign"] for r in rows) == 1
    assert sum(r["n_access"] for r in rows) == 1


def test_repeated_rows_keep_a_result_each(spark):
    rows = [(1, "token=abcdef1", "a", 0)] * 3 + [(1, "x", "a", 0)]
    got = secrets.report(spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")).collect()
    assert sorted(r["spans"] for r in got) == ["", *["assign:0:13"] * 3]


def test_redaction(spark, odd_docs):
    rows = [
        (1, "é token=abcdef1 and token=abcdef2.", "a"),
        (2, "token=EXAMPLE00", "a"),
        (3, "token=EXAMPLE00", "b"),
        (4, "token=EXAMPLE00", "c"),
        *((10 + i, f"token=EXAMPLE00 {i}", "c") for i in range(10)),
        (5, None, "c"),
        (6, "token=" + "9f" * 20, "c"),
        (7, "password=letters", "c"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert got[1] == "é [secret] and [secret]"
    assert got[2] == got[3] == got[4] == "token=EXAMPLE00"
    assert got[5] is None
    assert got[6] == "[secret]"
    assert got[7] == "password=letters"
    assert secrets.redact(odd_docs).columns == odd_docs.columns


def test_repositories_take_part_in_the_verdict(spark):
    key = "Ab1" * 10
    rows = [(i, f"copy {i} token=EXAMPLE0000 {key}", "hot") for i in range(2000)]  # in many texts of one source
    rows += [(i, "copied whole token=abcdef1", "hot") for i in range(2000, 4000)]  # in one text, many times
    rows += [(i, f"leak {i} token=abcdef2", f"owner{i}") for i in range(4000, 4003)]  # in three copies
    rows += [(i, f"docs {i} token=EXAMPLE1111", f"owner{i}") for i in range(4003, 4023)]  # widely copied
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spans = {}
    for r in secrets.scan(docs).collect():
        ours = [(s["kind"], s["live"], s["example"], s["n_owners"], s["n_repos"]) for s in r["spans"]]
        spans.setdefault(r["doc"]["text"].split()[0], set()).add(tuple(ours))
    assert spans == {
        "copy": {(("assign", False, True, 1, 2000),)},
        "copied": {(("assign", True, False, 1, 1),)},
        "leak": {(("assign", True, False, 3, 3),)},
        "docs": {(("assign", False, True, 20, 20),)},
    }
    kept = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert kept == {i: t.replace("token=abcdef1", "[secret]").replace("token=abcdef2", "[secret]") for i, t, _ in rows}


def test_a_verdict_does_not_change_with_the_corpus(spark):
    """Values near the limits, alone and among 20,000 plain rows."""
    rows = [(i, f"leak {i} token=abcdef1", f"owner{i}") for i in range(3)]
    rows += [(100 + i, f"docs {i} token=EXAMPLE11", f"owner{i % 3}") for i in range(10)]
    rows += [(200 + i, f"docs {i} token=EXAMPLE22", f"owner{i % 3}") for i in range(11)]
    plain = [(1000 + i, f"plain text {i}", f"owner{i % 50}") for i in range(20_000)]
    schema = "doc_id long, text string, source string"
    few, many = (
        {r["doc_id"]: r["text"] for r in secrets.redact(spark.createDataFrame(x, schema)).collect() if r["doc_id"] < 1000}
        for x in (rows, rows + plain)
    )
    assert few == many
    assert [few[0], few[100]] == ["leak 0 [secret]", "docs 0 [secret]"] and few[200].endswith("EXAMPLE22")


def test_texts_with_very_many_spans(spark):
    """Positions of more matches than one run holds; the time grows with their number, not its square."""
    text = " é ".join(f"{i:024x}" for i in range(8000))
    docs = spark.createDataFrame([(1, text, "a")], "doc_id long, text string, source string")
    start = time.perf_counter()
    (row,) = secrets.report(docs).collect()
    assert time.perf_counter() - start < 10
    spans = given_spans(text)
    assert row["base_sha256"] == hashlib.sha256(listed(spans).encode()).hexdigest()
    assert row["n_hex"] == 8000


def test_no_python_in_the_plan(docs):
    plan = secrets.redact(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
