"""Merkle audit and url templates."""

import pytest
from pyspark.sql import functions as F

from lakemart.llm.merkle import audit
from lakemart.llm.queries_web import RULES
from lakemart.llm.url_templates import listed_rule, template_verdicts, url_parts

SCHEMA = "id long, body string"


def damage(spark, expected, found):
    left, right = (spark.createDataFrame(rows, SCHEMA).withColumn("hash", F.lit(1)) for rows in (expected, found))
    rows = audit(left, right, "id", ["body"]).orderBy("key").collect()
    return [(row["key"], row["status"], row["offset"], row["n_bytes"]) for row in rows]


def size(id_, body):
    fields = ("-" if value is None else f"{len(str(value).encode())}:{value}" for value in (id_, body))
    return len("".join(fields))


def test_damage_is_located(spark):
    rows = [(i * 37, f"body {i}" * (i % 5)) for i in range(3000)]
    changed = dict(rows)
    changed[37 * 700] = "rot"
    del changed[37 * 1500]
    changed[37 * 1500 + 1] = "new"
    changed[1 << 40] = "far"
    starts, at = {}, 0
    for row in rows:
        starts[row[0]] = at
        at += size(*row)
    want = [
        (37 * 700, "corrupt", starts[37 * 700], size(*rows[700])),
        (37 * 1500, "missing", starts[37 * 1500], size(*rows[1500])),
        (37 * 1500 + 1, "extra", starts[37 * 1501], None),
        (1 << 40, "extra", at, None),
    ]
    assert damage(spark, rows, list(changed.items())) == want
    assert damage(spark, rows, rows) == []


def test_repeats_nulls_and_empty_archives(spark):
    rows = [(1, "a"), (1, "a"), (1, None), (None, "x"), (-5, ""), (2, "é")]
    assert damage(spark, rows, rows[::-1]) == []
    assert damage(spark, rows, rows[1:]) == [(1, "corrupt", size(None, "x") + size(-5, ""), 2 * size(1, "a") + size(1, None))]
    assert damage(spark, rows, [(1, ""), *rows[1:]])[0][:2] == (1, "corrupt")
    assert damage(spark, [(7, "a")], []) == [(7, "missing", 0, size(7, "a"))]
    assert damage(spark, [], [(7, "a")]) == [(7, "extra", 0, None)]
    assert damage(spark, [], []) == []
    assert damage(spark, [(None, "x")], [(None, "y")])[0][:2] == (None, "corrupt")


@pytest.mark.parametrize(
    "url, host, path",
    [
        (None, "", ""),
        ("no scheme/x", "", ""),
        ("http://A.Com/En/x?q=/y#z", "a.com", "/En/x"),
        ("http://a.com?x://b/c", "a.com", ""),
        ("x://://h/p", ":", "//h/p"),
        ("://ÄB.de#f", "Äb.de", ""),
        ("", "", ""),
    ],
)
def test_parts_of_urls(one, url, host, path):
    got = url_parts(F.col("c"))
    assert one(got[0], row=(url,)) == host and one(got[1], row=(url,)) == path


@pytest.mark.parametrize(
    "host, path, rule",
    [
        ("x.com", "/", ("com/", "allow")),
        ("x.com", "", (None, None)),
        ("xcom", "/", (None, None)),
        ("a.example.com", "/en/1", ("example.com/en/", "block")),
        ("badexample.com", "/en/1", ("com/", "allow")),
        ("m.www.example.com", "/en/1", ("www.example.com/en/", "allow")),
        ("x.net", "/es/", ("net/es/", "block")),
        ("x.net", "/es", (None, None)),
    ],
)
def test_rules(one, host, path, rule):
    got = listed_rule(F.col("h"), F.col("p"), RULES)
    run = lambda column: one(column, "h string, p string", (host, path))
    assert (run(got[0]), run(got[1])) == rule


def test_bad_branches_are_told_apart(spark):
    rows = [(f"/good/{i}", 1.0) for i in range(60)] + [(f"/spam/{i}", 0.0) for i in range(60)]
    rows += [(f"/fine/{i}", 1.0 if i % 9 else None) for i in range(60)] + [("", None), (None, None)]
    pages = spark.createDataFrame([("h", *row) for row in rows] + [(None, "/x", 1.0)], "host string, path string, good double")
    pages = pages.na.fill({"host": "", "path": ""}).withColumn("page", F.lit("old"))
    found = template_verdicts(pages)
    assert found.count() == len(rows) + 1 and set(pages.columns) < set(found.columns)
    by_path = {row["path"]: row for row in found.where("host = 'h'").collect()}
    assert by_path["/spam/1"]["template"] == "h/spam/*" and by_path["/spam/1"]["purity"] < 0.5
    assert by_path["/good/1"]["purity"] > 0.5 and by_path["/fine/2"]["purity"] > 0.5
    assert template_verdicts(pages.where("host = 'none'")).count() == 0
