"""URL verdicts against plain Python, and the cascade against a set."""

import re

import pytest
from pyspark.sql import functions as F

from stagemart.llm.queries import URL_RULES
from stagemart.llm.scratch import Scratch
from stagemart.llm.urls import CascadeOptions, build_cascade, filter_urls

URLS = [
    None, "", "no scheme", "http://", "://x", "HTTP://WWW.Example.COM/en/x?q#f", "http://a.b.example.com/en/", "http://example.com/en", "http://com/", "http://com",
    "http://xcom/", "http://a.com?x=/", "http://a.com#/en/", "http://a.net/es/1", "http://a.net/fr", "http://net/fr/?utm_source=1", "http://É.org/ABC/utm_source=",
    "a://b://c/d", "http://u:p@h.org:80/x\ny?utm_source=z", "http://long.org/" + "p/" * 40_000, "http://wwwxexample.com/en/", "x://www.example.com/en/", "http://a.org", "http://a.org", "http://a.org?utm_source=1",
]


def _cut(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]) if found else ("", "")


def _expected(urls):
    listed = {"".join(_cut(url)) for url in urls if "utm_source=" in (url or "")}
    found = []
    for url in urls:
        host, path = _cut(url)
        fits = [rule for rule in URL_RULES if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)]
        best = max(fits, key=lambda rule: len(rule.text), default=None)
        verdict = best.verdict if best else "block" if host + path in listed else "allow"
        found.append((host, path, best and best.text, verdict))
    return found


@pytest.mark.parametrize("options", [CascadeOptions(), CascadeOptions(1 / 2, 1 / 2), CascadeOptions(max_bits=1 << 10)], ids=["usual", "many levels", "many shards"])
def test_verdicts_equal_plain_python(spark, options):
    urls = URLS + [f"http://h{n % 37}.org/p{n % 501}{'?utm_source=a' if n % 7 == 0 else ''}" for n in range(3000)]
    frame = spark.createDataFrame([(n, url, "x", 1) for n, url in enumerate(urls)], "page_id long, url string, host string, verdict int")
    with pytest.raises(ValueError, match="verdict"):
        filter_urls(frame, F.lit(True), URL_RULES, output="verdict")
    found = filter_urls(frame.repartition(3), F.col("url").contains("utm_source="), URL_RULES, options=options)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Join", plan)
    rows = {row.page_id: tuple(row.judged) for row in found.collect()}
    assert [rows[number] for number in range(len(urls))] == _expected(urls)


@pytest.mark.parametrize("max_bits", [1 << 27, 1 << 12])
def test_cascade_is_exact_over_all_keys(spark, max_bits):
    keys = spark.range(4_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 3 == 0).alias("listed"))
    keys = keys.union(keys).union(spark.createDataFrame([(None, None), (None, True), ("z", None)], "key string, listed boolean"))
    scratch = Scratch(spark, "test")
    cascades = build_cascade(keys, scratch, CascadeOptions(1 / 4, 1 / 2, max_bits))
    assert (len(cascades.shards) > 1) == (max_bits < 1 << 20) and max(len(cascade.levels) for cascade in cascades.shards) > 3
    key = F.coalesce("key", F.lit(""))
    found = cascades.passed(keys, key, lambda rows, listed: rows.select("key", listed.alias("found")), scratch).distinct().collect()
    assert {row.key for row in found if row.found} == {f"k{n}" for n in range(0, 4_000, 3)} | {None}
    assert len(found) == 4_002


@pytest.mark.parametrize("listed", [True, False])
def test_all_or_none_listed_and_no_rows(spark, listed):
    frame = spark.createDataFrame([(n, f"http://h{n}.org/") for n in range(50)], "page_id long, url string")
    found = filter_urls(frame, F.lit(listed), []).select("judged.verdict").distinct().collect()
    assert [row[0] for row in found] == ["block" if listed else "allow"]
    assert filter_urls(frame.limit(0), F.lit(listed), URL_RULES).collect() == []
