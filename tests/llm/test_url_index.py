"""Many URL rules, and the query over its whole table."""

import random
import re
import time

import duckdb
from conftest import SF

from dwellframe.llm import queries, url_rules


def test_query_equals_trying_every_rule(spark):
    urls = duckdb.sql(f"select page_id, url from '{SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in queries.op8_url_rules(spark, SF).collect()}
    assert set(got) == {p for p, _ in urls}
    for page_id, url in urls:
        lower = (url or "").translate(url_rules.LOWER)
        hits = [p for p in queries.PATTERNS if re.search(p.regex(), lower)]
        first = next((p for p in hits if p.verdict == "allow"), hits[0] if hits else None)
        row = got[page_id]
        if row["rule"] is None:
            assert (row["verdict"], row["pattern"]) == ((first.verdict, first.pattern) if first else ("allow", None))


def test_twenty_thousand_rules(spark):
    rng = random.Random(1)
    words = [f"w{n}" for n in range(3000)]
    patterns = [url_rules.Pattern(rng.choice(["allow", "block", "block"]), rng.choice(["||{}.{}.", "^{}^{}^", "/{}/*{}.htm|", "^{}*^{}"]).format(*rng.choices(words, k=2))) for _ in range(20_000)]
    patterns.append(url_rules.Pattern("block", "*zz*"))  # no whole token
    hosts = url_rules.rule_list([("block", f"{w}.org/{rng.choice(['', 'a/', 'a/b/'])}") for w in words] * 2)
    url = lambda: f"http://{rng.choice(words)}.{rng.choice(words)}.{rng.choice(['com', 'org'])}/{rng.choice(words)}/{rng.choice(['a/b/', 'zz', ''])}{rng.choice(words)}.htm"
    urls = [url() for _ in range(150)] + [None, "", "no scheme w1/w2", "http://W5.ORG/a/b/c"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    began = time.time()
    got = url_rules.judge_urls(pages, hosts, patterns).orderBy("page_id").collect()
    assert time.time() - began < 40  # the rules are no part of the plan
    made = [re.compile(p.regex()) for p in patterns]
    for u, row in zip(urls, got, strict=True):
        host, path = url_rules.host_and_path(u)
        fits = [r for r in hosts if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        if fits:
            assert len(row["rule"]) == max(len(str(r)) for r in fits) and row["pattern"] is None
            continue
        lower = (u or "").translate(url_rules.LOWER)
        hits = [p for p, run in zip(patterns, made, strict=True) if run.search(lower)]
        first = next((p for p in hits if p.verdict == "allow"), hits[0] if hits else None)
        assert (row["verdict"], row["pattern"]) == ((first.verdict, first.pattern) if first else ("allow", None)), u
