import random

import numpy as np
import pytest

from portrait.llm import urlgraph as U


def brute_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    rest = rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return host, rest[:end]


def brute_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fits, key=lambda r: (-len(r.text), r.text, r.verdict), default=None)


def brute_judge(pages, links, rules, damping=0.85, turns=20, threshold=0.075):
    at = [brute_url(u) for _, u, _ in pages]
    fit = [brute_rule(h, p, rules) for h, p in at]
    hosts = sorted({h for h, _ in at} | {h for e in links for h in e})
    index = {h: k for k, h in enumerate(hosts)}
    seeds = np.zeros((2, len(hosts)))
    for h in {h for h, _ in at if h}:
        own = [f.verdict if f else "" for (x, _), f in zip(at, fit) if x == h]
        seeds[:, index[h]] = own.count("allow") / len(own), own.count("block") / len(own)
    scores = []
    for seed, turn in zip(seeds, (links, [(b, a) for a, b in links])):
        matrix = np.zeros((len(hosts), len(hosts)))
        for a, b in turn:
            matrix[index[b], index[a]] = damping / sum(x == a for x, _ in turn)
        x = (1 - damping) * seed
        for _ in range(turns):
            x = matrix @ x + (1 - damping) * seed
        scores.append(x)
    bad = {h for h in hosts if scores[1][index[h]] - scores[0][index[h]] > threshold}
    return sorted((i if i is not None else -1, h, p, f.text if f else None, f.verdict if f else "block" if h in bad else "allow")
                  for (i, _, _), (h, p), f in zip(pages, at, fit))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    hosts = [f"h{i}.example.{t}" for i in range(12) for t in ("com", "org", "net", "edu")]
    pages, links = [], set()
    for i in range(400):
        host = "h0.example.edu" if i % 3 == 0 else rng.choice(hosts)
        out = [rng.choice(hosts) for _ in range(rng.choice([0, 0, 1, 3]))]
        links |= {(host, x) for x in out if x != host}
        body = "".join(f"<A class=x HREF={q}{s}{x.upper()}/p?q{q}>t</a>" for x in out for q, s in [rng.choice([('"', "http://"), ("'", "//"), ("", "https://")])])
        pages.append((i, f"http://{host}" + rng.choice(["/", "/de/x", "/en/y", "/fr/z", "", "/en"]) + rng.choice(["", "?q=/", "#a"]), body + "<a href='/own'><p data-href='http://no.example.net'>"))
    pages += [(9000, None, None), (9001, "no scheme", "<a href='http://h1.example.net/'>"), (9002, "HTTP://UP.Example.NET/EN/", None), (9003, "x://", ""), (None, "a://h3.example.com?x://y/z", ""), (5, *pages[5][1:])]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, host string, verdict string")
    got = sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in U.judge_urls(df, U.OP2_RULES).collect())
    assert got == brute_judge(pages, sorted(links), U.OP2_RULES)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_rules(spark):
    rules = [U.UrlRule("a.b", "/x", "block"), U.UrlRule("a.b", "/x", "allow"), U.UrlRule("b", "/xyz", "block"), U.UrlRule("c", "", "block")]
    urls = ["http://a.b/xy", "http://b/xyz/", "http://ca.b/x", "http://z.a.b/xyzz", "http://c", "http://d.c?x", "http://dc/"]
    df = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = [(r.rule, r.verdict) for r in U.judge_urls(df, rules).orderBy("page_id").collect()]
    assert got == [("a.b/x", "allow"), ("b/xyz", "block"), (None, "allow"), ("b/xyz" if len("b/xyz") > len("a.b/x") else "a.b/x", "block" if len("b/xyz") > len("a.b/x") else "allow"), ("c", "block"), ("c", "block"), (None, "allow")]
    many = rules + [U.UrlRule(f"h{i}.a.b", "/x", "allow") for i in range(5_000)]  # any number of rules
    assert [(r.rule, r.verdict) for r in U.judge_urls(df, many).orderBy("page_id").collect()] == got
    one = spark.createDataFrame([(1, "http://deep.h77.a.b/xyz", "")], "page_id long, url string, html string")
    assert [(r.rule, r.verdict) for r in U.judge_urls(one, U.rule_table(spark, many)).collect()] == [("h77.a.b/x", "allow")]


def test_empty_table_and_no_rules(spark):
    df = spark.createDataFrame([(1, "http://a/b", "<a href='http://c/d'>")], "page_id long, url string, html string")
    assert U.judge_urls(df.limit(0), U.OP2_RULES).count() == 0
    assert [tuple(r) for r in U.judge_urls(df, []).collect()] == [(1, "a", "/b", None, "allow")]
