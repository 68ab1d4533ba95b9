import random
import re

import pytest
from pyspark.sql import functions as F

from strataflow.llm import url_filter as U


def slow_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def slow_rule(host, path):
    fits = [r for _, r in U.RULES if (host == (d := r.split("/")[0]) or host.endswith("." + d)) and path.startswith(r[len(d) :])]
    return max(fits, key=len, default=None)


def slow_ranks(links, family, seeds, rounds=1000, damping=U.DAMPING, share=U.FAMILY):
    """By the definition: seeds of mass one, dangling mass returned to them in each round."""
    total = sum(seeds.values())
    seeds = {h: v / total for h, v in seeds.items()}
    rank = dict(seeds)
    for _ in range(rounds):
        now, kept = {}, 0.0
        for edges, part in ((links, 1 - share), (family, share)):
            out = {}
            for (s, _), n in edges.items():
                out[s] = out.get(s, 0) + n
            kept += sum(v * part for h, v in rank.items() if h in out)
            for (s, d), n in edges.items():
                if s in rank:
                    now[d] = now.get(d, 0) + rank[s] * part * n / out[s] * damping
        for h, v in seeds.items():
            now[h] = now.get(h, 0) + v * ((1 - damping) + damping * (1 - kept))
        rank = now
    return rank


def slow_verdicts(rows):
    edges, hosts, tally = {}, set(), {}
    for _, url, html in rows:
        host, path = slow_split(url)
        hosts.add(host)
        said = dict((r, a) for a, r in U.RULES).get(slow_rule(host, path))
        t = tally.setdefault(host, [0, 0, 0])
        t[0] += said == "allow"
        t[1] += said == "block"
        t[2] += 1
        for to in re.findall(r"""href\s*=\s*["']?[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#"'\s<>]*)""", html or "", re.I):
            to = to.lower()
            if host and to and host != to:
                edges[host, to] = edges.get((host, to), 0) + 1
                hosts.add(to)
    above = set()
    for h in hosts:
        while h.count(".") >= 2:
            above.add((h, h.split(".", 1)[1]))
            h = h.split(".", 1)[1]
    family = {pair: 1 for a, b in above for pair in ((a, b), (b, a))}
    trust = slow_ranks(edges, family, {h: g / n for h, (g, _, n) in tally.items() if h and g})
    doubt = slow_ranks({(b, a): n for (a, b), n in edges.items()}, family, {h: d / n for h, (_, d, n) in tally.items() if h and d})
    out = []
    for i, url, _ in rows:
        host, path = slow_split(url)
        rule = slow_rule(host, path)
        t, d = (round(x.get(host, 0), 12) for x in (trust, doubt))
        out.append((i, host, path, rule, dict((r, a) for a, r in U.RULES)[rule] if rule else "block" if d > t else "allow", t, d))
    return out


def pages_of(n):
    rng = random.Random(4)
    hosts = [f"{s}{w}.example.{t}" for s in ("", "m.", "Blog.") for w in ("a", "b", "c", "d") for t in ("net", "org", "com")]
    link = lambda: f'<a href="https://{rng.choice(hosts)}/x">y</a>'
    rows = [(i, f"http://{rng.choice(hosts)}/{rng.choice(('en', 'fr', 'de'))}/{i}?q#z", "".join(link() for _ in range(rng.randint(0, 4)))) for i in range(n)]
    odd = [None, "", "no scheme", "http://", "x://NET/", "http://net", "http://a.net?x/y", "http://xnet/en/", "a://b://c.net/", "http://example.net/en/\nq", "http://é.org/fr/"]
    return rows + [(1000 + i, u, None) for i, u in enumerate(odd)] + [(None, "http://a.example.com/", ""), rows[0], rows[0]]


def test_matches_brute_force(spark):
    rows = pages_of(120)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("mine")).withColumn("rank", F.lit(1))
    got = sorted([tuple(r) for r in U.judge_urls(frame).collect()], key=repr)
    want = sorted(slow_verdicts(rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], abs=2e-9)


def test_empty_table(spark):
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_long_chains_and_hubs_reach_a_verdict(spark):
    """Distrust goes back over 30 links, and through two hubs that divide it below any fixed number of decimals."""
    blocked = "http://bad.net/x"
    link = lambda to: f'<a href="http://{to}/">y</a>'
    chain = [(i, f"http://c{i}/", link(f"c{i - 1}") if i else link("bad.net")) for i in range(30)]
    hubs = [(100, "http://hub1/", link("bad.net")), (101, "http://hub2/", link("mid")), (102, "http://mid/", link("hub1")), (103, "http://far/", link("hub2")), (104, "http://alone/", "")]
    crowd = [(1000 + 2 * i + k, f"http://{h}x{i}/", link(h)) for i in range(20_000) for k, h in enumerate(("hub1", "hub2"))]
    pages = spark.createDataFrame([(99, blocked, ""), *chain, *hubs, *crowd], "page_id long, url string, html string")
    said = {r.page_id: r for r in U.judge_urls(pages).collect()}
    assert all(said[i].verdict == "block" and said[i].distrust > 0 for i in (*range(30), 100, 101, 102, 103))
    assert 0 < said[103].distrust < 5e-10 and said[104].verdict == "allow" and said[104].distrust == 0


def test_slices_of_hubs_change_nothing_and_ranks_have_mass_one(spark):
    frame = spark.createDataFrame(pages_of(150), "page_id long, url string, html string")
    plain, sliced = (sorted([tuple(r) for r in U.judge_urls(frame, hub=h).collect()], key=repr) for h in (U.HUB, 2))
    assert [r[:5] for r in plain] == [r[:5] for r in sliced]
    assert [x for r in plain for x in r[5:]] == pytest.approx([x for r in sliced for x in r[5:]], rel=1e-6, abs=1e-15)
    edges = spark.createDataFrame([("t", "a", "b", False, 3), ("t", "b", "c", False, 1), ("t", "b", "a", True, 1)], "kind string, src string, dst string, family boolean, n long")
    seeds = spark.createDataFrame([("t", "a", 5.0), ("t", "z", 2.5)], "kind string, host string, seed double")
    ranks = {r.host: r["rank"] for r in U.propagate(edges, seeds).collect()}
    assert sum(ranks.values()) == pytest.approx(1) and ranks == pytest.approx(slow_ranks({("a", "b"): 3, ("b", "c"): 1}, {("b", "a"): 1}, {"a": 5.0, "z": 2.5}))


def test_links_outweigh_the_domain_above(spark):
    """Two hosts under one trusted domain; the one that links to a blocked host is blocked all the same."""
    pages = [(1, "http://good.org/fr/x", ""), (2, "http://bad.net/x", ""), (3, "http://a.good.org/x", '<a href="http://bad.net/">y</a>'), (4, "http://b.good.org/x", "")]
    said = {r.page_id: r.verdict for r in U.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert said == {1: "allow", 2: "block", 3: "block", 4: "allow"}
