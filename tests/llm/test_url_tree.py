"""The template tree and its purity against plain recursion over lists of paths."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from stayglass.llm import url_filter
from stayglass.llm.common import table
from stayglass.llm.url_filter import RULES, Settings

FOLDER = "/root/testdata/sf0.001"


def split(url):
    _, found, rest = (url or "").partition("://")
    host = re.match(r"[^/?#]*", rest, re.S)[0] if found else ""
    path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0] if found else ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)).verdict if fits else None


def bounds(k, n, z):
    p = k / n
    middle = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return middle - half, middle + half


def brute(urls, s):
    """{(host, path): (template, purity)}; every level of every path is walked."""
    counts = defaultdict(lambda: [0, 0, 0])
    for url in urls:
        host, path = split(url)
        verdict = ruled(host, path)
        for i, one in enumerate((1, verdict == "allow", verdict == "block")):
            counts[host, path][i] += one

    def total(rows):
        return [sum(c) for c in zip(*(counts[r] for r in rows))]

    def smooth(rows, above, parent=None):
        n, good, bad = total(rows)
        if parent is not None and n == total(parent)[0]:
            return above
        return (good + (n - good - bad + s.weight) * above) / (n + s.weight)

    out = {}

    def walk(rows, template, above):
        level, children = len(template), defaultdict(list)
        for row in rows:
            segments = [x for x in row[1].split("/") if x]
            if len(segments) == level:
                out[row] = (tuple(template), above)
            else:
                children["*" if re.search("[0-9]", segments[level]) else segments[level]].append(row)
        literal = [k for k in children if k != "*"]
        everything = sum(total(v)[0] for v in children.values())
        many = len(literal) >= s.variable_children and max(total(children[k])[0] for k in literal) * 100 < everything * s.literal_percent
        beside = total([r for k in literal for r in children[k]])

        def overlap(rows):
            mine = total(rows)
            pairs = [(bounds(mine[i], mine[0], s.z), bounds(beside[i], beside[0], s.z)) for i in (1, 2)]
            return all(low <= high_all and high >= low_all for (low, high), (low_all, high_all) in pairs)

        merged = defaultdict(list)
        for k, v in children.items():
            alike = k != "*" and len(literal) > 1 and overlap(v)
            merged["*" if k == "*" or many else "~" if alike else k] += v
        for k, v in merged.items():
            walk(v, [*template, k], smooth(v, above, rows))

    hosts = defaultdict(list)
    for row in counts:
        hosts[row[0]].append(row)
    domains = defaultdict(list)
    for host, rows in hosts.items():
        domains[".".join(host.split(".")[-2:])] += rows
    for host, rows in hosts.items():
        domain = domains[".".join(host.split(".")[-2:])]
        walk(rows, [], smooth(rows, smooth(domain, s.prior), domain))
    return out


def compare(spark, urls, s=Settings()):
    rows = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), settings=s).collect()
    assert sorted(r.page_id for r in rows) == list(range(len(urls)))
    want = brute(urls, s)
    for r in rows:
        template, purity = want[r.host, r.path]
        assert r.template == "/" + "/".join(template), urls[r.page_id]
        assert r.purity == pytest.approx(purity, abs=2e-6)
        assert r.verdict == (ruled(r.host, r.path) or ("block" if purity < s.reject_below else "allow"))
    return rows


def test_given_pages(spark):
    compare(spark, [r.url for r in table(spark, FOLDER, "pages").collect()])


def test_deep_paths_and_many_children(spark):
    draw = random.Random(5)
    hosts = ["a.example.com", "www.example.com", "b.net", "c.net", "d.org", "x.co.uk"]
    names = ["en", "es", "fr", "news", "ads", "p1", "2024"]
    urls = ["http://" + draw.choice(hosts) + "/" + "/".join(draw.choice(names) for _ in range(draw.randrange(12))) for _ in range(400)]
    urls += [f"http://shop.net/item/{''.join(draw.choices('abcdefgh', k=5))}" for _ in range(60)]  # a variable segment
    urls += ["http://deep.net/" + "/".join("abcdefghij") + "/ads", "http://deep.net/" + "/".join("abcdefghij") + "/docs"]
    urls += [None, "", "no scheme", "http://b.net", "http://b.net/", "http://b.net//es//x", "HTTP://B.NET/es/x?q=1#f", urls[0], urls[0]]
    rows = compare(spark, urls)
    seen = {r.template for r in rows if r.host == "deep.net"}
    assert seen == {"/a/b/c/d/e/f/g/h/i/j/~"}  # two branches without labels are alike, and nothing above them is cut
    assert Counter(r.template for r in rows if r.host == "shop.net") == {"/item/*": 60}


def test_verdicts_follow_the_tree(spark):
    """Blocked branches of a host are rejected below, the rest of the host is not."""
    rules_block = [f"http://m.net/es/{n}" for n in range(40)]
    beside = [f"http://m.net/docs/{n}" for n in range(200)]
    under = ["http://m.net//es//99"]  # the same template as a blocked branch, but no rule fits
    rows = compare(spark, rules_block + beside + under)
    verdict = {u: r.verdict for u, r in zip(rules_block + beside + under, sorted(rows, key=lambda r: r.page_id))}
    assert all(verdict[u] == "block" for u in rules_block + under)
    assert all(verdict[u] == "allow" for u in beside)


def test_empty(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
