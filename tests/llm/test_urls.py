import random
import re

import pytest

from martkeep.llm import urls
from martkeep.llm.queries import RULES

PAGE = "page_id long, url string, html string, host string, rule string, verdict string"


def brute(pages, rules, links):
    def split(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        return (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")

    def rule(url):
        host, path = split(url)
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fit, key=lambda r: (len(r.host + r.path), r.host + r.path, r.verdict), default=None)

    bare = lambda url: url.split("#")[0]
    near = {}
    for a, b in links:
        near.setdefault(bare(a), set()).add(bare(b))
        near.setdefault(bare(b), set()).add(bare(a))
    out = []
    for page_id, url in pages:
        best, verdict = rule(url), "allow"
        if best:
            verdict = best.verdict
        elif url is not None and bare(url) in near:
            seen, todo = {bare(url)}, [bare(url)]
            while todo:
                for x in near.get(todo.pop(), ()):
                    if x not in seen:
                        seen.add(x)
                        todo.append(x)
            verdicts = {r.verdict for x in seen if (r := rule(x))}
            verdict = "block" if verdicts == {"block"} else "allow"
        host, path = split(url)
        out.append((page_id, host, path, best and best.host + best.path, verdict))
    return sorted(out, key=repr)


def test_rules_and_aliases(spark):
    rnd = random.Random(8)
    hosts = ["a.example.org", "EXAMPLE.org", "x.com", "com", "b.net", "c.net", "notexample.org", "d.net:80"]
    paths = ["", "/", "/es/1", "/en/17", "/fr/2", "/de/3", "/q?x=/de/", "/en/2#f"]
    links, pages = [], []
    for i in range(120):
        url = f"http://{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.randrange(30)}"
        html = "<html></html>"
        if rnd.random() < 0.4:
            other = f"https://{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.randrange(30)}"
            html = rnd.choice([
                f'<head><LINK href="{other}" rel="canonical"></head>', f"<link rel=canonical href={other}>",
                f'<meta http-equiv="refresh" content="0; URL={other}">',
            ])
            links.append((url, other))
        pages.append((i, url, html))
    pages += [(200, None, None), (201, "no scheme/de/", None), (202, "", ""), (None, "http://x.com/de/", "x"), pages[3], pages[3], (203, "a://b.net/x://y.com/de/", None)]
    pages += [(204, "http://b.net/start", '<link rel="canonical" href="/de">'), (205, "http://b.net/x\ny#z", "")]
    links.append(("http://b.net/start", "http://b.net/de"))
    df = spark.createDataFrame([(*p, "clash", "clash", "clash") for p in pages], PAGE)
    got = urls.judge_urls(df, RULES, urls.page_links(df)).collect()
    want = brute([p[:2] for p in pages], RULES, links)
    assert sorted(map(tuple, got), key=repr) == want
    assert {v for *_, v in want} == {"allow", "block"} and any(r is None and v == "block" for *_, r, v in want)


@pytest.mark.parametrize("literal", [0, 64])
def test_many_rules_are_joined_to_the_same_end(spark, monkeypatch, literal):
    monkeypatch.setattr(urls, "LITERAL_RULES", literal)
    rnd = random.Random(2)
    parts = ["a", "b", "org", "com", "x-y"]

    def host():
        return ".".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 4)))

    def path():
        return "".join("/" + rnd.choice("abc") * rnd.randrange(1, 3) for _ in range(rnd.randrange(0, 4)))

    rules = list({(h := host(), p := path()): urls.Rule(rnd.choice(["allow", "block"]), h, p) for _ in range(400)}.values())
    pages = [(i, f"http://{host()}{path()}{rnd.choice(['', '?q', '#f', '/'])}") for i in range(300)] + [(500, None), (501, "none"), (502, "a://"), (503, "a://.com/a")]
    links = [(pages[i][1], pages[i + 1][1]) for i in range(0, 60, 2)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    for given in (rules, spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")):
        got = urls.judge_urls(df, given, spark.createDataFrame(links, "url string, other string")).collect()
        assert sorted(map(tuple, got), key=repr) == brute(pages, rules, links)


def test_more_rules_than_a_plan_holds(spark):
    rules = [urls.Rule("block", f"h{i}.org", "/") for i in range(20_000)] + [urls.Rule("allow", "h7.org", "/a")]
    pages = spark.createDataFrame([(i, f"http://www.h{i}.org/a") for i in (5, 7, 19_999, 20_000)], "page_id long, url string")
    got = urls.judge_urls(pages, rules, spark.createDataFrame([], "url string, other string"))
    assert dict(got.select("page_id", "verdict").collect()) == {5: "block", 7: "allow", 19_999: "block", 20_000: "allow"}


def test_explicit_allow_comes_first(spark):
    pages = [(1, "http://b.net/1"), (2, "http://x.com/de/"), (3, "http://x.com/fr/"), (4, "http://c.net/1"), (5, "http://c.net/2")]
    links = [("http://b.net/1", "http://x.com/de/"), ("http://x.com/fr/", "http://b.net/1"), ("http://c.net/1", "http://c.net/2"), ("http://c.net/2", "http://y.com/de/")]
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = urls.judge_urls(df, RULES, spark.createDataFrame(links, "url string, other string"))
    assert dict(got.select("page_id", "verdict").collect()) == {1: "allow", 2: "block", 3: "allow", 4: "block", 5: "block"}


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge_urls(df, RULES, urls.page_links(df)).count() == 0
    assert urls.judge_urls(df, [], urls.page_links(df)).count() == 0


def test_all_links_of_any_form_are_followed(spark):
    def canonical(href):
        return f'<link rel="canonical" href="{href}">'

    pages = [
        (1, "http://Free.net/1", canonical("http://free.net/other") + canonical("http://y.com/de/")),  # the second link
        (2, "http://a.net/x/2", canonical("../y?a=1&amp;b=2")), (3, "http://a.net/y?a=1&b=2", canonical("HTTP://Y.com/de/")),
        (4, "http://c.net/d/4", canonical("5")), (5, "http://C.NET/d/5", '<meta http-equiv="refresh" content="0; url=?id=3">'),
        (6, "http://c.net/d/5?id=3#f", '<meta http-equiv="refresh" content="0; url=//y.com/de/">'),
        (7, "http://e.net/7", '<base href="http://y.com/de/">' + canonical("q")), (8, "http://f.net/8", canonical("mailto:a@y.com/de/")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = urls.judge_urls(df, RULES, urls.page_links(df))
    assert dict(got.select("page_id", "verdict").collect()) == {**dict.fromkeys(range(1, 8), "block"), 8: "allow"}


def test_links_are_resolved_as_the_standard_says():
    base = "http://a/b/c/d;p?q"
    want = {
        "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y",
        "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s", ".": "http://a/b/c/", "..": "http://a/b/", "../g": "http://a/b/g",
        "../..": "http://a/", "../../../g": "http://a/g", "g;x=1/../y": "http://a/b/c/y", "g?y/../x": "http://a/b/c/g?y/../x", "g:h": None,
    }
    assert {link: urls.resolve(base, link) for link in want} == want
