import itertools
import math
import random
import re

import pytest

from turnsieve.llm import urlrules

from .fixtures import lower

APART = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "page_id bigint, url string, html string"


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return lower(host), path, rest[len(host) + len(path) :]


def basket(url):
    return sorted({f"{m}:{x}" for m, t in zip("hpq", parts(url), strict=True) for x in APART.split(re.sub("[0-9]+", "0", lower(t))) if x})


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: len(r[1] + r[2]), default=None)


def plain(rows, rules=urlrules.RULES, support=urlrules.MIN_SUPPORT, confidence=urlrules.MIN_CONFIDENCE):
    """Every combination of frequent tokens is counted."""
    judged = [(*parts(u)[:2], rule_of(*parts(u)[:2], rules), basket(u)) for _, u in rows]
    known = [(r[0], set(b)) for _, _, r, b in judged if r]
    least = math.ceil(support * len(known))
    where = {}
    for token in sorted({t for _, b in known for t in b}):
        places = tuple(i for i, (_, b) in enumerate(known) if token in b)
        if len(places) >= least:
            where.setdefault(places, token)
    items, sets = set(where.values()), {}
    for label, b in known:
        for n in range(1, len(b & items) + 1):
            for s in itertools.combinations(sorted(b & items), n):
                sets.setdefault(s, {}).setdefault(label, 0)
                sets[s][label] += 1
    mined = [(n / sum(c.values()), n, y, s) for s, c in sets.items() for y, n in c.items() if n >= least and n / sum(c.values()) >= confidence]
    out = []
    for (i, _), (host, path, rule, b) in zip(rows, judged, strict=True):
        if rule:
            out.append((i, host, path, rule[1] + rule[2], rule[0], None, None))
            continue
        hits = [(-c, -n, len(s), y != "block", list(s), y) for c, n, y, s in mined if set(s) <= set(b)]
        best = min(hits, default=None)
        out.append((i, host, path, None, best[-1] if best else "allow", " ".join(best[4]) if best else None, -best[0] if best else None))
    return out


def some(n, seed):
    rng = random.Random(seed)
    hosts = ["a.example.org", "example.org", "b.com", "www.b.com", "shop.net", "x.shop.net", "org", "notexample.org", "c.biz"]
    return [
        (i, f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(['/es/', '/en/', '/fr/', '/de/', '/'])}"
            f"{rng.randint(0, 300)}{rng.choice(['', '', '?utm=1', '#top', '.html', '?buy=now&x=2'])}")
        for i in range(n)
    ]


ODD = [
    (900, None), (901, ""), (902, "no scheme/at/all"), (903, "http://"), (904, "://"), (905, "http://ORG"), (906, "http://Org/"),
    (907, "http://example.org?x=/es/"), (908, "http://example.org/en/1"), (909, "a://b://example.org/es/x"), (910, "http://a.b.com/de/\nline?q\nr"),
    (None, "http://b.com/fr/1"), (911, "http://xorg/de/"), (911, "http://xorg/de/"), (912, "http://c.biz/" + "/".join(f"seg{i}" for i in range(3000))),
    (913, "http://b.com/de/" + "deep/" * 5000), (914, "http://münchen.org/ß/É?ä=Ö"),
]


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = urlrules.judge(df, **options).select("page_id", "host", "path", "rule", "verdict", "pattern", "confidence")
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize(("support", "confidence"), [(0.01, 0.9), (0.05, 0.6)])
def test_against_every_combination(spark, support, confidence):
    rows = some(300, 1) + ODD
    want = plain(rows, support=support, confidence=confidence)
    assert found(spark, rows, min_support=support, min_confidence=confidence) == sorted(want, key=str)
    assert {r[4] for r in want if r[3] is None} == {"allow", "block"}


def test_hot_url_of_many_tokens(spark):
    """A third of all rows are one URL of forty tokens: they are one item, not 2^40 combinations."""
    hot = "http://example.org/es/" + "/".join(f"{a}{b}" for a in "abcdefgh" for b in "vwxyz")
    rows = some(100, 2) + [(1000 + i, hot) for i in range(50)]
    assert found(spark, rows, min_support=0.1) == sorted(plain(rows, support=0.1), key=str)


def test_longest_rule_wins(spark):
    rules = [("allow", "org", "/"), ("block", "x.org", "/a"), ("allow", "x.org", "/a/b"), ("block", "y.x.org", "/")]
    urls = ["http://x.org/a/b/c", "http://x.org/a/c", "http://z.x.org/b", "http://y.x.org/b", "http://y.x.org/a/b"]
    got = {r[0]: r[3:5] for r in found(spark, list(enumerate(urls)), rules=rules)}
    assert got == {0: ("x.org/a/b", "allow"), 1: ("x.org/a", "block"), 2: ("org/", "allow"), 3: ("y.x.org/", "block"), 4: ("x.org/a/b", "allow")}
    with pytest.raises(ValueError):
        urlrules.given(None, None, rules * 1000)


def test_without_rules_or_rows(spark):
    assert found(spark, some(5, 3), rules=[]) == sorted(((i, *parts(u)[:2], None, "allow", None, None) for i, u in some(5, 3)), key=str)
    assert found(spark, []) == []


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "http://a.org/", "h", "k", "v")], "page_id bigint, url string, Host string, key string, _key string")
    got = urlrules.judge(df)
    assert got.columns == ["page_id", "url", "key", "_key", "host", "path", "rule", "verdict", "pattern", "confidence"]
    assert tuple(got.first()) == (1, "http://a.org/", "k", "v", "a.org", "/", "org/", "allow", None, None)


def test_native_plan(spark):
    df = spark.createDataFrame([(*r, "x") for r in some(50, 4)], SCHEMA)
    plan = urlrules.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)
