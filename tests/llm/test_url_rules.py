import random
from itertools import combinations

from pyspark.sql import functions as F

from feedertrace.llm import url_rules as u


def slow_parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def slow_rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in u.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


URLS = ["http://A.Example.com/en/1?x=1#y", "https://www.example.com/en/2", "x.example.net/es/", "http://q.net/es/9", "ftp://net/fr/", "http://fr.org", "http://com", "http://com/", "http://É.com/a", "://", "http://a?b://c/d", "http://a.com#/en/", None, "", "http://notexample.com/en/", "http://example.com/en", "a\nb://c\nd.com/e\nf?g"]


def test_host_path_rule(spark):
    frame = spark.createDataFrame([(i, x, i) for i, x in enumerate(URLS)], "page_id long, url string, verdict long")
    got = {r.page_id: r for r in u.judge_urls(frame).collect()}
    for i, x in enumerate(URLS):
        host, path = slow_parse(x)
        rule, verdict = slow_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), x
        assert got[i].verdict == verdict or verdict is None and got[i].verdict in ("allow", "block")
    assert u.judge_urls(frame.limit(0)).count() == 0


def test_mined_rules_equal_all_combinations(spark):
    rng = random.Random(3)
    urls = [f"http://{rng.choice(['a', 'b-c', 'www'])}.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'es', 'fr'])}/{rng.randrange(99)}{rng.choice(['', '.html', '?q=1'])}" for _ in range(400)]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(urls)] + [(None, urls[0]), (0, urls[0])], "page_id long, url string")
    support, confidence = 0.03, 0.8
    host, path = u.parse_url(F.col("url"))
    sets = [frozenset(r[0]) for r in frame.select(u.url_tokens(host, path, F.col("url"))).collect()]
    said = [slow_rule(*slow_parse(r.url))[1] for r in frame.collect()]
    labelled = [(s, v) for s, v in zip(sets, said, strict=True) if v]
    rules = {}
    for v in ("allow", "block"):
        seen = {frozenset(c) for s, w in labelled if w == v for k in range(1, len(s) + 1) for c in combinations(sorted(s), k)}
        for c in seen:
            both, all_ = sum(c <= s and w == v for s, w in labelled), sum(c <= s for s, _ in labelled)
            if both >= support * len(labelled) and both >= confidence * all_:
                rules[c, v] = both / all_, both / len(labelled)
    kept = {k: x for k, x in rules.items() if not any(c < k[0] and v == k[1] and y[0] >= x[0] for (c, v), y in rules.items())}
    rows = u.judge_urls(frame, min_support=support, min_confidence=confidence).collect()
    want = []
    for r, s, v in zip(frame.collect(), sets, said, strict=True):
        fit = [(*x, len(c), w) for (c, w), x in kept.items() if c <= s]
        want.append((str(r.page_id), v or (max(fit)[3] if fit else "allow"), "stated" if v else "mined" if fit else "default"))
    assert sorted((str(r.page_id), r.verdict, r.by) for r in rows) == sorted(want) and any(x[2] == "mined" for x in want)


def test_a_host_of_half_a_percent_is_mined(spark):
    labelled = [f"http://{'bad-x.example.com/en/' if i < 5 else 'good.com/fr/'}{i}.html" for i in range(1000)]
    frame = spark.createDataFrame(list(enumerate([*labelled, "http://bad-x.example.org/de/7"])), "page_id long, url string")
    last = u.judge_urls(frame).where("page_id = 1000").first()
    assert (last.verdict, last.by) == ("block", "mined")


def test_long_urls_keep_all_tokens(spark):
    deep = "/".join("abcdefghi")
    long = "/".join(f"s{i}" for i in range(40))
    labelled = [f"http://bad-x.example.com/en/{long}/{i}?q=1" for i in range(20)] + [f"http://good.com/en/{deep}/{i}" for i in range(80)]
    frame = spark.createDataFrame(list(enumerate([*labelled, f"http://bad-x.example.org/{deep}"])), "page_id long, url string")
    host, path = u.parse_url(F.col("url"))
    tokens = frame.select("page_id", u.url_tokens(host, path, F.col("url")).alias("t"))
    assert {"h:bad-x", "w:bad", "p:i"} <= set(tokens.where("page_id = 100").first().t)
    # Every token that the 20 alone have is a rule: the host too, behind 40 segments.
    mined, stands = u.mine_rules(tokens.where("page_id < 100").select(F.col("t").alias("tokens"), F.expr("IF(page_id < 20, 'block', 'allow')").alias("verdict")))
    assert {"h:bad-x", "w:bad", "p:s39", "q:q"} <= {r.t for r in stands.join(mined.where("verdict = 'block'").select(F.explode("tokens").alias("k")), "k").collect()}
    assert u.judge_urls(frame).where("page_id = 100").first().by == "mined"
