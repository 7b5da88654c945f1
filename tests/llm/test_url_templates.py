import random
import re

from gigframe.llm import queries
from gigframe.llm import url_templates as ut

RULES = queries.URL_RULES


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    if rest is None:
        host = path = ""
    else:
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, rule in RULES:
        name, slash, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + tail):
            if best is None or len(rule) > len(best[1]):
                best = verdict, rule
    return host, path, best


def test_whole_table_and_odd_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odd = [None, "", "no scheme", "http://", "HTTP://A.COM", "x://WWW.Example.COM/en/1?q#f",
           "http://com/en", "http://example.com/en", "http://xexample.com/en/1", "a://b://c.net/es/",
           "http://a.net/fr/x\ny", "http://É.com/", "http://user@a.com:80/de/", "http://a.net?x/es/"]
    extra = spark.createDataFrame([(10**6 + k, u) for k, u in enumerate(odd)],
                                  "page_id long, url string")
    df = pages.select("page_id", "url").unionByName(extra).unionByName(extra)
    urls = {r.page_id: r.url for r in df.collect()}
    got = ut.verdicts(df, RULES).collect()
    assert len(got) == df.count()
    for r in got:
        host, path, best = brute(urls[r.page_id])
        assert (r.host, r.path) == (host, path), urls[r.page_id]
        assert r.rule == (best[1] if best else None)
        assert r.verdict in ("allow", "block") and (best is None or r.verdict == best[0])
    assert ut.verdicts(df.limit(0), RULES).count() == 0


def test_purity_rejects_templates_like_the_blocked_ones(spark):
    # /news/ is blocked by rule on most of its numbers' siblings; /shop/x is allowed.
    rows = [(k, f"http://h.org/news/{k}.html") for k in range(40)]
    rows += [(100 + k, f"http://h.org/shop/item-{k}") for k in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = [("block", f"h.org/news/{k}") for k in range(1, 4)] + [("allow", "h.org/shop/item-")]
    got = {r.page_id: r for r in ut.verdicts(df, rules).collect()}
    assert got[0].rule is None and got[0].verdict == "block"  # its template is mostly blocked
    assert got[0].template == got[39].template and got[0].purity < ut.LEAST
    assert got[120].verdict == "allow" and got[120].purity > 0.8


def brute_shape(path):
    clean = re.sub(r"/+$", "", path.lower())
    clean = re.sub(r"(?<![0-9a-z])(?=[a-f]*[0-9])[0-9a-f-]{8,}(?![0-9a-z])", "{x}", clean)
    return re.sub(r"^/", "", re.sub(r"[0-9]+", "{n}", clean)).split("/")


def brute_form(seg):
    return "".join(x if x in ("{n}", "{x}") else re.sub(r"[^\W\d_]+", "{w}", x)
                   for x in re.split(r"(\{[nx]\})", seg))


def brute_differ(hits, n, all_hits, all_n):
    rest = all_n - n
    if not n or not rest or not 0 < all_hits < all_n:
        return False
    p = all_hits / all_n
    z = (hits / n - (all_hits - hits) / rest) / (p * (1 - p) * (1 / n + 1 / rest)) ** 0.5
    return abs(z) > ut.Z


def brute_templates(urls, rules):
    """(host, path) -> template and purity, from lists of urls per node of the tree."""
    def ruled(host, path):
        fits = [(len(r), r, v) for v, r in rules if path.startswith(r[r.index("/"):])
                and (host == r[:r.index("/")] or host.endswith("." + r[:r.index("/")]))]
        return max(fits)[2] if fits else None

    rows = [(h, brute_shape(p), ruled(h, p)) for h, p in urls]
    prefix = [""] * len(rows)
    for level in range(ut.DEPTH):
        last = level == ut.DEPTH - 1
        segs = ["/".join(s[level:]) if last else s[level] if len(s) > level else "" for _, s, _ in rows]
        nodes = {}
        for k, (h, _, _) in enumerate(rows):
            nodes.setdefault((h, prefix[k]), {}).setdefault(segs[k], []).append(k)
        new = list(prefix)
        for kids in nodes.values():
            stat = {g: (len(ks), sum(rows[k][2] == "allow" for k in ks),
                        sum(rows[k][2] == "block" for k in ks),
                        sum(last or len(rows[k][1]) <= level + 1 for k in ks)) for g, ks in kids.items()}
            total = [sum(x) for x in zip(*stat.values())]
            for g, (n, good, bad, ends) in stat.items():
                alike = [v for o, v in stat.items() if brute_form(o) == brute_form(g) and not v[1] + v[2]]
                if g == "":
                    branch = ""
                elif len(kids) > ut.FEW and len(kids) > ut.DIFFERENT * total[0]:
                    branch = "*"
                elif len(kids) == 1:
                    branch = g
                elif good + bad:
                    branch = g if brute_differ(good, good + bad, total[1], total[1] + total[2]) \
                        else "{similar}"
                else:
                    branch = g if brute_differ(ends, n, sum(v[3] for v in alike),
                                               sum(v[0] for v in alike)) \
                        else "{unlabelled}" + brute_form(g)
                for k in kids[g]:
                    new[k] = f"{prefix[k]}/{branch}"
        prefix = new

    def count(of):
        out = {}
        for k, (h, _, v) in enumerate(rows):
            at = out.setdefault(of(h, prefix[k]), [0, 0])
            at[0] += v == "allow"
            at[1] += v is not None
        return out

    def domain(h):
        return ".".join(h.split(".")[-2:])

    own, hosts = count(lambda h, t: (h, t)), count(lambda h, t: h)
    there = count(lambda h, t: (domain(h), t))
    out = {}
    for (h, p), t in zip(urls, prefix):
        base = (hosts[h][0] + ut.HOST_URLS * ut.PRIOR) / (hosts[h][1] + ut.HOST_URLS)
        g, n = own[h, t]
        ag, an = there[domain(h), t]
        like = (ag - g + ut.DOMAIN_URLS * base) / (an - n + ut.DOMAIN_URLS)
        out[h, p] = t, (g + ut.URLS * like) / (n + ut.URLS)
    return out


def random_urls(seed):
    rng = random.Random(seed)
    hosts = ["a.one.net", "b.one.net", "one.net", "x.two.org", "c.com"]
    out = []
    for _ in range(900):
        h = rng.choice(hosts)
        first = rng.choice(["en", "es", "fr", "de", "tag", "news"])
        tail = {"tag": f"/w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}",
                "news": f"/{rng.randrange(90)}/{rng.choice(['a', 'b'])}/{rng.randrange(9)}/x/y"}.get(
            first, rng.choice([f"/{rng.randrange(999)}", f"/{rng.randrange(999)}.html", "", "/"]))
        out.append((h, f"/{first}{tail}"))
    return out


def test_trees_and_verdicts_match_brute_force(spark):
    rules = [("block", "net/es/"), ("block", "net/fr/"), ("allow", "com/"), ("block", "c.com/en/"),
             ("allow", "b.one.net/en/1"), ("block", "two.org/news/1"), ("allow", "two.org/news/2"),
             ("allow", "a.one.net/tag/wa")]
    for seed in (1, 2):
        urls = random_urls(seed)
        df = spark.createDataFrame([(k, f"http://{h}{p}", "t", 0.5) for k, (h, p) in enumerate(urls)],
                                   "page_id long, url string, template string, purity double")
        want = brute_templates(urls, rules)
        blocked = 0
        for r in ut.verdicts(df, rules).collect():
            t, purity = want[urls[r.page_id]]
            assert (r.template, round(r.purity, 9)) == (t, round(purity, 9)), urls[r.page_id]
            if r.rule is None:
                assert r.verdict == ("block" if purity < ut.LEAST else "allow")
                blocked += r.verdict == "block"
        assert blocked > 0


def test_unruled_urls_have_templates_of_their_own_and_deep_paths_work(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    got = [r for r in ut.verdicts(pages, RULES).collect() if r.rule is None]
    assert len({r.template for r in got}) > 1 and {r.verdict for r in got} == {"allow", "block"}
    deep = spark.createDataFrame([(1, "http://h.org/" + "a/" * 5000), (2, "http://h.org/" + "b" * 10**6),
                                  (3, "http://h.org//" + "/" * 99)], "page_id long, url string")
    assert {r.verdict for r in ut.verdicts(deep, RULES).collect()} == {"allow"}


def test_different_segments_become_a_wildcard(spark):
    rows = [(k, f"http://h.org/tag/word{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}") for k in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    assert {r.template for r in ut.verdicts(df, []).collect()} == {"/tag/*//"}
