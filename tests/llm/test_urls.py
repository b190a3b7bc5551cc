import cases
from pyspark.sql import functions as F

from formflow.llm import urls
from formflow.llm.queries import URL_RULES


def parts(spark, url):
    return tuple(spark.createDataFrame([(url,)], "url string").select(urls.host_of(F.col("url")), urls.path_of(F.col("url"))).first())


def test_hosts_and_paths(spark):
    assert parts(spark, "http://A.Example.ORG/en/1?x#y") == ("a.example.org", "/en/1")
    assert parts(spark, "x://y://z/p") == ("y:", "//z/p")
    assert parts(spark, "http://h?q=/a") == ("h", "") and parts(spark, "http://h#/a") == ("h", "")
    assert parts(spark, "no scheme/at/all") == ("", "") and parts(spark, None) == ("", "") and parts(spark, "://") == ("", "")
    assert parts(spark, "http://É.COM/É") == ("É.com", "/É") and parts(spark, "a\nb://h/\np") == ("h", "/\np")


def judged(spark, pages, **how):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: (r.rule, r.verdict) for r in urls.judge_pages(df, URL_RULES, urls.Propagation(**how)).collect()}


def test_the_longest_rule_wins(spark):
    got = judged(spark, [
        (1, "http://a.org/x", ""), (2, "http://example.org/es/x", ""), (3, "http://w.example.org/en/17", ""), (4, "http://example.org/en/2", ""),
        (5, "http://x.com/fr/1", ""), (6, "http://x.com/de/1", ""), (7, "http://notorg/x", ""), (8, "http://a.org", ""), (9, "http://badexample.org/es/", ""), (10, None, None)])
    assert got[1] == ("org/", "allow") and got[2] == ("example.org/es/", "block") and got[3] == ("example.org/en/1", "block") and got[4] == ("org/", "allow")
    assert got[5] == ("com/fr/", "allow") and got[6] == ("com/de/", "block") and got[7] == (None, "allow") and got[8][0] is None
    assert got[9] == ("org/", "allow") and got[10] == (None, "allow")


def propagated(edges, seeds, steps, d):
    hosts = {h for e in edges for h in e} | set(seeds)
    score = {h: [(1 - d) * x for x in seeds.get(h, (0, 0))] for h in hosts}
    start = {h: tuple(v) for h, v in score.items()}
    for _ in range(steps):
        new = {h: list(start[h]) for h in hosts}
        for a, b in edges:
            new[b][0] += d * score[a][0] / sum(x == a for x, _ in edges)
            new[a][1] += d * score[b][1] / sum(y == b for _, y in edges)
        score = new
    return score


def test_propagation_equals_power_iteration(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "d"), ("e", "f"), ("f", "e"), ("d", "e"), ("g", "a")]
    seeds = {"a": (1.0, 0.0), "f": (0.0, 0.5), "z": (0.2, 0.2)}
    e = spark.createDataFrame([(a, b, 1.0) for a, b in edges], "src string, dst string, weight double")
    s = spark.createDataFrame([(h, *v) for h, v in seeds.items()], "host string, trust double, distrust double")
    want = propagated(edges, seeds, 5, 0.8)
    for r in urls.propagate(e, s, urls.Propagation(steps=5, damping=0.8)).collect():
        assert abs(r.trust - want[r.host][0]) < 1e-12 and abs(r.distrust - want[r.host][1]) < 1e-12


def test_distrust_reaches_hosts_beyond_eight_links(spark):
    pages = [(0, "http://bad.com/de/1", "")] + [
        (k, f"http://h{k}.net/", f'<a href="http://{f"h{k - 1}.net" if k > 1 else "bad.com"}/">') for k in range(1, 20)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judge_pages(df, URL_RULES).collect()}
    for k in range(1, 20):
        assert abs(got[k].distrust - 0.15 * 0.85**k) < 1e-4 and got[k].verdict == ("block" if k <= 16 else "allow"), k


def test_cycles_converge(spark):
    e = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "src string, dst string, weight double")
    s = spark.createDataFrame([("a", 0.0, 1.0)], "host string, trust double, distrust double")
    got = {r.host: r.distrust for r in urls.propagate(e, s, urls.Propagation(tolerance=0.001)).collect()}
    assert abs(got["a"] - 0.15 / (1 - 0.85**2)) < 0.006 and abs(got["b"] - 0.85 * 0.15 / (1 - 0.85**2)) < 0.006


def test_hosts_that_link_to_blocked_hosts_are_blocked(spark):
    link = '<a href="http://Bad.com/de/1">x</a> <a href=//bad.com/de/2>y</a> <a href="/local">z</a>'
    got = judged(spark, [(1, "http://bad.com/de/1", ""), (2, "http://farm.net/1", link), (3, "http://farm.net/2", None), (4, "http://good.net/1", '<a href="http://farm.net/1">')])
    assert got[2][1] == got[3][1] == "block"
    got = judged(spark, [(1, "http://bad.com/de/1", ""), (2, "http://farm.net/1", link)], threshold=0.99)
    assert got[2][1] == "allow"


def test_edge_cases(spark):
    assert judged(spark, []) == {}
    df = spark.createDataFrame([(1, "http://a.org/x", "<a>"), (1, "http://a.org/x", "<a>"), (None, None, None)], "page_id long, url string, html string")
    out = urls.judge_pages(cases.with_clashes(df).withColumns({"host": F.lit(1), "trust": F.lit("t"), "verdict": F.lit(None)}), URL_RULES)
    assert out.count() == 3 and out.where("verdict = 'allow'").count() == 3
