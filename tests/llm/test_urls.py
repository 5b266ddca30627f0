import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loadsieve.llm import QUERIES
from loadsieve.llm.urls import RULES, judge_urls, matched_rule, segment_shape, url_host, url_path

URLS = {
    "http://A.Example.ORG/es/x?q#f": ("a.example.org", "/es/x", "example.org/es/", "block"),
    "https://example.org/en/19": ("example.org", "/en/19", "example.org/en/1", "block"),
    "https://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
    "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "https://x.org": ("x.org", "", None, None),
    "https://x.org?a=/b": ("x.org", "", None, None),
    "https://x.com/fr/1": ("x.com", "/fr/1", "com/fr/", "allow"),
    "https://x.com/de/1#a?b": ("x.com", "/de/1", "com/de/", "block"),
    "https://x.com/DE/1": ("x.com", "/DE/1", None, None),
    "https://xcom/de/1": ("xcom", "/de/1", None, None),
    "a://b://c/d": ("b:", "//c/d", None, None),
    "http://É.com/fr/\n1": ("É.com", "/fr/\n1", "com/fr/", "allow"),
    "no scheme.org/": ("", "", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
    "://": ("", "", None, None),
}


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string").select("url", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p"))
    for r in df.withColumn("m", matched_rule(F.col("h"), F.col("p"))).collect():
        assert (r.h, r.p, r.m and r.m.rule, r.m and r.m.verdict) == URLS[r.url], r.url


@pytest.mark.parametrize("segment,shape", [("12", "{number}"), ("12.html", "{number}.html"), ("a", "a"), ("deadbeef01", "{hash}"), ("2024-01-02", "{date}"), ("a-b-c-d", "{slug}"), ("x1y2z3", "{code}"), ("index.HTML", "index.HTML")])
def test_shapes(spark, segment, shape):
    assert spark.createDataFrame([(segment,)], "s string").select(segment_shape(F.col("s"))).first()[0] == shape


def brute_templates(paths):
    """paths: (host, segments) -> [n, good, bad]. The template of each."""
    template = {p: "" for p in paths}
    for level in range(max((len(s) for _, s in paths), default=0)):
        at = lambda s, i: s[i] if i < len(s) else ""
        shape = lambda x: x if x.startswith("{") or x == "" else "{literal}"
        nodes = defaultdict(lambda: defaultdict(lambda: [0, 0, 0, Counter()]))
        for (h, s), counts in paths.items():
            cell = nodes[h, template[h, s]][at(s, level)]
            for i in range(3):
                cell[i] += counts[i]
            cell[3][shape(at(s, level + 1))] += counts[0]
        for (h, s), old in list(template.items()):
            segment, node = at(s, level), nodes[h, old]
            if segment == "":
                continue
            n, good, bad, after = node[segment]
            rest = [c for k, c in node.items() if k != segment]
            alike = bool(rest) and not segment.startswith("{")
            if alike:
                rest_n, rest_good, rest_bad = (sum(c[i] for c in rest) for i in range(3))
                rest_after = sum((c[3] for c in rest), Counter())
                distance = sum(abs(after[k] / n - rest_after[k] / rest_n) for k in after | rest_after) / 2
                z = 0.0
                a, b = good + bad, rest_good + rest_bad
                if a and b:
                    share = (good + rest_good) / (a + b)
                    spread = (share * (1 - share) * (1 / a + 1 / b)) ** 0.5
                    z = abs(good / a - rest_good / b) / spread if spread else 0.0
                alike = z < 2.58 and distance <= 0.25
            template[h, s] = f"{old}/{'*' if alike else segment}"
    return template


def brute_verdicts(urls, shape_of):
    parsed = []
    for u in urls:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        parsed.append((host, path, *(max(fits)[1:] if fits else (None, None))))
    paths, way = defaultdict(lambda: [0, 0, 0]), {}
    for host, path, _, verdict in parsed:
        segments = [shape_of[s] for s in path.split("/") if s]
        way[host, path] = (host, tuple(segments if len(segments) <= 8 else [*segments[:7], "{rest}"]))
        for i, hit in enumerate((True, verdict == "allow", verdict == "block")):
            paths[way[host, path]][i] += hit
    template = brute_templates(paths)
    counts, hosts = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for p, (_, good, bad) in paths.items():
        for c in (counts[p[0], template[p]], hosts[p[0]]):
            c[0] += good
            c[1] += bad
    overall = (sum(h[0] for h in hosts.values()) + 1) / (sum(map(sum, hosts.values())) + 2)
    out = []
    for host, path, rule, verdict in parsed:
        t = template[way[host, path]]
        g, b = hosts[host]
        prior = (g + 2 * overall) / (g + b + 2)
        g, b = counts[host, t]
        purity = (g + 2 * prior) / (g + b + 2)
        out.append((host, path, rule, verdict or ("block" if purity < 0.5 else "allow"), t, round(purity, 9)))
    return out


def check(spark, pages):
    rows = pages.collect()
    segments = sorted({s for r in rows for s in re.sub(r"(?s)^.*?://[^/?#]*", "", r.url or "").split("?")[0].split("#")[0].split("/") if s} | {""})
    shapes = {r.s: r.shape for r in spark.createDataFrame([(s,) for s in segments], "s string").select("s", segment_shape(F.col("s")).alias("shape")).collect()}
    want = brute_verdicts([r.url for r in rows], defaultdict(str, shapes))
    got = judge_urls(pages).collect()
    mine = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict, r.template, round(r.purity, 9)) for r in got)
    assert mine == sorted((str(r.page_id), h, p, str(rule), v, t, purity) for r, (h, p, rule, v, t, purity) in zip(rows, want))


def test_query_against_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    check(spark, pages)
    got = QUERIES["op8_path_templates"](spark, sf_dir)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"] and got.count() == pages.count()


def test_deep_paths_and_edges(spark):
    urls = [*URLS, *URLS, *(f"http://h.com/{'fr' if i % 3 else 'de'}/{'/'.join('abcdefghijk'[: i % 11])}/{i}" for i in range(120)), *(f"http://s.net/{a}/x/{i}" for i in range(9) for a in "abc")]
    check(spark, spark.createDataFrame([(i if i % 5 else None, u) for i, u in enumerate(urls)], "page_id long, url string"))
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
