import math

from corpusflow.llm import url_filter
from tests.llm.cases import CLASHING

PAGES = "page_id long, url string"


def judged(spark, pages, labelled=(), **settings):
    frame = spark.createDataFrame(pages, PAGES).selectExpr("*", *[f"1 as `{c}`" for c in CLASHING])
    return {r["page_id"]: r for r in url_filter.judge(frame, spark.createDataFrame(list(labelled), "url string, bad int"), **settings).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [
        "http://A.Example.NET/en/1?x=/de/", "https://example.net/fr/", "http://x.example.com/de/9#a", "http://myexample.com/de/1", "http://b.org/fr/x",
        "http://b.org/FR/x", "no scheme", None, "", "ftp://net", "http://h.net/en/", "a://b://c/d", "http://É.COM/\nx?y", "http:///de/", "x://example.com/de",
    ]
    rows = judged(spark, list(enumerate(urls)))
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for _, r in sorted(rows.items())]
    assert got == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/fr/", "net/", "block"), ("x.example.com", "/de/9", "example.com/de/", "block"),
        ("myexample.com", "/de/1", None, "allow"), ("b.org", "/fr/x", "org/fr/", "allow"), ("b.org", "/FR/x", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("net", "", None, "allow"), ("h.net", "/en/", "net/", "block"), ("b:", "//c/d", None, "allow"),
        ("É.com", "/\nx", None, "allow"), ("", "/de/", None, "allow"), ("example.com", "/de", None, "allow"),
    ]


def tree(urls, labels, prior_labels=8.0, z=2.58):
    """The template of each (host, segments), level by level, in plain Python."""
    mean = sum(labels.values()) / len(labels)
    at = {u: "" for u in urls}
    for level in range(max(len(u[1]) for u in urls)):
        step = {}
        for key in {(u[0], t) for u, t in at.items()}:
            kids = {}
            for u, t in at.items():
                if (u[0], t) == key and level < len(u[1]):
                    n, bad = kids.get(u[1][level], (0, 0))
                    kids[u[1][level]] = (n + len(urls[u]), bad + sum(urls[u]))
            pn, pb = sum(n for n, _ in kids.values()), sum(b for _, b in kids.values())
            for k, (n, b) in kids.items():
                own = False
                if n and pn > n and 0 < pb < pn:
                    s = pb / pn
                    own = abs(b / n - (pb - b) / (pn - n)) > z * math.sqrt(s * (1 - s) * (1 / n + 1 / (pn - n)))
                step[key[0], key[1], k] = k if own else "*"
        at = {u: t + ("/" + step[u[0], t, u[1][level]] if level < len(u[1]) else "") for u, t in at.items()}
    sums = {}
    for u, t in at.items():
        n, b = sums.get((u[0], t), (0, 0))
        sums[u[0], t] = (n + len(urls[u]), b + sum(urls[u]))
    return {u: (t, 1 - (sums[u[0], t][1] + mean * prior_labels) / (sums[u[0], t][0] + prior_labels)) for u, t in at.items()}


def test_templates_against_plain_python(spark):
    urls, pages, labelled, labels = {}, [], [], {}
    i = 0
    for host in ("a.com", "b.com"):
        for section, bad_share in (("news", 0.02), ("spam", 0.95), ("blog", 0.1), ("wiki", 0.0)):
            for k in range(40):
                url = f"http://{host}/{section}/{['en', 'de'][k % 2]}/{1000 + k}"
                pages.append((i, url))
                key = (host, (section, ["en", "de"][k % 2], "{number}"))
                urls.setdefault(key, [])
                if k % 4:
                    bad = int((k * 37 % 100) / 100 < bad_share)
                    labelled.append((url, bad))
                    labels[i] = bad
                    urls[key].append(bad)
                i += 1
    rows, want = judged(spark, pages, labelled), tree(urls, labels)
    for n, url in pages:
        host, path = url.split("//")[1].split("/", 1)
        template, purity = want[host, (*path.split("/")[:2], "{number}")]
        assert rows[n]["template"] == template and abs(rows[n]["purity"] - purity) < 1e-9
    assert {r["verdict"] for n, r in rows.items() if "/spam/" in pages[n][1]} == {"block"}
    assert {r["verdict"] for n, r in rows.items() if "/spam/" not in pages[n][1]} == {"allow"}


def test_deep_paths_repeated_rows_and_no_rows(spark):
    deep = "http://a.com/" + "/".join(f"s{i}" for i in range(3000))
    rows = url_filter.judge(spark.createDataFrame([(1, deep), (1, deep), (2, deep + "x")], PAGES), spark.createDataFrame([(deep, None)], "url string, bad int"))
    assert sorted((r["page_id"], r["verdict"]) for r in rows.collect()) == [(1, "allow"), (1, "allow"), (2, "allow")]
    assert judged(spark, []) == {}
