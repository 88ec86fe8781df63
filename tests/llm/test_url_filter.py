import re
from collections import defaultdict
from math import isclose, log, sqrt

from clickloom.llm.url_filter import RULES, judge_urls

URLS = [None, "", "no scheme/org/", "http://", "http://EXAMPLE.org", "http://a.org/", "https://x.example.org/es/a?b#c",
        "http://example.org/en/1", "http://example.org/en/2", "http://example.org/en/19/x", "http://org/x", "ftp://borg/x",
        "http://a.com/fr/1", "http://a.com/fr", "http://a.com/de/7", "http://a.com/de/8/9/10/11/12/13", "http://é.COM/de/İ",
        "http://a.com:80/de/7", "x://y://z/q", "http://h.net/a#/fr/", "http://a.com//fr/", "http://a.com/en/\n/fr?x/y"]
URLS += [f"http://big.com/{p}/{i}.html" for i in range(40) for p in ("fr", "de", "en")]
URLS += [f"http://wide.com/s{chr(97 + i)}/x" for i in range(20)] + [f"http://wide.com/de/{i}/x" for i in range(5)]
URLS += ["http://a.com/fr/1"] * 3
# Labels of both kinds on paths that part late, and on many branches of which one stands out.
URLS += [f"http://example.org/{'deep/' * 30}{p}/{i}" for p in ("x", "y") for i in range(4)]
URLS += [f"http://example.org/{'es' if i % 4 == 0 else 'it'}/{'abc'[i % 3]}/{'z/' * (i % 9)}" for i in range(60)]
URLS += [f"http://www.example.org/en/{i}/s{chr(97 + i % 26)}/t{chr(97 + i // 26)}" for i in range(200)]
URLS += [f"http://www.example.org/en/{i}/odd" for i in range(100, 140)]


def grown(rows, template, level, support, z):
    """rows: (shape, labelled, blocked, index); the template of every index."""
    n, k, kinds = sum(r[1] for r in rows), sum(r[2] for r in rows), {r[0][level:] for r in rows}
    if len(kinds) == 1:
        return {r[3]: template + "".join("/" + p for p in r[0][level:]) for r in rows}
    if n < support or k in (0, n):
        return {r[3]: template + ("/**" if len(r[0]) > level else "") for r in rows}
    while len({r[0][level : level + 1] for r in rows}) == 1:
        template += "/" + rows[0][0][level]
        level += 1
    out, branches = {}, defaultdict(list)
    for r in rows:
        if len(r[0]) == level:
            out[r[3]] = template
        else:
            branches[r[0][level]].append(r)
    nodes = defaultdict(list)
    for segment, own in branches.items():
        a, b = sum(r[1] for r in own), sum(r[2] for r in own)
        alike = abs(b - a * (k / n)) <= max(z, sqrt(2 * log(len(branches)))) * sqrt(a * (k / n) * (1 - k / n))
        nodes["*" if alike and len(branches) > 1 else segment] += own
    for branch, own in nodes.items():
        out |= grown(own, f"{template}/{branch}", level + 1, support, z)
    return out


def brute(urls, support=5, z=1.96, smooth=5.0, reject=0.5):
    rows = []
    for url in urls:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match("[^/?#]*", rest)[0]
            path = re.match("[^?#]*", rest[len(host) :])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        rule = None
        for r in RULES:
            at, prefix = r.split("/", 1)
            if (host == at or host.endswith("." + at)) and path.startswith("/" + prefix) and len(r) > len(rule or ""):
                rule = r
        rows.append([host, path, rule, tuple(re.sub("[0-9]+", "N", path[1:]).split("/")) if path else (), ""])
    label = [(r[2] is not None, RULES.get(r[2]) == "block") for r in rows]
    of_host = defaultdict(list)
    for i, (r, (a, b)) in enumerate(zip(rows, label, strict=True)):
        of_host[r[0]].append((r[3], a, b, i))
    for own in of_host.values():
        for i, template in grown(own, "", 0, support, z).items():
            rows[i][4] = template
    total, hosts, leaves = [0, 0], defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for r, (a, b) in zip(rows, label, strict=True):
        for c in (total, hosts[r[0]], leaves[r[0], r[4]]):
            c[0] += a
            c[1] += b
    out = []
    for i, r in enumerate(rows):
        of_host = (hosts[r[0]][1] + smooth * total[1] / max(total[0], 1)) / (hosts[r[0]][0] + smooth)
        bad = (leaves[r[0], r[4]][1] + smooth * of_host) / (leaves[r[0], r[4]][0] + smooth)
        out.append((i, r[0], r[1], r[2], RULES[r[2]] if r[2] else "block" if bad > reject else "allow", r[4], bad))
    return out


def pages(spark, rows):
    return spark.createDataFrame([(i, u, None, 1) for i, u in rows], "page_id long, url string, html string, host int")


def test_against_brute_force(spark):
    found = sorted(map(tuple, judge_urls(pages(spark, enumerate(URLS))).collect()))
    want = brute(URLS)
    assert [r[:6] for r in found] == [r[:6] for r in want]
    assert all(isclose(a[6], b[6], abs_tol=1e-9) for a, b in zip(found, want, strict=True))
    assert {r[4] for r in found} == {"allow", "block"}
    templates = {r[5] for r in found}
    assert "/deep" * 30 + "/x/N" not in templates  # of one kind: not opened
    assert any(t.startswith("/en/N/") and "*" in t for t in templates) and any(t.startswith("/es/") or t == "/es/**" for t in templates)


def test_a_branch_that_stands_out_among_many_is_kept(spark):
    urls = [f"http://www.example.org/p{chr(97 + i % 26)}{chr(97 + i // 26)}/{i}" for i in range(400)]
    urls += [f"http://www.example.org/es/{i}" for i in range(40)]
    found = judge_urls(pages(spark, enumerate(urls))).collect()
    assert {r.template for r in found} == {"/*/N", "/es/N"}


def test_null_id_and_empty_table(spark):
    assert judge_urls(pages(spark, [(None, None)])).first()["verdict"] == "allow"
    assert judge_urls(pages(spark, [])).count() == 0
