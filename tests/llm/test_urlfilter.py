"""URL rules and path templates against a plain version."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest

from motionloom.llm import urlfilter as u

from .cases import EXTRA

RULES = dict(u.RULES)


def fitted(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, after = rest[:cut].translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})), rest[cut:]
    path = after[:min([after.find(c) for c in "?#" if c in after], default=len(after))]
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len, default=None)


def shape(segment):
    import re
    plain = re.sub(r"[^-_.%+=,;:@0]+", "A", re.sub(r"[0-9]+", "0", segment))
    return "X" if len(plain) > u.LONGEST_SHAPE else plain


def by_force(pages):
    rows = []
    for page, url in pages:
        host, path, rule = fitted(url)
        rows.append({"page": page, "host": host, "path": path, "rule": rule, "said": RULES.get(rule), "s": path.removeprefix("/").split("/") if path else [], "t": []})
    for level in range(u.DEPTH):
        nodes = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
        for r in rows:
            if level < len(r["s"]):
                nodes[r["host"], tuple(r["t"])][shape(r["s"][level])][r["s"][level]] += 1
        for r in rows:
            segment = r["s"][level] if level < len(r["s"]) else None
            if segment is not None:
                held = nodes[r["host"], tuple(r["t"])][shape(segment)]
                segment = segment if len(held) < u.FEW or held[segment] >= u.SHARE * sum(held.values()) else f"<{shape(segment)}>"
            r["next"] = segment or ""
        for r in rows:
            r["t"] = [*r["t"], r["next"]]
    for r in rows:
        r["m"] = list(r["t"]) + ["**" if len(r["s"]) > u.DEPTH else ""]
    for level in reversed(range(u.DEPTH)):
        parents = defaultdict(list)
        for r in rows:
            parents[r["host"], tuple(r["m"][:level])].append(r)
        for group in parents.values():
            pool, branches = defaultdict(int), defaultdict(list)
            for r in group:
                pool[tuple(r["m"][level + 1:])] += 1
                branches[r["m"][level]].append(r)
            labelled = [r for r in group if r["said"]]
            e = (sum(r["said"] == "block" for r in labelled) + 1) / (len(labelled) + 2)
            alike = []
            for name, members in branches.items():
                seen = defaultdict(int)
                for r in members:
                    seen[tuple(r["m"][level + 1:])] += 1
                chi = sum(o * o * len(group) / (len(members) * pool[k]) for k, o in seen.items()) - len(members)
                mine = [r for r in members if r["said"]]
                agree = not mine or abs(sum(r["said"] == "block" for r in mine) / len(mine) - e) <= u.DEVIATIONS * math.sqrt(e * (1 - e) / len(mine))
                if name and agree and chi <= len(pool) - 1 + u.DEVIATIONS * math.sqrt(2 * (len(pool) - 1)) + 1e-6:
                    alike.append(name)
            if len(alike) > 1:
                for name in alike:
                    for r in branches[name]:
                        r["m"][level] = "*"
    evidence = defaultdict(lambda: [0, 0])
    for r in rows:
        if r["said"]:
            evidence[r["host"], tuple(r["m"])][0] += 1
            evidence[r["host"], tuple(r["m"])][1] += r["said"] == "block"
    out = []
    for r in rows:
        n, b = evidence[r["host"], tuple(r["m"])]
        gone = (b + u.PRIOR_WEIGHT / 2) / (n + u.PRIOR_WEIGHT) >= u.PUREST
        out.append((r["page"], r["host"], r["path"], r["rule"], r["said"] or ("block" if gone else "allow")))
    return sorted(out, key=str)


def frame(spark, pages):
    names = [c.split()[0] for c in EXTRA.split(", ")]
    return spark.createDataFrame([(i, url, *names) for i, url in pages], f"page_id long, url string, {EXTRA}")


def got(spark, pages):
    return sorted(map(tuple, u.judged_urls(frame(spark, pages).repartition(4)).select("page_id", "host", "path", "rule", "verdict").collect()), key=str)


AWKWARD = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://NET"), (6, "http://a.NET/"), (7, "https://x.example.net/en/1?u=://b/c"), (8, "https://xexample.net/en/"),
           (9, "https://example.com/de/"), (10, "https://example.com/de"), (11, "https://EXAMPLE.com/DE/"), (12, "https://a.b.org/fr/#x"), (13, "a://b://c/d"), (14, "http://org/fr/é/" + "z" * 5000),
           (15, "http://h/a//b///c"), (16, "http://h?x/y"), (None, "http://q.net#a"), (1, None), (17, "http://h/a\nb/c\td"), (18, "http://net.example/"), (19, "http://É.ORG/fr/")]


def test_awkward_urls(spark):
    assert got(spark, AWKWARD) == by_force(AWKWARD)
    assert got(spark, []) == []


def test_rules(spark):
    rules = {p: (h, path, r, v) for p, h, path, r, v in got(spark, [x for x in AWKWARD if x[0] not in (1, None)])}
    assert rules[5] == ("net", "", None, "allow") and rules[6] == ("a.net", "/", "net/", "block") and rules[7][2:] == ("example.net/en/", "allow")
    assert rules[8][2] == "net/" and rules[9][2] == "example.com/de/" and rules[10][2] is None and rules[11][2] is None and rules[13] == ("b:", "//c/d", None, "allow")


def grown():
    """A hot host whose sections look alike, one section of which is blocked; a host with sections of another make; one with few pages."""
    pages = [f"http://big.example.com/{s}/{k}{e}" for s in ("de", "en", "fr") for k in range(120) for e in ("", ".html")]
    pages += [f"http://two.example.com/de/{k}" for k in range(60)] + [f"http://two.example.com/en/topic-{k}/part/{k % 3}/x" for k in range(60)]
    pages += [f"http://two.example.com/shop/w{k}/item/view/{k}" for k in range(40)]
    pages += [f"http://few.example.com/de/{k}" for k in range(4)] + [f"http://few.example.com/en/{k}" for k in range(4)]
    pages += [f"http://n.example.net/{s}/{k}" for s in ("en", "de") for k in range(50)] + [f"http://o.example.org/{s}/{k}" for s in ("fr", "de") for k in range(50)]
    return list(enumerate(pages))


def test_templates_decide(spark):
    pages = grown()
    rows = got(spark, pages)
    assert rows == by_force(pages)
    verdicts = defaultdict(set)
    for _, host, path, rule, verdict in rows:
        if rule is None:
            verdicts[host, path.split("/")[1]].add(verdict)
    assert verdicts["big.example.com", "en"] == verdicts["big.example.com", "fr"] == {"block"}  # alike, and the labelled section is blocked
    assert verdicts["two.example.com", "en"] == verdicts["two.example.com", "shop"] == {"allow"}  # made otherwise
    assert verdicts["few.example.com", "en"] == {"allow"} and verdicts["o.example.org", "de"] == {"allow"}


def test_path_ends_are_one_template(spark):
    """A rejected template with and without a last slash, at every level: each page gives one row."""
    pages = list(enumerate(f"http://x.net{end}" for end in ("", "/", "/a", "/a/", "/a/b", "/a/b/", "//", "///") for _ in range(40)))
    rows = got(spark, pages)
    assert len(rows) == len(pages) and rows == by_force(pages)


@pytest.mark.parametrize("rows_per_task", ["4"])
def test_salted_lookups(tiny_tasks, rows_per_task):
    pages = [p for p in grown() if p[0] % 3 == 0] + AWKWARD
    assert got(tiny_tasks, pages) == by_force(pages)


def test_plan_is_native(spark):
    plan = u.judged_urls(frame(spark, AWKWARD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
