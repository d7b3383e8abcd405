"""The path-template tree against a plain version, and its answers on labelled hosts."""

import math
import random
import re
from collections import defaultdict

import pytest

from corpusflow.llm import url_filter as uf


def _judge(spark, urls, labels):
    pages = spark.createDataFrame([*enumerate(urls)], "page_id long, url string").repartition(3)
    return uf.judge(pages, labels=spark.createDataFrame(labels, "url string, bad boolean")).collect()


def _sums(rows, keep):
    out = defaultdict(lambda: [0, 0, 0])
    for r in rows:
        for k in range(3):
            out[keep(r)][k] += r["c"][k]
    return out


def _branches(members):
    """Members ``(share, name, bad, labelled)`` -> lists of members."""
    def z(b1, n1, b2, n2):
        p = (b1 + b2) / (n1 + n2)
        e = math.sqrt(p * (1 - p) * (1 / n1 + 1 / n2))
        return abs(b1 / n1 - b2 / n2) > 1.96 * e
    out = []
    for m in sorted(members):
        b, n = (sum(x[k] for x in out[-1]) for k in (2, 3)) if out else (0, 0)
        if out and not z(b, n, m[2], m[3]) and not z(out[-1][0][2], out[-1][0][3], m[2], m[3]):
            out[-1].append(m)
        else:
            out.append([m])
    return out


def _brute(urls, labels):
    """Verdict by url, for hosts without rules."""
    rows = defaultdict(lambda: [0, 0, 0])
    for u in urls:
        rows[u][0] += 1
    for u, bad in labels:
        rows[u][1] += bad
        rows[u][2] += 1
    hosts = defaultdict(list)
    for u, c in rows.items():
        host, _, path = u.split("://")[1].partition("/")
        seg = [re.sub("[0-9]+", "{n}", s) for s in path.split("/")]
        seg = seg if len(seg) <= uf.DEPTH else seg[:uf.DEPTH - 1] + ["/".join(seg[uf.DEPTH - 1:])]
        hosts[host].append({"u": u, "c": c, "seg": seg, "t": (), "vote": None})
    verdict = {}
    for rows in hosts.values():
        for level in range(uf.DEPTH):
            live = [r for r in rows if len(r["seg"]) > level]
            child = _sums(live, lambda r: (r["t"], r["seg"][level]))
            whole = _sums(live, lambda r: r["t"])
            star, votes = {}, defaultdict(list)
            for (t, s), (n, b, m) in child.items():
                if n >= uf.COMMON and n * 4 * uf.BRANCHES >= whole[t][0]:
                    star[t, s] = s
                elif m:
                    votes[t].append(b / m)
                    star[t, s] = "*{allow}" if b / m < 0.05 else "*{block}" if b / m > 0.95 else f"*{{{math.floor(b / m * 10 + 0.5) / 10}}}"
                else:
                    star[t, s] = "*"
            for r in live:
                s = star[r["t"], r["seg"][level]]
                if s == "*" and votes[r["t"]]:
                    r["vote"] = votes[r["t"]]
                r["t"] += (s,)
        leaf = _sums(rows, lambda r: r["t"])
        branch = {t: t for t in leaf}
        for level in range(uf.DEPTH - 1, -1, -1):
            sums = defaultdict(lambda: [0, 0])
            for t, (_, b, m) in leaf.items():
                if m and len(branch[t]) > level:
                    sums[branch[t]][0] += b
                    sums[branch[t]][1] += m
            groups = defaultdict(list)
            for t, (b, m) in sums.items():
                groups[t[:level], t[level + 1:]].append((b / m, t[level], b, m))
            new = {}
            for (before, after), members in groups.items():
                for part in _branches(members):
                    for x in part:
                        new[before + (x[1],) + after] = before + (tuple(y[1] for y in part),) + after
            branch = {t: new.get(x, x) for t, x in branch.items()}
        all_b, all_n = sum(c[1] for c in leaf.values()), sum(c[2] for c in leaf.values())
        for r in rows:
            same = [t for t in leaf if branch[t] == branch[r["t"]]]
            b, n = sum(leaf[t][1] for t in same), sum(leaf[t][2] for t in same)
            purity = 0.0
            if n:
                purity = (b + uf.PRIOR * (all_b - b + uf.PRIOR * uf.BASE) / (all_n - n + uf.PRIOR)) / (n + uf.PRIOR)
            elif r["vote"]:
                m, p, z = len(r["vote"]), sum(r["vote"]) / len(r["vote"]), uf.SURE
                purity = (p + z * z / (2 * m) - z * math.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
            verdict[r["u"]] = "block" if purity > uf.LEAST else "allow"
    return verdict


@pytest.mark.parametrize("seed", range(3))
def test_tree_matches_plain_version(spark, seed):
    rng = random.Random(seed)
    urls, labels = [], []
    for h in range(4):
        rates = {s: rng.choice((0.0, 0.1, 0.5, 0.9, 1.0)) for s in ("blog", "shop", "news", "wiki", "x" * 40)}
        for _ in range(120):
            s = rng.choice(list(rates))
            tail = [rng.choice(("a", "b", "c", f"v{rng.randrange(9)}", rng.choice("pqrstuvw") * rng.randint(1, 4))) for _ in range(rng.choice((0, 1, 1, 2, 9)))]
            u = f"http://h{h}.org/" + "/".join([s, *tail] if rng.random() < 0.8 else tail)
            urls += [u] * rng.choice((1, 1, 3))
            if rng.random() < 0.4:
                labels.append((u, rng.random() < rates[s]))
    want = _brute(urls, labels)
    assert {"allow", "block"} == set(want.values())
    for r in _judge(spark, urls, labels):
        assert r.verdict == want[urls[r.page_id]], (urls[r.page_id], r)


@pytest.mark.parametrize("sections", [2, 31, 32, 33, 34, 200])
def test_one_more_section_changes_nothing(spark, sections):
    names = [chr(97 + i % 26) + chr(97 + i // 26) for i in range(max(sections, 4))]
    urls = [f"http://h.org/{s}/page" for s in names]
    got = _judge(spark, urls, [(u, True) for u in urls[:4]])
    assert {urls[r.page_id] for r in got if r.verdict == "block"} == set(urls[:4])


def test_merges_do_not_chain(spark):
    urls = [f"http://h.org/s{chr(97 + k)}/p" for k in range(10) for _ in range(20)]
    labels = [(f"http://h.org/s{chr(97 + k)}/p", i < 10 * k) for k in range(10) for i in range(100)]
    got = {urls[r.page_id][14]: r.verdict for r in _judge(spark, urls, labels)}
    assert [got[chr(97 + k)] for k in range(10)] == ["allow"] * 5 + [got["f"]] + ["block"] * 4


def test_inner_branches_merge(spark):
    urls = [f"http://h.org/{a}/{x}" for a in ("a", "b") for x in ("x", "y") for _ in range(20)]
    got = _judge(spark, urls, [(f"http://h.org/{a}/{x}", x == "x") for a in ("a", "b") for x in ("x", "y") for _ in range(10)])
    assert {(r.template, r.branch) for r in got} == {("/a/x", "/{a+1}/x"), ("/b/x", "/{a+1}/x"), ("/a/y", "/{a+1}/y"), ("/b/y", "/{a+1}/y")}


def test_two_labels_do_not_block_a_host(spark):
    urls = [f"http://h.org/p/{i}" for i in range(1000)]
    assert {r.verdict for r in _judge(spark, urls, [(u, True) for u in urls[:2]])} == {"allow"}


def test_recall_and_precision(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    urls = [(f"http://h{h}.org/{'promo' if bad else 'docs'}/{word()}/{rng.randrange(99)}", bad) for h in range(5) for bad in (True, False) for _ in range(100)]
    labels = [(u, bad if rng.random() > 0.03 else not bad) for u, bad in urls if rng.random() < 0.3]
    got = {r.page_id: r.verdict == "block" for r in _judge(spark, [u for u, _ in urls], labels)}
    known = {u for u, _ in labels}
    rest = [(got[i], bad) for i, (u, bad) in enumerate(urls) if u not in known]
    hits = sum(g and b for g, b in rest)
    assert hits >= 0.9 * sum(b for _, b in rest) and hits >= 0.9 * sum(g for g, _ in rest)


def test_deep_and_long_paths(spark):
    deep = "http://d.org/" + "a/" * 400
    urls = [deep + "good", deep + "bad", "http://d.org/" + "é" * 200_000, "http://d.org/*/*"] * 8
    got = _judge(spark, urls, [(deep + "bad", True)] * 6 + [(deep + "good", False)] * 6)
    assert {urls[r.page_id][-3:] for r in got if r.verdict == "block"} == {"bad"}
