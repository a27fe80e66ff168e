"""URL filter against plain Python, against its SQL, and its defined cases."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from mercato.llm import url_filter as U

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/de/1", "https://example.com/den", "https://example.com/de", "http://a.net",
    "http://a.net/", "http://net/x?y", "http://a.example.net/en/5#t", "http://notexample.net/en/5", "http://example.net/EN/5",
    "http://x.org/fr/1", "http://xorg/fr/1", "http://h.com/a://b/c", "http://h.com:80//a//b/", "http://h.com#f/a", "http://h.com/*/**/#x",
    "http://ÄÖ.com/ä/" + "ü" * 30, "http://h.com/" + "/".join("abcdefghijk"), "http://h.com/" + "/".join(f"s{i}" for i in range(300)),
    "http://" + "h" * 3000 + ".com/" + "p" * 5000,
]


def build(spark, urls):
    return spark.createDataFrame([(i, u, "clash", "x") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string").repartition(3)


def plain(urls, labels=None):
    """Host, path, rule, verdict, template of each url."""
    rows = []
    for at, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        rule = max(((len(h + p), len(h), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)),
                   default=None)
        named = [s for s in path.split("/") if s]
        toks = ["*" + (re.search(r"\.[A-Za-z]{2,5}\Z", s) or [""])[0] if re.search("[0-9]", s) or len(s) > 24 else s for s in named[:8]]
        toks += ["**"] * (len(named) > 8)
        if labels is not None:
            label = labels[at]
        elif rule:
            label = int(rule[3] == "block")
        else:
            label = int(any(w in U.WORDS for w in re.split("[^a-z0-9]+", (host + path).lower())))
        rows.append((host, path, rule, tuple(toks), label))
    cells, kids = defaultdict(Counter), defaultdict(set)
    for host, _, _, toks, label in rows:
        for k in range(1, len(toks) + 1):
            shape = "end" if k == len(toks) else "wild" if toks[k].startswith("*") else "name"
            cells[host, toks[:k]][label, shape] += 1
            kids[host, toks[: k - 1]].add(toks[:k])

    def kind(c):
        n = Counter(label for (label, _), m in c.items() for _ in range(m))
        return "bad" if n[1] > n[0] else "good"

    branch = {}
    for (host, parent), children in kids.items():
        for child in children:
            mine = cells[host, child]
            pool = sum((cells[host, x] for x in children if kind(cells[host, x]) == kind(mine)), Counter())
            n, total = sum(mine.values()), sum(pool.values())
            df = len(pool) - 1
            if n == total or sum((mine[c] - pool[c] * n / total) ** 2 / (pool[c] * n / total) for c in pool) / (1 - n / total) <= (
                    df + 3 * (2 * df) ** 0.5):
                branch[host, child] = "#" + kind(mine)
    merged = ["/".join([h, *(branch.get((h, t[: k + 1]), t[k]) for k in range(len(t)))]) for h, _, _, t, _ in rows]
    bad, seen = Counter(), Counter()
    for m, r in zip(merged, rows):
        bad[m] += r[4] == 1
        seen[m] += r[4] is not None
    return [(h, p, r and r[2], r[3] if r else "block" if (bad[m] + U.PRIOR) / (seen[m] + 1) > 0.5 else "allow", m)
            for (h, p, r, _, _), m in zip(rows, merged)]


def mixed():
    out = list(URLS)
    for i in range(60):
        out += [f"http://big.com/en/{i}", f"http://big.com/de-x/{i}.html", f"http://big.com/casino/{i}", f"http://shop.com/name{'abcdefgh'[i % 8]}/item",
                f"http://big.com/tag/{'abcdefghij'[i % 10] * 3}", f"http://sub{i % 5}.casino-win.com/fr/{i}"]
    return out + ["http://big.com/en/poker", "http://shop.com/adult/item"] + out[40:60] * 2


def test_against_plain_python(spark):
    urls = mixed()
    got = {r["page_id"]: r for r in U.judge(build(spark, urls)).collect()}
    want = plain(urls)
    assert len(got) == len(urls)
    for i, w in enumerate(want):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"], got[i]["template"]) == w, urls[i]
    by = dict(zip(urls, want))
    assert by["http://big.com/casino/7"][3] == "block" and by["http://big.com/en/7"][3] == "allow"
    assert by["http://sub1.casino-win.com/fr/1"][3] == "block"


@pytest.mark.parametrize("urls", [mixed(), URLS[:1], []])
def test_against_sql(spark, urls):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    if urls:
        con.executemany("INSERT INTO pages VALUES (?, ?)", [(i, u) for i, u in enumerate(urls)])
    rows = U.judge(build(spark, urls))
    want = con.execute(U.oracle()).fetchall()
    assert rows.columns == ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    assert sorted(repr(tuple(r)[:6]) for r in rows.collect()) == sorted(repr(r[:6]) for r in want)


def test_own_labels_repeated_and_null_ids(spark):
    rows = [(None, "http://a.com/x/1", 1, "c"), (7, "http://a.com/x/2", None, "c"), (7, "http://a.com/x/2", 1, "c"), (8, "http://a.com/y/2", 0, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, label int, rule string")
    got = [tuple(r)[:6] for r in U.judge(pages, rules=(), label="label").collect()]
    want = plain([r[1] for r in rows], [r[2] for r in rows])
    assert sorted(map(repr, got)) == sorted(repr((r[0], *w)) for r, w in zip(rows, want))


def test_main_path_has_no_python(spark):
    text = U.judge(build(spark, URLS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
