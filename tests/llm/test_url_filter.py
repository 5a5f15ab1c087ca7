import duckdb

from aisleframe.llm.sql import URL_FILTER
from aisleframe.llm.url_filter import RULES, judge_urls

ODD = [
    None, "", "no scheme", "http://", "http://Example.ORG", "http://EXAMPLE.org/ES/1", "http://example.org/es/1?x=/de/", "http://a.example.org/en/15",
    "http://myexample.org/es/1", "http://x.com/de", "http://x.com/de/", "http://x.com/fr/#a", "http://com/fr/1", "ftp://x.org?/es/", "a://b://c/d",
    "http://ÄB.com/de/é", "http://x.net/a/b/c/d/e/f/g/h", "http://x.net//", "http://x.net/a//b"]


def urls():
    rows = []
    for h in range(6):
        for i in range(60):
            rows.append(f"http://h{h}.{('com', 'net', 'org')[h % 3]}/{('fr', 'de', 'en')[i % 3]}/{i * 7}{('', '.html', '/')[i % 2]}")
    rows += [f"http://shop.com/de/item-{'abcdefghijklmnop'[i % 16]}{i}/x" for i in range(40)]
    rows += [f"http://shop.com/{'abcdefghijklmnop'[i]}{'zyxw'[i % 4]}/list" for i in range(16)] * 2
    rows += ["http://hot.net/en/1"] * 300
    return rows + ODD + ODD


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def test_rules_and_method(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string").repartition(4)
    found = {r["page_id"]: r for r in judge_urls(pages).collect()}
    assert len(found) == len(rows)
    for i, u, *_ in rows:
        host, path, rule, verdict = brute(u)
        r = found[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["purity"] >= 0.5 else "allow"))
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", [r[:2] for r in rows])
    own = {r[0]: r for r in con.execute(URL_FILTER).fetchall()}
    for i, r in found.items():
        assert tuple(r) == own[i]


def test_variable_segments_and_merging(spark):
    rows = [(i, f"http://a.com/de/{'abcdefghijklmnop'[i % 16]}{'qrstuv'[i % 6]}") for i in range(48)]
    found = judge_urls(spark.createDataFrame(rows + [(99, "http://a.com/xx/new")], "page_id long, url string")).collect()
    assert {r["template"] for r in found if r["page_id"] < 99} == {"de/*"}


def templates(spark, urls):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    return {u: r for u, r in zip(urls, sorted(judge_urls(pages).collect(), key=lambda r: r["page_id"]), strict=True)}


def test_repeated_urls_change_nothing(spark):
    once = [u for u in dict.fromkeys(urls()) if u is not None]
    first = templates(spark, once)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(once * 4)], "page_id long, url string")
    for r in judge_urls(pages).collect():
        assert tuple(r)[1:] == tuple(first[once[r["page_id"] % len(once)]])[1:]


def test_levels_below_a_wildcard(spark):
    """Many names with many titles each: both are variable, also where each name has more paths than names are needed."""
    named = [f"http://b.net/u/{chr(97 + i % 26)}{chr(97 + i // 26)}x/{chr(97 + k)}{chr(98 + i % 7)}y" for i in range(60) for k in range(12)]
    found = templates(spark, [*named, "http://b.net/about/us/now"])
    assert {found[u]["template"] for u in named} == {"u/*/*"}


def test_inner_branches_are_merged_by_their_share(spark):
    rules = (("c.net", "/good", "allow"), ("c.net", "/bad", "block"))
    paths = [f"http://c.net/{kind}{x}/list/{i}" for kind, names in (("good", "abc"), ("bad", "de")) for x in names for i in ("k", "l", "m", "n")]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*paths, "http://c.net/other/list/k"])], "page_id long, url string")
    found = {r["path"]: r for r in judge_urls(pages, rules=rules).collect()}
    assert all(found[u[12:]]["verdict"] == ("block" if "/bad" in u else "allow") for u in paths)
    assert len({found[u[12:]]["template"] for u in paths if "/bad" in u} & {found[u[12:]]["template"] for u in paths if "/good" in u}) == 0
    alike = (("e.net", "/", "allow"),)
    pages = spark.createDataFrame([(i, f"http://e.net/{x}/{y}/z") for i, (x, y) in enumerate(zip("abcabc", "kkkmmm", strict=True))], "page_id long, url string")
    assert {r["template"] for r in judge_urls(pages, rules=alike).collect()} == {"*/*/*"}


def test_deep_and_very_long_paths(spark):
    deep = ["http://d.net/" + "/".join("abcdefghijk") + f"/{x}" for x in ("p", "q")] + ["http://d.net/" + "x/" * 50_000 + "y" * 100_000]
    rules = (("d.net", "/a/b/c/d/e/f/g/h/i/j/k/p", "block"), ("d.net", "/a/b/c/d/e/f/g/h/i/j/k/q", "allow"))
    rows = [u + f"/{k}" for u in deep for k in range(30)]
    found = sorted(judge_urls(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), rules=rules).collect())
    assert [r["verdict"] for r in found[:60]] == ["block"] * 30 + ["allow"] * 30 and len(found) == 90
    assert found[0]["template"] != found[30]["template"] and found[0]["purity"] > found[30]["purity"]


def test_extra_columns_with_names_in_use(spark):
    rows = [(i, u, "t", 1, 2, "v") for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id long, url string, token string, a int, n int, verdict string")
    assert sorted(map(str, judge_urls(pages).collect())) == sorted(map(str, judge_urls(pages.select("page_id", "url")).collect()))


def test_empty_and_unruled(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
    found = judge_urls(spark.createDataFrame([(1, "http://a.net/b")], "page_id long, url string"), rules=()).collect()
    assert [tuple(r)[:5] for r in found] == [(1, "a.net", "/b", None, "allow")]
