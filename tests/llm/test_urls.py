import random

from ledgerlake.llm import urls
from ledgerlake.llm.queries import URL_RULES


def judge(host, path, rules):
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, None)


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:k], rest[k:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path[:end]


URLS = [
    None, "", "no scheme", "http://", "http://COM/", "https://a.com", "https://a.com/x", "http://www.example.com/en/1", "http://example.com/en/",
    "http://xexample.com/en/", "http://b.net/es/?q=/x", "http://b.net/fr", "http://b.net/fr/#a", "x://y://z.net/es/", "http://É.com/é", "http://a.com?x=/en/",
]


def test_rules(spark):
    random.seed(1)
    rules = [*URL_RULES, ("block", "a.com", "/x"), ("allow", "t.u.v", "/p/"), ("block", "u.v", "/p/q")]
    more = ["http://" + ".".join(random.choices(["a", "com", "net", "t", "u", "v", "example"], k=random.randint(1, 4))) + random.choice(["", "/", "/p/q", "/en/x", "/es/"]) for _ in range(300)]
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate([*URLS, *more])] + [(None, "http://a.com/", "clash"), (3, "http://a.com/", "x")], "page_id long, url string, host string")
    given = {k: u for k, u in enumerate([*URLS, *more])}
    rows = urls.filter_urls(pages, rules).collect()
    assert len(rows) == len(given) + 2
    for r in rows:
        if r.page_id is not None and r.page_id != 3:
            host, path = cut(given[r.page_id])
            rule, verdict = judge(host, path, rules)
            assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), given[r.page_id]
    assert urls.filter_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages, [], default="block").collect()} == {"block"}


def test_collisions_do_not_decide(tmp_path, monkeypatch):
    monkeypatch.setattr(urls, "_digest", lambda entry: len(entry) % 3)
    (tmp_path / "rules").write_bytes(urls.pack_rules(URL_RULES))
    array = urls.DigestArray(str(tmp_path / "rules"))
    for url in URLS:
        host, path = cut(url)
        assert array.judge([host], [path]) == [judge(host, path, URL_RULES)]
