import re

from cartwheel.llm import urls as U

SF = "/root/testdata/sf0.01"
TLD = str.maketrans(U.UPPER, U.LOWER)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(TLD), re.match(r"[^?#]*", rest[len(host):]).group()


def rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def test_pages_against_plain_code(spark):
    rows = U.url_report(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path) == split(urls[r.page_id])
        name, verdict = rule(r.host, r.path)
        assert r.rule == name and (name is None or r.verdict == verdict)
        if name is None:
            topic = re.search(r"adult|bets|casino|pills|spam|ads-track", r.host)
            assert r.verdict == ("block" if topic else "allow"), (r.host, r.block_score)


def test_edge_urls(spark):
    odd = [None, "", "no scheme", "://", "http://", "HTTP://A.ORG", "http://A.ORG/", "x://org/de/?a://b", "http://example.org/en/12",
           "http://sub.example.org/es/", "http://notexample.org/es/", "http://com/de/#x", "a://b.com/fr/de/", "http://é.com\n/de/",
           "http://x.com/de/\nz?q", "http://a?b/c", "http://a#b/c", "http://x.org?/"]
    pages = spark.createDataFrame([(i % 7, u, "h", 1) for i, u in enumerate(odd)], "page_id int, url string, host string, rule int")
    out = U.filter_urls(pages.withColumnRenamed("page_id", "k"), U.fit(U.labelled_urls(spark)))
    assert out.columns == ["k", "url", "host", "path", "rule", "verdict", "block_score"]
    rows = out.collect()
    assert len(rows) == len(odd)
    for r in rows:
        assert (r.host, r.path) == split(r.url)
        assert r.rule == rule(r.host, r.path)[0] and r.verdict in ("allow", "block")
    assert U.url_report(pages.limit(0)).count() == 0
    assert U.filter_urls(pages, U.fit(U.labelled_urls(spark)), rules=[]).where("rule is not null").count() == 0


def test_labels_are_independent_of_the_pages(spark):
    hosts = {h for r in spark.read.parquet(f"{SF}/pages.parquet").select("url").collect() for h in split(r.url)[0].split(".")}
    names = {n for i, w in enumerate(U.BLOCKED + U.WELCOME) for n in U.host_names(w, i)}
    assert hosts and hosts.isdisjoint(names)


def test_held_out_hosts(spark):
    """Each host name judged by a model that never saw it, only other names of its word: four folds."""
    rows = U.labelled_urls(spark).collect()
    right = {0.0: [], 1.0: []}
    for fold in range(4):
        away = rows[fold::4]
        train = spark.createDataFrame([r for i, r in enumerate(rows) if i % 4 != fold])
        for r in U.filter_urls(spark.createDataFrame(away), U.fit(train), rules=[]).collect():
            right[r.label].append((r.verdict == "block") == (r.label == 1))
    share = {k: sum(v) / len(v) for k, v in right.items()}
    # Measured: every welcome host, 0.84 of the blocked ones (0.96 of all); short words leave few n-grams.
    assert share[0.0] >= 0.97 and share[1.0] > 0.8, share
    assert sum(right[0.0] + right[1.0]) / len(right[0.0] + right[1.0]) > 0.9


def test_held_out_words(spark):
    """Words the model never saw: welcome ones stay welcome, and a blocked one is mostly let through, as it has nothing to go by."""
    rows = U.labelled_urls(spark).collect()
    names = len(U.COMPANIONS) + 1
    away = [r for i, r in enumerate(rows) if i // names % 4 == 0]
    train = spark.createDataFrame([r for i, r in enumerate(rows) if i // names % 4])
    out = U.filter_urls(spark.createDataFrame(away), U.fit(train), rules=[]).collect()
    welcome = [r.verdict == "allow" for r in out if r.label == 0]
    assert sum(welcome) / len(welcome) >= 0.9
