import re

from corpusloom.llm import url_filter
from corpusloom.llm.queries import LISTED_WORDS, URL_RULES, op10_url_verdicts


def plain(url, listed_hosts):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if fits:
        best = max(fits, key=lambda r: (len(r[0]), len(r[1])))
        return host, path, best[0] + best[1], best[2]
    labels = host.split(".")
    parents = {".".join(labels[i:]) for i in range(len(labels))}
    return host, path, None, "block" if parents & listed_hosts else "allow"


def test_query(spark, small_dir):
    pages = [(r["page_id"], r["url"]) for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect()]
    hosts = {plain(u, set())[0] for _, u in pages}
    listed = {h for h in hosts if re.search(LISTED_WORDS, h)}
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in op10_url_verdicts(spark, small_dir).collect()}
    assert found == {key: plain(url, listed) for key, url in pages}


def judged(spark, urls, entries, **options):
    table = spark.createDataFrame(urls, "page_id long, url string, host int, verdict int")
    made = spark.createDataFrame(entries, "host string, path string, verdict string, listed boolean")
    return sorted((tuple(r) for r in url_filter.judge(table, made, **options).collect()), key=str)


def test_nulls_repeats_ties_and_clashing_names(spark):
    entries = [("a.com", "/", "block", False), ("a.com", "/", "allow", False), ("b.com", "", "block", True), (None, "/", "block", False)]
    urls = ["http://x.A.com/p?q", "http://x.A.com/p?q", None, "", "no scheme", "://b.com", "http://ab.com/"]
    found = judged(spark, [(i, u, 1, 1) for i, u in enumerate(urls)] + [(None, "http://a.com#x", 1, 1)], entries)
    assert found == sorted(
        [
            (0, "x.a.com", "/p", "a.com/", "allow", None),
            (1, "x.a.com", "/p", "a.com/", "allow", None),
            (2, "", "", None, "allow", None),
            (3, "", "", None, "allow", None),
            (4, "", "", None, "allow", None),
            (5, "b.com", "", None, "block", "b.com"),
            (6, "ab.com", "/", None, "allow", None),
            (None, "a.com", "", None, "allow", None),
        ],
        key=str,
    )
    assert judged(spark, [], entries) == []
    assert judged(spark, [(1, "http://a.com/", 1, 1)], []) == [(1, "a.com", "/", None, "allow", None)]


def test_colliding_digests_are_told_apart(spark, monkeypatch, tmp_path):
    entries = spark.createDataFrame(
        [(f"h{i}.com", "", "block" if i % 2 else "allow", True) for i in range(50)],
        "host string, path string, verdict string, listed boolean",
    )
    files = url_filter.build_index(entries, f"file://{tmp_path}/index", file_entries=8)
    assert len(files) > 1
    mapped = [url_filter._Mapped(f["file"]) for f in files]
    assert sum(len(m.keys) for m in mapped) == 50
    for m in mapped:
        assert (m.keys[1:] >= m.keys[:-1]).all()
        assert m.find(m.keys.copy(), [b"other"] * len(m.keys)) == [-1] * len(m.keys)


def test_query_equals_sql(spark, small_dir):
    from oracle import differences

    from corpusloom.llm.oracles import ORACLES
    from corpusloom.llm.queries import op10_url_verdicts

    assert differences(op10_url_verdicts(spark, small_dir), ORACLES["op10_url_verdicts"], small_dir) == []


def test_listed_hosts_are_lowered_like_the_hosts_of_urls(spark, tmp_path):
    urls = ["http://ADS.\u00c4b.com/x", "http://ads.\u00e4b.com/", "http:///y://spam.com/", None]
    rows = [(i, url, "") for i, url in enumerate(urls)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r["page_id"]: r for r in op10_url_verdicts(spark, str(tmp_path)).collect()}
    assert [found[i]["host"] for i in range(4)] == ["ads.\u00c4b.com", "ads.\u00e4b.com", "", ""]
    assert [found[i]["verdict"] for i in range(4)] == ["block", "block", "allow", "allow"]
