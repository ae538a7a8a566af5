import duckdb
import pytest

from rosterloom.llm import urls

PAGES = "page_id long, url string, host string, rate string, n long"


def pages(spark, given):
    return spark.createDataFrame([(i, u, "x", "y", 1) for i, u in given], PAGES)


def judged(spark, given, bad=(), good=(), **options):
    outcomes = spark.createDataFrame([(i, True) for i in bad] + [(i, False) for i in good],
                                     "id long, bad boolean")
    return urls.judged(pages(spark, given), outcomes, ["page_id", "rate", "host"], **options)


def split(url):
    """Host and path, by hand."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, rest = (rest[:min(ends)], rest[min(ends):]) if ends else (rest, "")
    ends = [rest.find(c) for c in "?#" if c in rest]
    path = rest[:min(ends)] if ends else rest
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


URLS = [None, "", "no scheme", "http://", "://a.net/es/", "HTTP://WWW.Example.COM/en/1?x#y",
        "http://example.com/en/", "http://example.com/en", "https://a.example.com/en/x",
        "http://a.www.example.com/en/x", "http://com/", "http://com", "http://x.com?q=/en/",
        "http://x.com#://y.net/es/", "http://telecom/", "http://a.net/es/1", "http://a.net/fr/",
        "http://a.net/es", "http://net/fr/", "http://é.org/ü?x", "http://ÀB.org/",
        "http://x\ny.net/fr/a\nb", "http://user@a.net:80/es/", "http://[::1]/", "http://1.2.3.4/",
        "http://" + "a." * 5000 + "net/es/" + "b/" * 5000, "x://y://z", "http:///en/"]


def test_hosts_paths_and_rules_equal_plain_reading(spark):
    rows = {r["page_id"]: r for r in judged(spark, enumerate(URLS)).collect()}
    assert len(rows) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = split(url)
        fit = [(len(h + p), h + p, a) for a, h, p in urls.RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, text, action = max(fit, default=(0, None, "allow"))
        assert tuple(rows[i][c] for c in ("host", "path", "rule", "verdict")) == (
            host, path, text, action), url


def test_hosts_with_bad_pages_are_blocked_and_lend_doubt_to_their_domain(spark):
    given = [(1000 * d + 100 * h + i, f"http://h{h}.d{d}.org/{i}")
             for d in range(8) for h in range(4) for i in range(20)]
    bad = [i for i, _ in given if i // 1000 == 3 and i // 100 % 10 != 0]
    good = [i for i, _ in given if i // 1000 != 3]
    got = judged(spark, given, bad, good).collect()
    blocked = {r["host"] for r in got if r["verdict"] == "block"}
    # The unlabelled host of the bad domain is judged by its domain.
    assert blocked == {f"h{h}.d3.org" for h in range(4)}
    assert {r["host_labelled"] for r in got if r["host"] == "h0.d3.org"} == {0}


def test_few_outcomes_don_t_block(spark):
    given = [(i, f"http://h{i % 40}.org/{i}") for i in range(400)]
    got = judged(spark, given, [7], [i for i in range(400) if i != 7 and i % 40 != 7]).collect()
    assert {r["verdict"] for r in got} == {"allow"}
    assert {(r["host_labelled"], r["host_bad"]) for r in got if r["host"] == "h7.org"} == {(1, 1)}


def test_repeated_and_null_ids(spark):
    given = [(1, "http://a.org/"), (1, "http://a.org/"), (None, "http://a.org/"),
             (2, "http://b.org/")]
    got = judged(spark, given, [1, 1, None, 2], [1, None]).collect()
    assert sorted((r["host"], r["host_labelled"], r["host_bad"]) for r in got) == [
        ("a.org", 2, 2)] * 3 + [("b.org", 1, 1)]


@pytest.mark.parametrize("host,domain", [
    ("a.b.co.uk", ("b.co.uk", "co.uk")), ("co.uk", ("co.uk", "co.uk")), ("org", ("org", "org")),
    ("x.y.z.org:8080", ("z.org", "org")), ("u@y.org", ("y.org", "org")), ("10.0.0.1", ("10.0.0.1", "")),
    ("", ("", ""))])
def test_domains(spark, host, domain):
    from pyspark.sql import functions as F
    assert tuple(spark.range(1).select(*urls.domain_of(F.lit(host))).first()) == domain


def test_longest_rule_wins_and_lists_are_bounded(spark):
    rules = [("block", "a.org", "/"), ("allow", "a.org", "/x"), ("block", "b.a.org", "/xy")]
    given = enumerate(["http://b.a.org/xyz", "http://b.a.org/x", "http://a.org/", "http://c.org/"])
    assert [r["rule"] for r in judged(spark, given, rules=rules).orderBy("page_id").collect()] == [
        "b.a.org/xy", "a.org/x", "a.org/", None]
    with pytest.raises(ValueError):
        urls.ruled(None, None, [("allow", str(i), "/") for i in range(1001)])


def test_equals_the_sql(spark, tmp_path):
    ends = ["org", "net", "com", "co.uk"]
    given = [(i, f"http://h{i % 7}.d{i % 23}.{ends[i % 4]}/{'en/' if i % 2 else 'es/'}{i}")
             for i in range(3000)] + [(None, None), (1, "http://A.org")] + list(enumerate(URLS))
    labels = [(i, int(i % 23 not in (4, 5, 6)), int(i % 97 == 0)) for i in range(0, 3000, 2)]
    labels += [(2, None, None), (3, None, 1), (None, 0, 1), (4, 0, None), (4, 1, 0)]
    sides = {"pages": spark.createDataFrame(given, "page_id long, url string"),
             "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int")}
    con = duckdb.connect()
    for name, df in sides.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    got = [tuple(r) for r in urls.op13_urls(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(con.execute(urls.oracle()).fetchall(), key=repr)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_empty_tables(spark):
    assert judged(spark, []).collect() == []
    got = judged(spark, [(1, "http://a.org/")]).collect()
    assert [(r["page_id"], r["verdict"], r["rate"]) for r in got] == [(1, "allow", "y")]
