from tablework.llm import urls


def test_links_without_scheme_lead_to_other_hosts(spark):
    html = '<a href="//Other.org/x?u=http://c.org/">a</a><a HREF=//b.org>b</a><a href="/own//x">c</a><a href="https://b.org/2">d</a>'
    pages = spark.createDataFrame([("http://a.org/1", html)], "url string, html string")
    got = {(r.src, r.dst, r.n) for r in urls.links(pages).collect()}
    assert got == {("a.org", "other.org", 1), ("a.org", "b.org", 2)}
