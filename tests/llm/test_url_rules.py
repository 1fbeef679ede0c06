import re

from tallyweir.llm import url_rules
from tests.llm.common import empty

PAGES = "page_id long, url string, html string"
URLS = [
    None, "", "no scheme", "http://", "https://a.com", "https://a.com/", "http://COM/x", "http://com/", "https://xcom/",
    "http://example.com/en/1", "http://example.com/EN/1", "http://m.EXAMPLE.com/en/", "http://www.example.com/en/9?q",
    "http://a.www.example.com/en/", "http://notexample.com/en/", "https://x.net/es/1#top", "https://net/fr/", "http://x.net/fr",
    "http://m.casino-win.example.org/en/1", "http://casino-winner.org/", "ftp://h.org/a/login", "ftp://h.org/help/a/login?x",
    "http://ads.h.org", "http://h.org/pixel/a/b?track", "http://h.org?PHPSESSID=1", "a://b.org/c.zip", "a://b.org/c.zipper",
    "http://user@h.org:80/p;x?y#z", "x://h.org#frag/", "x://h.org?q=http://net/es/", "http://É.org/ü", "a" * 5000,
]


def expected(url):
    text = url or ""
    rest = text.split("://", 1)[1] if "://" in text else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in url_rules.HOST_RULES:
        name, prefix = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + prefix):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    matching = set()
    for _, verdict, pattern in url_rules.PATTERN_RULES:
        regex = "".join({"*": ".*", "^": "(?:[^a-z0-9_%-]|$)"}.get(c, re.escape(c)) for c in pattern.lower())
        if re.search(regex, lowered):
            matching.add(verdict)
    return host, path, None, "allow" if "allow" in matching or not matching else "block"


def pages(spark, urls):
    return spark.createDataFrame([(i % 7 or None, u, None) for i, u in enumerate(urls)], PAGES)


def test_every_url_against_all_rules(spark):
    table = pages(spark, URLS + URLS[:9])
    made = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge_pages(table).collect()]
    assert sorted(made, key=repr) == sorted(((r["page_id"], *expected(r["url"])) for r in table.collect()), key=repr)
    assert url_rules.judge_pages(empty(spark, PAGES)).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = spark.createDataFrame(
        [("a", "block", "/common/rare/"), ("b", "block", "part*whole"), ("c", "block", "^unseen^common^")], "name string, verdict string, pattern string"
    )
    urls = spark.createDataFrame([("x://h/common/rare/",), ("x://h/common/2/",), ("x://h/apartwholesome",)], "_url string")
    filed = {r["name"]: r["token"] for r in url_rules.index_rules(rules, urls).collect()}
    assert filed == {"a": "rare", "b": "", "c": "unseen"}
    found = {r["_url"]: r["pattern_rule"] for r in url_rules.pattern_verdicts(urls, rules).collect()}
    assert found == {"x://h/common/rare/": "a", "x://h/apartwholesome": "b"}


def test_no_rules_at_all(spark):
    rules = url_rules.rule_table(spark, [])
    verdicts = {r["verdict"] for r in url_rules.judge_pages(pages(spark, ["x://casino-win.org/"]), rules).collect()}
    assert verdicts == {"allow"}
