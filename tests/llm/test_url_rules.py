"""URL rules: fetched by token, the same as running all of them."""

import random
import re

from lakeferry.llm import url_rules as ur

RULES = (
    ur.HostRule("allow", "com"),
    ur.HostRule("block", "example.com", "/en/"),
    ur.HostRule("allow", "www.example.com", "/en/"),
    ur.HostRule("block", "net", "/es/"),
    ur.HostRule("block", "exa-mple.net", "/e"),
    ur.HostRule("allow", "", "/x"),
    *ur.PATTERNS,
    ur.PatternRule("*pills*"),
)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url):
    host, path = parts(url)
    fits = [
        r for r in RULES
        if isinstance(r, ur.HostRule)
        and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    if fits:
        best = min(fits, key=lambda r: (-len(r.text), r.text))
        return host, path, best.text, best.verdict
    for r in RULES:
        if isinstance(r, ur.PatternRule):
            regex = ".*".join(map(re.escape, r.pattern.split("*")))
            if re.fullmatch(regex, host + path, re.S):
                return host, path, None, "block"
    return host, path, None, "allow"


def urls():
    pick = random.Random(2)
    out = [None, "", "a.com/x", "http://", "HTTP://WWW.Example.COM", "x://com", "http://a.com?x=/en/", "http://É.NET/es/", "http://a.b\n.net/es/"]
    host = ["www", "example", "com", "net", "org", "exa-mple", "cheap-pills", "m", "casino", "spam-farm", "xnet", "EXAMPLE"]
    path = ["en", "es", "e", "x", "a.exe", "login", "pills", "b", "EN", "http://net"]
    for _ in range(3000):
        h = ".".join(pick.choices(host, k=pick.randrange(1, 4)))
        p = "".join("/" + pick.choice(path) for _ in range(pick.randrange(4)))
        out.append(f"http://{h}{p}" + pick.choice(["", "/", "?q=/es/", "#/x"]))
    return out


def test_all_rules_against_brute_force(spark):
    rows = [(i, u, "old") for i, u in enumerate(urls())]
    frame = spark.createDataFrame(rows, "page_id long, url string, VERDICT string")
    for block in (ur.BLOCK_RULES, 3):
        found = ur.judged(frame, RULES, block_rules=block).collect()
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
        assert got == {i: brute(u) for i, u, _ in rows}


def test_only_rules_of_a_fetched_token_run():
    index = ur.Index(RULES, {"com": 9, "example": 5, "en": 1})
    filed = {token: [r.text for r, _ in entries] for token, entries in index.by_token.items()}
    assert filed["en"] == ["example.com/en/"] or "www.example.com/en/" in filed["www"]
    assert [r.text for r, _ in index.always] == ["/x", "*pills*"]


def test_empty(spark):
    frame = spark.createDataFrame([], "page_id long, url string")
    assert ur.judged(frame, RULES).count() == 0
    frame = spark.createDataFrame([(1, "http://a.net/es/")], "page_id long, url string")
    assert ur.judged(frame, []).first().verdict == "allow"
