import math
import re
from collections import Counter

from pyspark.sql import functions as F

from cohortry.llm import url_filter as uf
from cohortry.llm.common import table
from cohortry.llm.queries import op5_url_filter

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans(uf.UPPER, uf.LOWER)


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOWER), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def plain_rule(host, path):
    fit = [r for r in uf.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name)) if fit else None


def plain_tokens(text):
    return [f"#{len(t)}" if t.isdigit() else t for t in re.findall(r"[0-9]+|[^\W\d_]+", text.lower())]


def shown(html):
    """The page without comments, scripts, styles, tags and entities, found by going through it once."""
    out, at, lower = [], 0, html.lower()
    while at < len(html):
        name = next((n for n in ("script", "style") if re.match(f"<{n}\\b", lower[at : at + 8])), None)
        if name:
            end = re.compile(f"</{name}[^<>]*>").search(lower, at)
            at = end.end() if end else len(html)
        elif html.startswith("<!--", at):
            at = html.find("-->", at) + 3 if "-->" in html[at:] else len(html)
        elif m := re.compile(r"<[^<>]*>|&#?[a-z0-9]+;", re.I).match(html, at):
            at = m.end()
        else:
            out.append(html[at])
            at += 1
            continue
        out.append(" ")
    return "".join(out)


def test_query_matches_a_plain_model(spark):
    pages = [(r.page_id, r.url, r.html) for r in table(spark, SF, "pages").collect()]
    got = {r.page_id: r for r in op5_url_filter(spark, SF).collect()}
    assert len(got) == len(pages)
    counts = Counter()
    for _, url, html in pages:
        counts.update(w for text in (shown(html or ""), plain_split(url)[1]) for w in re.findall(r"[^\W\d_]+", text.lower()) if len(w) <= uf.LABEL)
    assert counts["track"] < 5 and not counts["amp"] and not counts["doctype"]
    total = sum(counts.values())
    floor = -math.log10(total + 1)
    known = {w: math.log10(n) + floor for w, n in counts.items()}
    unknown = [floor - k for k in range(uf.LABEL + 1)]
    tokens, model, sides = {}, {"block": Counter(), "allow": Counter()}, Counter()
    for key, url, _ in pages:
        host, path = plain_split(url)
        words = [w for t in plain_tokens(host) for w in ([t] if t[0] == "#" else uf.best_cut(t, known, unknown))]
        tokens[key] = [f"h:{w}" for w in words] + [f"p:{t}" for t in plain_tokens(path)]
        assert got[key].host_words == " ".join(words)
        rule = plain_rule(host, path)
        assert (got[key].host, got[key].path, got[key].rule) == (host, path, rule.name if rule else None)
        if rule:
            model[rule.verdict].update(tokens[key])
            sides[rule.verdict] += 1
    kinds = len(set(model["block"]) | set(model["allow"]))
    for key, url, _ in pages:
        odds = math.log((sides["block"] + 1) / (sides["allow"] + 1))
        for t in tokens[key]:
            if model["block"][t] + model["allow"][t] == 0:
                continue
            odds += math.log((model["block"][t] + 1) / (sum(model["block"].values()) + kinds)) - math.log((model["allow"][t] + 1) / (sum(model["allow"].values()) + kinds))
        assert math.isclose(got[key].block_odds, odds, abs_tol=1e-6)
        rule = plain_rule(*plain_split(url))
        assert got[key].verdict == (rule.verdict if rule else "block" if odds > 0 else "allow")


def test_cut_is_the_best_of_all_cuts():
    known = {"the": -1.0, "theme": -2.5, "me": -1.8, "park": -2.0, "them": -2.2, "epark": -3.0}
    unknown = [-5.0 - k for k in range(uf.LABEL + 1)]

    def every(label):
        return max([(known.get(label[:k], unknown[k]) + every(label[k:])) for k in range(1, len(label) + 1)]) if label else 0.0

    for label in ("themepark", "parkthe", "xpark", "thethe", "mepark"):
        words = uf.best_cut(label, known, unknown)
        assert "".join(words) == label and math.isclose(sum(known.get(w, unknown[len(w)]) for w in words), every(label))


def test_awkward_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/en/1?x#y", "x://org", "x://org/", "x://notorg/", "x://q.com/de/", "x://q.com/de?", "a://b://c/d", "x://" + "verylong" * 300 + ".net/p" * 500, "x://münchen.de/straße/9"]
    docs = spark.createDataFrame([(i, u, None, 1.0) for i, u in enumerate(urls)] + [(None, "x://org/", "w", 1.0), (6, "x://org/", "w", 1.0)], "page_id long, url string, html string, verdict double")
    rows = uf.judge(docs).collect()
    assert len(rows) == len(urls) + 2
    for r in rows:
        if r.page_id is not None:
            assert (r.host, r.path) == plain_split(urls[r.page_id])
            rule = plain_rule(r.host, r.path)
            assert r.rule == (rule.name if rule else None) and r.verdict in ("allow", "block")
    assert uf.judge(docs.limit(0)).count() == 0 and uf.judge(docs.where(F.col("page_id") == 0)).count() == 1


def concatenated(spark):
    """Pages whose text teaches the words; hosts of rules and hosts of none are made of two of them."""
    words = "cheap pills city library watches museum loans garden street school".split()
    text = "<style>cheappills citylibrary</style><p>" + " ".join(words * 5) + "</p>"
    bad, good = ("cheappills", "cheapwatches", "cheaploans"), ("citylibrary", "citymuseum", "citygarden")
    rules = tuple(uf.Rule(f"{h}.net", "/", v) for hosts, v in ((bad, "block"), (good, "allow")) for h in hosts)
    hosts = [f"{h}.net" for h in (*bad, *good)] * 3 + ["cheapgarden.net", "cityschool.net", "cheapstreet.net", "citystreet.net", "unheardofname.net"]
    return spark.createDataFrame([(i, f"http://{h}/{i}", text) for i, h in enumerate(hosts)], "page_id long, url string, html string"), rules


def test_concatenated_names_are_cut_and_judged_by_their_words(spark):
    pages, rules = concatenated(spark)
    got = {r.host: r for r in uf.judge(pages, rules=rules).collect()}
    assert got["cheappills.net"].host_words == ["cheap", "pills", "net"] and got["citymuseum.net"].host_words == ["city", "museum", "net"]
    assert got["cheapgarden.net"].host_words == ["cheap", "garden", "net"]
    assert {h: got[h].verdict for h in ("cheapgarden.net", "cheapstreet.net", "cityschool.net", "citystreet.net")} == {"cheapgarden.net": "block", "cheapstreet.net": "block", "cityschool.net": "allow", "citystreet.net": "allow"}
    assert abs(got["unheardofname.net"].block_odds - got["cheapstreet.net"].block_odds) > 0.5
    assert all(got[h].rule is None for h in ("cheapgarden.net", "citystreet.net"))


def test_hosts_held_out_from_the_rules_get_the_rules_verdict(spark):
    pages, rules = concatenated(spark)
    right = 0
    for out in (rules[0], rules[-1]):
        judged = uf.judge(pages, rules=tuple(r for r in rules if r != out)).where(F.col("host") == out.host).first()
        assert judged.rule is None
        right += judged.verdict == out.verdict
    assert right == 2


def test_long_labels_stay_whole_and_open_markup_ends_with_the_page(spark):
    long = "pills" * 13
    pages = spark.createDataFrame([(1, f"http://{long}.net/", "<p>pills pills net <!-- never <p>shut pillsx"), (2, f"http://{long[:60]}.net/", "<script>pillsy"), (3, None, "<" * 50_000 + "<script>" * 20_000)], "page_id long, url string, html string")
    got = {r.page_id: r.host_words for r in uf.judge(pages).collect()}
    assert got == {1: [long, "net"], 2: ["pills"] * 12 + ["net"], 3: []}
