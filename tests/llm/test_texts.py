"""Fingerprints, line dedup, url filters and mixing against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from compare import connect, same

from loadcast.llm import boilerplate, mixing, sketch, urlrules
from loadcast.llm.queries import ORACLES, QUERIES

NAMES = sorted(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = connect(sf_dir).execute(ORACLES[name]).df()
    assert len(want) > 0
    assert same(got, want) is None


def follow(rows):
    """(row, next text) by descending id, ties by text."""
    known = sorted([r for r in rows if r[0] is not None], key=lambda r: (-r[0], r[1] or ""))
    return [(r, known[(k + 1) % len(known)][1] or "") for k, r in enumerate(known)] + [(r, "") for r in rows if r[0] is None]


def test_fingerprints(docs, odd):
    for df in (docs, odd):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        want = Counter()
        for (doc_id, text), after in follow(rows):
            text = text or ""
            n = len(text) // 3
            new = text[: len(text) - n] + after[:n]
            f, e, x = (sketch.fingerprint(t) for t in (text, new, after))
            want[(doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), sketch.text_form(f), sketch.text_form(e),
                  sketch.likeness(f, e), sketch.likeness(f, x))] += 1
        got = Counter(tuple(r)[:7] for r in sketch.fingerprints(df).collect())
        assert got == want


def test_fingerprints_of_nothing_and_one(spark, nothing):
    assert sketch.fingerprints(nothing).count() == 0
    one = sketch.fingerprints(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0


def test_sketch_estimates_containment_and_merges():
    words = [f"{k * 7919 % 100003:x}q{k * k % 7907:x}" for k in range(6000)]
    whole, part, other = " ".join(words), " ".join(words[1000:1400]), " ".join(words[5000:]) + " ".join(words[:50])
    exact = lambda t: {t[k : k + 8] for k in range(len(t) - 7)}
    for a, b in ((part, whole), (whole, part), (other, whole), (other, part), (whole, other)):
        x, y, f, g = exact(a), exact(b), sketch.fingerprint(a), sketch.fingerprint(b)
        assert abs(sketch.containment(f, g) - len(x & y) / len(x)) < 0.05
        assert abs(sketch.likeness(f, g) - len(x & y) / len(x | y)) < 0.05
        both = sketch.fingerprint(a + "\x00" * 8 + b)
        merged = sketch.merge(f, g)
        assert set(merged) <= set(both) and len(both) - len(merged) < 20
    w = sketch.fingerprint(whole)
    assert (sketch.from_text(sketch.text_form(w)) == w).all()
    assert set(w) <= set(sketch.fingerprint(whole * 30))  # hashed in stretches
    assert len(sketch.fingerprint("")) == 0 and len(sketch.fingerprint("a")) == 1


def brute_boilerplate(rows, ratio, least):
    """Pages are the different sets of lines of a site."""
    pages, of = Counter(), defaultdict(Counter)
    for site, lines in {(s, frozenset(x.strip(" \t\r") for x in (t or "").split("\n")) - {""}) for _, t, s in rows}:
        pages[site] += 1
        for line in lines:
            of[site][line] += 1
    bad = {s: {x for x, c in lines.items() if c >= least and c > ratio * pages[s]} for s, lines in of.items()}
    return Counter(
        (i, t if t is None else "\n".join(x for x in t.split("\n") if x.strip(" \t\r") not in bad.get(s, ())), s) for i, t, s in rows
    )


def test_line_dedup(docs, odd, nothing):
    for df, ratio, least in ((docs, 0.05, 2), (odd, 0.3, 2), (odd, 0.0, 1)):
        rows = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
        out = boilerplate.drop_boilerplate(df, "source", ratio, least)
        assert out.columns[: len(df.columns)] == df.columns or "lines" in df.columns
        assert Counter(tuple(r) for r in out.select("doc_id", "text", "source").collect()) == brute_boilerplate(rows, ratio, least)
    assert boilerplate.drop_boilerplate(nothing).count() == 0


def test_query_and_pipeline_drop_the_same_lines(spark, docs):
    """Six copies on a site of 40 pages keep their lines; a footer on 4 of 4 pages goes."""
    texts = [("a", "copied line\nand its second")] * 6 + [("a", f"page {k}") for k in range(40)] + [("b", f"own {k}\nfooter") for k in range(4)]
    given = spark.createDataFrame([(k, t, s) for k, (s, t) in enumerate(texts)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in boilerplate.drop_boilerplate(given).collect()}
    assert got == {k: t.removesuffix("\nfooter") for k, (_, t) in enumerate(texts)}


def brute_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = []
    for verdict, rule in rules:
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(rule), len(h), verdict == "block", rule, verdict))
    return (host, path, *max(fits)[3:]) if fits else (host, path, None, "allow")


def test_url_filter(spark):
    urls = [
        None, "", "example.org/x", "http://EXAMPLE.org/en/12?q", "http://a.b.example.org/es/x", "http://notexample.org/es/", "http://org/",
        "http://org", "x://y.com/fr/a#b", "x://com/de/", "http://a.com/fr", "ftp://u@b.com:80/fr/", "http://é.org/en/1", "http://.org/",
        "http://a..org/es/", "http://example.org/en/1", "http://example.org?en/1", "://example.org/es/", "a://b://example.org/", "http://x.org/\nq",
    ] * 2
    df = spark.createDataFrame([(k, u, "clash", 1) for k, u in enumerate(urls)], "page_id long, url string, host string, digest int")
    rules = [*urlrules.RULES, ("block", "/"), ("allow", "b.example.org/"), ("block", "x.org/")]
    for some in (list(urlrules.RULES), rules):
        got = urlrules.filter_pages(df, urlrules.rule_table(spark, some)).collect()
        assert {tuple(r) for r in got} == {(k, *brute_rule(u, some)) for k, u in enumerate(urls)} and len(got) == len(urls)
    none = urlrules.filter_pages(df, urlrules.rule_table(spark, some).limit(0), "block").collect()
    assert {r["verdict"] for r in none} == {"block"}
    assert urlrules.filter_pages(df.limit(0), urlrules.rule_table(spark)).count() == 0


def colliding():
    """Two paths of one host whose expressions share the first four bytes of their digest."""
    seen = {}
    for k in range(1_000_000):
        rule = f"example.org/{k}/"
        prefix = hashlib.sha256(rule.encode()).hexdigest()[: urlrules.PREFIX_DIGITS]
        if prefix in seen:
            return seen[prefix], rule
        seen[prefix] = rule
    raise AssertionError("no two rules of one prefix")


def test_rules_of_one_prefix(spark, capsys):
    """The join sees the short prefix alone; the full digest tells rules of one prefix apart."""
    one, two = colliding()
    urls = spark.createDataFrame([(1, f"http://{one}x"), (2, f"http://a.{two}"), (3, "http://example.org/")], "page_id long, url string")
    for some, want in (([("block", one), ("allow", two)], ["block", "allow", "allow"]), ([("block", two)], ["allow", "block", "allow"])):
        got = urlrules.filter_pages(urls, urlrules.rule_table(spark, some * 2))
        assert [r["verdict"] for r in got.orderBy("page_id").collect()] == want
    got.explain("formatted")
    plan = capsys.readouterr().out
    keys = [k for k in re.findall(r"keys(?: \[\d+\])?: \[(.*)\]", plan) if "prefix" in k]
    assert keys and not any("digest" in k for k in re.findall(r"(?:Left|Right) keys \[\d+\]: (.*)", plan))


def test_many_shapes(spark, monkeypatch):
    """Beyond the bound on shapes, urls are expanded into all of theirs, with the same result."""
    urls = [None, "", "http://a.b.example.org/es/x", "http://org", "http://./x", "x://y.com/fr/a#b", "http://example.org/en/1", "http://é.org/日本/"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    rules = [*urlrules.RULES, ("block", "/"), ("block", "é.org/日")]
    monkeypatch.setattr(urlrules, "MOST_SHAPES", 2)
    got = urlrules.filter_pages(df, urlrules.rule_table(spark, rules)).collect()
    assert {tuple(r) for r in got} == {(k, *brute_rule(u, rules)) for k, u in enumerate(urls)}


def brute_targets(sizes, weights, most):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        share = (total - sum(most * sizes[s] for s in capped)) / sum(w[s] for s in free)
        over = {s for s in free if share * w[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else share * w[s] for s in names}
        capped |= over


def test_mixing(docs, odd, nothing):
    for df in (docs, odd):
        rows = mixing.plan(df).collect()
        given = df.select("doc_id", "text", "source").collect()
        size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == Counter((i, s, size(t)) for i, t, s in given)
        sizes = Counter()
        for _, t, s in given:
            sizes[s] += size(t)
        want = brute_targets(sizes, mixing.WEIGHTS, mixing.MOST)
        taken, largest = Counter(), Counter()
        for r in rows:
            assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
            due = r["target"] / r["source_size"] if r["source_size"] else 0
            assert math.floor(due) <= r["copies"] <= math.ceil(due) <= 3 and r["taken"] == r["copies"] * r["size"]
            taken[r["source"]] += r["taken"]
            largest[r["source"]] = max(largest[r["source"]], r["size"])
        for s in sizes:
            assert abs(taken[s] - want[s]) <= largest[s] + 1
        assert math.isclose(sum(want.values()), sum(sizes.values()))
        assert sorted(map(str, rows)) == sorted(map(str, mixing.plan(df).collect()))  # reruns agree
    assert mixing.plan(nothing).count() == 0


def test_mix_repeats_rows(odd):
    planned = Counter()
    for r in mixing.plan(odd).collect():
        planned[r["doc_id"]] += r["copies"]
    out = mixing.mix(odd)
    assert out.columns == odd.columns
    assert Counter(r["doc_id"] for r in out.collect()) == +planned
