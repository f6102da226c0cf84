"""Fingerprints and URL rules, which are DataFrame expressions only."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import pytest

from halala.llm import urlrules, weighted
from halala.llm.queries import URL_RULES
from tests.llm.rows import odd, words


def edited(rows):
    """(doc_id, n_chars, digest of the edited text) by walking over the sorted documents."""
    ordered = sorted(rows, key=lambda r: 1 << 70 if r[0] is None else r[0])
    out = []
    for k, (i, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        q = len(text) // 4
        out.append((i, len(text), hashlib.sha256((text[: len(text) - q] + following[:q]).encode()).hexdigest()))
    return sorted(out, key=repr)


def sums(text):
    return Counter({w: c * min(len(w), 31) ** 2 for w, c in Counter(words(text)).items()})


def alike(a, b):
    x, y = sums(a), sums(b)
    every = set(x) | set(y)
    return sum(min(x[w], y[w]) for w in every) / max(1, sum(max(x[w], y[w]) for w in every))


def test_likeness_is_generalised_jaccard(spark, monkeypatch):
    monkeypatch.setattr(weighted, "BUCKET_ROWS", 5)
    draw = random.Random(2)
    rows, text = [], [f"w{draw.randrange(90)}" for _ in range(150)]
    for i in range(40):
        text = [w if draw.random() < 0.6 else f"v{draw.randrange(90)}" * draw.randrange(1, 3) for w in text]
        rows.append((i * 7, " ".join(text)))
    got = sorted(weighted.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), 64).collect(), key=lambda r: r["doc_id"])
    assert [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got] == [r for r in sorted(edited(rows))]
    gaps = [r["near_next"] - alike(rows[k][1], rows[(k + 1) % len(rows)][1]) for k, r in enumerate(got)]
    assert abs(sum(gaps) / len(gaps)) < 0.04 and max(map(abs, gaps)) < 0.25
    gaps = []
    for k, r in enumerate(got):
        text, following = rows[k][1], rows[(k + 1) % len(rows)][1]
        q = len(text) // 4
        gaps.append(r["near_edited"] - alike(text, text[: len(text) - q] + following[:q]))
    assert abs(sum(gaps) / len(gaps)) < 0.04 and max(map(abs, gaps)) < 0.25


def test_fingerprints_of_odd_rows(spark):
    df = odd(spark).where("not (doc_id = 2 and text like 'another%')")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    nulls = [r for r in rows if r[0] is None]
    got = weighted.fingerprints(df).collect()
    assert len(got) == len(rows)
    known = [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got if r["doc_id"] not in (None, 10)]
    assert sorted(known) == [r for r in edited(rows) if r[0] not in (None, 10)]
    assert len([r for r in got if r["doc_id"] is None]) == len(nulls)
    by_text = {}
    for r in got:
        by_text.setdefault(next(t or "" for i, t in rows if i == r["doc_id"]) if r["doc_id"] is not None else None, set()).add(r["fingerprint"])
    assert all(len(v) == 1 for k, v in by_text.items() if k is not None)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    assert weighted.fingerprints(df.limit(0)).count() == 0
    one = weighted.fingerprints(df.where("doc_id = 9")).collect()[0]
    assert one["near_edited"] == one["near_next"] == 1.0


URLS = [
    "https://a.example.org/es/1", "https://EXAMPLE.org/en/12", "http://example.org", "http://example.org/", "https://x.com/fr/2?de=1#x",
    "https://x.com/de/2", "com/de/3", None, "", "https://net.example.net/de/7.html", "https://net.example.net/fr/7", "https://forg/x", "://org/q",
    "https://h://org/x", "HTTP://W.COM/fr/", "https://org?x/y", "a\n://b.org/c",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group(0)
    path = re.match(r"[^?#]*", rest[len(host) :]).group(0)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


def test_given_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string, tokens string")
    got = {r["page_id"]: r for r in urlrules.verdicts(pages, URL_RULES).collect()}
    assert len(got) == len(URLS) + 3
    for i, url in enumerate(URLS):
        host, path = parts(url)
        rule = ruled(host, path)
        assert (got[i]["host"], got[i]["path"]) == (host, path), url
        assert got[i]["rule"] == (rule.name if rule else None), url
        assert got[i]["verdict"] in ("allow", "block")
        if rule:
            assert got[i]["verdict"] == rule.verdict
    assert urlrules.verdicts(pages.limit(0), URL_RULES).count() == 0
    alone = urlrules.verdicts(pages.where("page_id in (7, 9)"), URL_RULES).collect()
    assert {r["verdict"] for r in alone} == {urlrules.DEFAULT}


def test_mined_rules_have_their_confidence(spark):
    draw = random.Random(9)
    rows = []
    for _ in range(300):
        own = {draw.choice(["a", "b", "c"]), draw.choice(["d", "e"]), "f"}
        bad = "a" in own and "d" in own and draw.random() < 0.95
        rows.append((sorted(own), "block" if bad else "allow"))
    rules = urlrules.mined(spark.createDataFrame(rows, "tokens array<string>, verdict string")).collect()
    assert {("a d", "block")} <= {(r["rule"], r["verdict"]) for r in rules}
    for r in rules:
        held = [v for own, v in rows if set(r["tokens"]) <= set(own)]
        assert r["confidence"] == pytest.approx(held.count(r["verdict"]) / len(held))
        smaller = [s for s in rules if s["verdict"] == r["verdict"] and set(s["tokens"]) < set(r["tokens"])]
        assert all(s["confidence"] < r["confidence"] for s in smaller)
    urls = spark.createDataFrame([("u1", ["a", "d", "z"]), ("u2", ["c", "e"]), ("u3", ["z"])], "url string, tokens array<string>")
    from halala.llm.shared import written

    found = {r["url"]: r["mined_verdict"] for r in urlrules.judged_by_rules(urls, written(spark.createDataFrame(rules))).collect()}
    assert found == {"u1": "block", "u2": "allow"}


def test_all_frequent_tokens_are_mined(spark):
    """Rules over a token that 18 others tell more than, and over each of the tokens that always go together."""
    rows = []
    for i in range(30):
        for n in range(20):
            own = ["every", f"t{i}"] + (["twin", "win-twin"] if n < 5 else [])
            rows.append((own, "block" if (i < 20) == (n >= 5) else "allow"))
    rules = urlrules.mined(spark.createDataFrame(rows, "tokens array<string>, verdict string")).collect()
    want = {}
    tokens = sorted({t for own, _ in rows for t in own} - {"every"})
    for size in (1, 2, 3):
        for some in itertools.combinations(tokens, size):
            held = [v for own, v in rows if set(some) <= set(own)]
            for verdict in ("allow", "block"):
                sure = held.count(verdict) / max(1, len(held))
                shorter = [want.get((part, verdict), 0) for k in range(1, size) for part in itertools.combinations(some, k)]
                if held.count(verdict) >= urlrules.SUPPORT * len(rows) and sure >= urlrules.CONFIDENCE and sure > max(shorter, default=0):
                    want[some, verdict] = sure
    assert {(tuple(r["tokens"]), r["verdict"]): pytest.approx(r["confidence"]) for r in rules} == want
    assert {t for some, _ in want for t in some} == set(tokens)


def test_a_part_counts_beyond_unsure_rules(spark):
    """a b c is less sure than a, though no rule of two tokens with a is sure enough to be one."""
    lists = [("a", 90, 90), ("a b", 10, 2), ("a c", 10, 2), ("a b c", 10, 8), ("b c", 10, 0), ("d", 10, 0), ("a d e", 10, 10)]
    rows = [(own.split(), "block" if i < bad else "allow") for own, n, bad in lists for i in range(n)]
    want, sure = {}, {}
    for size in (1, 2, 3):
        for some in itertools.combinations("abcde", size):
            held = [v for own, v in rows if set(some) <= set(own)]
            for verdict in ("allow", "block"):
                if held.count(verdict):
                    sure[some, verdict] = held.count(verdict) / len(held)
                    shorter = [sure.get((part, verdict), 0) for k in range(1, size) for part in itertools.combinations(some, k)]
                    if sure[some, verdict] >= urlrules.CONFIDENCE and sure[some, verdict] > max(shorter, default=0):
                        want[some, verdict] = sure[some, verdict]
    rules = urlrules.mined(spark.createDataFrame(rows, "tokens array<string>, verdict string")).collect()
    assert {(tuple(r["tokens"]), r["verdict"]): pytest.approx(r["confidence"]) for r in rules} == want
    assert (("a", "b", "c"), "block") not in want and (("a",), "block") in want


@pytest.mark.parametrize("native", ["weighted", "urlrules"])
def test_native_operators_run_no_python(spark, native):
    if native == "weighted":
        plan = weighted.fingerprints(odd(spark))
    else:
        plan = urlrules.verdicts(spark.createDataFrame([(1, "https://x.org/a"), (2, "https://x.net/a")], "page_id long, url string"), URL_RULES)
    text = plan._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExternalRDD|CartesianProduct|BroadcastNestedLoop", text)
