"""URL verdicts against character models counted over whole URLs, one character at a time."""

import math
import zlib
from collections import Counter

from topicmill.llm import catalog, url_filter
from topicmill.operators import lookup

ORDER, TRUST, ALPHABET, STEP = 4, 2.0, 128, 0.005

#: Ruled URLs whose numbers tell the two kinds apart, and unruled ones that differ in numbers only.
ALLOWED = [f"http://a{i}.shop.com/item?{1000 + i}" for i in range(30)]
BLOCKED = [f"http://c{i}.example.net/{'es' if i % 2 else 'fr'}/{77 * i % 97}97" for i in range(30)]
UNRULED = ["http://10.1.2.3/", "http://192.168.0.9/", "http://g00gle.org/7", "http://g00gle.org/977777", "http://x.org/1000", "", None]


def held(url):
    return zlib.crc32(url.encode()) % 5 == 0


#: A held-out URL that makes up a third of all rows; it still enters the counts.
HEAVY = next(u for u in (f"http://h{i}.big.net/es/{i}" for i in range(100)) if held(u))
ROWS = ALLOWED + BLOCKED + UNRULED + [HEAVY] * 33


def says(url):
    return "allow" if ".com/" in url else "block" if ".net/" in url else None


def counts(urls):
    """By context length: how often a string of that length and one character occurs, and its context."""
    grams, contexts = Counter(), Counter()
    for url, n in urls.items():
        padded = "\1" * ORDER + url
        for at in range(ORDER, len(padded)):
            for k in range(ORDER + 1):
                grams[padded[at - k : at + 1]] += n
                contexts[(k, padded[at - k : at])] += n
    return grams, contexts


def score(url, models):
    padded, total = "\1" * ORDER + url, 0.0
    for at in range(ORDER, len(padded)):
        chance = {}
        for kind, (grams, contexts) in models.items():
            p = 1 / ALPHABET
            for k in range(ORDER + 1):
                p = (grams[padded[at - k : at + 1]] + TRUST * p) / (contexts[(k, padded[at - k : at])] + TRUST)
            chance[kind] = p
        total += math.log(chance["block"]) - math.log(chance["allow"])
    return total / len(url) if url else 0.0


def trained(rows):
    return {kind: counts(Counter(u for u in rows if says(u) == kind)) for kind in ("allow", "block")}


def cut(rows):
    """The middle of the best cuts of the held-out ruled URLs, scored by the others."""
    models = trained([u for u in rows if not held(u)])
    bins = {kind: Counter() for kind in ("allow", "block")}
    for u in rows:
        if says(u) and held(u):
            bins[says(u)][math.floor(score(u, models) / STEP)] += 1
    total = {kind: sum(found.values()) for kind, found in bins.items()}
    assert min(total.values()) > 0
    places = sorted({*bins["allow"], *bins["block"]})
    errors = {}
    for place in [*places, places[-1] + 1]:
        wrong = sum(n for b, n in bins["allow"].items() if b >= place) / total["allow"]
        missed = sum(n for b, n in bins["block"].items() if b < place) / total["block"]
        errors.setdefault(round(wrong + missed, 9), []).append(place)
    best = errors[min(errors)]
    return (min(best) + max(best)) / 2 * STEP


def test_whole_urls(spark):
    pages = spark.createDataFrame(list(enumerate(ROWS)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judged(pages, catalog.URL_RULES).collect()}
    urls = [u or "" for u in ROWS]
    models, at = trained(urls), cut(urls)
    assert sorted(got) == list(range(len(ROWS)))
    for i, url in enumerate(urls):
        assert abs(got[i]["score"] - score(url, models)) < 1e-9, url
        assert got[i]["verdict"] == (says(url) or ("block" if got[i]["score"] >= at else "allow")), url


def test_numbers_tell_urls_apart(spark):
    pages = spark.createDataFrame(list(enumerate(ROWS)), "page_id long, url string")
    got = {ROWS[r["page_id"]]: r["score"] for r in url_filter.judged(pages, catalog.URL_RULES).collect()}
    assert got["http://10.1.2.3/"] != got["http://192.168.0.9/"]
    assert got["http://g00gle.org/7"] != got["http://g00gle.org/977777"]


def test_long_urls_and_other_planes(spark):
    """A URL of 100,000 characters is scored whole, and characters outside the first plane stay one."""
    long = "http://u.org/" + "".join(f"{i * 7919 % 1000:03d}/é" for i in range(20_000))
    urls = [*ROWS[:60], long, "http://\U0001f600.org/\U0001f600a", *[HEAVY] * 5]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["score"] for r in url_filter.judged(pages, catalog.URL_RULES).collect()}
    assert len(long) > 100_000
    models = trained(urls)
    for i, url in enumerate(urls):
        assert abs(got[i] - score(url, models)) < 1e-9, url[:80]


def test_same_verdicts_when_frequent_grams_are_met_apart(spark, monkeypatch):
    pages = spark.createDataFrame(list(enumerate(ROWS)), "page_id long, url string")
    whole = sorted(map(tuple, url_filter.judged(pages, catalog.URL_RULES).drop("score").collect()))
    monkeypatch.setattr(lookup, "HEAD_BYTES", 2000)
    apart = sorted(map(tuple, url_filter.judged(pages, catalog.URL_RULES).drop("score").collect()))
    assert whole == apart
