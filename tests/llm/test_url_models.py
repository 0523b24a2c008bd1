"""Operator 13: rules, models and calibration against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from acreage.llm import url_models
from acreage.llm.url_models import ORDER, RULES, Models, allowed_pages, judged_urls, logistic
from acreage.llm.words import texts_of
from tests.llm.brute import LOWER
from tests.llm.conftest import CLASHING, SMALL, frame

FILLER = (7, 7, 7, "x", 7, "x", 7, "x", "x", "x", 7.0, 7, "x")


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOWER), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def rule_of(host, path, rules=RULES):
    best = None
    for verdict, rule in rules:
        name, slash, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best or (None, None)


def text_of(url):
    url = url or ""
    return ("\x02" + (url.split("://", 1)[1] if "://" in url else url).split("#")[0] + "\x03").translate(LOWER).encode()


class Plain:
    """A model by dictionaries."""

    def __init__(self, texts, kept):
        self.count = defaultdict(Counter)
        for t in texts:
            for i in range(1, len(t)):
                for k in range(min(i, ORDER) + 1):
                    if (t[i - k : i], t[i]) in kept:
                        self.count[t[i - k : i]][t[i]] += 1

    def log(self, t):
        out = 0.0
        for i in range(1, len(t)):
            p = 1 / 256
            for k in range(min(i, ORDER) + 1):
                c = self.count.get(t[i - k : i])
                if c:
                    p = (c[t[i]] + len(c) * p) / (sum(c.values()) + len(c))
            out += math.log(p)
        return out / (len(t) - 1)


def held_out(spark, hosts, seed=url_models.SEED):
    df = frame(spark, [(h,) for h in hosts], "host string")
    return {r[0] for r in df.selectExpr("host", f"pmod(xxhash64(host, {seed}), {url_models.HELD_OUT}) = 0 as held").where("held").collect()}


URLS = [
    None, "", "no scheme", "http://", "HTTP://Www.Example.ORG/es/1", "http://example.org/es", "http://a.example.org/en/12?x#y", "http://xorg/1", "http://org/1",
    "http://b.org", "http://b.org?q/", "http://b.org#q/", "ftp://x.com/fr/9", "http://x.com/de/", "http://x.com/es/", "a://b://c.com/de/", "http://É.com/fr/é",
    "http://x.com/de/" + "a" * 50_000, "http://u@x.org:80/", "://c.com/de/1",
]


def _table(spark, urls):
    return frame(spark, [(i, u, *FILLER) for i, u in enumerate(urls)], f"page_id bigint, url string, {CLASHING}")


def _drawn(n, seed):
    draw = random.Random(seed)
    words = ["news", "shop", "casino", "blog", "win", "docs"]
    return [
        f"https://{draw.choice(words)}{draw.randint(0, 30)}.{draw.choice(['example.org', 'site.com', 'b.net'])}/{draw.choice(['fr', 'de', 'es', 'en'])}/{draw.choice(words)}{draw.randint(0, 99)}"
        for _ in range(n)
    ]


@pytest.mark.parametrize("given", ["odd", "table"])
def test_whole_query_against_plain_python(spark, given):
    urls = URLS + _drawn(400, 1) + ["https://b.site.com/de/hot"] * 100
    if given == "table":
        urls = [r[0] for r in spark.read.parquet(f"{SMALL}/pages.parquet").orderBy("page_id").select("url").collect()]
    got = sorted(judged_urls(_table(spark, urls)).collect(), key=lambda r: r["page_id"])
    assert len(got) == len(urls)
    hosts = {parsed(u)[0] for u in urls}
    held = held_out(spark, hosts)
    ruled = [(rule_of(*parsed(u))[0], parsed(u)[0] in held, text_of(u)) for u in urls]
    seen, letters = Counter(), 0
    for verdict, out, t in ruled:
        if verdict and not out:
            letters += len(t) - 1
            seen.update((t[i - k : i], t[i]) for i in range(1, len(t)) for k in range(min(i, ORDER) + 1))
    least = max(url_models.SEEN, -(-letters // url_models.MODEL_ROWS))
    kept = {key for key, n in seen.items() if n >= least or not key[0]}
    good, bad = (Plain([t for v, out, t in ruled if v == verdict and not out], kept) for verdict in ("allow", "block"))
    width = 2 * url_models.LIMIT / url_models.BINS
    counts = np.zeros((2, url_models.BINS))
    for verdict, out, t in ruled:
        if verdict and out:
            d = good.log(t) - bad.log(t)
            counts[int(verdict == "allow"), min(max(math.floor((d + url_models.LIMIT) / width), 0), url_models.BINS - 1)] += 1
    slope, height = logistic(-url_models.LIMIT + (np.arange(url_models.BINS) + 0.5) * width, counts[1], counts[0])
    for r, u in zip(got, urls, strict=True):
        host, path = parsed(u)
        verdict, rule = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        t = text_of(u)
        margin = slope * (good.log(t) - bad.log(t)) + height
        assert math.isclose(r["p_allow"], 1 / (1 + math.exp(-margin)), rel_tol=1e-6, abs_tol=1e-9)
        if verdict or abs(margin) > 1e-9:
            assert r["verdict"] == (verdict or ("block" if margin < 0 else "allow"))


def test_learns_what_rules_say(spark):
    rows = [f"http://{w}{i}.{t}/{k}" for i in range(60) for k in range(3) for w, t in (("casino", "bad"), ("docs", "good"), ("casino", "net"), ("docs", "net"))]
    got = judged_urls(_table(spark, rows), rules=(("allow", "good/"), ("block", "bad/"))).where("rule is null").collect()
    assert {(r["host"][:4], r["verdict"]) for r in got} == {("casi", "block"), ("docs", "allow")}


def test_rules_alone_and_nothing_given(spark):
    urls = ["http://a.b/x", None, "http://b/y"]
    assert [r["verdict"] for r in judged_urls(_table(spark, urls), rules=()).collect()] == ["allow"] * 3
    got = {r["page_id"]: r for r in judged_urls(_table(spark, urls), rules=(("block", "b/x"), ("allow", "b/"), ("block", "b"))).collect()}
    assert [got[i]["rule"] for i in range(3)] == ["b/x", None, "b/"] and [got[i]["verdict"] for i in range(3)] == ["block", "allow", "allow"]
    assert judged_urls(_table(spark, [])).count() == 0


def test_allowed_pages_keep_all_columns(spark):
    urls = URLS + _drawn(200, 2)
    df = _table(spark, urls)
    want = sorted(r["page_id"] for r in judged_urls(df).collect() if r["verdict"] == "allow")
    got = allowed_pages(df)
    assert got.columns == df.columns and sorted(r["page_id"] for r in got.collect()) == want


def test_model_rows_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(url_models, "MODEL_ROWS", 50)
    rows = frame(spark, [(i % 2 == 0, f"\x02{u}\x03") for i, u in enumerate(_drawn(300, 3))], "accepted boolean, text string")
    models = url_models._fitted(rows)
    assert 0 < len(models.keys) <= 256 + 50 * ORDER and models.complete


def test_unseen_bytes_and_curve():
    models = Models.of(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, 2)))
    assert not models.complete and models.differences(texts_of(pa.array(["\x02abc\x03", "\x02\x03"]))).tolist() == [0.0, 0.0]
    x = np.linspace(-1, 1, 9)
    slope, height = logistic(x, np.array([0, 0, 0, 0, 0, 9, 9, 9, 9.0]), np.array([9, 9, 9, 9, 0, 0, 0, 0, 0.0]))
    assert slope > 0 and abs(height) < 1e-3 and logistic(x, np.ones(9), np.zeros(9)) == (1.0, 0.0)


def test_rare_contexts_count_beyond_the_broadcast(spark, monkeypatch):
    """Few broadcast rows give the judgements of all rows; nothing that was counted is left out."""
    urls = URLS[:-3] + _drawn(400, 4) + ["https://b.site.com/de/hot"] * 50
    df = _table(spark, urls)
    want = {r["page_id"]: r for r in judged_urls(df).collect()}
    monkeypatch.setattr(url_models, "MODEL_ROWS", 60)
    monkeypatch.setattr(url_models, "PART_BYTES", 3000)
    got = judged_urls(df).collect()
    assert len(got) == len(urls) and all(r["p_allow"] is not None for r in got)
    for r in got:
        assert math.isclose(r["p_allow"], want[r["page_id"]]["p_allow"], rel_tol=1e-9) and r["verdict"] == want[r["page_id"]]["verdict"]
    kept = allowed_pages(df)
    assert kept.columns == df.columns and sorted(r["page_id"] for r in kept.collect()) == sorted(k for k, r in want.items() if r["verdict"] == "allow")


def test_contexts_seen_once_are_in_the_models(spark):
    """A URL that is seen once tells its bytes from others."""
    models = url_models._fitted(frame(spark, [(True, "\x02abcdefgh\x03"), (False, "\x02ijklmnop\x03")], "accepted boolean, text string"))
    assert models.rest is None and len(models.keys) == sum(2 * (9 - max(0, k - 1)) for k in range(ORDER + 1)) - 1
