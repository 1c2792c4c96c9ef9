"""URL verdicts: host and path rules first, then logistic regression on hashed character n-grams of host and path.

A rule fits its host and all subdomains if the path starts with the rule's; the longest fitting rule decides. URLs without a rule are judged by a model
that learns from a small table of labelled URLs, `labelled_urls()` unless the caller has one: it is fitted by numpy on the driver, a weight per bucket,
host and path in buckets of their own. With labels of one kind only, that kind is the verdict; with no labels it is `allow`. N-grams that the table does not
hold weigh nothing, so they neither add to a sign nor dilute it. A null url or one without `://` has an empty host and path and is judged by the model.
Every row gets its verdict, repeated ones too; an empty table gives an empty one.
"""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.llm import kit

#: Verdict, host, path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
BITS, LENGTHS, STEPS, RATE, DECAY = 16, (4, 5, 6), 200, 0.3, 1e-4
#: What sites call themselves that a text corpus leaves out (gambling, adult, pills and loans, piracy, fraud, spam).
BLOCKED = (
    "casino casinos bets freebets sportsbet betting bookmaker poker roulette blackjack slots jackpot lottery-win baccarat "
    "porn pornhub porno xxx xxxtube sexcams sex-cams sextube sexchat adult-video adultcams nudes milf escorts webcamgirls hentai "
    "viagra cialis pills pharmacy-discount payday-loans paydayloan quick-cash "
    "warez torrent torrents cracked keygen serialz nulled "
    "phishing phish-login verify-account malware free-download-exe replica-watches replicas "
    "spam spamlinks link-farm linkfarm backlinks doorway seo-links").split()
#: Ordinary sites, look-alikes of the words above among them.
ORDINARY = (
    "library museum theatre university college school academy research science physics chemistry biology history geography philosophy "
    "news weather recipes kitchen garden gardening farm farmers farmhouse orchard forest wildlife birds travel hotel airline railway city council "
    "parliament court health hospital clinic dentist pharmacy breast-cancer sexual-health sex-education adult-education adulthood "
    "essex sussex middlesex wessex sexton alphabets betsy bettys better alphabet tibet best abet cassino castle casings spamalot "
    "music orchestra opera gallery photos film cinema books bookshop bookkeeping publisher writer poetry software developer docs wiki forum "
    "linkage linkedlist links-golf farmlinks market shop store bakery coffee tea wine beer brewery sports football cricket tennis chess bridge "
    "running cycling swimming sailing fishing hiking climbing yoga bank insurance accounting tax lawyer notary energy water solar wind telecom "
    "network cloud data maps watches watchmaker jewellery fashion shoes clothing furniture design architect builder plumber electrician "
    "torrential slotcars potholes poke pokemon cracker crackers seoul serial serials exeter downloads nudge adultery-law escort-cars").split()
#: How hosts are built around a word, and paths that say nothing; both kinds of sites have them alike.
FORMS = ("{}.com", "www.{}.org", "m.{}.net", "{}-online.net", "best{}.com", "my-{}.co.uk", "{}24.info", "blog.{}.example.org", "the{}.de", "{}.example.net")
PATHS = ("/", "/en/12", "/index.html", "/news/2024/05/", "/de/4411.html", "/about", "/fr/1204/", "/item/5", "", "/page/2")
PATH_FORMS = ("/{}", "/{}/index.html", "/en/{}/12", "/free-{}.html")
SYLLABLES = ("ba", "ke", "li", "mo", "nu", "ra", "se", "ti", "vo", "th", "an", "er", "ing", "on", "sh")


def labelled_urls(blocked=BLOCKED, ordinary=ORDINARY) -> list[tuple[str, str, int]]:
    """(host, path, 1 for block): every word in every form of host, words in paths of hosts made of syllables, and such hosts by themselves."""
    rows = [(form.format(w), PATHS[(i + j) % len(PATHS)], y) for y, kind in ((1, blocked), (0, ordinary)) for i, w in enumerate(kind) for j, form in enumerate(FORMS)]
    n = len(SYLLABLES)
    names = [SYLLABLES[i % n] + SYLLABLES[(i // n + 3 * i) % n] + SYLLABLES[(i * i + 7) % n] for i in range(max(len(blocked) + len(ordinary), 400))]
    hosts = [FORMS[i % len(FORMS)].format(name) for i, name in enumerate(names)]
    paths = [(form.format(w), y) for y, kind in ((1, blocked), (0, ordinary)) for w in kind for form in PATH_FORMS]
    rows += [(hosts[i % len(hosts)], path_text, y) for i, (path_text, y) in enumerate(paths)]
    return rows + [(h, PATHS[i % len(PATHS)], 0) for i, h in enumerate(hosts)]


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(urls: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule and rule_verdict; the last two are null where no rule fits. Of equally long rules the first one counts."""
    parts = urls.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p) for _, h, p in ordered]
    pick = lambda value: F.coalesce(*[F.when(f, F.lit(value(r))) for f, r in zip(fits, ordered)], F.lit(None).cast("string"))
    return parts.withColumn("rule", pick(lambda r: r[1] + r[2])).withColumn("rule_verdict", pick(lambda r: r[0]))


def grams(host_text: str, path_text: str) -> np.ndarray:
    """The distinct buckets of the n-grams of host and path, in a space of their own each."""
    spaces = [np.concatenate([kit.gram_buckets(kit.code_points(t), n, BITS) for n in LENGTHS]).astype(np.int64) + (k << BITS)
              for k, t in enumerate((f".{host_text}.", f"{path_text}/"))]
    return np.unique(np.concatenate(spaces))


def fit(labelled: list[tuple[str, str, int]]) -> tuple[np.ndarray, float]:
    """(weights, bias) of block = 1 by gradient descent over the presence of n-grams, steps scaled by what a bucket has moved so far, so that rare words learn too."""
    y = np.array([v for *_, v in labelled], float)
    if not len(y) or y.min() == y.max():
        return np.zeros(2 << BITS), (20.0 if len(y) and y[0] else -20.0)
    sets = [grams(h, p) for h, p, _ in labelled]
    rows, columns = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
    w, bias, seen, seen_bias = np.zeros(2 << BITS), 0.0, np.full(2 << BITS, 1e-12), 1e-12
    for _ in range(STEPS):
        z = np.bincount(rows, w[columns], minlength=len(sets)) + bias
        slope = (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        down, down_bias = np.bincount(columns, slope[rows], minlength=2 << BITS) + DECAY * w, slope.sum()
        seen, seen_bias = seen + down * down, seen_bias + down_bias * down_bias
        w, bias = w - RATE * down / np.sqrt(seen), bias - RATE * down_bias / np.sqrt(seen_bias)
    return w, bias


def probability(model: tuple[np.ndarray, float], host_text: str, path_text: str) -> float:
    w, bias = model
    return float(1.0 / (1.0 + np.exp(-np.clip(w[grams(host_text, path_text)].sum() + bias, -40, 40))))


def verdicts(pages: DataFrame, rules=RULES, labelled: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row; score is the model's probability of block.

    `labelled` holds (host, path, 1 for block), `labelled_urls()` if None; with a table of one's own it should stay below some ten thousand rows.
    """
    rows = judged(pages.select("page_id", "url"), rules)
    shared = pages.sparkSession.sparkContext.broadcast(fit(labelled_urls() if labelled is None else list(labelled)))

    @F.pandas_udf("double")
    def block(host_text: pd.Series, path_text: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([probability(model, h, p) for h, p in zip(host_text, path_text)], dtype="float64")

    scored = rows.withColumn("score", block("host", "path"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
