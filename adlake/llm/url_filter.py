"""URL filter: path rules first, then logistic regression on hashed character n-grams of host and path.

The model is trained on a small labelled table of URLs (:data:`LABELLED`, or any other of at most ``MOST_LABELLED``
rows); its weights are one array of ``2**BITS`` numbers, which bounds the broadcast. Scoring is one pass without a
shuffle, over two columns.

Defined cases: a NULL url, or one without ``://``, has an empty host and path and is judged by the model's intercept
alone; repeated rows are judged alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import Powers, Rolling, byte_codes, flat_bytes, slices
from adlake.llm.toxicity import sigmoid

BITS = 14
GRAMS = (3, 4, 5)
STEPS = 1000
RATE = 4.0
DECAY = 1e-5
MOST_LABELLED = 100_000
INTERCEPT = -1.0  # an URL of unknown parts is allowed

# (host, path, verdict); a rule fits its host and all hosts below it.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

BLOCKED_URLS = """
http://www.casino-royal.example.biz/en/bonus http://online-casino.example.info/win/121 https://casino24.example.com/fr/4410
https://win-big.example.net/casino/page-3 http://lucky-win.example.com/en/7712?ref=ad http://best-bets.example.net/de/sport-bets
https://bets-online.example.com/en/331 https://freebets.example.org/offer/77 http://poker-room.example.com/es/1203
https://slots-jackpot.example.info/en/55.html http://jackpot-win.example.net/en/8890 http://cheap-meds.example.com/buy/pills
https://pills-online.example.net/en/9021 https://www.cheap-viagra.example.com/order/3 http://discount-pills.example.biz/fr/22/
http://pharmacy-cheap.example.info/en/18 https://diet-pills.example.com/es/400?page=2 https://adult-video.example.com/en/6120
http://adult-chat.example.net/de/312 https://xxx-tube.example.com/watch/99 http://free-xxx.example.net/en/171#top
https://x-adult.example.info/fr/805 http://porn-hub-free.example.biz/en/4 https://sexcam.example.com/live/1
https://adult-dating.example.com/en/7001.html http://hot-escort.example.net/es/15 http://spam-host.example.com/en/900
https://www.spamlink.example.net/es/81?utm_source=feed http://link-farm.example.info/en/3310 https://spam-blog.example.org/de/55
http://seo-spam.example.com/en/6021/ https://content-farm.example.net/en/1177 http://linkfarm24.example.biz/fr/6
http://ads-server.example.com/en/45 https://track-ads.example.net/click/121 http://adtrack.example.com/pixel/7
https://tracker.example.info/en/3015?page=2 http://popup-ads.example.net/en/72 https://click-track.example.com/es/410
http://free-gift.example.com/en/claim/9 https://free-money.example.net/en/2204 http://free-iphone.example.info/win/1
https://prize-winner.example.com/en/611 http://get-rich.example.biz/fr/19 https://payday-loan.example.com/en/1500
http://fast-loans.example.net/de/802/ https://cheap-replica.example.com/shop/31 http://replica-watches.example.net/en/240
http://warez-download.example.com/en/crack/77 https://keygen-crack.example.net/en/619 http://torrent-free.example.info/es/3
https://malware-drop.example.com/en/10 http://phish-login.example.net/bank/2 https://verify-account.example.biz/en/5521
""".split()

ALLOWED_URLS = """
http://www.example.com/en/120 https://example.net/de/4410.html https://news.example.com/en/politics/331
http://blog.example.net/fr/825?page=2 https://m.example.org/en/25#top https://library.example.org/es/685
http://university.example.com/en/research/676 https://docs.example.net/en/770#top https://blog.river.example.com/en/853/
http://blog.mountain.example.net/en/960 https://m.weather.example.com/en/474.html https://science.example.com/en/671?utm_source=feed
https://www.museum.example.net/en/148.html https://blog.garden.example.org/es/978?page=2 http://history.example.org/en/453
https://www.thorin.example.net/es/797 https://blog.anther.example.org/en/777 http://m.lantern.example.com/en/1303
https://www.northern.example.com/de/252?page=2 http://other.example.net/en/217 https://weaver.example.com/en/977
https://thunder.example.net/fr/12611 http://www.tender.example.com/en/27711 https://station.example.com/en/36222
http://nation.example.net/en/30146.html https://blog.motion.example.com/de/44257 https://m.action.example.net/es/20756
http://recipes.example.com/en/17796 https://www.kitchen.example.net/fr/35414 https://travel.example.com/es/24418
http://schools.example.net/en/15611.html https://sport.example.com/de/22796#top https://football.example.net/en/43742/
http://music.example.com/en/16447 https://films.example.net/de/36855?utm_source=feed https://books.example.com/en/34896
http://forum.example.net/en/38620 https://wiki.example.com/es/14294 https://www.health.example.net/en/11734/
http://gardening.example.com/fr/14 https://www.city-council.example.net/en/39 https://open-data.example.com/en/502
http://local-news.example.net/de/7340 https://my-recipes.example.com/es/911/ https://www.art-school.example.net/en/64
http://energy.example.com/en/8891 https://software.example.net/en/20453 https://maths.example.com/fr/310.html
http://m.thread.example.net/en/5530 https://www.theatre.example.com/en/6204 https://hotels.example.net/es/1290
http://trains.example.com/de/871#top https://gallery.example.net/en/40007 https://jobs.example.com/en/2330
""".split()

LABELLED = tuple((u, 1) for u in BLOCKED_URLS) + tuple((u, 0) for u in ALLOWED_URLS)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: from behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end; path: on to ``?``, ``#`` or the end."""
    text = F.coalesce(url, F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(text, parts, 1), UPPER, LOWER), F.regexp_extract(text, parts, 2)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else NULL."""
    longest = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [
        (((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for h, p, v in longest
    ]
    if not fits:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    return reduce(lambda chain, f: chain.when(*f), fits[1:], F.when(*fits[0]))


def grams(texts: list[str], salt: int, powers: Powers, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram of the texts with their ends marked; numbers all look alike."""
    data, offsets = flat_bytes(pa.array([f"^{DIGITS.sub('0', t)}$" for t in texts], pa.large_string()))
    rolling, ends = Rolling(data, powers, codes), np.repeat(offsets[1:], np.diff(offsets))
    rows, buckets = [], []
    for n in GRAMS:
        at = np.flatnonzero(np.arange(len(data)) + n <= ends)
        rows.append(np.searchsorted(offsets, at, "right") - 1)
        buckets.append((rolling(at, at + n) ^ np.uint64(salt)) >> np.uint64(64 - BITS))
    return np.concatenate(rows), np.concatenate(buckets).astype(np.int64)


DIGITS = re.compile("[0-9]+")
HOST_SALT, PATH_SALT = 0, 0xA5A5 << 48
PATH_SHARE = 0.3  # hosts tell more than paths


def features(hosts: list[str], paths: list[str], powers: Powers, codes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, bucket, value) of the n-grams of host and path; the values of either side have a fixed sum of squares."""
    parts = []
    for texts, salt, share in ((hosts, HOST_SALT, 1.0), (paths, PATH_SALT, PATH_SHARE)):
        row, bucket = grams(texts, salt, powers, codes)
        counts = np.bincount(row, minlength=len(texts))
        parts.append((row, bucket, share / np.sqrt(np.maximum(counts, 1))[row]))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def fit(hosts: list[str], paths: list[str], labels: Sequence[int]) -> np.ndarray:
    """Weights by gradient steps on the penalised logistic loss."""
    if len(hosts) > MOST_LABELLED:
        raise ValueError(f"more than {MOST_LABELLED} labelled rows")
    row, bucket, value = features(hosts, paths, Powers(), byte_codes())
    y, weights = np.asarray(labels, float), np.zeros(1 << BITS)
    for _ in range(STEPS if len(y) else 0):
        error = (sigmoid(np.bincount(row, weights[bucket] * value, len(y)) + INTERCEPT) - y) / len(y)
        weights -= RATE * (np.bincount(bucket, error[row] * value, 1 << BITS) + DECAY * weights)
    return weights


def judge(
    pages: DataFrame,
    labelled: DataFrame | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, score. ``labelled``: (url, label) with 1 for URLs to block."""
    spark = pages.sparkSession
    table = labelled if labelled is not None else spark.createDataFrame(LABELLED, "url string, label int")
    split = table.select(*host_and_path(F.col("url")), "label").toDF("host", "path", "label")
    known = sorted(tuple(r) for r in split.limit(MOST_LABELLED + 1).collect())
    weights = fit([r[0] for r in known], [r[1] for r in known], [r[2] for r in known])
    shared = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes = Powers(), byte_codes()
        for whole in batches:
            for batch in slices(whole, "path"):
                columns = [batch.column(c) for c in (key, "host", "path", "rule", "ruled")]
                row, bucket, value = features(columns[1].to_pylist(), columns[2].to_pylist(), powers, codes)
                p = sigmoid(np.bincount(row, shared.value[bucket] * value, batch.num_rows) + INTERCEPT)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(p)], [key, "host", "path", "rule", "ruled", "score"])

    host, path = host_and_path(F.col(url))
    parsed = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    rule = matched_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumn("_r", rule).select(key, "host", "path", F.col("_r.rule").alias("rule"), F.col("_r.verdict").alias("ruled"))
    kind = pages.schema[key].dataType.simpleString()
    scored = ruled.mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, ruled string, score double")
    by_model = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(key, "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score")
