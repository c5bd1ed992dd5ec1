"""URL filter: host rules, else a logistic regression on hashed character n-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import add_columns

# The rules of the production query, (host and path, verdict).
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

# A small labelled table, 1 for a URL that should be blocked.
LABELLED_URLS = (
    ("http://ads.shop-deals.test/en/11", 1),
    ("http://adserver.test/fr/300.html", 1),
    ("https://track.pixel-count.test/en/7/", 1),
    ("https://click-tracker.test/de/9", 1),
    ("http://spam-links.test/en/1.html", 1),
    ("http://www.link-farm.test/de/22", 1),
    ("http://cheap-meds.test/es/5", 1),
    ("https://online-pills.test/en/602/", 1),
    ("https://casino-bonus.test/en/81", 1),
    ("http://www.win-casino.test/en/2.html", 1),
    ("http://free-porn.test/en/4", 1),
    ("http://xxx-cams.test/en/33/", 1),
    ("https://best-poker.test/es/6", 1),
    ("http://popup-ads.test/en/3", 1),
    ("https://m.spam-mail.test/fr/40", 1),
    ("http://tracking.metrics-ads.test/en/12", 1),
    ("http://seo-farm.test/en/7", 1),
    ("https://warez-crack.test/en/91.html", 1),
    ("http://phish-login.test/en/14", 1),
    ("http://malware-host.test/en/15", 1),
    ("https://blog.spam-network.test/en/88", 1),
    ("http://www.ad-track.test/en/71.html", 1),
    ("http://cheap-pills.test/en/17", 1),
    ("http://blog.pills-now.test/de/5/", 1),
    ("http://casino-win.test/fr/19", 1),
    ("http://blog.casino-royal.test/en/61", 1),
    ("http://free-bets.test/en/27.html", 1),
    ("http://www.sport-bets.test/es/73", 1),
    ("http://adult-dates.test/en/39", 1),
    ("http://m.adult-x.test/fr/21", 1),
    ("http://ads-track.test/en/46/", 1),
    ("http://spam-farm.test/de/30", 1),
    ("http://www.spam-farms.test/en/57", 1),
    ("http://free-adult.test/en/64", 1),
    ("http://bets-casino.test/en/5?page=2", 1),
    ("https://www.university.test/en/12", 0),
    ("https://blog.writer.test/en/2021.html", 0),
    ("http://news.daily.test/de/17", 0),
    ("https://docs.library.test/en/4/", 0),
    ("https://en.encyclopedia.test/es/8", 0),
    ("http://m.weather.test/fr/42", 0),
    ("https://forum.garden.test/en/1?page=2", 0),
    ("https://recipes.kitchen.test/es/9.html", 0),
    ("http://www.museum.test/fr/3/", 0),
    ("https://journal.science.test/en/55", 0),
    ("http://northern.test/en/102", 0),
    ("https://m.winter-tours.test/de/1870.html", 0),
    ("http://blog.heather.test/es/44/", 0),
    ("https://www.farmhouse.test/en/3312?utm_source=feed", 0),
    ("http://orchard.test/fr/208#top", 0),
    ("https://theatre.test/en/7", 0),
    ("http://www.town-hall.test/de/1", 0),
    ("https://school.test/en/4.html", 0),
    ("https://code.project.test/en/31", 0),
    ("http://poetry.test/en/18", 0),
    ("http://harbour.test/en/655.html", 0),
    ("http://thither.test/en/205", 0),
    ("http://m.nothing.test/en/71", 0),
    ("http://station.test/de/309.html", 0),
    ("http://www.motion.test/en/44", 0),
    ("http://m.theory.test/fr/63/", 0),
    ("http://another.test/en/5021", 0),
    ("http://blog.thousand.test/en/940", 0),
    ("http://healthy.test/es/87", 0),
    ("http://m.thanks.test/en/611.html", 0),
    ("http://bath-house.test/en/26", 0),
    ("http://strengthen.test/en/78?utm_source=feed", 0),
    ("http://action.test/en/4410", 0),
    ("http://m.within.test/de/34", 0),
    ("http://thinly.test/en/1200/", 0),
    ("http://blog.weather-station.test/en/52#top", 0),
    ("http://the-nation.test/en/905", 0),
    ("http://m.trading.test/en/16", 0),
    ("http://www.than.test/es/330", 0),
    ("http://ration.test/en/48", 0),
    ("http://m.therapy.test/en/59?page=2&ref=x", 0),
    ("http://rethink.test/en/811", 0),
    ("http://mention.test/fr/92.html", 0),
    ("http://threshold.test/en/23", 0),
    ("http://blog.bestow.test/en/385", 0),
    ("http://thistle.test/en/6600.html", 0),
    ("http://m.onward.test/fr/15", 0),
    ("https://blog.mountain.test/en/98", 0),
)

DIMENSIONS = 1 << 14
SIZES = (3, 4, 5)


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case and path; both empty for null or without ``://``."""
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (found[1].encode().lower().decode(), found[2]) if found else ("", "")


def features(host: str, path: str) -> np.ndarray:
    """Hashed n-grams of both parts, digits made alike; each place counts once."""
    places = set()
    for part, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        plain = re.sub(r"\d+", "0", text)
        for n in SIZES:
            for i in range(len(plain) - n + 1):
                places.add(zlib.crc32(f"{part}{plain[i : i + n]}".encode()) % DIMENSIONS)
    return np.fromiter(sorted(places), np.int64, len(places))


def train(
    labelled: Sequence[tuple[str, int]] = LABELLED_URLS, rounds: int = 1000, penalty: float = 2e-4
) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent; the table is small and fits the driver."""
    rows = [features(*split_url(url)) for url, _ in labelled]
    matrix = np.zeros((len(rows), DIMENSIONS))
    for i, places in enumerate(rows):
        matrix[i, places] = 1 / np.sqrt(max(1, len(places)))
    wanted = np.array([label for _, label in labelled], float)
    weights, bias = np.zeros(DIMENSIONS), 0.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(matrix @ weights + bias))) - wanted
        weights -= 4 * (matrix.T @ error / max(1, len(rows)) + penalty * weights)
        bias -= float(error.mean()) if len(rows) else 0.0
    return weights, bias


def host_column(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_column(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits: its host or a subdomain, and a path it begins; else null."""
    column = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        column = F.when(fits, rule).otherwise(column)
    return column


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    labelled: Sequence[tuple[str, int]] = LABELLED_URLS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns ``keep`` and host, path, rule, verdict and score of every row.

    A null url or one without ``://`` has an empty host and path, fits no rule and
    is scored like any other. Repeated rows are judged alike, each for itself. An
    empty labelled table scores 0.5 everywhere, which allows. Row by row, without
    a shuffle; the model is a fixed 128 KB.
    """
    weights, bias = train(labelled)

    def factory():
        def score(urls):
            values = []
            for u in urls:
                places = features(*split_url(u))
                values.append(float(weights[places].sum() / np.sqrt(max(1, len(places))) + bias))
            return [1 / (1 + np.exp(-np.array(values, float)))]

        return score

    scored = add_columns(
        pages.select(*[F.col(f"`{c}`") for c in keep], F.col(url).alias("_url_")),
        "_url_", "_score_ double", factory,
    )
    verdicts = F.lit(None).cast("string")
    for rule, verdict in rules:
        verdicts = F.when(F.col("_rule_") == rule, verdict).otherwise(verdicts)
    parts = scored.withColumns(
        {"_host_": host_column(F.col("_url_")), "_path_": path_column(F.col("_url_"))}
    ).withColumn("_rule_", rule_column(F.col("_host_"), F.col("_path_"), rules))
    model = F.when(F.col("_score_") > 0.5, "block").otherwise("allow")
    return parts.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col("_host_").alias("host"),
        F.col("_path_").alias("path"),
        F.col("_rule_").alias("rule"),
        F.coalesce(verdicts, model).alias("verdict"),
        F.col("_score_").alias("score"),
    )
