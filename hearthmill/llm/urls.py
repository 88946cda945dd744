"""URL verdicts by rules and logistic regression, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# The labelled table: kinds of hosts and paths to block (1) and to allow (0).
LABELLED = [
    *[(url, 1) for url in (
        "http://casino-win.com/bonus/1", "http://www.casino-online.net/play.html", "https://best-casino.org/en/12", "http://poker-win.net/slots",
        "http://cheap-pills.com/buy/3", "http://www.cheap-pills-online.net/order", "https://pills-store.org/en/9", "http://cheap-meds.com/pills.html",
        "http://adult-x.net/video/5", "http://www.adult-xxx.com/cam", "https://m.xxx-adult.org/en/77", "http://adult-dating.net/hot",
        "http://spam-farm.org/links/8", "http://www.spam-links.com/page?id=1", "https://link-farm.net/en/40", "http://blog.spam-site.net/x",
        "http://warez-crack.com/download", "http://torrent-warez.net/keygen.html", "http://replica-watch.com/cheap", "http://payday-loan.net/cash",
        "http://free-money-win.com/click", "http://www.porn-tube.net/1.html", "http://viagra-cheap.org/pills", "http://betting-win.com/bonus",
        "http://casino-club.example.com/en/17", "https://www.win-casino.example.net/fr/52.html", "http://pills-cheap.example.org/de/8", "https://m.cheap-pills.example.net/en/301",
        "http://adult-cam.example.com/es/6", "https://blog.x-adult.example.net/en/90/", "http://spam-host.example.com/fr/23", "https://www.farm-spam.example.org/en/4?page=2",
        "http://casino-win.example.org/en/71#top", "http://spam-farm.example.net/de/15",
        "http://adult-video.example.net/en/3", "https://www.adult-x.example.org/fr/802",
    )],
    *[(url, 0) for url in (
        "http://example.com/en/12", "https://www.example.org/de/articles/7", "http://blog.example.net/fr/2020/notes.html", "https://m.example.com/es/44",
        "http://library.org/en/books/3", "https://www.university.net/research", "http://news.example.com/en/world/5?page=2", "https://museum.org/fr/9",
        "http://weather.net/today", "https://www.school.org/en/lessons/12.html", "http://docs.example.com/guide/start", "https://recipes.example.net/en/88",
        "http://theatre.com/en/100", "https://www.nation.org/en/history", "http://blog.thorn.net/de/31", "https://m.heron.com/es/5#top",
        "http://gardening.example.org/fr/tips", "https://www.travel.net/en/61?utm_source=feed", "http://science.com/en/200/", "https://health.example.org/de/77",
        "http://maps.net/en/6", "https://www.music.com/fr/13.html", "http://opensource.org/en/projects", "https://wiki.example.net/en/9",
        "http://station.example.net/en/17", "https://www.tulip.example.net/fr/52.html", "http://thistle.example.net/de/8", "https://m.stone.example.net/en/301",
        "http://blog.weather.example.net/es/6", "https://blog.nation.example.net/en/90/", "http://theory.example.com/fr/23", "https://www.thread.example.org/en/4?page=2",
        "http://motion.example.org/en/71#top", "http://other.example.net/de/15", "https://m.shore.example.net/es/651.html", "http://earth.example.com/en/5",
        "http://notion.example.net/fr/2286.html?utm_source=feed", "https://www.winter.example.com/es/66", "http://herbs.example.org/en/7207#top",
        "http://shelter.example.net/en/4636/", "https://ocean.example.net/de/4954?page=2&ref=x", "http://m.feather.example.net/fr/8592.html",
        "http://habitat.example.net/es/94", "https://www.hatter.example.net/fr/3204",
    )],
]


@dataclass(frozen=True)
class Rule:
    """Verdict for a host with all its subdomains and the paths that begin so."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Options:
    dimensions: int = 1024
    shortest: int = 3
    longest: int = 5
    epochs: int = 60
    rate: float = 0.1


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, CAPITALS, CAPITALS.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def features(options: Options, host: str = "host", path: str = "path") -> Column:
    """Hash places of the character n-grams of host and path, each once."""

    def grams(part: str) -> str:
        of = f"concat('^', {part}, '$')"
        return ", ".join(
            f"transform(sequence(1, greatest(char_length({of}) - {n - 1}, 1)), i -> cast(pmod(xxhash64('{part}', substr({of}, i, {n})), {options.dimensions}) as int))"
            for n in range(options.shortest, options.longest + 1)
        )

    return F.expr(f"array_distinct(concat({grams(host)}, {grams(path)}))")


def train(labelled: DataFrame, options: Options = Options()) -> list[float]:
    """Weights of a logistic regression, the intercept last.

    ``labelled`` has url and label (1 to block). It is a small table of a few
    thousand rows at most: gradient steps over its rows in a fixed order run
    as one fold over one row of feature vectors. Rows without url or label
    are left out; an empty table gives zero weights.
    """
    rows = labelled.filter("url is not null and label is not null").select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "url", "label")
    dims = options.dimensions
    vectors = rows.select(F.xxhash64("url").alias("h"), "url", F.col("label").cast("double").alias("y"), features(options).alias("f"))
    vectors = vectors.select("h", "url", "y", F.expr(f"transform(sequence(0, {dims}), i -> if(i = {dims} or array_contains(f, i), 1D, 0D))").alias("x"), "f")
    table = vectors.agg(F.sort_array(F.collect_list(F.struct("h", "url", "y", "x", "f"))).alias("rows"))
    score = f"aggregate(r.f, get(w, {dims}), (s, i) -> s + get(w, i))"
    step = f"transform(array({options.rate} * (r.y - 1 / (1 + exp(-{score})))), e -> zip_with(w, r.x, (a, b) -> a * 0.9999 + e * b))[0]"
    fold = f"aggregate(sequence(1, {options.epochs}), array_repeat(0D, {dims + 1}), (v, epoch) -> aggregate(rows, v, (w, r) -> {step}))"
    return list(table.select(F.expr(fold).alias("w")).first()["w"])


def rule_of(rules: Sequence[Rule], host: str = "host", path: str = "path") -> Column:
    """Name and verdict of the longest rule that fits, or null."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        same = (F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)
        named = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        fits = F.when(same & F.col(path).startswith(rule.path), named).otherwise(fits)
    return fits


def judged(pages: DataFrame, weights: Sequence[float], rules: Sequence[Rule] = RULES, options: Options = Options()) -> DataFrame:
    """pages with host, path, rule, verdict and chance (of being one to block).

    A null url or one without ``://`` has an empty host and path, fits no
    rule and is judged by the method like any other. ``rules`` is a short
    list that becomes part of the plan. Columns of pages with these names
    are replaced.
    """
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "chance")]
    cut = pages.select(*own, host_of(F.col("url").cast("string")).alias("host"), path_of(F.col("url").cast("string")).alias("path"))
    learned = F.array(*[F.lit(float(w)) for w in weights])
    intercept = F.lit(float(weights[-1]))
    logit = F.aggregate(features(options), intercept, lambda s, i: s + F.get(learned, i))
    found = cut.withColumns({"__rule": rule_of(rules), "chance": 1 / (1 + F.exp(-logit))})
    verdict = F.coalesce("__rule.verdict", F.when(F.col("chance") >= 0.5, "block").otherwise("allow"))
    return found.select(*own, "host", "path", F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), "chance")


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED, "url string, label int")
