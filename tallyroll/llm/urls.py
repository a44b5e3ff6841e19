"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lengths of n-grams in bytes, places of the hash table, steps, rate and decay of fitting.
GRAMS, PLACES = (3, 4, 5), 1 << 16
STEPS, RATE, DECAY = 400, 2.0, 1e-3
#: Fitting takes a table of at most this many labelled urls.
FIT_ROWS = 100_000

#: Labelled urls, 1 to block and 0 to allow. None has a host of the pages to be judged.
LABELLED = [
    *((u, 1) for u in """
http://casino-royal.example.com/en/12 https://www.lucky-casino.example.net/de/play
http://blog.casino-night.example.edu/fr/305 https://m.online-casino.example.info/es/8
http://bonus-bets.example.info/en/44 https://www.best-bets.example.com/fr/bonus
http://sports-bets.example.org/de/91 https://m.bets-free.example.net/es/7
http://poker-win.example.net/en/3 https://slots-jackpot.example.com/de/spin
http://adult-dating.example.info/en/17 https://www.adult-cams.example.org/fr/20
http://xxx-adult.example.com/de/5 https://m.adult-video.example.net/es/61
http://spam-mail.example.edu/en/9 https://www.link-farm.example.com/fr/1
http://content-farm.example.net/de/70 https://m.spam-links.example.org/es/13
http://diet-pills.example.info/en/50 https://www.pills-online.example.com/fr/2
http://buy-pills.example.org/de/33 https://m.cheap-meds.example.net/es/64
http://ads-click.example.edu/en/28 https://www.track-clicks.example.com/fr/19
http://ads-server.example.net/de/6 https://m.tracker-ads.example.org/es/71
http://free-prize.example.com/en/win https://www.win-lottery.example.net/fr/claim
http://free-download-crack.example.org/de/warez https://m.cheap-loans.example.com/es/apply
http://hot-singles.example.net/en/chat https://www.payday-loans.example.info/fr/cash
http://replica-watches.example.com/de/shop https://m.click-bait.example.org/es/99
http://casino.example.org/en/slots https://www.casinos-online.example.com/de/15
http://bets.example.net/fr/odds https://m.live-bets.example.org/en/27
http://adult.example.com/es/38 https://www.adult-toys.example.net/en/shop
http://spam.example.org/de/46 https://m.mail-spam.example.info/fr/54
http://pills.example.net/en/order https://www.weight-pills.example.edu/es/63
http://ads.example.com/fr/click https://m.pop-ads.example.net/de/72
""".split()),
    *((u, 0) for u in """
http://news.example.com/en/12 https://www.thenation.example.net/de/politik
http://blog.weather.example.edu/fr/305 https://m.library.example.info/es/8
http://university.example.info/en/44 https://www.history.example.com/fr/articles
http://science.example.org/de/91 https://m.theater.example.net/es/7
http://cooking.example.net/en/3 https://gardening.example.com/de/rosen
http://museum.example.info/en/17 https://www.thorne.example.org/fr/20
http://river.example.com/de/5 https://m.mountain.example.net/es/61
http://another.example.edu/en/9 https://www.lessons.example.com/fr/1
http://thinking.example.net/de/70 https://m.station.example.org/es/13
http://ocean.example.info/en/50 https://www.letters.example.com/fr/2
http://thunder.example.org/de/33 https://m.handles.example.net/es/64
http://docs.example.edu/en/28 https://www.forest.example.com/fr/19
http://wiki.example.net/de/6 https://m.author.example.org/es/71
http://school.example.com/en/news https://www.council.example.net/fr/agenda
http://health.example.org/de/arzt https://m.travel.example.com/es/hotel
http://thoughts.example.net/en/essay https://www.mathematics.example.info/fr/cours
http://motion.example.com/de/film https://m.thesis.example.org/es/99
http://music.example.org/en/album https://www.recipes.example.com/de/suppe
http://photos.example.net/fr/81 https://m.archive.example.org/en/90
http://sports.example.com/es/liga https://www.railway.example.net/en/map
http://radio.example.org/de/18 https://m.parliament.example.info/fr/29
http://bookshop.example.net/en/36 https://www.theatre-west.example.edu/es/45
http://the-herald.example.com/fr/une https://m.north-bank.example.net/de/63
http://thirty-trees.example.info/en/73 https://www.both-streets.example.com/es/82
http://this-and-that.example.org/de/93 https://m.water-truth.example.net/fr/14
http://notation.example.com/en/4 https://www.python.example.org/de/51
http://garden.example.net/fr/66 https://m.nation.example.com/es/18
""".split()),
]


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains and the start of the path, like ``example.org/en/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_of(url) -> F.Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url) -> F.Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host, path, rules: list[Rule]) -> F.Column:
    """The longest rule that fits (of equal ones the first given), as a struct of its text and verdict; else null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        best = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(best)
    return best


def _grams(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all n-grams, and the url each belongs to. Ends of host and path are marked; the two never mix."""
    parts = [x.encode("utf-8", "surrogatepass") for h, p in zip(hosts, paths, strict=True) for x in (f"\x02{h}\x03", f"\x04{p}\x05")]
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    part = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    places, owners = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        h = np.full(len(data) - n + 1, n, np.uint32)
        for i in range(n):
            h = (h ^ data[i : len(data) - n + 1 + i]) * np.uint32(16_777_619)
        inside = part[: len(h)] == part[n - 1 :]
        places.append(((h ^ (h >> np.uint32(15)))[inside] % PLACES).astype(np.int64))
        owners.append(part[: len(h)][inside] // 2)
    return (np.concatenate(places), np.concatenate(owners)) if places else (np.empty(0, int), np.empty(0, int))


def _sums(weights: np.ndarray, hosts: list[str], paths: list[str]) -> np.ndarray:
    places, owners = _grams(hosts, paths)
    count = np.maximum(np.bincount(owners, minlength=len(hosts)), 1)
    return np.bincount(owners, weights[places], len(hosts)) / np.sqrt(count)


@dataclass
class Model:
    weights: np.ndarray
    offset: float

    def blocked(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability that a url is to be blocked."""
        return 1 / (1 + np.exp(-(_sums(self.weights, hosts, paths) + self.offset)))


def fit(labelled: DataFrame) -> Model:
    """A model of ``labelled`` (``url``, ``label`` 1 to block, 0 to allow), of at most FIT_ROWS rows; more raise.

    Null urls are empty; rows without a label are left out. A table of one label or
    none gives a model that allows everything or blocks everything alike.
    """
    rows = (
        labelled.where("label in (0, 1)")
        .select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("int"))
        .limit(FIT_ROWS + 1)
        .collect()
    )
    if len(rows) > FIT_ROWS:
        raise ValueError(f"the labelled table has more than {FIT_ROWS} rows")
    rows.sort()
    label = np.array([r["label"] for r in rows], float)
    weights, offset = np.zeros(PLACES), 0.0
    if not rows or label.min() == label.max():
        return Model(weights, 10.0 if len(rows) and label[0] else -10.0)
    places, owners = _grams([r["host"] for r in rows], [r["path"] for r in rows])
    scale = 1 / np.sqrt(np.maximum(np.bincount(owners, minlength=len(rows)), 1))
    for _ in range(STEPS):
        z = np.bincount(owners, weights[places], len(rows)) * scale + offset
        d = (1 / (1 + np.exp(-z)) - label) / len(rows)
        weights -= RATE * (np.bincount(places, (d * scale)[owners], PLACES) + DECAY * weights)
        offset -= RATE * d.sum()
    return Model(weights, offset)


def judged(pages: DataFrame, rules: list[Rule], model: Model) -> DataFrame:
    """``page_id, host, path, rule, verdict, blocked_probability`` of every row of ``pages`` (``page_id``, ``url``).

    The longest rule that fits decides (``rules`` is a short list); without one the model
    does, from a half. Null urls and urls without ``://`` have an empty host and path and
    are judged by the model. Repeated rows stay; other columns are ignored; an empty
    table gives no rows.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)  # PLACES weights, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = sent.value.blocked(b.column("host").to_pylist(), b.column("path").to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], [*b.schema.names, "blocked_probability"])

    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    scored = split.mapInArrow(run, T.StructType([*split.schema, T.StructField("blocked_probability", T.DoubleType())]))
    ruled = scored.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    model_says = F.when(F.col("blocked_probability") >= 0.5, "block").otherwise("allow")
    return ruled.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", model_says).alias("verdict"), "blocked_probability",
    )
