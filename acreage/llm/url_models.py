"""URL filter by rules and by two character language models (operator 13).

Rules of hosts and paths decide the URLs they fit. What they allow and block teaches two models, one of accepted and one
of rejected URLs, which judge the URLs that no rule fits. A model is a Markov chain of variable order over the lowered
bytes of host, path and query: the distribution after the longest known context is interpolated with those after its
shorter ends, by the number of different bytes that each was followed by (Witten and Bell). The difference of the two log
likelihoods, divided by the number of bytes, is calibrated on the URLs of hosts that neither model has seen: a
logistic curve through their counts gives the probability that a rule would allow such a URL.

All URLs that a rule decides are counted, summed map-side, and all that was counted is in the models. Contexts that were
seen often against the bytes that follow them are broadcast, so many that no order can hold more than ``MODEL_ROWS`` of
these, so the broadcast is bounded whatever the input. While that is all, each URL is scored where it is read. Beyond,
the rest stays in a table: different URLs are dealt into parts of about ``PART_BYTES``, a part asks for the contexts that
it holds, each once, and meets all bytes that were seen after them; only URLs and these counts are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.shared import cut_lineage, small_batches
from acreage.llm.words import LOWER_ASCII, Texts, mix, range_hashes, slices
from acreage.session import broadcast_counted, spread

#: (verdict, host and path) of the contract, which are fixed; a rule's host ends at the first slash.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Most bytes of context; fewest occurrences of a byte after a context; most such rows of one order that are broadcast.
ORDER, SEEN, MODEL_ROWS = 6, 1, 1 << 17
#: Bytes of different URLs that are scored at once by the rows that are not; most scores that are broadcast, and their bytes.
PART_BYTES, FEW_SCORES, SCORE_BYTES = 1 << 19, 100_000, 16 << 20
#: One host in so many is kept from the models for their calibration.
HELD_OUT = 5
#: Bins of the differences, which are cut off at the limit.
BINS, LIMIT = 4096, 8.0
#: Marks before and after a URL.
FIRST, LAST = "\x02", "\x03"
SEED = 13

_SYMBOL = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x3C6EF372FE94F82B))


def _events(texts: Texts) -> tuple[np.ndarray, np.ndarray, Iterator[tuple[int, np.ndarray, np.ndarray]]]:
    """Bytes that are predicted, their texts, and of each order (order, which of them have such a context, its hash)."""
    sizes = np.diff(texts.offsets)
    owner = np.repeat(np.arange(len(texts)), sizes)
    start = np.repeat(texts.offsets[:-1], sizes)
    place = np.arange(len(texts.data))
    inner = place > start
    owner, start, place = owner[inner], start[inner], place[inner]

    def orders() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for order in range(ORDER + 1):
            at = np.flatnonzero(place - order >= start)
            yield order, at, range_hashes(texts, place[at] - order, place[at])

    return LOWER_ASCII[texts.data[place]], owner, orders()


def _counted(rows: DataFrame) -> DataFrame:
    """(context_order, context, symbol, accepted, rejected) of ``rows`` (accepted, text)."""
    names = ["context_order", "context", "symbol", "accepted", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            accepted = np.asarray(batch.column(0).cast(pa.int8())) == 1
            for low, high, texts in slices(batch.column(1)):
                symbol, owner, orders = _events(texts)
                good = accepted[low:high][owner]
                for order, at, context in orders:
                    _, first, inverse = np.unique(mix(context ^ _SYMBOL[symbol[at]]), return_index=True, return_inverse=True)
                    both = np.bincount(inverse, minlength=len(first))
                    kept = np.bincount(inverse[good[at]], minlength=len(first))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(first), order, dtype=np.int32)), pa.array(context[first].view(np.int64)),
                        pa.array(symbol[at][first].astype(np.int32)), pa.array(kept), pa.array(both - kept),
                    ], names=names)

    counts = rows.mapInArrow(run, "context_order int, context bigint, symbol int, accepted bigint, rejected bigint")
    return counts.groupBy("context_order", "context", "symbol").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted values among sorted keys, and whether they are there."""
    place = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return place, keys[place] == wanted if len(keys) else np.zeros(len(wanted), dtype=bool)


@dataclass
class Models:
    """Counts of bytes after contexts for accepted and rejected URLs: rows by key, contexts by hash, both sorted.

    ``rest`` (context, symbol, accepted, rejected) has those of all contexts that are not among them, if there are any.
    """

    keys: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    different: np.ndarray
    rest: DataFrame | None = None

    @staticmethod
    def of(context: np.ndarray, symbol: np.ndarray, counts: np.ndarray) -> Models:
        """``counts`` has a column of accepted and one of rejected URLs."""
        key = mix(context ^ _SYMBOL[symbol])
        order = np.argsort(key)
        contexts, inverse = np.unique(context, return_inverse=True)
        totals = np.stack([np.bincount(inverse, weights=c, minlength=len(contexts)) for c in counts.T], axis=1)
        different = np.stack([np.bincount(inverse, weights=c > 0, minlength=len(contexts)) for c in counts.T], axis=1)
        return Models(key[order], counts[order].astype(np.float64), contexts, totals, different)

    @property
    def complete(self) -> bool:
        """Whether both models have seen anything."""
        return len(self.counts) > 0 and bool((self.counts.sum(axis=0) > 0).all())

    def differences(self, texts: Texts, *others: Models) -> np.ndarray:
        """Log likelihood of the accepted less that of the rejected model, by byte, of each text; ``others`` hold further contexts."""
        symbol, owner, orders = _events(texts)
        chance = np.full((len(symbol), 2), 1 / 256)
        for _, every, wanted in orders:
            for held in (self, *others):
                place, known = _found(held.contexts, wanted)
                at, place, context = every[known], place[known], wanted[known]
                row, seen = _found(held.keys, mix(context ^ _SYMBOL[symbol[at]]))
                count = np.where(seen[:, None], held.counts[row], 0.0)
                total, different = held.totals[place], held.different[place]
                # A context that one model has not seen leaves that model's distribution as it is.
                mixed = (count + different * chance[at]) / np.maximum(total + different, 1)
                chance[at] = np.where(total > 0, mixed, chance[at])
        ratio = np.log(chance[:, 0]) - np.log(chance[:, 1])
        return np.bincount(owner, weights=ratio, minlength=len(texts)) / np.maximum(np.bincount(owner, minlength=len(texts)), 1)


def _arrays(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, symbols and counts of rows (context, symbol, accepted, rejected)."""
    context, symbol, good, bad = (c.to_numpy() for c in rows.select(["context", "symbol", "accepted", "rejected"]).columns)
    return context.view(np.uint64), symbol, np.stack([good, bad], axis=1)


def _fitted(rows: DataFrame) -> Models:
    """Models of ``rows`` (accepted, text); what is not broadcast is their ``rest``."""
    counts = cut_lineage(_counted(rows))
    n = F.col("accepted") + F.col("rejected")
    total = counts.where("context_order = 0").agg(F.sum(n)).first()[0] or 0
    least = max(SEEN, -(-total // MODEL_ROWS))
    rest = None
    if least > 1:
        # So often for each byte that follows: the rows of an order are at most the bytes of all URLs divided by that.
        often = counts.groupBy("context").agg(((F.sum(n) >= F.count(F.lit(1)) * least) | (F.max("context_order") == 0)).alias("often"))
        counts = cut_lineage(counts.join(often, "context"))
        rest, counts = counts.where("not often"), counts.where("often")
        if rest.isEmpty():
            rest = None
    return replace(Models.of(*_arrays(counts.select("context", "symbol", "accepted", "rejected").toArrow())), rest=rest)


def logistic(place: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and height of the curve through counts at places, both classes weighing alike, targets drawn in as by Platt."""
    if not good.sum() or not bad.sum():
        return 1.0, 0.0
    targets = np.array([(good.sum() + 1) / (good.sum() + 2), 1 / (bad.sum() + 2)])
    weights = np.concatenate([good / good.sum(), bad / bad.sum()])
    x, t = np.concatenate([place, place]), np.repeat(targets, len(place))
    line = np.zeros(2)

    def loss(line: np.ndarray) -> float:
        z = line[0] * x + line[1]
        return float((weights * (np.logaddexp(0, z) - t * z)).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(line[0] * x + line[1], -500, 500)))
        slope = np.array([(weights * (p - t) * x).sum(), (weights * (p - t)).sum()])
        bend = weights * p * (1 - p)
        square = np.array([[(bend * x * x).sum(), (bend * x).sum()], [(bend * x).sum(), bend.sum()]]) + 1e-9 * np.eye(2)
        step, size = np.linalg.solve(square, slope), 1.0
        while loss(line - size * step) > loss(line) and size > 1e-6:
            size /= 2
        line = line - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(line[0]), float(line[1])


def _rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Number of the longest rule that fits; of equally long ones the first."""
    fits = []
    for number in sorted(range(len(rules)), key=lambda k: (-len(rules[k][1]), k)):
        name, _, rest = rules[number][1].partition("/")
        start = rules[number][1][len(name) :]
        fits.append(F.when(((host == name) | host.endswith(f".{name}")) & path.startswith(start), number))
    return F.coalesce(*fits, F.lit(None)).cast("int")


def _parsed(url: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(host, path, rule, text) of a URL; text is what the models read, without the part after ``#``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    named = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(named) + F.lit(1)), "^[^?#]*", 0)
    host = F.translate(named, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = F.regexp_extract(F.when(at > 0, rest).otherwise(url), "^[^#]*", 0)
    return F.struct(host.alias("host"), path.alias("path"), _rule(host, path, rules).alias("rule"), F.concat(F.lit(FIRST), text, F.lit(LAST)).alias("text"))


def _scorer(rows: DataFrame, models: Models):
    shared = rows.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        parts = [shared.value.differences(texts) for _, _, texts in slices(text)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scored


def _scores(urls: DataFrame, models: Models) -> DataFrame:
    """(text, difference) of the different texts of ``urls``, by models with a ``rest``; written."""
    shared = urls.sparkSession.sparkContext.broadcast(replace(models, rest=None))
    texts = cut_lineage(urls.select("text").distinct())
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    texts = texts.select(F.pmod(F.xxhash64("text"), F.lit(size // PART_BYTES + 1)).alias("part"), "text")

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The contexts of a part that are not broadcast, once for each batch."""
        for batch in batches:
            part = np.asarray(batch.column(0))
            for low, high, whole in slices(batch.column(1)):
                _, owner, orders = _events(whole)
                of = part[low:high][owner]
                for _, at, context in orders:
                    open_ = ~_found(shared.value.contexts, context)[1]
                    of_open, context = of[at][open_], context[open_]
                    first = np.unique(mix(context ^ mix(of_open.astype(np.uint64))), return_index=True)[1]
                    yield pa.RecordBatch.from_arrays([pa.array(of_open[first]), pa.array(context[first].view(np.int64))], names=["part", "context"])

    def judged(given: pa.Table, met: pa.Table) -> pa.Table:
        context, symbol, counts = _arrays(met)
        first = np.unique(mix(context ^ _SYMBOL[symbol]), return_index=True)[1]  # batches of a part may have asked for the same
        rarer = Models.of(context[first], symbol[first], counts[first])
        found = [shared.value.differences(whole, rarer) for _, _, whole in slices(given["text"])]
        return pa.table({"text": given["text"], "difference": np.concatenate(found)})

    wanted = spread(texts, "part").sortWithinPartitions("part").mapInArrow(asked, "part bigint, context bigint")
    met = wanted.join(models.rest, "context").select("part", "context", "symbol", "accepted", "rejected")
    return cut_lineage(texts.groupBy("part").cogroup(met.groupBy("part")).applyInArrow(judged, "text string, difference double"))


def _judged(pages: DataFrame, url_column: str, rules: Sequence[tuple[str, str]], seed: int, name: str) -> DataFrame:
    """``pages`` with a column ``name`` of (host, path, rule, verdict, p_allow)."""
    urls = pages.select(_parsed(F.col(url_column), rules).alias("u")).select("u.*")
    allowed = F.array(*(F.lit(verdict == "allow") for verdict, _ in rules)) if rules else F.array(F.lit(True))
    taught = urls.where("rule is not null").select(
        F.get(allowed, F.col("rule")).alias("accepted"), "text", (F.pmod(F.xxhash64("host", F.lit(seed)), F.lit(HELD_OUT)) == 0).alias("held")
    )
    models = _fitted(small_batches(taught.where("not held").select("accepted", "text")))
    rows = pages.withColumn(name, _parsed(F.col(url_column), rules))
    margin = F.lit(None).cast("double")
    asked = taught.where("held")
    if models.complete:
        if models.rest is None:
            score = _scorer(pages, models)
            asked, difference = asked.withColumn("difference", score("text")), score(F.col(name)["text"])
        else:
            scores = _scores(urls, models)
            asked, difference = asked.join(scores, "text"), F.col(f"{name}_d")
            # Pages are not shuffled for a few scores.
            scores = broadcast_counted(scores.toDF(f"{name}_t", f"{name}_d"), FEW_SCORES, SCORE_BYTES)
            rows = rows.join(scores, F.col(name)["text"] == F.col(f"{name}_t"), "left")
        width = 2 * LIMIT / BINS
        near = F.least(F.greatest(F.floor((F.col("difference") + LIMIT) / width), F.lit(0)), F.lit(BINS - 1)).cast("int")
        bins = asked.select("accepted", near.alias("bin")).groupBy("accepted", "bin").count().collect()
        counts = np.zeros((2, BINS))
        for accepted, place, n in bins:
            counts[int(accepted), place] = n
        slope, height = logistic(-LIMIT + (np.arange(BINS) + 0.5) * width, counts[1], counts[0])
        margin = slope * difference + height
    rows = rows.withColumn(name, F.struct(
        F.col(name)["host"].alias("host"), F.col(name)["path"].alias("path"), F.col(name)["rule"].alias("rule"), margin.alias("margin")
    )).drop(f"{name}_t", f"{name}_d")
    x = F.col(name)
    ruled = F.get(F.array(*(F.lit(v) for v, _ in rules)), x["rule"]) if rules else F.lit(None).cast("string")
    said = F.get(F.array(*(F.lit(r) for _, r in rules)), x["rule"]) if rules else F.lit(None).cast("string")
    verdict = F.coalesce(ruled, F.when(x["margin"] < 0, "block").otherwise("allow"))
    return rows.withColumn(name, F.struct(
        x["host"].alias("host"), x["path"].alias("path"), said.alias("rule"), verdict.alias("verdict"), (1 / (1 + F.exp(-x["margin"]))).alias("p_allow")
    ))


def judged_urls(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", rules: Sequence[tuple[str, str]] = RULES, seed: int = SEED) -> DataFrame:
    """(page_id, host, path, rule, verdict, p_allow) of every row; rule is null and the models judge where no rule fits.

    A null URL is an empty one; without ``://`` host and path are empty, and the models read the whole. Repeated rows are
    judged alike and teach as often as they are given. Without rules, or without URLs that rules allow and URLs that they block
    among those that teach, every other URL is allowed and p_allow is null; a URL as likely under both models is allowed.
    Very long URLs are read whole. Empty tables give no rows. Only the named columns are read. ``rules`` are part of the
    plan and meant to be few. Counting and calibration run jobs while the result is built.
    """
    rows = pages.select(F.col(id_column).cast("bigint").alias("page_id"), F.col(url_column).alias("url"))
    return _judged(rows, "url", rules, seed, "x").select("page_id", "x.*")


def allowed_pages(pages: DataFrame, url_column: str = "url", rules: Sequence[tuple[str, str]] = RULES, seed: int = SEED) -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with all their columns; only URLs reach Python."""
    name = uuid.uuid4().hex  # no given column has such a name
    return _judged(pages, url_column, rules, seed, name).where(F.col(name)["verdict"] == "allow").drop(name)
