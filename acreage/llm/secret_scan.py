"""Secrets in whole texts (operator 9, SQL functions only).

Base patterns find assignments, access keys and long hexadecimal runs. Two Markov models of characters, one of random
strings and one of ordinary identifiers, score every other long run of key characters by its log-likelihood ratio. The
random model is trained on strings derived from hashes in the usual alphabets and on the values that the base patterns
find, the ordinary one on words and numbers of all documents; only transition counts reach the driver.
Texts are never shuffled: every row's spans are found where it is read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.spans import Kind, listing, located, quoted, running, tagged

_NAMED = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""
#: The contract's patterns. Shorter access keys and hexadecimal runs would be dropped and are not matched; a shorter
#: assigned value is matched first, as the contract drops it without another try.
KINDS = [
    Kind("assign", _NAMED + "++", None, f"x.value rlike {quoted('^' + _NAMED + '{6,}+$')}"),
    Kind("access", r"AKIA[A-Z0-9]{16,}+", "AKIA"),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+"),
]
#: Runs that the models score: characters of common key encodings, some letter among them (others are numbers).
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
#: What the ordinary model is trained on: whole identifiers of letters, and whole numbers.
ORDINARY = r"(?<![A-Za-z0-9])(?:[A-Za-z]{2,}+|[0-9]++)(?![A-Za-z0-9])"
#: States of the models: the candidates' characters, fixed order.
CHARACTERS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
#: Number of hash strings in each alphabet.
RANDOM_STRINGS = 4_000
#: Added to every transition count.
SMOOTHING = 0.5
#: Identifiers are joined by these; the ordinary model goes to them with this probability from any state, and from
#: them as from a start, since corpora differ in which separators they hold.
SEPARATORS, JOINED = "+/_=-", 0.1
#: A run is a secret when it is so much likelier to be random that this outweighs the odds of 10,000 to 1 against it.
THRESHOLD = math.log(10_000)
SEED = 9


def _labelled(docs: DataFrame, text_column: str, seed: int) -> DataFrame:
    """(random, word, n): labelled strings and how often each was seen."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ordinary = texts.select(F.explode(F.expr(f"regexp_extract_all(text, {quoted(ORDINARY)}, 0)")).alias("word"))
    values = located(texts, KINDS)
    found = values.select(F.explode(F.concat("at_access", "at_hex")).alias("x")).select(F.col("x.value").alias("word"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 512)
    packed = F.base64(F.unhex(digest))
    drawn = spark.range(RANDOM_STRINGS).select(F.explode(F.array(
        F.substring(digest, 1, 40), F.substring(packed, 1, 40), F.regexp_replace(F.substring(packed, 1, 80), "[+/=]", ""),
        F.regexp_replace(F.upper(F.substring(packed, 1, 60)), "[^A-Z0-9]", ""),
        F.regexp_replace(F.lower(F.substring(packed, 1, 60)), "[^a-z0-9]", ""),
        F.translate(F.substring(packed, 1, 40), "+/", "-_"),
    )).alias("word"))
    return ordinary.select(F.lit(0).alias("random"), "word").union(found.union(drawn).select(F.lit(1).alias("random"), "word")).groupBy("random", "word").agg(F.count("*").alias("n"))


def transition_scores(docs: DataFrame, text_column: str = "text", seed: int = SEED) -> list[float]:
    """Log ratio of each transition, by 1 + number of states times the state before (0 at the start) plus the state."""
    words = _labelled(docs, text_column, seed)
    pairs = words.select("random", "n", F.explode(F.expr("transform(sequence(0, length(word) - 1), i -> if(i = 0, left(word, 1), substr(word, i, 2)))")).alias("pair"))
    counts: dict[tuple[int, str], int] = {(r[0], r[1]): r[2] for r in pairs.groupBy("random", "pair").agg(F.sum("n")).collect()}
    out = []
    parts = [c for c in CHARACTERS if c not in SEPARATORS]
    for before in ("", *CHARACTERS):
        drawn = {c: counts.get((1, before + c), 0) + SMOOTHING for c in CHARACTERS}
        state = "" if before in SEPARATORS else before
        known = {c: counts.get((0, state + c), 0) + SMOOTHING for c in parts}
        for c in CHARACTERS:
            ordinary = JOINED / len(SEPARATORS) if c in SEPARATORS else (1 - JOINED) * known[c] / sum(known.values())
            out.append(math.log(drawn[c] / sum(drawn.values())) - math.log(ordinary))
    return out


def _ratio(value: Column, scores: list[float]) -> Column:
    """Log-likelihood ratio of a run, one step for each character."""
    size = len(CHARACTERS)
    states = [0] * 128
    for i, c in enumerate(CHARACTERS):
        states[ord(c)] = i
    of = F.array(*(F.lit(x) for x in states))
    table = F.array(*(F.lit(x) for x in scores))
    codes = F.transform(F.split(value, ""), lambda c: F.get(of, F.ascii(c)))
    start = F.struct(F.lit(-1).alias("before"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        codes, start,
        lambda s, c: F.struct(c.alias("before"), (s["sum"] + F.get(table, (s["before"] + 1) * size + c)).alias("sum")),
        lambda s: s["sum"],
    )


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD, seed: int = SEED) -> DataFrame:
    """(doc_id, at_assign, at_access, at_hex, at_markov) of every row.

    A null text is empty and has no spans. Repeated rows and rows with null or equal ids all come back. Very long texts
    are searched whole; runs of any length are scored whole. Empty tables give no rows (and models without evidence).
    Only the named columns are read. Model spans that start inside a base span add nothing and are left out. Counting
    transitions runs jobs while the result is built.
    """
    scores = transition_scores(docs, text_column, seed)
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = located(rows, [*KINDS, Kind("markov", CANDIDATE, None, "x.value rlike '[A-Za-z]'")]).drop("text")
    scored = rows.withColumn("at_markov", F.when(
        F.size("at_markov") > 0, F.filter("at_markov", lambda x: _ratio(x["value"], scores) >= threshold)
    ).otherwise(F.col("at_markov")))
    # In order of start, base spans first: a model span counts when it starts at or after the end of all base spans so far.
    fields = ("start", "end", "value", "left", "right")
    ordered = F.array_sort(F.concat(*(tagged(F.col(f"at_{k}"), F.lit(rank), "rank", *fields) for rank, k in enumerate(("assign", "access", "hex", "markov")))))
    scored = scored.withColumn("ordered", F.when(F.size("at_markov") > 0, ordered))
    scored = scored.withColumn("ends", F.expr("transform(ordered, x -> if(x.rank < 3, x.end, 0))"))
    scored = running(scored, "ends", "until", "greatest({}, {})".format)
    free = F.expr("filter(ordered, (x, i) -> x.rank = 3 and x.start >= until[i])")
    alone = F.when(F.size("at_markov") > 0, F.transform(free, lambda x: F.struct(*(x[f].alias(f) for f in fields)))).otherwise(F.col("at_markov"))
    return scored.withColumn("at_markov", alone).drop("ordered", "ends", "until")


def secret_digest(found: DataFrame) -> DataFrame:
    """The contract's columns; model spans are listed after the base kinds."""
    base: list[tuple[str, Column]] = [(k.name, F.col(f"at_{k.name}")) for k in KINDS]
    return found.select(
        "doc_id", *(F.size(f"at_{k.name}").cast("bigint").alias(f"n_{k.name}") for k in KINDS),
        F.sha2(listing(base), 256).alias("base_sha256"), listing([*base, ("markov", F.col("at_markov"))]).alias("spans"),
        F.size("at_markov").cast("bigint").alias("n_markov"),
    )
